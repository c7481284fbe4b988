"""Ranked lexical search: bundles of items visit the owners of terms one after the other.

Documents are dealt into slices and terms to OWNERS owners; a row of the stored index holds
what one owner has of one slice.  Items travel in bundles.  In round r bundle b is at owner
(b + r) mod OWNERS, so every owner works in every round, and a cogroup brings the bundle's
accumulators for a slice together with the owner's postings of that slice.  Accumulators are
sparse: (item, document, score) for documents that hold a term of the item so far.  The owner
adds integer contributions; the bundle moves on.  After the last owner each slice has its
exact scores and selects its best documents; the best of all slices are the result.

Every key of a shuffle is (owner, slice), with at most SLICE_DOCS documents and about
SLICE_POSTINGS postings behind it, so neither a term that every document holds nor a popular
item gathers in one task.  Terms that no item asks for are dropped at the scan by a bitmap of
2**MAP_BITS hashes, the only thing that is broadcast; what it lets through by chance meets no
item later.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import from_arrow_schema

OWNERS = 4
BUNDLE = 64  # items in a bundle, about
SLICE_DOCS = 8192
SLICE_POSTINGS = 2_000_000
SPREAD = 64  # copies of a bundle's terms, dealt over its slices
MAP_BITS = 20
KNOWN = 1_000_000  # terms whose owner a task remembers
SEED = 42  # of Spark's xxhash64

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

_ints = pa.list_(pa.int64())
#: What an owner has of a slice: its documents and their lengths, and its terms with the
#: number of documents (`held`), positions (u2) and frequencies (u4) of each.
INDEX = pa.schema([
    ("owner", pa.int64()), ("slice", pa.int64()), ("doc_ids", _ints), ("lengths", _ints),
    ("terms", pa.list_(pa.string())), ("held", _ints), ("docs", pa.binary()),
    ("tfs", pa.binary())])
_asked = pa.list_(pa.struct([
    ("item", pa.int64()), ("term", pa.string()), ("weight", pa.int64())]))
#: A bundle between two owners: its items' terms and, item by item in ascending order,
#: `held` accumulators.
TRAVELLER = pa.schema([
    ("bundle", pa.int64()), ("slice", pa.int64()), ("asked", _asked), ("held", _ints),
    ("docs", pa.binary()), ("scores", pa.binary())])
FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


def terms(text: Column) -> Column:
    """array<string>: the same terms, by Spark's functions."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), 0)


def one_row(schema: pa.Schema, **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([values[f.name]], f.type) for f in schema], schema=schema)


# --- the index ------------------------------------------------------------------
class Owners(dict):
    """term -> its owner, or -1 if no item has a term of that hash."""

    def __init__(self, asked: np.ndarray):
        super().__init__()
        self.asked = asked

    def __missing__(self, term: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        h = xxhash.xxh64_intdigest(term, SEED)
        self[term] = owner = (h >> 32) % OWNERS if self.asked[h & (1 << MAP_BITS) - 1] else -1
        return owner


def asked_hashes(wanted: DataFrame) -> np.ndarray:
    """Whether a term of `wanted` has a hash with these low bits: at most 2**MAP_BITS bits
    reach the driver."""
    at = F.xxhash64("term").bitwiseAND(F.lit((1 << MAP_BITS) - 1)) + 1
    rows = wanted.groupBy(F.bitmap_bucket_number(at).alias("n")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(1 << MAP_BITS, bool)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        start = (r["n"] - 1) * len(bits)
        out[start:start + len(bits)] |= bits[:len(out) - start].astype(bool)
    return out


def index(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """INDEX rows of (id, text); every slice has a row for each owner."""
    asked = np.packbits(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = Owners(np.unpackbits(asked).astype(bool))
        number = TaskContext.get().partitionId() << 32
        ids, lengths, size = [], [], 0
        postings = [{} for _ in range(OWNERS)]

        def rows() -> Iterator[pa.RecordBatch]:
            for owner, own in enumerate(postings):
                yield one_row(
                    INDEX, owner=owner, slice=number, doc_ids=ids, lengths=lengths,
                    terms=[t.decode() for t in own], held=[len(d) for d, _ in own.values()],
                    docs=b"".join(d.tobytes() for d, _ in own.values()),
                    tfs=b"".join(n.tobytes() for _, n in own.values()))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                at = len(ids)
                ids.append(doc_id)
                lengths.append(len(words))
                for term, n in Counter(words).items():
                    owner = owners[term]
                    if owner >= 0:
                        own = postings[owner]
                        if term not in own:
                            own[term] = array("H"), array("I")
                        places, counts = own[term]
                        places.append(at)
                        counts.append(n)
                        size += 1
                if len(ids) == SLICE_DOCS or size >= SLICE_POSTINGS:
                    yield from rows()
                    number, ids, lengths, size = number + 1, [], [], 0
                    postings = [{} for _ in range(OWNERS)]
        if ids:
            yield from rows()

    return docs.mapInArrow(run, from_arrow_schema(INDEX))


# --- one visit --------------------------------------------------------------------
def visit(n_docs: int, n_terms: int, top: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Add an owner's contributions to the bundles that are there.

    Gives TRAVELLER rows, or with `top` the best documents of each item in the slice."""

    def score(bundle: dict, own: dict, lengths: np.ndarray) -> tuple[list, np.ndarray]:
        items = sorted({a["item"] for a in bundle["asked"]}, key=lambda i: (i is None, i or 0))
        row_of = {i: r for r, i in enumerate(items)}
        total = np.zeros((len(items), len(lengths)), np.int64)
        rows = np.repeat(np.arange(len(items)), bundle["held"] or [0] * len(items))
        total[rows, np.frombuffer(bundle["docs"], "<u2")] = np.frombuffer(bundle["scores"], "<i8")
        edge = np.append(0, np.cumsum(own["held"]))
        at = {t: (a, b) for t, a, b in zip(own["terms"], edge[:-1], edge[1:])}
        docs, tfs = np.frombuffer(own["docs"], "<u2"), np.frombuffer(own["tfs"], "<u4")
        m = 100 - 25 + (25 * lengths * n_docs) // n_terms
        part = {}
        for a in bundle["asked"]:
            if a["term"] not in at:
                continue
            if a["term"] not in part:
                span = slice(*at[a["term"]])
                tf = tfs[span].astype(np.int64)
                part[a["term"]] = docs[span], 1_000_000_000 * tf // (1000 * tf + 12 * m[docs[span]])
            where, by = part[a["term"]]
            total[row_of[a["item"]], where] += a["weight"] * by
        return items, total

    def best(items: list, total: np.ndarray, ids: list) -> pa.Table:
        null = np.array([i is None for i in ids])
        key = np.array([0 if i is None else i for i in ids], np.int64)
        out = {f.name: [] for f in FOUND}
        for item, scores in zip(items, total):
            at = np.flatnonzero(scores > 0)
            if len(at) > top:
                at = at[scores[at] >= np.partition(scores[at], len(at) - top)[len(at) - top]]
            at = at[np.lexsort((key[at], null[at], -scores[at]))][:top]
            out["item"] += [item] * len(at)
            out["doc_id"] += [ids[k] for k in at]
            out["score"] += scores[at].tolist()
        return pa.table(out, schema=FOUND)

    def run(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        schema = TRAVELLER if top is None else FOUND
        if not owned.num_rows:
            return schema.empty_table()
        own, = owned.to_pylist()
        lengths = np.array(own["lengths"], np.int64)
        done = [schema.empty_table()]
        for bundle in bundles.to_pylist():
            items, total = score(bundle, own, lengths)
            if top is not None:
                done.append(best(items, total, own["doc_ids"]))
                continue
            rows, docs = np.nonzero(total)
            done.append(pa.Table.from_batches([one_row(
                TRAVELLER, bundle=bundle["bundle"], slice=bundle["slice"], asked=bundle["asked"],
                held=np.bincount(rows, minlength=len(items)).tolist(),
                docs=docs.astype("<u2").tobytes(),
                scores=total[rows, docs].astype("<i8").tobytes())]))
        return pa.concat_tables(done)

    return run


# --- the search -------------------------------------------------------------------
def search(docs: DataFrame, items: DataFrame, save: Callable[[DataFrame, str], DataFrame],
           top: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest scores above 0 of each item.

    Defined cases: a null or empty text holds no term; it is not counted as a document of the
    statistics and not found.  Rows that share an item id (nulls share one) are one item with
    the terms of all; an item without terms finds nothing.  Rows that share a document id are
    documents of their own; equal scores are ranked by ascending document id, null last.
    Empty tables give no rows; other columns are ignored.
    """
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item"),
                         F.explode(terms(F.col(f"`{query_col}`"))).alias("term")) \
        .groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats"))
    asked = save(asked, "asked")
    number = F.when(F.col("item").isNull(), F.lit(True))
    n_items = asked.agg((F.count_distinct("item") + F.coalesce(F.max(number).cast("long"), F.lit(0)))
                        .alias("n")).first()["n"]
    lanes = max(1, -(-n_items // (BUNDLE * OWNERS)))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    owned = save(index(rows, asked_hashes(asked.select("term"))), "index")

    stats = owned.where("owner = 0").agg(
        F.sum(F.size(F.filter("lengths", lambda n: n > 0))),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    n_docs, n_terms = (x or 0 for x in stats)
    df = owned.select(F.inline(F.arrays_zip("terms", "held"))) \
        .groupBy(F.col("terms").alias("term")).agg(F.sum("held").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    bundle = F.pmod(F.xxhash64(F.coalesce("item", F.lit(-1))), F.lit(lanes * OWNERS))
    bundles = save(
        asked.join(df, "term").withColumn("weight", weight * F.col("repeats"))
        .groupBy(bundle.cast("long").alias("bundle"))
        .agg(F.collect_list(F.struct("item", "term", "weight")).alias("asked")), "bundles")

    salted = bundles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    moving = owned.where("owner = 0").select(
        "slice", F.explode(F.expr(f"sequence(0L, {lanes * OWNERS - 1}L)")).alias("bundle"),
        F.pmod(F.xxhash64("slice"), F.lit(SPREAD)).cast("int").alias("salt")) \
        .join(salted, ["bundle", "salt"]).select(
            "bundle", "slice", "asked", F.array().cast("array<long>").alias("held"),
            F.lit(b"").alias("docs"), F.lit(b"").alias("scores"))
    # An owner's row is there once for each lane, so a visit has one bundle.
    owned = owned.select(
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("its_lane"),
        F.col("owner").alias("its_owner"), F.col("slice").alias("its_slice"),
        "doc_ids", "lengths", "terms", "held", "docs", "tfs")
    for turn in range(OWNERS):
        last = turn == OWNERS - 1
        at = moving.withColumn("lane", F.expr(f"cast(bundle div {OWNERS} as int)")) \
            .withColumn("owner", F.pmod(F.col("bundle") + turn, F.lit(OWNERS)).cast("long"))
        moving = at.groupBy("lane", "owner", "slice").cogroup(
            owned.groupBy("its_lane", "its_owner", "its_slice")).applyInArrow(
            visit(n_docs, n_terms, top if last else None),
            from_arrow_schema(FOUND if last else TRAVELLER))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return moving.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
