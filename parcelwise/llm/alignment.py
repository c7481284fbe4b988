"""Alignment of two tokenizers over the same bytes, and how often their tokens meet.

Each text is encoded twice; token ends become byte offsets.  Inside a task everything between
the encoders and the digests is Arrow: token lists are flattened, ends are cumulative sums
restarted at every document, and a full outer hash join on (document, end) gives the segments
between neighbouring ends.  A segment lies in exactly one token of either side, so segments
are the links; an end of both sides closes a group.

Spark merges the counts: tasks write, for every slice of documents, the links of each document
and how many of its documents hold an id pair.  The pairs of all slices are summed, compared
with the best of their left id, and travel back to their slices as one row a slice and pair,
so a pair that every document holds costs one row a slice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

BATCH = 2_000_000  # characters aligned at once; a longer text comes alone
SLICE = 1_000_000  # (document, pair) entries after which a slice ends
STEP = 65_536  # pairs of a slice in one row
END_BITS = 40  # of a key (document, end)

#: Rows of documents (`held` entries each, in `codes` and `links`) and rows of `pairs`.
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_many = pa.list_(pa.int64())
SLICES = pa.schema([
    ("slice", pa.int64()), ("doc_id", _many), *[(c, _many) for c in COUNTS],
    ("groups_sha256", pa.list_(pa.string())), ("held", _many), ("codes", pa.binary()),
    ("links", pa.binary()),
    ("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("docs", pa.int64())])))])
RESULT = pa.schema([
    (c, pa.int64()) for c in ("doc_id", *COUNTS, "n_best", "count_sum")]
    + [("groups_sha256", pa.string())])


# --- the two vocabularies -----------------------------------------------------
class Side:
    """encode(texts) -> lists of ids; token[id] its bytes."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], token: list[bytes]):
        self.encode = encode
        self.token = pa.array(token, pa.large_binary())
        self.size = pa.array([len(t) for t in token], pa.int64())


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in
    order, as the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@cache
def byte_level(path: str, pattern: str) -> Side:
    """A byte-level BPE vocabulary file; its ids are merge ranks, and a space goes before the
    text.  Strings of special tokens are text."""
    import tiktoken
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)
    special = {t["content"] for t in entries["added_tokens"]}
    byte = byte_of_char()
    ranks = {bytes(byte[c] for c in t): i for t, i in entries["model"]["vocab"].items()
             if t not in special}
    token = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        token[i] = t
    coder = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks,
                              special_tokens={})
    return Side(lambda texts: [coder.encode_ordinary(" " + t) for t in texts], token)


@cache
def pieces(path: str) -> Side:
    """A sentencepiece model with byte fallback; the model adds the space."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, model.id_to_piece(i)) for i in range(model.vocab_size()))]
    return Side(lambda texts: model.encode(texts, num_threads=1), token)


# --- one batch of documents ---------------------------------------------------
def id_lists(rows: list[list[int]]) -> pa.LargeListArray:
    offsets = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(rows), np.int64, int(offsets[-1]))
    return pa.LargeListArray.from_arrays(offsets, flat)


def joined(lists: pa.LargeListArray, strings: pa.Array) -> pa.Array:
    """The strings that the ids of each list stand for, put together."""
    parts = pa.LargeListArray.from_arrays(
        lists.offsets, strings.take(lists.flatten()))
    return pc.binary_join(parts, pa.scalar(b"", strings.type))


def end_keys(lists: pa.LargeListArray, side: Side) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(ids, documents, keys) of the tokens; a key is the document and the token's end."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    run = pc.cumulative_sum(side.size.take(ids))
    # What ran before a document's first token, for each document.
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), run]),
                     lists.offsets.slice(0, len(lists)))
    end = pc.subtract(run, before.take(doc))
    return ids, doc, pc.add(pc.shift_left(doc, pa.scalar(END_BITS, pa.int64())), end)


def segments(a: pa.LargeListArray, b: pa.LargeListArray, left: Side,
             right: Side) -> pa.Table:
    """Sorted by key: the tokens that cover each segment, and whether they end with it."""
    ids_a, _, keys_a = end_keys(a, left)
    ids_b, _, keys_b = end_keys(b, right)
    both = pa.table({"key": keys_a, "a": ids_a}).join(
        pa.table({"key_b": keys_b, "b": ids_b}), "key", "key_b", "full outer",
        coalesce_keys=True, use_threads=False)
    both = both.take(pc.sort_indices(both["key"])).combine_chunks()
    return pa.table({
        "doc": pc.shift_right(both["key"], pa.scalar(END_BITS, pa.int64())),
        "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
        "a_ends": pc.is_valid(both["a"]), "b_ends": pc.is_valid(both["b"])})


@cache
def shown_ids(size_a: int, size_b: int) -> pa.Array:
    """Decimal ids with what follows them: left ids a comma or bar, right ids a comma,
    semicolon or nothing."""
    return pa.array([f"{i}{s}" for i in range(size_a) for s in ",|"]
                    + [f"{i}{s}" for i in range(size_b) for s in (",", ";", "")],
                    pa.large_string())


def group_digests(found: pa.Table, n: int, n_tokens: np.ndarray, left: Side,
                  right: Side) -> list[str]:
    """SHA-256 of `a1,a2|b1;a3|b2` for each of n documents; '' for those without tokens."""
    doc = found["doc"].to_numpy()
    a_ends, b_ends = found["a_ends"].to_numpy(), found["b_ends"].to_numpy()
    cut = a_ends & b_ends
    group = np.cumsum(cut) - cut
    total = int(cut.sum())
    rows_a, rows_b = np.flatnonzero(a_ends), np.flatnonzero(b_ends)
    in_a, in_b = (np.bincount(group[r], minlength=total) for r in (rows_a, rows_b))
    # A token comes after all tokens of its side before it and the other side's earlier groups.
    at_a = np.arange(len(rows_a)) + (np.cumsum(in_b) - in_b)[group[rows_a]]
    at_b = np.arange(len(rows_b)) + np.cumsum(in_a)[group[rows_b]]
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else cut
    code = np.empty(len(rows_a) + len(rows_b), np.int64)
    code[at_a] = found["a"].to_numpy()[rows_a] * 2 + cut[rows_a]
    code[at_b] = 2 * len(left.token) + found["b"].to_numpy()[rows_b] * 3 \
        + cut[rows_b] + last[rows_b]
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(n_tokens, out=offsets[1:])
    shown = joined(pa.LargeListArray.from_arrays(offsets, code),
                   shown_ids(len(left.token), len(right.token)))
    return [hashlib.sha256(s.as_buffer()).hexdigest() if c else ""
            for s, c in zip(shown, n_tokens)]


def align(texts: pa.Array, left: Side, right: Side) -> tuple[dict, pa.Table]:
    """Per document counts and digests, and a table (doc, pair, links) of its id pairs."""
    words = texts.to_pylist()
    a, b = id_lists(left.encode(words)), id_lists(right.encode(words))
    whole = pa.array([b" " + w.encode() for w in words], pa.large_binary())
    good = pc.and_(pc.equal(joined(a, left.token), whole), pc.equal(joined(b, right.token), whole))
    good = pc.and_(good, pc.not_equal(texts, "")).to_numpy(zero_copy_only=False)
    none = pa.scalar([], a.type)
    a, b = (pc.if_else(pa.array(good), x, none) for x in (a, b))
    found = segments(a, b, left, right)
    n = len(words)
    doc = found["doc"].to_numpy()
    cut = found["a_ends"].to_numpy() & found["b_ends"].to_numpy()
    n_a, n_b = (pc.list_value_length(x).to_numpy().astype(np.int64) for x in (a, b))
    per_doc = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc[cut], minlength=n),
               "n_links": np.bincount(doc, minlength=n),
               "groups_sha256": group_digests(found, n, n_a + n_b, left, right)}
    pair = pc.add(pc.multiply(found["a"], len(right.token)), found["b"])
    held = pa.table({"doc": found["doc"], "pair": pair}) \
        .group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return per_doc, held.rename_columns(["doc", "pair", "links"]).sort_by("doc")


# --- slices of documents --------------------------------------------------------
def code_type(left: Side, right: Side) -> str:
    return "<u4" if len(left.token) * len(right.token) < 2 ** 32 else "<i8"


def batches(docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where BATCH characters are reached."""
    for batch in docs:
        size = pc.cumulative_sum(pc.utf8_length(batch.column(1)).cast(pa.int64())).to_numpy()
        start = 0
        while start < len(size):
            done = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, done + BATCH, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def one_row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([values.get(f.name)], f.type) for f in SLICES], schema=SLICES)


def slices(docs: DataFrame, sides: Callable[[], tuple[Side, Side]]) -> DataFrame:
    """SLICES of (id, text) rows.  A slice stays inside a task, its number holds the task's."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = sides()
        number, entries, partial = TaskContext.get().partitionId() << 32, 0, []

        def merged() -> Iterator[pa.RecordBatch]:
            counts = pa.concat_tables(partial).group_by("pair", use_threads=False) \
                .aggregate([("docs", "sum")]).rename_columns(["pair", "docs"]).to_struct_array()
            for start in range(0, len(counts), STEP):
                part = counts.slice(start, STEP)
                part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
                yield one_row(slice=number, pairs=part.to_pylist())

        for batch in batches(given):
            per_doc, held = align(batch.column(1), left, right)
            yield one_row(
                slice=number, doc_id=batch.column(0).to_pylist(),
                groups_sha256=per_doc["groups_sha256"],
                **{c: per_doc[c].tolist() for c in COUNTS},
                held=np.bincount(held["doc"].to_numpy(), minlength=len(batch)).tolist(),
                codes=held["pair"].to_numpy().astype(code_type(left, right)).tobytes(),
                links=held["links"].to_numpy().astype("<u4").tobytes())
            partial.append(held.group_by("pair", use_threads=False).aggregate(
                [([], "count_all")]).rename_columns(["pair", "docs"]))
            entries += len(held)
            if entries >= SLICE:
                yield from merged()
                number, entries, partial = number + 1, 0, []
        if partial:
            yield from merged()

    return docs.mapInArrow(run, from_arrow_schema(SLICES))


def finish(kind: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Documents of a slice with the counts of its pairs."""

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        pair, count, best = (known[c].to_numpy() for c in ("pair", "count", "best"))
        done = []
        for row in docs.to_pylist():
            at = np.searchsorted(pair, np.frombuffer(row["codes"], kind))
            links = np.frombuffer(row["links"], "<u4").astype(np.int64)
            edge = np.append(0, np.cumsum(row["held"]))

            def total(x: np.ndarray) -> np.ndarray:
                run = np.append(0, np.cumsum(x))
                return run[edge[1:]] - run[edge[:-1]]

            done.append(pa.table({
                **{c: row[c] for c in ("doc_id", "groups_sha256", *COUNTS)},
                "n_best": total(links * best[at]), "count_sum": total(links * count[at])}
            ).select(RESULT.names).cast(RESULT))
        return pa.concat_tables(done) if done else RESULT.empty_table()

    return run


def meetings(docs: DataFrame, save: Callable[[DataFrame, str], DataFrame],
             sides: Callable[[], tuple[Side, Side]], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Align both sides' tokens of every text and count how many documents hold an id pair.

    Defined cases: a null or empty text, and one whose tokens of either side do not spell a
    space and the text, has no tokens: zeros and an empty digest; null and repeated ids are
    documents of their own, as are repeated rows; an empty table gives no rows; other columns
    are ignored.  A very long text is aligned alone, in memory for its tokens.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    left, right = sides()
    kept = save(slices(rows, sides), "slices")
    pairs = kept.where("pairs is not null").select("slice", F.inline("pairs"))
    a = F.expr(f"pair div {len(right.token)}L")
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count")) \
        .withColumn("best", (F.col("count") == F.max("count").over(Window.partitionBy(a)))
                    .cast("long"))
    known = pairs.select(F.col("slice").alias("of"), "pair").join(counts, "pair")
    return kept.where("pairs is null").drop("pairs").groupBy("slice").cogroup(
        known.groupBy("of")).applyInArrow(
            finish(code_type(left, right)), from_arrow_schema(RESULT))
