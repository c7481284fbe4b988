"""Removal of repeated byte passages by column-wise suffix sorting.

A byte goes if a string of LENGTH bytes that covers it also starts earlier (smaller id, or
same document and earlier start).

A collection-wide insertion of one symbol per document and round would take as many passes
over all data as the longest document has bytes.  So the collection is cut first, without
losing a string: in every string of LENGTH bytes the q-gram with the lowest hash is its
anchor, and a string that repeats has the same anchor at the same place.  A fragment is an
anchor with all the bytes that strings with this anchor can reach.

1. Equal fragments are reduced to their first occurrence, inside each batch and then over
   all data; every other occurrence is covered as a whole.
2. First occurrences whose anchor also stands in a different fragment get their bytes.
3. The fragments of an anchor are aligned and sorted column by column from the right: each
   round inserts one symbol of every fragment, which permutes the order of the last round
   (the column read in that order is the round's Burrows-Wheeler transform) and updates the
   common prefixes by range minima.  The columns lie in a file that is read once, in
   sequence.  Where a common prefix has LENGTH symbols, all but the earliest go.

Anchors with very many different fragments are spread over tasks by a salt while they are
reduced and in pairs of tiles while they are sorted.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .minhash import NO_ID
from .names import free
from .words import INVERSE, U, mix, powers, prefix_sums

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM  # bytes before an anchor that its strings can reach
WIDTH = REACH + LENGTH
CHUNK = 1 << 20
TIE = 31  # bits of a place below those of the text's hash; no text has more bytes
FEW = 1 << 40  # numbers below all ids, for texts without one
TILE = 4096
SALTS = 64
HEAVY = 16  # different fragments of an anchor in a batch that make it a candidate for salts
MOST_HEAVY = 10_000
PAD = 0xFF  # not in UTF-8
Save = Callable[[DataFrame, str], DataFrame]


def sliding(values: np.ndarray, width: int, better) -> np.ndarray:
    """better() over each run of `width` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = better(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return better(out[:len(out) - rest], out[rest:]) if rest else out


def anchors_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int = 0,
               last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in data, anchor hash, fragment hash) of joined documents; only
    strings that start in [first, last) count."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    mark = np.zeros(n + 1, np.int32)
    full = ends - starts >= LENGTH
    np.add.at(mark, starts[full], 1)
    np.add.at(mark, ends[full] - LENGTH + 1, -1)
    valid = np.cumsum(mark)[:n - LENGTH + 1] > 0
    valid[:first] = False
    if last is not None:
        valid[last:] = False
    sums = prefix_sums(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(INVERSE, n + 1)[:n - GRAM + 1])
    lowest = np.where(valid, sliding(grams, REACH + 1, np.minimum), U(0))
    edge = np.zeros(REACH, U)
    highest = sliding(np.concatenate([edge, lowest, edge]), REACH + 1, np.maximum)
    at = np.flatnonzero((highest == grams) & (highest > 0))
    doc = np.searchsorted(starts, at, side="right") - 1
    a, b = np.maximum(at - REACH, starts[doc]), np.minimum(at + LENGTH, ends[doc])
    whole = mix((sums[b] - sums[a]) * powers(INVERSE, n + 1)[a]
                + (at - a).astype(U) * U(0x9E3779B97F4A7C15))
    return doc, at, grams[at].view(np.int64), whole.view(np.int64)


def anchors(texts: list[str | None]):
    """(text number, place, anchor, fragment) arrays over all texts of a batch."""
    found, run, first, size = [], [], 0, 0

    def flush() -> None:
        starts = np.cumsum([0, *[len(r) for r in run]])
        doc, at, key, whole = anchors_of(np.frombuffer(b"".join(run), np.uint8), starts[:-1],
                                         starts[1:])
        found.append((doc + first, at - starts[doc], key, whole))

    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if run and size + len(raw) > CHUNK:
            flush()
            run, first, size = [], i, 0
        if len(raw) <= CHUNK:
            if not run:
                first = i
            run.append(raw)
            size += len(raw)
            continue
        if run:
            flush()
            run, size = [], 0
        places = np.zeros(0, np.int64)
        for a in range(0, len(raw), CHUNK):
            low = max(0, a - REACH)
            part = np.frombuffer(raw[low:a + CHUNK + 2 * LENGTH], np.uint8)
            _, at, key, whole = anchors_of(part, np.array([0]), np.array([len(part)]),
                                           a - low, a - low + CHUNK)
            fresh = ~np.isin(at + low, places)
            places = (at + low)[fresh]
            found.append((np.full(len(places), i), places, key[fresh], whole[fresh]))
        first = i + 1
    if run:
        flush()
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found))


def sorted_anchors(batch: pd.DataFrame):
    """The batch's anchors in the order anchor, fragment, id, place, and whether a row is the
    first of its fragment."""
    doc, at, key, whole = anchors(list(batch["t"]))
    ids = batch["i"].to_numpy(np.int64)[doc]
    place = (batch["h"].to_numpy(np.int64)[doc] << TIE) + at
    order = np.lexsort((place, ids, whole, key))
    key, whole, ids, place = key[order], whole[order], ids[order], place[order]
    new_key = np.r_[True, key[1:] != key[:-1]][:len(key)]
    return key, whole, ids, place, new_key, new_key | np.r_[True, whole[1:] != whole[:-1]][:len(key)]


def scan(docs: DataFrame) -> DataFrame:
    """kind 0: (i, place) whose fragment has come before in its batch; kind 1: firsts of
    fragments in each batch; kind 2: anchors with many different fragments in a batch and, in
    `whole`, how many.  Store it: what is first depends on the borders of batches, which a
    second scan need not repeat."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            key, whole, ids, place, new_key, first = sorted_anchors(batch)
            again = ~first
            # an equal row (same id, same place) is a repeated row, not an earlier string
            same = np.r_[False, (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])][:len(ids)]
            again &= ~same | ~first_run(first, same)
            many = np.add.reduceat(first.astype(np.int64), np.flatnonzero(new_key)) \
                if len(key) else np.zeros(0, np.int64)
            heavy, many = key[new_key][many >= HEAVY], many[many >= HEAVY]
            n = [int(again.sum()), int(first.sum()), len(heavy)]
            no_key, no_place = np.zeros(n[0], np.int64), np.zeros(n[2], np.int64)
            yield pd.DataFrame({
                "kind": np.repeat([0, 1, 2], n).astype(np.int32),
                "key": np.concatenate([no_key, key[first], heavy]),
                "whole": np.concatenate([no_key, whole[first], many]),
                "i": np.concatenate([ids[again], ids[first], no_place]),
                "place": np.concatenate([place[again], place[first], no_place])})

    return docs.mapInPandas(run, "kind int, key long, whole long, i long, place long")


def first_run(first: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Rows from the start of a fragment on while they repeat its first row."""
    broken = ~first & ~same
    group = np.cumsum(first)
    seen = np.cumsum(broken)
    return seen - np.r_[0, seen[np.flatnonzero(first)]][group] == 0


def salted(scanned: DataFrame) -> DataFrame:
    """The firsts of a stored scan, with a salt at heavy anchors and -1 at others."""
    heavy = scanned.where("kind = 2").groupBy("key").agg(F.sum("whole").alias("n")) \
        .orderBy(F.desc("n"), "key").limit(MOST_HEAVY).collect()
    hot = scanned.sparkSession.createDataFrame([(r["key"], True) for r in heavy],
                                               "key long, hot boolean")
    return scanned.where("kind = 1").join(F.broadcast(hot), "key", "left").select(
        "key", "whole", "i", "place",
        F.when(F.col("hot"), F.pmod("whole", F.lit(SALTS))).otherwise(-1).cast("int").alias("salt"))


def reduce_fragments(rows: DataFrame) -> DataFrame:
    """kind 0: places that repeat an earlier equal fragment; kind 1: first places of
    fragments whose anchor has others as well."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in [*batches, None]:
            if batch is not None:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if held is None or not len(held):
                continue
            key = held["key"].to_numpy()
            end = len(key) if batch is None else int(np.searchsorted(key, key[-1]))
            if not end:
                continue
            yield decide(held.iloc[:end])
            held = held.iloc[end:].reset_index(drop=True)

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        key, whole, salt = (rows[c].to_numpy() for c in ("key", "whole", "salt"))
        ids, place = rows["i"].to_numpy(), rows["place"].to_numpy()
        new_key = np.r_[True, key[1:] != key[:-1]]
        first = new_key | np.r_[True, whole[1:] != whole[:-1]]
        same = np.r_[False, (ids[1:] == ids[:-1]) & (place[1:] == place[:-1])]
        again = ~first & ~(same & first_run(first, same))
        several = np.add.reduceat(first.astype(int), np.flatnonzero(new_key)) > 1
        wanted = first & (several[np.cumsum(new_key) - 1] | (salt >= 0))
        keep = again | wanted
        return pd.DataFrame({"kind": wanted[keep].astype(np.int32), "key": key[keep],
                             "i": ids[keep], "place": place[keep]})

    return rows.repartition("key", "salt").sortWithinPartitions("key", "whole", "i", "place") \
        .mapInPandas(run, "kind int, key long, i long, place long")


def cut_fragments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, i, place, left, bytes): the fragments at the wanted places, from one of the equal
    rows that a task meets."""
    per_doc = wanted.withColumn("h", F.shiftright("place", TIE)).groupBy("i", "h").agg(
        F.collect_list(F.struct("key", F.col("place").bitwiseAND((1 << TIE) - 1).alias("at")))
        .alias("wanted"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            rows = []
            for i, h, text, places in batch[["i", "h", "t", "wanted"]].itertuples(index=False):
                raw = (text or "").encode("utf-8", "surrogatepass")
                if (i, len(raw), hash(raw)) in seen:
                    continue
                seen.add((i, len(raw), hash(raw)))
                for w in places:
                    at = w["at"]
                    low = max(0, at - REACH)
                    rows.append((w["key"], i, (h << TIE) + at, at - low, raw[low:at + LENGTH]))
            yield pd.DataFrame(rows, columns=["key", "i", "place", "left", "bytes"])

    return docs.join(per_doc, ["i", "h"]).mapInPandas(
        run, "key long, i long, place long, left int, bytes binary")


def sort_columns(matrix: np.ndarray) -> np.ndarray:
    """For aligned fragments in order of place: whether the string of LENGTH bytes at each
    start column also stands in an earlier fragment (also where padding makes it invalid)."""
    n, width = matrix.shape
    found = np.zeros((n, width - LENGTH + 1), bool)
    with tempfile.TemporaryFile() as columns:
        columns.write(np.ascontiguousarray(matrix.T[::-1]).data)  # last column first
        columns.seek(0)
        order, common = np.arange(n), np.zeros(n, np.uint8)
        for at in range(width - 1, -1, -1):
            symbols = np.frombuffer(columns.read(n), np.uint8)[order]
            place = np.argsort(symbols, kind="stable")
            ranked = symbols[place]
            starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            new = np.zeros(n, np.uint8)
            for a, b in zip(starts, [*starts[1:], n]):
                if b - a > 1:  # minima between neighbours with the same symbol
                    spot = place[a:b]
                    low = np.minimum.reduceat(common[:spot[-1] + 1], spot[:-1] + 1)
                    new[a + 1:b] = np.minimum(low, LENGTH - 1) + 1
            order, common = order[place], new
            if at <= width - LENGTH:
                heads = np.flatnonzero(common < LENGTH)
                if len(heads) < n:
                    earliest = np.minimum.reduceat(order, heads)
                    found[order, at] = order > np.repeat(earliest, np.diff(np.r_[heads, n]))
    return found


def repeated_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """Covered stretches of the fragments of whole anchors (or of two tiles of one), in order
    of key, id and place.  Equal rows of a document give one fragment."""
    rows = rows[~rows.duplicated(["key", "i", "place", "bytes"])]
    raw = rows["bytes"].to_numpy()
    left = rows["left"].to_numpy(np.int64)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    matrix = np.full((len(raw), WIDTH), PAD, np.uint8)
    for row, skip, part in zip(matrix, REACH - left, raw):
        row[skip:skip + len(part)] = np.frombuffer(part, np.uint8)
    found = sort_columns(matrix)
    column = np.arange(WIDTH - LENGTH + 1)
    found &= (column >= (REACH - left)[:, None]) \
        & (column + LENGTH <= (REACH - left + size)[:, None])
    step = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, a = np.nonzero(step == 1)
    b = np.nonzero(step == -1)[1]
    place = rows["place"].to_numpy()[r]
    return pd.DataFrame({"i": rows["i"].to_numpy()[r], "from": place + a - REACH,
                         "to": place + b - 1 - REACH + LENGTH})


def compare_fragments(fragments: DataFrame, save: Save) -> DataFrame:
    """(i, from, to), by anchor; an anchor with more than TILE fragments in pairs of tiles."""
    tiles = save(fragments.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("k"))
                 .where("k > 1"), "tiles")  # stored, so that the join with a large key can be split
    dealt = fragments.join(tiles, "key", "left") \
        .withColumn("k", F.coalesce("k", F.lit(1).cast("long"))) \
        .withColumn("tile", F.pmod(F.xxhash64("i", "place"), "k"))
    pairs = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))
                         .alias("other")).select(
        "key", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"),
        "i", "place", "left", "bytes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in [*batches, None]:
            if batch is not None:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if held is None or not len(held) or batch is not None and len(held) < TILE:
                continue
            new = np.zeros(len(held), bool)
            for c in ("key", "ta", "tb"):
                v = held[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            starts = np.r_[0, np.flatnonzero(new)]
            end = len(held) if batch is None else int(starts[-1])
            split = (held["tb"].to_numpy() > 0)[starts]
            # anchors in one tile are sorted together; a pair of tiles is one collection
            a = 0
            while a < end:
                k = int(np.searchsorted(starts, a))
                stop = k + 1
                if not split[k]:
                    while stop < len(starts) and starts[stop] < end and not split[stop] \
                            and starts[stop] - a < 2 * TILE:
                        stop += 1
                b = int(starts[stop]) if stop < len(starts) else len(held)
                b = min(b, end)
                out = repeated_strings(held.iloc[a:b])
                if len(out):
                    yield out
                a = b
            held = held.iloc[end:].reset_index(drop=True)

    return pairs.repartition("key", "ta", "tb") \
        .sortWithinPartitions("key", "ta", "tb", "i", "place") \
        .mapInPandas(run, "i long, from long, to long")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(number(F.col(f"`{id_col}`"), text).alias("i"), text_tie(text).alias("h"),
                       text.alias("t"))


def number(id_: Column, text: Column) -> Column:
    """The id; for null a number below all ids (but for the lowest FEW) from the text."""
    own = F.xxhash64(F.lit(1), F.coalesce(text, F.lit(""))).bitwiseAND(FEW - 1)
    return F.coalesce(id_.cast("long"), own + F.lit(NO_ID))


def text_tie(text: Column) -> Column:
    """Orders and tells apart the rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND((1 << (63 - TIE)) - 1)


def covered(docs: DataFrame, save: Save, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(i, h, spans): covered stretches of each document that has any, not merged.  i is the
    id (or a number for null), h (32 bits of a hash) tells texts of one id apart."""
    texts = keyed(docs, id_col, text_col)
    scanned = save(scan(texts), "anchors")
    reduced = save(reduce_fragments(salted(scanned)), "reduced")
    strings = compare_fragments(save(
        cut_fragments(texts, reduced.where("kind = 1").select("key", "i", "place")), "fragments"),
        save)
    whole = scanned.where("kind = 0").select("i", "place") \
        .unionByName(reduced.where("kind = 0").select("i", "place"))
    at = F.col("place").bitwiseAND((1 << TIE) - 1)
    whole = whole.select("i", (F.col("place") - F.least(at, F.lit(REACH))).alias("from"),
                         (F.col("place") + LENGTH).alias("to"))
    low = (1 << TIE) - 1
    return whole.unionByName(strings).withColumn("h", F.shiftright("from", TIE)) \
        .groupBy("i", "h").agg(F.collect_list(F.struct(
            F.col("from").bitwiseAND(low).alias("a"), F.col("to").bitwiseAND(low).alias("b")))
            .alias("spans"))


def merged(spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal covered runs."""
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.fromiter((s["a"] for s in spans), np.int64, len(spans))
    b = np.minimum(np.fromiter((s["b"] for s in spans), np.int64, len(spans)), size)
    order = np.argsort(a, kind="stable")
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > reach[:-1]]
    return a[new], np.r_[reach[np.flatnonzero(new)[1:] - 1], reach[-1]]


def kept_bytes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)]))


def remove_repeats(docs: DataFrame, save: Save, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document.

    Defined cases: null texts are empty; texts under LENGTH bytes keep everything; equal rows
    (same id and text) are one document and get equal results; texts that share an id are
    ordered by a hash; null ids come first; an empty table gives no rows.  Other columns are
    ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text, spans in batch[["i", "t", "spans"]].itertuples(index=False):
                raw = (text or "").encode("utf-8", "surrogatepass")
                starts, ends = merged(spans, len(raw))
                kept = kept_bytes(raw, starts, ends)
                rows.append((None if i < NO_ID + FEW else i, len(raw), len(raw) - len(kept),
                             len(starts), hashlib.sha256(kept).hexdigest()))
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans",
                                              "kept_sha256"])
            yield out.astype({"doc_id": "Int64"})

    spans = save(covered(docs, save, id_col, text_col), "spans")
    return keyed(docs, id_col, text_col).join(spans, ["i", "h"], "left").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, save: Save, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The documents with their repeated passages cut out and n_chars brought up to date;
    a cut never splits a character (its bytes stay).  Columns as given."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_text(t, s) for t, s in zip(texts, spans)])

    found = save(covered(docs, save, id_col, text_col), "spans")
    text = F.col(f"`{text_col}`")
    i, h, spans = free(docs, "_i", "_h", "_spans")
    rows = docs.select("*", number(F.col(f"`{id_col}`"), text).alias(i), text_tie(text).alias(h))
    new = rows.join(found.select(F.col("i").alias(i), F.col("h").alias(h),
                                 F.col("spans").alias(spans)), [i, h], "left")
    touched = F.col(spans).isNotNull()
    new = new.withColumn(text_col, F.when(touched, cut(text, F.col(spans))).otherwise(text))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new = new.withColumn("n_chars", F.when(touched, F.char_length(text).cast(kind))
                             .otherwise(F.col("n_chars")))
    return new.select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_text(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    starts, ends = merged(spans, len(raw))
    inner = np.frombuffer(raw + b"a", np.uint8) & 0xC0 == 0x80  # inside a character
    out, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        while inner[a]:
            a += 1
        while inner[b]:
            b -= 1
        if a < b:
            out.append(raw[at:a])
            at = b
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
