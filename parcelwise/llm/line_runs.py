"""Removal of frequent lines, with line hashes kept in levelled sorted runs.

Built from DataFrame functions only.  A run is a stored table of (a, b, docs, lines): two
64-bit hashes of a line's key, how many documents hold it and how often it stands in them,
sorted by hash.  Every batch of documents becomes one run of level 0: its keys are merged
against the runs, and those that a run already shows as full (in `limit` documents) are not
added again.  FAN runs of one level are compacted into one run of the next, so a batch meets
few runs.  With limit 1 a batch adds the lines never seen before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .ranked import LOWER, UPPER

FAN = 2
BATCHES = 4
HOT = 10_000  # keys that may be broadcast: those with this fraction of all lines
BLANK = " \t\n\x0b\x0c\r"
KEY = ["a", "b"]


def line_keys(lines: Column, min_chars: int) -> Column:
    """array<struct(a, b)>: hashes of the stripped lines with A-Z in lower case, null for
    keys of fewer than `min_chars` code points."""
    bare = F.transform(lines, lambda line: F.trim(line, F.lit(BLANK)))
    # lower() also changes letters beyond A-Z, but not in lines of single-byte characters.
    folded = F.transform(bare, lambda k: F.when(
        F.octet_length(k) == F.char_length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER)))
    return F.transform(folded, lambda k: F.when(
        F.char_length(k) >= min_chars,
        F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))))


class Runs:
    """levels[i] holds the runs of level i, oldest first."""

    def __init__(self, save: Callable[[DataFrame, str], DataFrame], limit: int,
                 levels: list[list[DataFrame]] | None = None):
        self.save, self.limit, self.levels = save, limit, levels or []

    def fresh(self, keys: DataFrame) -> DataFrame:
        """The keys that no run shows as full."""
        for run in (r for level in self.levels for r in level):
            full = run.where(F.col("docs") >= self.limit).select(*KEY)
            keys = keys.hint("merge").join(full, KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Store the fresh keys of a batch, unique in (a, b), as a run."""
        self._put(0, self.fresh(keys))

    def _put(self, level: int, keys: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self.save(keys.sortWithinPartitions(*KEY), f"run-{level}"))
        if len(self.levels[level]) == FAN:
            merged = totals(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    def frequent(self) -> DataFrame:
        """(a, b, docs, lines) of the keys in `limit` documents; counts of full keys go up to
        the batch in which they became full."""
        return totals([r for level in self.levels for r in level]).where(
            F.col("docs") >= self.limit)


def totals(runs: list[DataFrame]) -> DataFrame:
    every = runs[0]
    for run in runs[1:]:
        every = every.unionByName(run)
    return every.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("lines").alias("lines"))


def batch_keys(rows: DataFrame) -> DataFrame:
    """(a, b, docs, lines) of documents with `keys`; summed in the tasks that read them."""
    per_doc = rows.select(F.explode(F.filter("keys", lambda k: k.isNotNull())).alias("k"), "row")
    return per_doc.groupBy("row", "k").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(F.col("k.a").alias("a"), F.col("k.b").alias("b")) \
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("lines"))


def marked(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(r, s, dropped): positions of a document's lines that are frequent, for documents
    with any.  Keys with more than 1/HOT of all lines are joined by broadcast, at most HOT
    of them; no other key has many rows."""
    every = frequent.agg(F.sum("lines")).first()[0] or 0
    hot = F.col("lines") > every / HOT
    lines = rows.select("r", "s", F.posexplode("keys").alias("place", "k")) \
        .where("k is not null").select("r", "s", "place", "k.a", "k.b")
    few = F.broadcast(frequent.where(hot).select(*KEY))
    rest = lines.join(few, KEY, "left_anti").join(frequent.where(~hot).select(*KEY), KEY)
    return lines.join(few, KEY).unionByName(rest) \
        .groupBy("r", "s").agg(F.collect_set("place").alias("dropped"))


def without_frequent(docs: DataFrame, save: Callable[[DataFrame, str], DataFrame],
                     limit: int = 10, min_chars: int = 1, batches: int = BATCHES,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): texts without the lines whose key stands in
    `limit` documents or more.

    Defined cases: a null or empty text is one empty line; lines that are empty after
    stripping stay; a line repeated in one document counts once; repeated rows and rows that
    share an id count as documents of their own; an empty table gives no rows; other columns
    are ignored.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    # A name for equal (id, text); what is dropped depends on the text alone.
    named = given.withColumn("r", F.xxhash64("doc_id", "text")) \
        .withColumn("s", F.xxhash64("text", "doc_id", F.lit(1)))
    keys = line_keys(F.split("text", "\n"), min_chars)
    rows = save(named.select("r", "s", keys.alias("keys"),
                             F.monotonically_increasing_id().alias("row")), "keys")
    runs = Runs(save, limit)
    for n in range(batches):
        runs.add(batch_keys(rows.where(F.pmod("s", F.lit(batches)) == n)))
    frequent = save(runs.frequent(), "frequent")
    found = named.join(marked(rows, frequent), ["r", "s"], "left")
    lines = F.split("text", "\n")

    def left_of(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.transform(F.array_except(places, "dropped"), lambda p: F.get(lines, p))

    # The one-element arrays hold the split text, so no place splits it again.
    kept = F.element_at(F.transform(F.array(lines), lambda ls: F.array_join(left_of(ls), "\n")), 1)
    return found.select(
        "doc_id", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long")
        .alias("n_dropped"))
