"""Type-2 history in storage, by bucket of the key.

A release holds, for each bucket that changed, a folder of its open versions, and one folder
of the versions that this run closed.  Its list of parts names those and the folders of
earlier releases that are still right, so what did not change is neither read nor written,
and a closed version is copied only when many small folders of them are put together.

Whether a bucket changed is known from a digest of its keys and check columns, one row a
bucket, which is stored with each release.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import history
from . import sinks, storage

DIGESTS, PIECES, CLOSED = "digests", "pieces", "closed"
BUCKET, PIECE = "version_bucket", "version_piece"
BUCKETS, MERGE_AFTER = 64, 32
SUMS = ("first_sum", "second_sum")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_digests(current: DataFrame, key: str, check: Sequence[str], buckets: int) -> DataFrame:
    """One row per bucket that has rows: their number and two sums of 64-bit hashes.

    Whether a column is null is hashed as well, because a null leaves a hash as it was.
    """
    seen = [x for c in (key, *check) for x in (F.col(c).isNull(), F.col(c))]
    return current.groupBy(bucket_of(key, buckets).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.xxhash64(F.lit(n), *seen).cast("decimal(38,0)")).alias(s)
          for n, s in enumerate(SUMS)]).withColumn("buckets", F.lit(buckets))


def changed_buckets(now: DataFrame, before: DataFrame) -> list[int]:
    """Numbers of the buckets whose digests differ: at most as many as there are buckets."""
    said = F.struct("rows", *SUMS)
    both = now.select(BUCKET, said.alias("new")).join(
        before.select(BUCKET, said.alias("old")), BUCKET, "full_outer")
    return sorted(r[BUCKET] for r in both.where(~F.col("new").eqNullSafe(F.col("old")))
                  .select(BUCKET).collect())


def _piece(part: str) -> str:
    return part.rsplit(f"{PIECE}=", 1)[-1]


def write_versions(current: DataFrame, root: str, release: str, table: str, key: str,
                   check: Sequence[str], run_at: datetime, buckets: int = BUCKETS,
                   close_deleted: bool = True, merge_after: int = MERGE_AFTER) -> list[int]:
    """Write the next state of a history into an unmarked release; the buckets that changed.

    It goes on from the newest marked release that holds the table, whose number of buckets
    stays for good; `buckets` counts for the first one only.  A history stored whole, without
    buckets, is taken over.  A key in two rows of `current` fails the run; rows without a key
    are one row more that must be single.  An empty table closes all versions.
    """
    spark = current.sparkSession
    folder, last = f"{root}/{release}/{table}", sinks.released(spark, root, table)
    held, live, before = [], None, None
    if last is not None:
        old = f"{root}/{last}/{table}"
        if storage.exists(spark, f"{old}/{DIGESTS}"):
            held = sinks.parts_of(spark, old)
            before = spark.read.parquet(f"{old}/{DIGESTS}")
            known = before.select("buckets").first()
            buckets = known["buckets"] if known else buckets
        else:
            live = sinks.read_released(spark, root, table)

    bucket_digests(current, key, check, buckets).write.parquet(f"{folder}/{DIGESTS}")
    now = spark.read.parquet(f"{folder}/{DIGESTS}")
    changed = list(range(buckets)) if before is None else changed_buckets(now, before)
    names = {f"open-{b}" for b in changed}
    replaced = [p for p in held if _piece(p) in names]
    kept = [p for p in held if _piece(p) not in names]
    if replaced:
        live = spark.read.parquet(*replaced)
    if changed:
        rows = current if before is None else current.where(
            bucket_of(key, buckets).isin(changed))
        versions = history.snapshot(history.single_rows(rows, key), live, key, check, run_at,
                                    close_deleted)
        closed = [p for p in kept if _piece(p) == CLOSED]
        if len(closed) >= merge_after:
            versions = versions.unionByName(spark.read.parquet(*closed))
            kept = [p for p in kept if p not in closed]
        _write_pieces(versions, folder, key, buckets)
        kept = kept + [f"{folder}/{PIECES}/{n}"
                       for n in storage.folders(spark, f"{folder}/{PIECES}")]
    if not kept:  # no version at all
        history.snapshot(current.limit(0), None, key, check, run_at).write.parquet(f"{folder}/none")
        kept = [f"{folder}/none"]
    sinks.write_parts(spark, folder, kept)
    return changed


def _write_pieces(versions: DataFrame, folder: str, key: str, buckets: int) -> None:
    piece = F.when(F.col("valid_to").isNotNull(), F.lit(CLOSED)).otherwise(
        F.concat(F.lit("open-"), bucket_of(key, buckets).cast("string")))
    versions.withColumn(PIECE, piece).hint("rebalance", PIECE) \
        .sortWithinPartitions(PIECE, key).write.partitionBy(PIECE).parquet(f"{folder}/{PIECES}")


def versions_of(spark: SparkSession, root: str, release: str, table: str) -> DataFrame:
    """The history as a release holds it, marked or not."""
    return spark.read.parquet(*sinks.parts_of(spark, f"{root}/{release}/{table}"))
