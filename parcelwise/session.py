"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .sources import storage

TASK_BYTES = 16 << 20  # stored bytes that a task reads, of a file or of a shuffle
SHUFFLED = 4  # bytes of the widest shuffle for one of the source, at most
SENT_BYTES = 1 << 20  # stored bytes of a table that is sent to every task whole, at most


def configured(builder: SparkSession.Builder | None = None) -> SparkSession.Builder:
    return (
        (builder or SparkSession.builder)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )


def sized(spark: SparkSession, paths: list[str]) -> None:
    """Tasks small enough to sort what they read in memory, however large the tables are.

    A task's share of a scan or shuffle is stored compressed, and several sorted joins of
    wide rows run in one task; with Spark's usual sizes they spill many times the input.  The
    number of shuffle partitions grows with the tables; adaptive execution merges small ones."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = sum(storage.size(spark, p) for p in paths) * SHUFFLED // TASK_BYTES
    for key, value in {
            "spark.sql.files.maxPartitionBytes": TASK_BYTES,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": max(usual, wanted)}.items():
        spark.conf.set(key, str(value))
    _sent_whole(spark)


def _sent_whole(spark: SparkSession) -> None:
    """Tables are sent to every task by what they take in memory, not by what they store.

    A stored table may take a hundred times its size in memory, and the driver holds it several
    times.  Shuffled rows are measured as they are in memory, so they keep the usual limit."""
    stored, moved = (f"spark.sql.{x}autoBroadcastJoinThreshold" for x in ("", "adaptive."))
    if spark.conf.get(moved, None) is None:
        spark.conf.set(moved, spark.conf.get(stored))
    usual = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    spark.conf.set(stored, str(min(usual, SENT_BYTES)))


def star_warehouse(spark: SparkSession, folder: str):
    """Warehouse over a folder of star-schema Parquet tables."""
    from .plans.warehouse import Warehouse
    from .sources import star_schema as star
    from .sources.scratch import Scratch

    tables = star.read_tables(spark, folder)
    sized(spark, [f"{folder}/{t}.parquet" for t in star.SOURCE_TABLES])
    raw = {name: (lambda b=build: b(tables)) for name, build in star.RAW_BUILDERS.items()}
    return Warehouse(spark, raw, star.STAR_PARAMS, Scratch(spark),
                     stored=frozenset({"raw.orders", "raw.customers", "stg_geolocation"}))
