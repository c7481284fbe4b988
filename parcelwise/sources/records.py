"""Records of CSV files whose quoted fields hold line breaks, read by many tasks.

A file is read as lines, split between tasks as any text file.  A line begins a record if the
quotes before it are even in number.  Each block of a file counts its quotes, so the blocks
before say whether a block begins inside a field; within a block records are numbered by a
running count; and lines at a block's start that still belong to the record before go back to
the block where that record began.  Fields are quoted as RFC 4180 has it: a quote inside a
field is doubled, and stands in quoted fields only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BLOCK = ["file", "block"]


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, block, at, line, odd): `at` rises inside a block, `odd` is the parity of the
    line's quotes."""
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    return raw.withColumn("odd", quotes % 2)


def records(spark: SparkSession, paths: str | list[str],
            save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(file, block, record, text): whole records without their last line break, and line
    breaks as \\n where the file ends its lines with \\r\\n; the first of a file has block 0 and
    record 1.  Empty lines between records are left out."""
    every = lines(spark, paths)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = save(every.groupBy(*BLOCK).agg(
        F.sum("odd").alias("odds"),
        F.min_by(F.col("line").endswith("\r"), "at").alias("crlf")), "blocks")
    inside = blocks.select(
        *BLOCK, F.coalesce(F.sum("odds").over(before), F.lit(0)).alias("odds_before"),
        F.max(F.when(F.col("block") == 0, F.col("crlf"))).over(Window.partitionBy("file"))
        .alias("crlf"))

    by_line = Window.partitionBy(*BLOCK).orderBy("at")
    quotes = F.col("odds_before") + F.coalesce(
        F.sum("odd").over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The first line says how the lines of a file end.
    placed = every.join(inside, BLOCK).select(
        *BLOCK, "at", (quotes % 2 == 0).cast("int").alias("starts"),
        F.when(F.col("crlf"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line"))
        .alias("line"))
    numbered = placed.withColumn(
        "record", F.sum("starts").over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    in_order = F.array_sort(F.collect_list(F.struct("at", "line")))
    parts = save(numbered.groupBy(*BLOCK, "record").agg(
        F.array_join(F.transform(in_order, lambda x: x["line"]), "\n").alias("text")), "records")

    # At most one row a block: what continues the last record that began before it.
    last = parts.groupBy(*BLOCK).agg(F.max("record").alias("n"))
    owner = F.last(F.when(F.col("n") > 0, F.struct("block", F.col("n").alias("record"))),
                   ignorenulls=True).over(before)
    rest = parts.where("record = 0").join(last.select(*BLOCK, owner.alias("to")), BLOCK)
    tails = rest.groupBy("file", F.col("to.block").alias("block"),
                         F.col("to.record").alias("record")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), "text"))).alias("tail"))
    whole = parts.where("record > 0").join(tails, [*BLOCK, "record"], "left")
    tail = F.array_join(F.transform("tail", lambda x: x["text"]), "\n")
    text = F.concat("text", F.when(F.col("tail").isNull(), "").otherwise(F.concat(F.lit("\n"), tail)))
    return whole.select(*BLOCK, "record", text.alias("text")).where("text <> ''")
