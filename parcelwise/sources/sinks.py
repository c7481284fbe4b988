"""Physical layout of the facts, and release of finished tables.

A release is a fresh folder per run.  Its tables become visible together when an empty
marker file is created in it; readers take the newest marked folder.  Nothing is ever
overwritten, so a rerun or a failed run leaves the published tables as they were.  A table
may consist of folders of earlier releases.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..functions.dates import month_of
from . import storage

MARKER, CLAIMS, PARTS = "_RELEASED", "_claims", "parts"
ORDER_LAYOUT = ("customer_state", "seller_state", "order_status")
ITEM_LAYOUT = ("product_key", "seller_key", "customer_key")
PAYMENT_LAYOUT = ("payment_type", "order_id", "payment_key")


def by_month(df: DataFrame, cluster: Sequence[str], date_col: str = "order_purchase_date",
             again: Sequence[Mapping[str, Column]] = ()) -> DataFrame:
    """Rows of a month together, sorted inside tasks so row groups can be skipped.

    REBALANCE lets adaptive execution split a month that is too large for one task and
    merge small ones; a plain repartition by month would write a hot month in one task.

    ``again`` names columns that the others determine, and how: neither this shuffle nor those
    that ``df`` itself needs carry them; they are made when the rows are in their place.
    """
    made = [name for step in again for name in step]
    placed = (
        df.drop(*made).withColumn("purchase_month", month_of(date_col))
        .hint("rebalance", "purchase_month")
        .sortWithinPartitions("purchase_month", *cluster)
    )
    for step in again:
        placed = placed.withColumns(dict(step))
    return placed.select(*df.columns, "purchase_month")


def write_by_month(df: DataFrame, path: str, cluster: Sequence[str],
                   date_col: str = "order_purchase_date",
                   again: Sequence[Mapping[str, Column]] = ()) -> None:
    """Month folders of `by_month`."""
    by_month(df, cluster, date_col, again).write.options(**storage.PACKED) \
        .partitionBy("purchase_month").parquet(path)


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str]) -> None:
    """Range-clustered files.  The last column should be unique, so that equal leading
    values can still be split over tasks."""
    df.repartitionByRange(*cluster).sortWithinPartitions(*cluster).write.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of files that the CSV scan reads back unchanged."""
    df.write.option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .csv(path)


class ReleaseConflict(RuntimeError):
    """Another run has released since this one began."""


def mark_released(spark: SparkSession, root: str, release: str, base: str | None) -> None:
    """Make a finished folder visible, if the newest release is still the one this run began
    with.

    The claim on the successor of `base` is a file that only one run can create, so of two
    runs with the same base the later one to finish loses and its folder stays unmarked.
    """
    if released(spark, root) != base or not storage.create(
            spark, f"{root}/{CLAIMS}/{base or 'first'}"):
        raise ReleaseConflict(f"{root} has a release after {base or 'none'}; {release} is not "
                              "released")
    storage.create(spark, f"{root}/{release}/{MARKER}")


def marked(spark: SparkSession, root: str) -> list[str]:
    """Names of the released folders, oldest first; names sort by time."""
    return [n for n in storage.folders(spark, root)
            if storage.exists(spark, f"{root}/{n}/{MARKER}")]


def released(spark: SparkSession, root: str, table: str | None = None) -> str | None:
    """Name of the newest marked release (that holds the table, if one is named)."""
    return max((n for n in marked(spark, root)
                if table is None or storage.exists(spark, f"{root}/{n}/{table}")), default=None)


def read_released(spark: SparkSession, root: str, table: str) -> DataFrame:
    """From the newest release that holds it: a release of some tables leaves the others."""
    release = released(spark, root, table)
    if release is None:
        raise LookupError(f"{table} is not released under {root}")
    folder = f"{root}/{release}/{table}"
    parts = parts_of(spark, folder)
    return spark.read.parquet(*(parts or [folder]))


def write_parts(spark: SparkSession, folder: str, parts: Sequence[str]) -> None:
    """A table that consists of other folders, of this release or of earlier ones."""
    spark.createDataFrame([(p,) for p in parts], "value string").coalesce(1) \
        .write.text(f"{folder}/{PARTS}")


def parts_of(spark: SparkSession, folder: str) -> list[str]:
    if not storage.exists(spark, f"{folder}/{PARTS}"):
        return []
    return [r["value"] for r in spark.read.text(f"{folder}/{PARTS}").collect()]


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete releases before the newest `keep`, and unmarked folders older than those.

    The newest release of any table stays for that table, and so does what a table that stays
    refers to; the other tables of such a release go.  Names of the folders that are deleted
    whole are returned."""
    names = marked(spark, root)
    if len(names) <= keep:
        return []
    tables = {n: storage.folders(spark, f"{root}/{n}") for n in names}
    newest = {t: n for n in names for t in tables[n]}
    stay = {(n, t) for n in names[-keep:] for t in tables[n]} | {(n, t) for t, n in newest.items()}
    for n, t in list(stay):
        stay |= {tuple(p[len(root) + 1:].split("/")[:2])
                 for p in parts_of(spark, f"{root}/{n}/{t}") if p.startswith(root + "/")}
    held = {n for n, _ in stay}
    old = [n for n in storage.folders(spark, root) if n != CLAIMS and n < min(names[-keep:])]
    for n in old:
        if n not in held:
            storage.delete(spark, f"{root}/{n}")
        else:
            for t in storage.folders(spark, f"{root}/{n}"):
                if (n, t) not in stay:
                    storage.delete(spark, f"{root}/{n}/{t}")
    return [n for n in old if n not in held]
