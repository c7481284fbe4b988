"""Written intermediate tables.

Plans that are used more than once are cut by writing them to shared storage and reading
them back.  Unlike cached blocks the files outlive a lost executor, and the next plan
reads only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from . import storage

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_made: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only on a single machine."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="parcelwise-")
    return _local_roots[app]


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written.

    Without this they stay until the driver collects its garbage, so that a chain of written
    tables holds the shuffles of all of them."""
    before = spark.conf.get(FREE_KEY, None)
    spark.conf.set(FREE_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_KEY) if before is None else spark.conf.set(FREE_KEY, before)


class Scratch:
    """A private folder for one build."""

    def __init__(self, spark: SparkSession, label: str = "build"):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        _made.append(self.root)

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        with freed(self.spark):
            df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_all(self, frames: Sequence[DataFrame], name: str, **options: str) -> DataFrame:
        """One table of frames with the same columns, written one after another."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        for df in frames:
            with freed(self.spark):
                df.write.options(**options).mode("append").parquet(path)
        return self.spark.read.schema(frames[0].schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete the folders made inside, if all goes well; a failed run leaves them to look at."""
    before = len(_made)
    yield
    while len(_made) > before:
        storage.delete(spark, _made.pop())
