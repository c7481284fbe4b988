"""The whole run: one parse of the files, gate, manifest, raw load, reconciliation, marts, release.

Every step writes a new folder and marks it only when its checks pass, so a rerun gives
the same tables and a failed run changes nothing a reader can see.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.frames import union_all
from ..params import Params
from ..quality import gate
from ..quality.rules import WARN, Rule
from ..quality.suites import FILE_RULES
from ..sources import files, layout, sinks
from ..sources.scratch import Scratch, cleared
from ..sources.storage import PACKED
from .warehouse import Warehouse


class LoadMismatch(RuntimeError):
    """Loaded rows differ from the source rows."""


@dataclass(frozen=True)
class Load:
    release: str
    manifest: tuple
    reconciliation: tuple
    verdicts: gate.Report
    staged: Mapping[str, DataFrame]
    parsed: Mapping[str, list[str]]  # files that were read


MANIFEST, FILES, KEY = "load_manifest", "load_files", "file_key"
FILE_COLUMNS = {
    "table": "string", "uri": "string", "file_bytes": "bigint", "modified": "timestamp",
    "rows": "bigint", "content_sum": "decimal(38,0)", "batch_id": "string",
    "loaded_at": "timestamp_ntz", "stored": "string"}


def csv_paths(folder: str, tables: Sequence[str] | None = None,
              names: Mapping[str, str] | None = None) -> dict[str, str]:
    """``<table>.csv`` below ``folder`` unless ``names`` says otherwise."""
    names = names or {}
    return {t: f"{folder.rstrip('/')}/{names.get(t, t + '.csv')}"
            for t in layout.choose_tables(tables)}


def _known_files(spark: SparkSession, root: str) -> DataFrame | None:
    """Files of the newest load, with the folders that hold their rows."""
    return sinks.read_released(spark, root, FILES) if sinks.released(spark, root, FILES) else None


def _plan(spark: SparkSession, paths: Mapping[str, str], root: str) -> tuple[DataFrame, DataFrame]:
    """Files that the newest load holds and that are unchanged or of other tables, with its
    columns; and the files that must be read."""
    now = files.listing(spark, paths)
    known = _known_files(spark, root)
    if known is None:
        return spark.createDataFrame([], ", ".join(
            f"`{c}` {kind}" for c, kind in FILE_COLUMNS.items())), now
    same = known.join(now, files.FILE).select(*FILE_COLUMNS)
    return same.unionByName(known.where(~F.col("table").isin(list(paths)))), \
        now.join(same, files.FILE, "left_anti")


def load_raw(spark: SparkSession, paths: Mapping[str, str], expected: Mapping[str, int],
             root: str, now: datetime | None = None, stored: DataFrame | None = None,
             rules: Iterable[Rule] = tuple(FILE_RULES), encoding: str = "UTF-8") -> Load:
    """CSV files to a released folder of raw Parquet tables and their manifest.

    A file whose place, size and time of change are those of the newest load is not read
    again: its rows are taken over by reference.  Each other file is parsed once, whole, and
    its rows stay together, so that the next load can refer to them; counts, digests, rules
    and the release read what was written then.  A header or record that does not fit turns
    the gate red.  Row counts that differ from ``expected`` warn.  With ``stored``, a manifest
    of an earlier run, tables whose content has changed since are refused.
    """
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    batch, release = uuid.uuid4().hex[:12], now.strftime("%Y%m%dT%H%M%S%f")
    base = sinks.released(spark, root)
    scratch = Scratch(spark, "load")
    kept, changed = _plan(spark, paths, root)
    kept = scratch.save(kept, "kept")
    # One row a source file: the reader takes a list of paths.
    parsed: dict[str, list[str]] = {}
    for r in sorted(changed.select("table", "uri").collect()):
        parsed.setdefault(r["table"], []).append(unquote(r["uri"]))
    fresh = files.stage(spark, parsed, encoding)
    held: dict[str, list[str]] = {}
    asked = F.col("table").isin(list(paths))
    for r in kept.where(asked & F.col("stored").isNotNull()).select("table", "stored").collect():
        held.setdefault(r["table"], []).append(r["stored"])
    staged = {t: _together(spark, t, fresh.get(t), held.get(t, []))
              for t in paths if t in fresh or t not in parsed}
    verdict = gate.report(gate.file_results(spark, paths, expected, WARN, staged, rules))
    if verdict.blocked:
        raise gate.GateRed(verdict)

    contents = changed.join(files.file_contents(fresh), ["table", "uri"], "left") if fresh \
        else changed.selectExpr("*", "0L as rows", "cast(null as decimal(38,0)) as content_sum")
    folder = F.concat(F.lit(f"{root}/{release}/"), "table", F.lit("/" + KEY + "="), F.sha2("uri", 256))
    each = kept.unionByName(contents.select(
        *files.FILE, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "content_sum",
        F.lit(batch).alias("batch_id"), F.lit(now).alias("loaded_at"),
        F.when(F.col("rows") > 0, folder).alias("stored")))
    each.write.parquet(f"{root}/{release}/{FILES}")
    each = spark.read.parquet(f"{root}/{release}/{FILES}")
    files.table_manifest(each.where(asked), paths, expected).withColumns({
        "batch_id": F.lit(batch), "loaded_at": F.lit(now)}) \
        .write.parquet(f"{root}/{release}/{MANIFEST}")
    manifest = spark.read.parquet(f"{root}/{release}/{MANIFEST}")
    if stored is not None:
        verdict = gate.Report(verdict.rows + gate.report(gate.unchanged(manifest, stored)).rows)
        if verdict.blocked:
            raise gate.GateRed(verdict)

    loaded: dict[str, DataFrame] = {}
    for table in paths:
        target = f"{root}/{release}/{table}"
        parts = held.get(table, [])
        if table in fresh:
            parts = parts + _write_files(spark, fresh[table], each.where(
                (F.col("table") == table) & (F.col("batch_id") == batch)), batch, now, target)
        if not parts:  # no file has a record
            parts = [f"{target}/none"]
            files.stamp(staged[table], batch, now).limit(0).write.parquet(parts[0])
        sinks.write_parts(spark, target, parts)
        loaded[table] = spark.read.parquet(*parts)
    checked = tuple(files.reconcile(manifest, loaded).collect())
    if any(r["status"] != "OK" for r in checked):
        raise LoadMismatch(", ".join(r["table"] for r in checked if r["status"] != "OK"))
    sinks.mark_released(spark, root, release, base)
    return Load(release, tuple(manifest.collect()), checked, verdict, staged, parsed)


def _together(spark: SparkSession, table: str, fresh: DataFrame | None,
              held: Sequence[str]) -> DataFrame:
    """Rows parsed now and rows taken over, as they are staged."""
    columns = [*layout.columns_of(table), files.BAD_RECORD, "_source_uri"]
    parts = [] if fresh is None else [fresh.select(*columns)]
    if held:
        parts.append(spark.read.parquet(*held).withColumn(
            files.BAD_RECORD, F.lit(None).cast("string")).select(*columns))
    if not parts:
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema_of(table).fields]
        return spark.createDataFrame([], ", ".join([*kinds, f"{files.BAD_RECORD} string",
                                                    "_source_uri string"]))
    return union_all(parts)


def _write_files(spark: SparkSession, rows: DataFrame, contents: DataFrame, batch: str,
                 now: datetime, target: str) -> list[str]:
    """A folder for the rows of each file; the names of the folders."""
    digests = contents.where("stored is not null").select(
        F.col("uri").alias("_source_uri"), files.digest_of().alias("_digest"), "stored")
    files.stamp(rows.join(digests.drop("stored"), "_source_uri"), batch, now, F.col("_digest")) \
        .withColumn(KEY, F.sha2("_source_uri", 256)) \
        .write.options(**PACKED).partitionBy(KEY).parquet(target)
    return [r["stored"] for r in digests.select("stored").collect()]


def raw_warehouse(spark: SparkSession, root: str, params: Params) -> Warehouse:
    """Warehouse over the newest released raw tables."""
    raw = {t: (lambda t=t: sinks.read_released(spark, root, t)) for t in layout.TABLES}
    return Warehouse(spark, raw, params, Scratch(spark))


def build(spark: SparkSession, paths: Mapping[str, str], expected: Mapping[str, int],
          raw_root: str, mart_root: str, params: Params | None = None,
          encoding: str = "UTF-8", keep: int = 3) -> gate.Report:
    """Load, build, check, release; then the newest `keep` releases stay, and no scratch."""
    params = params or Params()
    with cleared(spark):
        load_raw(spark, paths, expected, raw_root, encoding=encoding)
        outcome = gate.release(spark, raw_warehouse(spark, raw_root, params), mart_root, params)
    for root in (raw_root, mart_root):
        sinks.expire(spark, root, keep)
    return outcome
