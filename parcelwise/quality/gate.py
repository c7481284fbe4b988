"""Verdicts, the file gate before a load, and release only after a green gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..params import Params
from ..plans.warehouse import MARTS, Warehouse
from ..sources import files, sinks, versions
from .invariants import evaluate_invariants
from .rules import ERROR, Rule, evaluate
from .suites import FILE_RULES, MODEL_RULES


@dataclass(frozen=True)
class Report:
    """One row per rule, so small by construction."""

    rows: tuple[Row, ...]

    @property
    def blocked(self) -> bool:
        return any(not r["passed"] and r["severity"] == ERROR for r in self.rows)

    @property
    def failures(self) -> list[Row]:
        return [r for r in self.rows if not r["passed"]]

    def summary(self) -> str:
        tables = {r["table_name"] for r in self.rows}
        red = {r["table_name"] for r in self.failures if r["severity"] == ERROR}
        lines = [f"{len(tables) - len(red)}/{len(tables)} tables passed"]
        lines += [f"{r['severity']}: {r['rule']} on {r['table_name']} "
                  f"({r['failing']} unexpected)" for r in self.failures]
        return "\n".join(lines)


class GateRed(RuntimeError):
    def __init__(self, outcome: Report):
        super().__init__(outcome.summary())
        self.report = outcome


def report(results: DataFrame) -> Report:
    return Report(tuple(results.collect()))


def file_results(spark: SparkSession, paths: Mapping[str, str],
                 expected: Mapping[str, int], severity: str = ERROR,
                 staged: Mapping[str, DataFrame] | None = None,
                 rules: Iterable[Rule] = tuple(FILE_RULES), encoding: str = "UTF-8") -> DataFrame:
    """Column list against the declared schema, records that do not fit it, row counts against
    ``expected``, and the file rules, over the parsed tables.

    Tables are parsed whole unless ``staged`` has them.  One with a wrong header gets no
    further rule.
    """
    frames = files.stage(spark, paths, encoding) if staged is None else staged
    headers = spark.createDataFrame(
        [(t, "columns(declared, in order)", ERROR, int(t not in frames), 1, t in frames)
         for t in paths],
        "table_name string, rule string, severity string, failing bigint, checked bigint, "
        "passed boolean")
    if not frames:
        return headers
    always = [Rule(t, "readable", files.BAD_RECORD) for t in frames] + [
        Rule(t, "row_count", "*", values=(expected[t],), severity=severity)
        for t in frames if t in expected]
    return headers.unionByName(
        evaluate(always + [r for r in rules if r.table in frames], frames))


def unchanged(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """Verdicts: each table's content against a manifest stored before."""
    before = stored.select("table", F.col("content_digest").alias("_before"))
    same = F.col("content_digest").eqNullSafe(F.col("_before"))
    return listed.join(before, "table", "left").select(
        F.col("table").alias("table_name"), F.lit("unchanged(content_digest)").alias("rule"),
        F.lit(ERROR).alias("severity"), F.when(same, 0).otherwise(1).cast("bigint")
        .alias("failing"), F.lit(1).cast("bigint").alias("checked"), same.alias("passed"))


def check_models(frames: Mapping[str, DataFrame], params: Params,
                 rules: Iterable[Rule] = tuple(MODEL_RULES)) -> Report:
    return report(evaluate(rules, frames).unionByName(evaluate_invariants(frames, params)))


def release(spark: SparkSession, models: Warehouse, root: str, params: Params,
            rules: Iterable[Rule] = tuple(MODEL_RULES), run_at: datetime | None = None) -> Report:
    """Write every mart once, into a new folder, check what was written, then mark the folder.

    A red gate leaves the folder unmarked, so readers keep the release before it.  The
    history of product categories goes on from the last release that has one, and refers to
    its buckets that did not change.
    """
    instant = run_at or datetime.now(timezone.utc)
    name, base = instant.strftime("%Y%m%dT%H%M%S%f"), sinks.released(spark, root)
    written = models.into(f"{root}/{name}")
    for table in MARTS:
        written[table]
    outcome = check_models(written, params, rules)
    if outcome.blocked:
        raise GateRed(outcome)
    versions.write_versions(written["stg_products"].select(*HISTORY_COLUMNS), root, name, HISTORY,
                            "product_key", HISTORY_CHECK, instant.replace(tzinfo=None))
    sinks.mark_released(spark, root, name, base)
    return outcome


HISTORY = "snap_product_category"
HISTORY_CHECK = ["product_category", "product_category_pt"]
HISTORY_COLUMNS = ["product_key", *HISTORY_CHECK, "product_weight_g", "product_volume_cm3"]
