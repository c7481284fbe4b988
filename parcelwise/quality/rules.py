"""Generic rules and their evaluation.

Row rules of a table are fused into one aggregate over one scan.  All rules about one key,
its uniqueness and the tables that refer to it, come from one frame of counts per key: one
shuffle without a join, and a repeated key is reduced before it moves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.frames import union_all
from ..sources.scratch import Scratch

ERROR, WARN = "error", "warn"
ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "length", "row_count", "readable")


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    mostly: float = 1.0
    parent: str = ""
    parent_key: str = ""
    also: tuple[str, ...] = ()  # further key columns of a composite uniqueness rule
    severity: str = ERROR

    @property
    def name(self) -> str:
        return f"{self.kind}({', '.join((self.column, *self.also))})"


def not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, "not_null", c) for c in columns]


def unique(table: str, column: str, *also: str) -> list[Rule]:
    return [Rule(table, "unique", column, also=also)]


def key(table: str, column: str) -> list[Rule]:
    return unique(table, column) + not_null(table, column)


def accepted(table: str, column: str, values: Iterable) -> list[Rule]:
    return [Rule(table, "accepted_values", column, values=tuple(values))]


def in_range(table: str, column: str, low: float | None = None, high: float | None = None,
             **more) -> list[Rule]:
    return [Rule(table, "accepted_range", column, low=low, high=high, **more)]


def refers(table: str, column: str, parent: str, parent_key: str) -> list[Rule]:
    return [Rule(table, "relationships", column, parent=parent, parent_key=parent_key)]


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def violation(rule: Rule) -> str:
    """SQL predicate of a failing row; NULL values pass everything except not_null."""
    c = f"`{rule.column}`"
    if rule.kind == "not_null":
        return f"{c} is null"
    if rule.kind == "readable":  # the column holds the text of a record that could not be read
        return f"{c} is not null"
    if rule.kind == "accepted_values":
        return f"{c} not in ({', '.join(map(_literal, rule.values))})"
    if rule.kind == "length":
        return f"length({c}) <> {rule.values[0]}"
    if rule.kind == "accepted_range":
        edge = "" if rule.inclusive else "="
        sides = []
        if rule.low is not None:
            sides.append(f"{c} <{edge} {rule.low}")
        if rule.high is not None:
            sides.append(f"{c} >{edge} {rule.high}")
        return " or ".join(sides) or "false"
    raise ValueError(f"{rule.kind} is not a row rule")


def failing_rows(rule: Rule, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The evidence: failing rows, duplicated keys with their count, or orphaned keys."""
    df = frames[rule.table]
    if rule.kind == "unique":
        keys = [rule.column, *rule.also]
        return (df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n_records"))
                .where("n_records > 1"))
    if rule.kind == "relationships":
        children = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(
            F.count("*").alias("n_records"))
        parents = frames[rule.parent].select(F.col(rule.parent_key).alias("_parent"))
        return children.join(parents, F.col(rule.column) == F.col("_parent"), "left_anti")
    return df.where(violation(rule))


def _result(rule: Rule, failing: str, checked: str, passed: str) -> str:
    """A result row as SQL.  Text keeps plans of hundreds of rules quick to put together."""
    return (f"named_struct('table_name', {_literal(rule.table)}, 'rule', {_literal(rule.name)}, "
            f"'severity', {_literal(rule.severity)}, 'failing', {failing}, "
            f"'checked', {checked}, 'passed', {passed})")


def _row_rules(rules: list[Rule], df: DataFrame) -> DataFrame:
    """All row rules of one table from one pass, then one result row per rule."""
    counts, rows = [], []
    for i, r in enumerate(rules):
        if r.kind == "row_count":
            counts.append(f"abs(count(*) - {r.values[0]}) as f{i}")
        else:
            counts.append(f"count_if({violation(r)}) as f{i}")
        every = r.kind in ("not_null", "row_count", "readable")
        counts.append(f"count({'*' if every else f'`{r.column}`'}) as c{i}")
        allowed = f"c{i} - c{i} * {r.mostly}D + 1e-9D" if r.mostly < 1 else "0"
        rows.append(_result(r, f"f{i}", f"c{i}", f"f{i} <= {allowed}"))
    return df.selectExpr(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


Key = tuple[str, tuple[str, ...]]  # a table and its key columns


def _key_of(rule: Rule) -> Key:
    """The key that a rule is about; a reference is about the key of its parent."""
    if rule.kind == "unique":
        return rule.table, (rule.column, *rule.also)
    if rule.kind == "relationships":
        return rule.parent, (rule.parent_key,)
    raise ValueError(f"unknown rule kind {rule.kind}")


def key_counts(sources: list[Key], frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key without nulls, with the number of rows that each source has of it."""
    rows = []
    for i, (table, columns) in enumerate(sources):
        whole = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
        rows.append(frames[table].dropna(subset=list(columns)).select(
            whole.alias("key"), F.lit(i).alias("source")))
    return reduce(DataFrame.unionAll, rows).groupBy("key").agg(
        *[F.expr(f"count_if(source = {i})").alias(f"n{i}") for i in range(len(sources))])


def _key_rules(about: Key, rules: list[Rule], frames: Mapping[str, DataFrame]) -> DataFrame:
    """All rules about one key, which is the first source of the counts."""
    refers_to = [(r.table, (r.column,)) for r in rules if r.kind == "relationships"]
    sources = list(dict.fromkeys([about, *refers_to]))
    counts, rows = [], []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            n, failing = "n0", "count_if(n0 > 1)"
        else:
            n = f"n{sources.index((r.table, (r.column,)))}"
            failing = f"coalesce(sum(if(n0 = 0, {n}, 0)), 0)"
        counts += [f"{failing} as f{i}", f"coalesce(sum({n}), 0) as c{i}"]
        rows.append(_result(r, f"f{i}", f"c{i}", f"f{i} = 0"))
    return key_counts(sources, frames).selectExpr(*counts).selectExpr(
        f"inline(array({', '.join(rows)}))")


def evaluate(rules: Iterable[Rule], frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: failing and checked counts and the verdict.

    Keys are counted one after another and their results, a row a rule, are stored: in one plan
    the driver would hold the stages of all keys, and the disks their shuffles, at once.
    """
    by_table: dict[str, list[Rule]] = {}
    by_key: dict[Key, list[Rule]] = {}
    for rule in rules:
        if rule.kind in ROW_KINDS:
            by_table.setdefault(rule.table, []).append(rule)
        else:
            by_key.setdefault(_key_of(rule), []).append(rule)
    keyed = [_key_rules(k, rs, frames) for k, rs in by_key.items()]
    if len(keyed) > 1:
        keyed = [Scratch(keyed[0].sparkSession, "rules").save_all(keyed, "keys")]
    return union_all(keyed + [_row_rules(rs, frames[t]) for t, rs in by_table.items()])
