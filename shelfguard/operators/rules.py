"""Expect-or-drop rules, per-rule failure counts and a raising validator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named SQL boolean expression that every kept row must satisfy."""

    name: str
    predicate: str

    def holds(self) -> Column:
        # NULL counts as a failure: the row is kept only when the rule is TRUE.
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def all_hold(rules: Sequence[Rule]) -> Column:
    return reduce(lambda acc, r: acc & r.holds(), rules, F.lit(True))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Drop every row that fails any rule (one filter, pushed to the scan)."""
    return df.where(all_hold(rules)) if rules else df


def failure_columns(rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(~r.holds()).alias(r.name) for r in rules]


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row fails, in the rules' order."""
    return F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))


def rule_failures(df: DataFrame, rules: Sequence[Rule], table: str | None = None) -> DataFrame:
    """One row per rule: rows that fail it, plus rows seen and rows kept.

    A single aggregation pass (partial per task, one tiny final merge).
    """
    aggregated = df.agg(
        F.count(F.lit(1)).alias("_rows_seen"),
        F.count_if(all_hold(rules)).alias("_rows_kept"),
        *failure_columns(rules),
    )
    names = ["_rows_seen", "_rows_kept"] + [r.name for r in rules]
    long = aggregated.unpivot([], names, "rule_name", "failed_rows")
    if table is not None:
        long = long.select(F.lit(table).alias("table_name"), "rule_name", "failed_rows")
    return long
