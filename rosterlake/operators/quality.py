"""Declarative checks on built tables. A check fails when it has failing rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named rule on one column of one table."""

    kind: str  # not_null | unique | accepted_values | expression
    table: str
    column: str
    values: tuple[str, ...] = ()
    failing: str = ""  # SQL predicate of failing rows, for kind "expression"
    show: tuple[str, ...] = ()  # columns shown for failing rows

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


class QualityError(RuntimeError):
    """A table broke one of its checks."""


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column)


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def accepted_values(table: str, column: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", table, column, tuple(values))


def expression(table: str, column: str, failing: str, show: Sequence[str]) -> Check:
    return Check("expression", table, column, failing=failing, show=tuple(show))


def _failing(check: Check) -> Column:
    """Predicate of a failing row; a NULL passes a list of accepted values."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    return F.expr(check.failing)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """Offending rows; for value checks one row per offending value with its count."""
    if check.kind == "unique":
        known = df.where(F.col(check.column).isNotNull())
        counts = known.groupBy(check.column).agg(F.count("*").alias("n_records"))
        return counts.where("n_records > 1")
    rows = df.where(_failing(check))
    if check.kind == "accepted_values":
        return rows.groupBy(check.column).agg(F.count("*").alias("n_records"))
    return rows.select(*check.show) if check.show else rows


def _hits(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(number, failures)`` of the checks that look at single rows, in one pass.

    Only failing rows go on from the filter, so a clean table shuffles nothing.
    Accepted values count once per value, the other checks once per row.
    """
    scanned = [(i, c) for i, c in enumerate(checks) if c.kind != "unique"]
    by_value = [i for i, c in scanned if c.kind == "accepted_values"]
    verdicts = [
        F.when(
            _failing(c),
            F.struct(
                F.lit(i).alias("number"),
                F.when(F.lit(i in by_value), F.col(c.column).cast("string")).alias("value"),
            ),
        )
        for i, c in scanned
    ]
    return (
        df.where(reduce(Column.__or__, [_failing(c) for _, c in scanned]))
        .select(F.explode(F.array_compact(F.array(*verdicts))).alias("hit"))
        .groupBy("hit.number", "hit.value")
        .agg(F.count("*").alias("n"))
        .groupBy("number")
        .agg(F.sum(F.when(F.col("number").isin(*by_value), 1).otherwise(F.col("n"))).alias("failures"))
    )


def summarize(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``(check_name, table_name, column_name, failures)`` of one table.

    One pass for all row and value checks; each uniqueness check adds a count
    per key over its own column.
    """
    parts = [_hits(df, checks)] if any(c.kind != "unique" for c in checks) else []
    for i, check in enumerate(checks):
        if check.kind == "unique":
            repeated = failing_rows(df, check).agg(F.count("*").alias("failures"))
            parts.append(repeated.select(F.lit(i).alias("number"), "failures"))
    found = reduce(DataFrame.unionByName, parts)
    rows = [(i, c.name, c.table, c.column) for i, c in enumerate(checks)]
    names = df.sparkSession.createDataFrame(
        rows, "number int, check_name string, table_name string, column_name string"
    )
    # At most one row per declared check on either side.
    return names.join(F.broadcast(found), "number", "left").select(
        "check_name",
        "table_name",
        "column_name",
        F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"),
    )


def gate(df: DataFrame, checks: Sequence[Check]) -> list:
    """Run the checks of one table and raise when any has failures."""
    results = summarize(df, checks).collect()
    broken = [f"{r.check_name} ({r.failures})" for r in results if r.failures > 0]
    if broken:
        raise QualityError("failed checks: " + ", ".join(broken))
    return results


def watched(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts the rows which fail a check of single rows, while another table is
    built from it. A frame that is empty by its plan is never run, so it counts nothing."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    if most.isDefined() and most.get() == 0:
        return df, None
    seen = Observation()
    counts = [F.count_if(_failing(c)).alias(c.name) for c in checks]
    return df.observe(seen, *counts), seen


def verdict(df: DataFrame, checks: Sequence[Check], seen: Observation | None) -> list:
    """What :func:`gate` says, from the counts of :func:`watched`; ``df`` is read only where
    a check has failures."""
    if seen is None or any(seen.get.values()):
        return gate(df, checks)
    return [Row(check_name=c.name, table_name=c.table, column_name=c.column, failures=0) for c in checks]
