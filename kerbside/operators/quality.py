"""Data checks over tables: each check is a count of failing rows or values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``kind``: unique, not_null, accepted_values (needs ``values``) or fresh (needs ``max_age``).

    ``max_age`` is an interval text; a fresh column must hold a timestamp no older than that.
    """

    model: str
    column: str
    kind: str
    values: tuple = ()
    max_age: str | None = None


def _row_failures(check: Check, as_of: Column) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "accepted_values":
        return F.count_if(~c.isin(*check.values))
    if check.kind == "fresh":
        newest = F.max(c)
        stale = newest.isNull() | (newest < as_of - F.expr(f"interval {check.max_age}"))
        return F.when(stale, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    raise ValueError(f"unknown check {check.kind}")


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check], as_of: Column | None = None) -> DataFrame:
    """One row per check: model, column, check, failures.

    All row-wise checks of a model share one scan; each uniqueness check is one aggregation
    with map-side combine, so a value that repeats in most rows stays cheap.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    results = []
    for name in dict.fromkeys(c.model for c in checks):
        df = models[name]
        row_wise = [c for c in checks if c.model == name and c.kind != "unique"]
        if row_wise:
            counted = df.agg(*[_row_failures(c, now).alias(f"_{i}") for i, c in enumerate(row_wise)])
            entries = F.array(
                *[
                    F.struct(F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
                             F.col(f"_{i}").alias("failures"))
                    for i, c in enumerate(row_wise)
                ]
            )
            results.append(counted.select(F.lit(name).alias("model"), F.inline(entries)))
        for c in (c for c in checks if c.model == name and c.kind == "unique"):
            repeated = df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count().filter("count > 1")
            results.append(
                repeated.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(name).alias("model"), F.lit(c.column).alias("column"), F.lit("unique").alias("check"),
                    "failures",
                )
            )
    return reduce(DataFrame.unionByName, results)


def failing(report: DataFrame) -> DataFrame:
    return report.filter("failures > 0")


def require_passing(report: DataFrame) -> None:
    """Stop the run when any check failed, naming the failed checks."""
    bad = failing(report).collect()  # one row per declared check
    if bad:
        raise ValueError("; ".join(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in bad))
