"""Shaping where Catalyst evaluates expensive expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column], keep: Column | None = None) -> DataFrame:
    """Add columns that later filters and projections refer to instead of repeating.

    Catalyst pushes a filter below a projection by copying the projected expression into it. For
    a parsed document that is read by many columns this repeats the parsing, many times over. A
    generator of one row is where such pushing stops. ``keep`` drops rows on the way.
    """
    one = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    # explode, unlike inline, stays inside generated code
    rows = df.select("*", F.explode(one if keep is None else F.when(keep, one)).alias("_once"))
    return rows.select("*", "_once.*").drop("_once")


def where_present(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)``, NULL where ``value`` is.

    For long rules that few rows need. Written as a lambda they stay out of the code Spark
    generates for the row loop, which the JVM only compiles while it is short.
    """
    return F.try_element_at(F.transform(F.when(value.isNotNull(), F.array(value)), rule), F.lit(1))
