"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.functions import greatest_strict, least_strict


def latest_by(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order; ``order`` should end in a total tie-break.

    Catalyst turns the rank filter into a group limit that runs before the shuffle as well, so
    each task ships at most one row per key: a key holding most rows does not overload anyone.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_undirected(
    df: DataFrame,
    a: str,
    b: str,
    extra_keys: Sequence[Column | str],
    order: Sequence[Column],
    strict: bool = True,
) -> DataFrame:
    """One row per unordered pair (a, b) and extra keys.

    With ``strict`` a pair with a missing end has no order, so all such rows of the same extra
    keys compete with each other. Otherwise the known end identifies the pair.
    """
    low, high = (least_strict, greatest_strict) if strict else (F.least, F.greatest)
    return latest_by(df, [*extra_keys, low(F.col(a), F.col(b)), high(F.col(a), F.col(b))], order)
