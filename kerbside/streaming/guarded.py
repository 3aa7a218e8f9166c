"""Micro-batches that a few unwritable rows do not stop."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbside.session import stage

_LOG = logging.getLogger(__name__)

#: Errors that lie in a row and come again however often it is tried.
PERMANENT = frozenset(
    "ARITHMETIC_OVERFLOW BINARY_ARITHMETIC_OVERFLOW CANNOT_PARSE_TIMESTAMP CAST_INVALID_INPUT CAST_OVERFLOW"
    " CONVERSION_INVALID_INPUT DATETIME_OVERFLOW DIVIDE_BY_ZERO INVALID_ARRAY_INDEX MALFORMED_RECORD_IN_PARSING"
    " NOT_NULL_ASSERT_VIOLATION NUMERIC_VALUE_OUT_OF_RANGE USER_RAISED_EXCEPTION".split()
)
_ROW, _HASH = "_kerbside_row", "_kerbside_hash"


class StrictCasts:
    """A ``prepare`` that casts columns and also tells, in one pass, which texts its casts refuse.

    Only casts of texts to other types than decimals, whose one row error is known, are told; rows that
    fail otherwise are found by :func:`isolate`.
    """

    def __init__(self, types: dict[str, str]):
        self.types = types

    def __call__(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.col(c).cast(t) for c, t in self.types.items()})

    def refusal(self, rows: DataFrame) -> Column:
        """The error condition of a row, NULL for a row whose casts hold."""
        texts = {f.name for f in rows.schema.fields if f.dataType == T.StringType()}
        told = {c: t for c, t in self.types.items() if c in texts and not t.lower().startswith("dec")}
        refused = F.lit(False)
        for c, t in told.items():
            refused = refused | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
        return F.when(refused, F.lit("CAST_INVALID_INPUT"))


def permanent_condition(error: BaseException) -> str | None:
    """The row error behind a failed job; None for anything else, which is worth another try."""
    seen: BaseException | None = error
    while seen is not None:
        condition = seen.getCondition() if isinstance(seen, PySparkException) else None
        if condition and condition.split(".")[0] in PERMANENT:
            return condition
        seen = seen.__cause__
    return None


def isolate(
    rows: DataFrame, attempt: Callable[[DataFrame], None], patience: int = 2000
) -> tuple[DataFrame, list[tuple[int, str]]]:
    """The rows with a number each, and (number, condition) of those that ``attempt`` refuses alone.

    A part that fails for good is halved by a hash of the row numbers until the culprits are alone: about
    2 log2(n) attempts for each. A passing error is raised as it is, and so is the row error when there are
    so many culprits that ``patience`` attempts do not find them.
    """
    numbered = stage(rows.withColumn(_ROW, F.monotonically_increasing_id()), "guarded_rows")
    hashed = numbered.withColumn(_HASH, F.xxhash64(_ROW))
    bad: list[tuple[int, str]] = []
    parts: list[tuple[int, int]] = [(0, 0)]  # (bits compared, their value)
    tried = 0
    while parts:
        bits, value = parts.pop()
        same = F.lit(True) if bits == 0 else F.col(_HASH).bitwiseAND(F.lit((1 << bits) - 1)) == F.lit(value)
        part = hashed.filter(same)
        try:
            tried += 1
            attempt(part.drop(_ROW, _HASH))
            continue
        except Exception as e:
            condition = permanent_condition(e)
            if condition is None or tried >= patience:
                raise
        first_two = [r[0] for r in part.select(_ROW).limit(2).collect()]
        if len(first_two) < 2:
            bad += [(r, condition) for r in first_two]
        else:
            parts += [(bits + 1, value), (bits + 1, value | 1 << bits)]
    return numbered, bad


def write_guarded(
    rows: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    commit: Callable[[DataFrame], None],
    dead_letters: Callable[[DataFrame], None],
    patience: int = 2000,
) -> None:
    """Commit ``prepare(rows)`` once, without the rows that cannot be; those go to ``dead_letters`` with why.

    The usual batch costs one write. Where ``prepare`` tells its refusals (:class:`StrictCasts`), a batch with
    culprits costs one more, however many they are. Only what then still fails is tried in parts, without
    output, and committed in one write of the others. Both functions must replace what an earlier try of the batch has
    written; both are called for every batch, so that a repeat leaves the same two tables.
    """
    empty = rows.withColumn("error_type", F.lit("")).filter(F.lit(False))
    try:
        commit(prepare(rows))
        dead_letters(empty)
        return
    except Exception as e:
        condition = permanent_condition(e)
        if condition is None:
            raise
        _LOG.warning("a batch has rows that cannot be written: %s", condition)
    told = empty
    if hasattr(prepare, "refusal"):
        judged = rows.withColumn("error_type", prepare.refusal(rows))
        told, rows = judged.filter("error_type is not null"), judged.filter("error_type is null").drop("error_type")
        try:
            commit(prepare(rows))
            dead_letters(told)
            return
        except Exception as e:
            if permanent_condition(e) is None:
                raise

    def attempt(part: DataFrame) -> None:
        prepare(part).write.format("noop").mode("overwrite").save()

    numbered, bad = isolate(rows, attempt, patience)
    refused = rows.sparkSession.createDataFrame(bad, f"{_ROW} bigint, error_type string")
    dead_letters(numbered.join(refused, _ROW).drop(_ROW).unionByName(told))
    commit(prepare(numbered.join(refused, _ROW, "left_anti").drop(_ROW)))


def run_guarded(
    rows: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    path: str,
    dead_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Stream ``prepare(rows)`` to ``path``; rows that cannot be written to ``dead_path``.

    Both tables have a folder for each batch, which a repeated batch replaces. Dead letters carry the row as
    JSON, the error and the time (``as_of``, else now).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        def commit(ready: DataFrame) -> None:
            ready.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        def bury(refused: DataFrame) -> None:
            row = F.to_json(F.struct(*[F.col(c) for c in refused.columns if c != "error_type"]), {"ignoreNullFields": "false"})
            at = (F.current_timestamp() if as_of is None else as_of).alias("dlq_ts")
            refused.select(at, "error_type", row.alias("row_json")).write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}")

        held = stage(batch, "guarded_batch")
        write_guarded(held, prepare, commit, bury)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
