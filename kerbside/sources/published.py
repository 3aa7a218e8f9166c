"""A Parquet table whose loads become visible all at once.

Rows lie in immutable month folders. A load writes new folders for the months it touches and then appends
one row to the manifest: the version, and the folder of every month. That row is one small file, which
appears whole or not at all, so a reader sees the table before the load or after it. Folders that the
newest versions no longer name are emptied, a load's folders together once none of them is named; readers of
a version that is still kept are not cut off.
Spark's readers and writers do all of it, so any file system they know will do.

There is one writer at a time. Of two that load onto the same version, the one whose name sorts first
counts for every reader, and the other gets :class:`ConcurrentLoad`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.latest import latest_by
from kerbside.session import stage

MONTH = "ingest_month"
#: Month of rows that have no time.
NO_MONTH = "none"
#: Versions whose manifest rows lie in one folder; folders before the last two are emptied.
EPOCH = 64
_MANIFEST = "version bigint, writer string, load_id string, schema string, months map<string,string>"


class ConcurrentLoad(RuntimeError):
    """Another writer has published the version this load was made for."""


class Version(NamedTuple):
    version: int
    writer: str
    load_id: str | None
    schema: str
    months: dict[str, str]


class PublishedTable:
    """Table at ``path``; ``ts`` names the column whose month a row belongs to."""

    def __init__(self, spark: SparkSession, path: str, ts: str = "ingest_ts", keep_versions: int = 2):
        self.spark, self.path, self.ts, self.keep = spark, path.rstrip("/"), ts, max(1, keep_versions)

    # --- reading ---------------------------------------------------------------------------

    def read(self, months: Sequence[str] | None = None) -> DataFrame | None:
        """The rows as of now: later loads do not change them. None before the first load."""
        now = self._newest(1)
        return self._rows(now[0], months) if now else None

    def version(self) -> int:
        """Number of loads so far."""
        now = self._newest(1)
        return now[0].version if now else 0

    def _rows(self, version: Version, months: Sequence[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(version.schema))
        folders = [f for m, f in sorted(version.months.items()) if months is None or m in months]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # month folders are read as they are, so columns that a load did not have come as NULL
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST + ", epoch bigint").parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _newest(self, n: int) -> list[Version]:
        """The last ``n`` versions, newest first; of two writers of one version the first by name."""
        manifest = self._manifest()
        if manifest is None:
            return []
        rows = latest_by(manifest, ["version"], [F.asc("writer")]).orderBy(F.desc("version")).limit(n)
        return [Version(*r) for r in rows.select("version", "writer", "load_id", "schema", "months").collect()]

    def has_load(self, load_id: str) -> bool:
        """Whether a load of this name is among the last EPOCH versions at least."""
        manifest = self._manifest()
        return manifest is not None and not manifest.filter(F.col("load_id") == load_id).isEmpty()

    # --- loading ---------------------------------------------------------------------------

    def replace(self, rows: DataFrame, load_id: str | None = None, cluster_by: Sequence[str] = ()) -> bool:
        """A full refresh: ``rows`` and nothing else. False if the load has been published before."""
        if load_id is not None and self.has_load(load_id):
            return False
        before = self._newest(self.keep)
        self._publish(self._with_month(rows), rows.schema, before, load_id, list(cluster_by), set(), True)
        return True

    def merge(
        self,
        new: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column],
        load_id: str | None = None,
        lookback: str | None = None,
        newest_wins: bool = False,
        cluster_by: Sequence[str] = (),
    ) -> bool:
        """Rows of ``new`` replace those of equal keys, in whatever month these lie.

        Among rows of equal keys within the load the first in ``order`` counts; with ``newest_wins`` also
        against the rows that are there, so that loads may come in any order. ``lookback`` takes only rows
        newer than the newest one less this interval, and rows without a time. Months that hold no row of
        the load or of its keys are not read beyond their keys, and where ``ts`` is a key not at all; a
        touched month is written anew as a whole. False if ``load_id`` has been published before.
        """
        if load_id is not None and self.has_load(load_id):
            return False
        before = self._newest(self.keep)
        incoming = new
        if before and lookback is not None:
            dated = sorted(m for m in before[0].months if m != NO_MONTH)
            newest = self._rows(before[0], dated[-1:]).agg(F.max(self.ts) - F.expr(f"interval {lookback}")).first()[0]
            if newest is not None:
                incoming = new.filter((F.col(self.ts) > F.lit(newest)) | F.col(self.ts).isNull())
        incoming = stage(self._with_month(incoming), "incoming")
        # at most one short text a month of history
        touched = {r[0] for r in incoming.select(MONTH).distinct().collect()}
        if not touched and before:
            schema = self._merged_schema(before[0], new.schema)
            self._publish(incoming, schema, before, load_id, list(cluster_by), set(), False)
            return True
        merged, schema = incoming.withColumn("_is_new", F.lit(True)), new.schema
        if before:
            if self.ts not in keys:
                there = self._with_month(self._rows(before[0]))
                same = incoming.select(*keys).distinct()
                matches = F.lit(True)
                for k in keys:
                    matches = matches & there[k].eqNullSafe(same[k])
                touched |= {r[0] for r in there.join(same, matches, "left_semi").select(MONTH).distinct().collect()}
            schema = self._merged_schema(before[0], new.schema)
            kept = self._with_month(self._rows(before[0], sorted(touched))).withColumn("_is_new", F.lit(False))
            merged = merged.unionByName(kept, allowMissingColumns=True)
        first = F.desc("_is_new")
        ranking = [*order, first] if newest_wins else [first, *order]
        merged = latest_by(merged, list(keys), ranking).drop("_is_new")
        self._publish(merged, schema, before, load_id, list(cluster_by) or list(keys[:1]), touched, False)
        return True

    def _with_month(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(MONTH, F.coalesce(F.date_format(self.ts, "yyyyMM"), F.lit(NO_MONTH)))

    def _merged_schema(self, version: Version, new: T.StructType) -> T.StructType:
        old = T.StructType.fromJson(json.loads(version.schema))
        types = {f.name: f.dataType for f in old}
        changed = [f.name for f in new if f.name in types and types[f.name] != f.dataType]
        if changed:
            raise ValueError(f"columns of another type than in the table: {changed}")
        return T.StructType([*old.fields, *[T.StructField(f.name, f.dataType) for f in new if f.name not in types]])

    def _publish(
        self, rows: DataFrame, schema: T.StructType, before: list[Version], load_id: str | None, cluster_by: list[str],
        touched: set[str], all_months: bool,
    ) -> None:
        """Write the folders, then the manifest row, then empty what no kept version names."""
        number = before[0].version + 1 if before else 1
        writer = uuid.uuid4().hex
        # a load that is repeated after it broke off writes over its own folders
        name = f"loads/{number:08d}-" + (writer if load_id is None else "".join(c if c.isalnum() else "_" for c in load_id))
        (
            rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, *cluster_by)
            .write.mode("overwrite").partitionBy(MONTH).parquet(f"{self.path}/{name}")
        )
        written = self.spark.read.schema(f"{MONTH} string").parquet(f"{self.path}/{name}")
        months = {r[0]: f"{name}/{MONTH}={r[0]}" for r in written.distinct().collect()}
        if before and not all_months:
            months = {m: f for m, f in before[0].months.items() if m not in touched} | months
        row = [(number, writer, load_id, schema.json(), months)]
        epoch = f"{self.path}/manifest/epoch={number // EPOCH}"
        self.spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("append").parquet(epoch)
        if self._newest(1)[0].writer != writer:
            raise ConcurrentLoad(f"version {number} of {self.path} is another writer's")
        kept = [Version(number, writer, load_id, schema.json(), months), *before]
        if len(kept) > self.keep:
            old, *live = [{f.rsplit("/", 1)[0] for f in v.months.values()} for v in (kept[self.keep], *kept[: self.keep])]
            self._empty(old.difference(*live))
        if number % EPOCH == 0 and number >= 2 * EPOCH:
            nothing = self.spark.createDataFrame([], _MANIFEST)
            nothing.write.mode("overwrite").parquet(f"{self.path}/manifest/epoch={number // EPOCH - 2}")

    def _empty(self, folders: set[str]) -> None:
        nothing = self.spark.createDataFrame([], f"{self.ts} timestamp").coalesce(1)
        for folder in sorted(folders):
            nothing.write.mode("overwrite").parquet(f"{self.path}/{folder}")
