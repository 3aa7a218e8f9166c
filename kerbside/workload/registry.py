"""Registered queries: name -> (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside import fixed_values as fx
from kerbside import schemas
from kerbside.functions import circle_wkt, haversine_m
from kerbside.operators import events, quality, replay
from kerbside.operators.asof import join_as_of, validity_intervals
from kerbside.operators.stations import flatten_station_info
from kerbside.plans import disruptions, hourly, impact, ops, stations
from kerbside.plans.rollup import HourlyRollup
from kerbside.session import configure, stage, staging_dir
from kerbside.sources import (
    PublishedTable,
    SeenIds,
    append_by_day,
    disruption_response_errors,
    explode_disruptions,
    land_raw,
    merge_incremental,
    publish_table,
    push_dead_letters,
    push_outcomes,
    raw_outcomes,
    read_for_footers,
    read_lines,
    read_seed,
    stream_lines,
    wrap_snapshot,
    write_dead_letters,
    write_ndjson,
)
from kerbside.streaming import (
    StrictCasts,
    deduplicate_stream,
    enrich_stream,
    read_changes,
    read_live_state,
    run_append,
    run_closing_windows,
    run_curation,
    run_deduplicated,
    run_disruption_staging,
    run_enrichment_as_of,
    run_guarded,
    run_live_state,
    run_station_changes,
    settled_totals,
    silent_stations,
    state_of_changes,
    windowed_totals,
)
from kerbside.workload.derived import Tables

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-02-01 00:00:00"

_QUERIES: dict[str, Query] = {}


def _boundary(df: DataFrame) -> DataFrame:
    """Instants leave as UTC wall-clock timestamps, the type of the given tables."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


#: A compressed megabyte of the given tables becomes some 40 MB of derived rows, which tasks sort in memory.
SPLIT_BYTES = "8m"


def _split_finely(spark: SparkSession) -> None:
    """Inputs in pieces whose derived rows a task can sort without spilling; a size chosen by the session stays."""
    if spark.conf.get("spark.sql.files.maxPartitionBytes") in ("134217728b", "134217728", "128m", "128MB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        _split_finely(spark)
        return _boundary(fn(Tables(spark, sf_dir)))

    _QUERIES[fn.__name__] = run
    return fn


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- shared inputs -----------------------------------------------------------------------


def _state(t: Tables) -> DataFrame:
    return stations.latest_state(t.station_status, [F.desc("event_id")])


def _information(t: Tables) -> DataFrame:
    return stations.latest_information(t.station_information)


def _facts(t: Tables) -> DataFrame:
    return stations.station_facts(_state(t), _information(t))


BOTH = (fx.SEVERITY_BLOCKING, fx.SEVERITY_DISTURBED)


def _sections(t: Tables, severities: tuple[str, ...] = (fx.SEVERITY_BLOCKING,), with_towns: bool = False) -> DataFrame:
    projected = disruptions.project_disruptions(t.disruptions_raw)
    return disruptions.disruption_sections(projected, t.zone_bridge, t.stops_reference, severities, with_towns)


def _active(t: Tables, severities: tuple[str, ...] = (fx.SEVERITY_BLOCKING,)) -> DataFrame:
    return disruptions.active_sections(stage(_sections(t, severities), "sections"))


def _near(t: Tables, cell_rows: int | None = None) -> DataFrame:
    near = impact.near_disruptions(_active(t), _information_for_near(t), cell_rows=cell_rows, digits=3)
    return near.drop("lat", "lon")


def _information_for_near(t: Tables) -> DataFrame:
    return _information(t).select(
        "station_id", "station_code", F.col("name").alias("station_name"), "lat", "lon",
        F.col("capacity").alias("station_capacity"),
    )


def _impact_inputs(t: Tables, severities: tuple[str, ...] = (fx.SEVERITY_BLOCKING,)) -> tuple[DataFrame, DataFrame]:
    """Active sections, a cheap filter over staged rows, and station facts, staged: both have several readers."""
    return _active(t, severities), stage(_facts(t), "facts")


def _comparison(t: Tables, severities: tuple[str, ...] = (fx.SEVERITY_BLOCKING,)) -> DataFrame:
    return impact.impact_comparison(*_impact_inputs(t, severities))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _routed(t: Tables) -> DataFrame:
    return events.route_snapshots(t.envelopes.select("value"))


def _dead_letters(t: Tables) -> DataFrame:
    return events.dead_letters(_routed(t))


def _hourly(t: Tables) -> DataFrame:
    return hourly.hourly_totals(hourly.snapshot_totals(t.station_status))


# --- events: parse, validate, flatten, dead letters --------------------------------------


@query
def normalized_events(t: Tables) -> DataFrame:
    ok = events.normalize_events(events.parse_events(t.envelopes)).filter("error is null")
    return ok.select(
        "event_id", "ingest_ts", "event_ts", "source", "event_type", "key",
        F.size(F.try_variant_get("payload", "$.data.stations", "array<variant>")).cast("bigint").alias("n_elements"),
    )


@query
def rejected_events(t: Tables) -> DataFrame:
    bad = events.normalize_events(events.parse_events(t.envelopes)).filter("error is not null")
    return bad.select("event_id", F.col("error.type").alias("error_type"), F.col("error.message").alias("error_message"))


@query
def curated_status(t: Tables) -> DataFrame:
    return events.station_rows(_routed(t)).drop("raw_station_json")


@query
def flattened_status(t: Tables) -> DataFrame:
    ok = events.normalize_events(events.parse_events(t.envelopes)).filter("error is null")
    return events.flatten_status(ok).drop("raw_station_json")


@query
def raw_station_members(t: Tables) -> DataFrame:
    raw = F.try_parse_json("raw_station_json")
    return events.station_rows(_routed(t)).select(
        "ingest_ts",
        "station_id",
        F.try_variant_get(raw, "$.last_reported", "bigint").alias("raw_last_reported"),
        F.try_variant_get(raw, "$.numDocksAvailable", "string").alias("raw_docks"),
    )


@query
def dead_letters_parse(t: Tables) -> DataFrame:
    return (
        _dead_letters(t)
        .filter(F.col("stage") == fx.STAGE_PARSE)
        .select("stage", "error_type", "error_message", "raw", "event_meta", "row_json", "sink_errors")
    )


@query
def dead_letters_mapping(t: Tables) -> DataFrame:
    return (
        _dead_letters(t)
        .filter(F.col("stage") == fx.STAGE_MAPPING)
        .select(
            "stage", "error_type", "error_message", "event_meta", "row_json",
            F.get_json_object("raw", "$.payload.data").isNull().alias("no_data"),
            *[F.get_json_object("raw", f"$.{n}").alias(f"raw_{n}") for n in ("ingest_ts", "event_ts", "key")],
        )
    )


@query
def dead_letters_sink(t: Tables) -> DataFrame:
    return (
        _dead_letters(t)
        .filter(F.col("stage") == fx.STAGE_SINK)
        .select(
            "stage", "error_type", "error_message", "raw", "event_meta", "sink_errors",
            F.get_json_object("row_json", "$.ingest_ts").alias("row_ingest_ts"),
            F.get_json_object("row_json", "$.event_ts").alias("row_event_ts"),
            F.get_json_object("row_json", "$.station_id").alias("row_station_id"),
        )
    )


@query
def dead_letter_counts(t: Tables) -> DataFrame:
    return events.dlq_counts(_dead_letters(t))


@query
def dead_letter_inspection(t: Tables) -> DataFrame:
    routed = events.route_snapshots(t.envelopes.select("value"), as_of())
    return ops.inspect_dead_letters(
        events.dead_letters(routed), stage=fx.STAGE_PARSE, message_like="%Missing source%"
    )


@query
def replayed_dead_letters(t: Tables) -> DataFrame:
    lines = events.replay_status_dead_letters(_dead_letters(t))
    return events.dlq_counts(events.dead_letters(events.route_snapshots(lines)))


@query
def second_replay(t: Tables) -> DataFrame:
    """Lines left for another replay after one that failed again in full: none."""
    first = stage(_dead_letters(t), "dead_letters")
    lines = events.replay_status_dead_letters(first)
    ledger = stage(events.replay_ledger(lines), "replay_ledger")
    again = events.dead_letters(events.route_snapshots(lines))
    left = events.replay_status_dead_letters(first.unionByName(again), ledger)
    return left.agg(F.count(F.lit(1)).alias("lines"))


# --- landing -----------------------------------------------------------------------------


@query
def landed_raw(t: Tables) -> DataFrame:
    return land_raw(t.info_messages)


@query
def landing_dead_letters(t: Tables) -> DataFrame:
    return raw_outcomes(t.info_messages).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def push_decisions(t: Tables) -> DataFrame:
    return (
        push_outcomes(t.info_messages, drill_enabled=True)
        .groupBy("outcome", "reason")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query
def landed_station_information(t: Tables) -> DataFrame:
    return flatten_station_info(t.info_messages, as_of()).drop("raw_station_json")


@query
def exhausted_deliveries(t: Tables) -> DataFrame:
    failed = push_outcomes(t.info_messages, drill_enabled=True).filter(F.col("outcome").isin("retry", "rejected"))
    return push_dead_letters(failed, "station-info-sub").select(
        "subscription_name", "message_id", "publish_time",
        F.length("data").cast("bigint").alias("data_bytes"), F.col("attributes")["origin"].alias("origin"),
    )


@query
def disruption_feed_rows(t: Tables) -> DataFrame:
    return explode_disruptions(t.bulk_responses)


@query
def disruption_errors(t: Tables) -> DataFrame:
    return disruption_response_errors(t.bulk_responses)


@query
def snapshot_envelopes(t: Tables) -> DataFrame:
    return wrap_snapshot(t.feed_documents, "bikeshare", fx.SNAPSHOT_EVENT_TYPE)


# --- stations ----------------------------------------------------------------------------


@query
def latest_state(t: Tables) -> DataFrame:
    return _state(t)


@query
def latest_information(t: Tables) -> DataFrame:
    return _information(t)


@query
def latest_enriched(t: Tables) -> DataFrame:
    return stations.enrich(_state(t), _information(t))


@query
def live_kpis(t: Tables) -> DataFrame:
    return ops.live_kpis(_state(t))


@query
def district_availability(t: Tables) -> DataFrame:
    state = _state(t).select("station_id", "num_bikes_available")
    return ops.availability_by_post_code(state.join(_information(t), "station_id"))


@query
def history_size(t: Tables) -> DataFrame:
    return ops.history_size(t.station_status)


@query
def station_count(t: Tables) -> DataFrame:
    return ops.distinct_stations(t.station_information)


@query
def daily_stations(t: Tables) -> DataFrame:
    return ops.daily_stations(t.station_information)


@query
def status_freshness(t: Tables) -> DataFrame:
    return ops.freshness(t.station_status, as_of())


def _footers(t: Tables) -> DataFrame:
    """The curated table with its ingest time as microseconds beside it, as the footer probes need it."""
    path = _folder(t)
    micros = F.unix_micros(F.col("ingest_ts").cast("timestamp"))
    append_by_day(t.station_status.withColumn("ingest_us", micros), path)
    return read_for_footers(t.spark, path)


@query
def status_flow_from_footers(t: Tables) -> DataFrame:
    return ops.flow_from_footers(_footers(t), "ingest_us", as_of())


@query
def daily_flow_from_footers(t: Tables) -> DataFrame:
    return ops.daily_flow_from_footers(_footers(t), "ingest_us")


@query
def temporal_baseline(t: Tables) -> DataFrame:
    return _rounded(ops.temporal_baseline(t.station_status), 6, "usual_bikes")


@query
def hourly_depletion(t: Tables) -> DataFrame:
    return ops.hourly_depletion(t.station_status, "event_id")


# --- hourly ------------------------------------------------------------------------------


@query
def snapshot_totals(t: Tables) -> DataFrame:
    return hourly.snapshot_totals(t.station_status)


@query
def hourly_aggregate(t: Tables) -> DataFrame:
    return _hourly(t)


@query
def hourly_from_partials(t: Tables) -> DataFrame:
    """Hourly figures from four loads that each touch every hour, one of them repeated."""
    rollup = HourlyRollup(t.spark, _folder(t))
    status = stage(t.station_status, "status")
    for i in (2, 0, 3, 1, 0):
        rollup.add(status.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i), f"load-{i}")
    return hourly.hourly_totals(rollup.snapshots())


@query
def hourly_coverage(t: Tables) -> DataFrame:
    return hourly.with_coverage(_hourly(t))


@query
def hourly_well_covered(t: Tables) -> DataFrame:
    return hourly.well_covered(_hourly(t))


@query
def availability_trend(t: Tables) -> DataFrame:
    return ops.availability_trend(hourly.well_covered(_hourly(t)))


@query
def empty_station_trend(t: Tables) -> DataFrame:
    return ops.empty_station_trend(hourly.well_covered(_hourly(t)))


@query
def windowed_status_totals(t: Tables) -> DataFrame:
    return windowed_totals(t.station_status, "1 hour", "30 minutes")


# --- disruptions -------------------------------------------------------------------------


@query
def staged_disruptions(t: Tables) -> DataFrame:
    return disruptions.stage_disruptions(t.disruptions_raw)


@query
def disruption_sections(t: Tables) -> DataFrame:
    return _sections(t)


@query
def active_sections(t: Tables) -> DataFrame:
    return _active(t)


@query
def disruption_periods(t: Tables) -> DataFrame:
    return disruptions.line_and_periods(disruptions.project_disruptions(t.disruptions_raw))


@query
def disruptions_by_severity(t: Tables) -> DataFrame:
    return ops.active_by_severity(disruptions.latest_disruptions(disruptions.project_disruptions(t.disruptions_raw)))


@query
def disruption_timeline(t: Tables) -> DataFrame:
    return ops.disruption_timeline(disruptions.stage_disruptions(t.disruptions_raw))


@query
def raw_flow(t: Tables) -> DataFrame:
    return ops.raw_flow(t.disruptions_raw)


@query
def poll_counts(t: Tables) -> DataFrame:
    return ops.poll_counts(disruptions.stage_disruptions(t.disruptions_raw))


@query
def incremental_staging(t: Tables) -> DataFrame:
    """Two overlapping loads, then a repeat of the second one, which must change nothing."""
    path = f"{staging_dir(t.spark)}/kerbside/staged-{uuid.uuid4().hex}"
    raw = t.disruptions_raw
    first_half = raw.filter(F.col("ingest_ts") < F.expr("timestamp_ntz '2024-01-30 16:00:00'"))
    for load in (first_half, raw, raw):
        merge_incremental(
            disruptions.stage_disruptions(load), path, ["disruption_id", "ingest_ts"], [F.asc("last_update")]
        )
    return t.spark.read.parquet(path).drop("ingest_month")


@query
def published_staging(t: Tables) -> DataFrame:
    """What readers have who began before and after the second load; a repeat of that load is a no-op."""
    table = PublishedTable(t.spark, _folder(t))
    raw = t.disruptions_raw

    def load(rows: DataFrame, name: str) -> None:
        table.merge(disruptions.stage_disruptions(rows), ["disruption_id", "ingest_ts"], [F.asc("last_update")], load_id=name)

    load(raw.filter(F.col("ingest_ts") < F.expr("timestamp_ntz '2024-01-30 16:00:00'")), "first")
    before = table.read()
    for _ in range(2):
        load(raw, "second")
    return before.withColumn("reader", F.lit("before")).unionByName(table.read().withColumn("reader", F.lit("after")))


@query
def merged_across_months(t: Tables) -> DataFrame:
    """The newest feed row of every key, from three loads that mix all months."""
    table = PublishedTable(t.spark, _folder(t))
    rows = stage(explode_disruptions(t.bulk_responses).select("ingest_ts", "key", "payload"), "feed_rows")
    share = F.pmod(F.xxhash64("ingest_ts", "key", "payload"), F.lit(3))
    for i in range(3):
        table.merge(rows.filter(share == i), ["key"], [F.desc("ingest_ts"), F.asc("payload")], newest_wins=True)
    return table.read()


@query
def published_refresh(t: Tables) -> DataFrame:
    """A model materialised as a table, refreshed as a whole."""
    path, totals = _folder(t), _hourly(t)
    publish_table(totals.filter("hour_ts < timestamp_ntz '2024-01-15 00:00:00'"), path, "hour_ts")
    return publish_table(totals, path, "hour_ts")


# --- streams over files Spark writes from the tables ---------------------------------------


@query
def streamed_status(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    t.envelopes.select("value").write.text(f"{base}/lines")
    run_curation(
        stream_lines(t.spark, f"{base}/lines", max_files_per_trigger=4),
        f"{base}/status", f"{base}/dlq", f"{base}/checkpoint", {"availableNow": True},
    ).awaitTermination()
    return t.spark.read.parquet(f"{base}/status").drop("raw_station_json", "batch_id", "ingest_date")


def _status_stream(t: Tables, base: str) -> DataFrame:
    """Station readings as a stream of several micro-batches."""
    t.station_status.repartition(4).write.parquet(f"{base}/status")
    stream = t.spark.readStream.schema(t.station_status.schema).option("maxFilesPerTrigger", 2)
    return stream.parquet(f"{base}/status")


def _closing(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    run_closing_windows(
        _status_stream(t, base), f"{base}/windows", f"{base}/checkpoint", {"availableNow": True}, "1 hour", "30 minutes",
        "2 hours",
    ).awaitTermination()
    return settled_totals(t.spark, f"{base}/windows")


@query
def streamed_windowed_totals(t: Tables) -> DataFrame:
    """Windows that closed, their late readings, and the windows still open: together the batch result."""
    return _closing(t).drop("closed")


@query
def streamed_closing_windows(t: Tables) -> DataFrame:
    """Windows that have closed: their end lies two hours behind the newest reading."""
    return _closing(t).filter("closed").select("window_start", "readings")


def _changes(t: Tables) -> DataFrame:
    """Readings as a stream of four deliveries in the order of their snapshots, taken up one by one."""
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    status = t.station_status
    span = status.agg(F.min("ingest_ts").alias("first"), F.max("ingest_ts").alias("last")).first()
    edges = [span["first"] + (span["last"] - span["first"]) * i / 4 for i in range(1, 4)]
    for low, high in zip([None, *edges], [*edges, None], strict=True):
        after = F.lit(True) if low is None else F.col("ingest_ts") > F.lit(low)
        until = F.lit(True) if high is None else F.col("ingest_ts") <= F.lit(high)
        status.filter(after & until).write.mode("append").parquet(f"{base}/status")
        stream = t.spark.readStream.schema(status.schema).parquet(f"{base}/status")
        run_station_changes(
            stream, f"{base}/changes", f"{base}/checkpoint", "event_id", "1 day", "1 hour", {"availableNow": True}
        ).awaitTermination()
    return read_changes(t.spark, f"{base}/changes", status.schema)


@query
def changed_stations(t: Tables) -> DataFrame:
    return state_of_changes(_changes(t))


@query
def stations_fallen_silent(t: Tables) -> DataFrame:
    """Stations without a reading for a day before the watermark, an hour behind the newest reading."""
    return silent_stations(_changes(t))


@query
def streamed_enrichment(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    rows = enrich_stream(_status_stream(t, base), stage(_information(t), "information"))
    run_append(rows, f"{base}/rows", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(f"{base}/rows").select("event_id", "station_id", "name", "lat", "lon", "capacity")


@query
def redelivered_messages(t: Tables) -> DataFrame:
    """Messages from three loads, a redelivery often in a later one than its first delivery; one load is repeated."""
    seen = SeenIds(t.spark, _folder(t), buckets=8)
    messages = stage(t.info_messages, "info_messages")
    share = F.pmod(F.xxhash64("message_id", "data", "attempt"), F.lit(3))
    loads = {i: stage(seen.fresh(messages.filter(share == i), f"load-{i}"), "fresh") for i in (0, 1, 2, 1)}
    return loads[0].unionByName(loads[1]).unionByName(loads[2]).select("message_id")


@query
def streamed_redeliveries(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    messages = t.info_messages
    messages.repartition(4).write.parquet(f"{base}/messages")
    source = t.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/messages")
    run_deduplicated(source, f"{base}/ids", f"{base}/unique", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(f"{base}/unique").select("message_id")


def _versions(t: Tables) -> DataFrame:
    versions = t.station_information.withColumnRenamed("ingest_ts", "valid_from")
    return validity_intervals(versions.select("station_id", "valid_from", "name", "capacity"), ["station_id"], "valid_from")


@query
def station_versions(t: Tables) -> DataFrame:
    return _versions(t)


VERSION_COLUMNS = ["valid_from", "valid_to", "name", "capacity"]


@query
def enriched_as_of(t: Tables) -> DataFrame:
    """Every reading with the metadata that was valid at its time."""
    status = t.station_status.withColumn("seen_at", F.coalesce("event_ts", "ingest_ts"))
    rows = join_as_of(status, _versions(t), ["station_id"], "seen_at", "valid_from", VERSION_COLUMNS)
    return rows.select("event_id", "station_id", *VERSION_COLUMNS)


@query
def streamed_enrichment_as_of(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    versions = stage(_versions(t), "versions")
    run_enrichment_as_of(
        _status_stream(t, base), lambda: versions, f"{base}/rows", f"{base}/checkpoint", VERSION_COLUMNS, {"availableNow": True}
    ).awaitTermination()
    return t.spark.read.parquet(f"{base}/rows").select("event_id", "station_id", *VERSION_COLUMNS)


def _guarded(t: Tables) -> str:
    """Readings with a station number, which a few stations lack: such rows cannot be written."""
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    number = F.when(F.col("event_id") % 4999 == 998, F.lit("depot")).otherwise(F.col("station_id"))
    t.station_status.select("event_id", number.alias("number")).repartition(4).write.parquet(f"{base}/in")
    stream = t.spark.readStream.schema("event_id bigint, number string").option("maxFilesPerTrigger", 2).parquet(f"{base}/in")

    run_guarded(
        stream, StrictCasts({"number": "bigint"}), f"{base}/rows", f"{base}/dead", f"{base}/checkpoint", {"availableNow": True}, as_of()
    ).awaitTermination()
    return base


@query
def guarded_rows(t: Tables) -> DataFrame:
    return t.spark.read.parquet(f"{_guarded(t)}/rows").select("event_id", "number")


@query
def guarded_dead_letters(t: Tables) -> DataFrame:
    dead = t.spark.read.parquet(f"{_guarded(t)}/dead")
    return dead.select("dlq_ts", "error_type", F.get_json_object("row_json", "$.event_id").cast("bigint").alias("event_id"))


@query
def streamed_message_ids(t: Tables) -> DataFrame:
    """Redelivered messages pass once."""
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    messages = t.info_messages.withColumn("publish_time", F.col("publish_time").cast("timestamp"))
    messages.repartition(4).write.parquet(f"{base}/messages")
    source = t.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/messages")
    unique = deduplicate_stream(source)
    run_append(unique, f"{base}/unique", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(f"{base}/unique").select("message_id")


@query
def streamed_live_state(t: Tables) -> DataFrame:
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    source = _status_stream(t, base)
    run_live_state(
        source, f"{base}/state", f"{base}/checkpoint", {"availableNow": True}, ["event_id"]
    ).awaitTermination()
    return read_live_state(t.spark, f"{base}/state")


@query
def streamed_staging(t: Tables) -> DataFrame:
    """The disruption feed as a stream of files that come newest first."""
    base = f"{staging_dir(t.spark)}/kerbside/stream-{uuid.uuid4().hex}"
    raw = t.disruptions_raw
    # four micro-batches of as many files as the input's size asks for; one poll may fill several
    files = -(-raw.rdd.getNumPartitions() // 4)
    raw.repartitionByRange(4 * files, F.desc("ingest_ts"), "key").write.parquet(f"{base}/raw")
    source = t.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/raw")
    run_disruption_staging(source, f"{base}/staged", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    return PublishedTable(t.spark, f"{base}/staged").read()


# --- round trips through the sinks and sources ---------------------------------------------


def _folder(t: Tables) -> str:
    return f"{staging_dir(t.spark)}/kerbside/round-{uuid.uuid4().hex}"


@query
def curated_table(t: Tables) -> DataFrame:
    """The day-partitioned table, a repeated overwrite included."""
    path = _folder(t)
    rows = stage(events.station_rows(_routed(t)), "status_rows")
    for _ in range(2):
        append_by_day(rows, path, mode="overwrite")
    return t.spark.read.parquet(path).drop("raw_station_json")


@query
def dead_letter_table(t: Tables) -> DataFrame:
    path = _folder(t)
    dead = stage(_dead_letters(t), "dead_letters")
    stages = (fx.STAGE_PARSE, fx.STAGE_MAPPING, fx.STAGE_SINK)
    write_dead_letters([dead.filter(F.col("stage") == s) for s in stages], path)
    return events.dlq_counts(t.spark.read.parquet(path))


@query
def ndjson_round_trip(t: Tables) -> DataFrame:
    """Envelope lines written as NDJSON text, read by the line source, curated."""
    path = _folder(t)
    t.envelopes.select("value").write.text(path)
    rows = events.station_rows(events.route_snapshots(read_lines(t.spark, path))).drop("raw_station_json")
    out = _folder(t)
    write_ndjson(rows, out)
    return t.spark.read.schema(rows.schema).json(out)


@query
def seed_round_trip(t: Tables) -> DataFrame:
    path = _folder(t)
    t.stops_reference.write.option("header", "true").csv(path)
    return read_seed(t.spark, path, schemas.STOPS_REFERENCE)


# --- impact ------------------------------------------------------------------------------


@query
def stations_near_disruptions(t: Tables) -> DataFrame:
    return _near(t)


@query
def stations_near_disruptions_split(t: Tables) -> DataFrame:
    """The same pairs with dense cells split by their counts."""
    return _near(t, cell_rows=20)


@query
def impact_comparison(t: Tables) -> DataFrame:
    return _rounded(_comparison(t), 3, "closest_station_distance_m")


@query
def impact_map(t: Tables) -> DataFrame:
    return _rounded(impact.impact_map(_comparison(t)), 3, "closest_station_distance_m").drop("geom_polygon")


@query
def impact_zone_polygons(t: Tables) -> DataFrame:
    """Each circle's points, whether its ring closes, and how far its corners lie from the stop."""
    rows = impact.impact_map(_comparison(t), per_section_ids=True)
    points = F.split(F.regexp_extract("geom_polygon", r"\(\((.*)\)\)", 1), ", *")

    def metres(point: Column) -> Column:
        lon, lat = (F.get(F.split(F.trim(point), " "), i).cast("double") for i in (0, 1))
        return F.round(haversine_m(F.col("lat"), F.col("lon"), lat, lon))

    away = F.transform("points", metres)
    return rows.select("objectid", "stop_role", "lat", "lon", points.alias("points")).select(
        "objectid", "stop_role", F.size("points").alias("points"),
        (F.get("points", F.lit(0)) == F.element_at("points", -1)).alias("closed"),
        F.array_min(away).alias("nearest_corner_m"), F.array_max(away).alias("farthest_corner_m"),
    )


@query
def far_zone_polygons(t: Tables) -> DataFrame:
    """Circles of 2 km around the stops, moved to the antimeridian and the poles: parts, and what holds for each."""
    turned = F.pmod(F.col("lon") * 40 + 179.0, F.lit(4.0)) + 178.0
    lon = F.when(turned > 180.0, turned - 360.0).otherwise(turned)
    lat = F.when(F.col("zda_id") % 4 == 0, 89.98 + F.col("zda_id") % 20 / 1000.0).otherwise(F.col("lat"))
    lat = F.when(F.col("zda_id") % 8 == 0, -lat).otherwise(lat)
    moved = t.stops_reference.select("zda_id", lon.alias("lon"), lat.alias("lat"))
    rings = F.regexp_extract_all(circle_wkt("lon", "lat", 2000.0), F.lit(r"\(([^()]+)\)"), F.lit(1))
    points = F.transform(
        rings,
        lambda ring: F.transform(F.split(ring, ", "), lambda p: F.transform(F.split(p, " "), lambda v: v.cast("double"))),
    )
    x = F.transform("points", lambda ring: F.transform(ring, lambda p: F.get(p, F.lit(0))))
    return moved.withColumn("points", points).select(
        "zda_id",
        F.size("points").alias("parts"),
        F.forall("points", lambda ring: F.get(ring, F.lit(0)) == F.element_at(ring, -1)).alias("closed"),
        # no edge of a part is longer than half the map, but for the edge along a pole
        (F.exists(x, lambda ring: F.array_max(ring) - F.array_min(ring) > 180.0)).alias("over_pole"),
        F.forall(x, lambda ring: (F.array_min(ring) >= -180.0) & (F.array_max(ring) <= 180.0)).alias("on_the_map"),
    )


@query
def impact_kpis(t: Tables) -> DataFrame:
    active, facts = _impact_inputs(t)
    return impact.impact_kpis(impact.measured_pairs(active, facts), facts)


@query
def impact_classes(t: Tables) -> DataFrame:
    classes = impact.impact_class(_comparison(t))
    return classes.select("disruption_id", "from_stop_name", "to_stop_name", "fill_rate_delta_pct", "impact_class")


@query
def impact_by_severity(t: Tables) -> DataFrame:
    return impact.impact_by_severity(_comparison(t, BOTH))


@query
def lowest_stations(t: Tables) -> DataFrame:
    return impact.lowest_stations(impact.impact_pairs(_active(t), _facts(t)))


@query
def nearest_stations(t: Tables) -> DataFrame:
    alike = impact.alike_in_listing(_active(t))
    near = impact.near_disruptions(alike, _information_for_near(t), columns=alike.columns)
    return impact.nearest_listing(near)


@query
def ring_comparison(t: Tables) -> DataFrame:
    return impact.ring_comparison(_sections(t, BOTH).filter("from_lat is not null"), stage(_facts(t), "facts"))


@query
def walking_listing(t: Tables) -> DataFrame:
    return impact.walking_listing(_sections(t, BOTH, with_towns=True), _facts(t))


# --- replay ------------------------------------------------------------------------------


def _replay_plan(t: Tables, **options) -> DataFrame:
    return replay.plan_replay(t.push_dlq, "run-1", "projects/demo/subscriptions/hold-sub", **options)


@query
def replay_plan(t: Tables) -> DataFrame:
    names = F.array_sort(F.map_keys("attributes"))
    text = F.array_join(F.transform(names, lambda k: F.concat(k, F.lit("="), F.col("attributes")[k])), ";")
    return _replay_plan(t).select("message_id", "publish_time", "data", text.alias("attributes"), "action", "acknowledge")


@query
def replay_summary(t: Tables) -> DataFrame:
    return replay.summarise_replay(_replay_plan(t, max_messages=None, ack_skipped=True))


@query
def replay_repeated(t: Tables) -> DataFrame:
    """Messages of two runs; the first one is repeated with a new plan, which changes nothing."""
    batches, ledger = _folder(t), _folder(t)
    plan = _replay_plan(t)
    replay.run_replay(plan, batches, ledger, "run-1")
    done = t.spark.read.parquet(ledger)
    for run_id in ("run-1", "run-2"):
        later = replay.plan_replay(t.push_dlq, run_id, "hold-sub", ledger=done)
        replay.run_replay(later, batches, ledger, run_id)
    return replay.replayed_messages(t.spark, batches).select("message_id", "run_id")


@query
def original_publish_times(t: Tables) -> DataFrame:
    return ops.original_publish_time(t.push_dlq)


# --- quality -----------------------------------------------------------------------------

CHECKS = [
    quality.Check("hourly_aggregate", "hour_ts", "unique"),
    quality.Check("hourly_aggregate", "hour_ts", "not_null"),
    quality.Check("hourly_aggregate", "avg_total_bikes_available", "not_null"),
    quality.Check("hourly_aggregate", "snapshot_samples", "not_null"),
    quality.Check("hourly_coverage", "hour_ts", "unique"),
    quality.Check("hourly_coverage", "hour_ts", "not_null"),
    quality.Check("hourly_well_covered", "hour_ts", "unique"),
    quality.Check("hourly_well_covered", "hour_ts", "not_null"),
    quality.Check("stops_reference", "zda_id", "unique"),
    quality.Check("stops_reference", "zda_id", "not_null"),
    quality.Check("station_status", "event_ts", "not_null"),
    quality.Check("station_status", "station_id", "unique"),
    quality.Check("station_status", "ingest_ts", "fresh", max_age="15 minutes"),
    quality.Check("disruptions_raw", "event_type", "accepted_values", values=("disruption",)),
]


@query
def quality_report(t: Tables) -> DataFrame:
    totals = stage(_hourly(t), "hourly")
    models = {
        "hourly_aggregate": totals,
        "hourly_coverage": hourly.with_coverage(totals),
        "hourly_well_covered": hourly.well_covered(totals),
        "stops_reference": t.stops_reference,
        "station_status": t.station_status,
        "disruptions_raw": t.disruptions_raw,
    }
    return quality.run_checks(models, CHECKS, as_of())


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
