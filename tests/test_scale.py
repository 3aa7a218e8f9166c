"""What one task or one job holds does not grow with the input."""

from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from kerbside.plans import impact
from kerbside.session import staging_dir
from kerbside.sources import sinks
from kerbside.workload import registry
from kerbside.workload.derived import Tables

SF = "/root/testdata/sf0.001"


def folders(spark):
    return set(Path(staging_dir(spark).removeprefix("file:")).glob("kerbside/stream-*"))


def test_long_rows_are_dealt_by_their_weight(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr("id", "timestamp '2026-01-01' as dlq_ts", "'parse' as stage", "repeat('long text ', 2000) as raw")
    sizes = [r["n"] for r in sinks.in_pieces(rows, "dlq_ts", piece_bytes=1 << 20).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 400 and max(sizes) < 150  # 20,000 bytes each, which compress to almost nothing
    monkeypatch.setattr(sinks, "PIECE_BYTES", 1 << 20)
    sinks.write_dead_letters([rows.filter("id < 200"), rows.filter("id >= 200")], str(tmp_path / "dead"))
    assert len(list((tmp_path / "dead").rglob("part-*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 400
    sinks.write_dead_letters([rows.filter("id < 0")], str(tmp_path / "none"))


def test_inputs_come_in_small_pieces(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "134217728b")
        registry.queries()["raw_flow"](spark, SF)
        assert spark.conf.get(key) == registry.SPLIT_BYTES
        spark.conf.set(key, "32m")  # somebody's choice
        registry.queries()["raw_flow"](spark, SF)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.set(key, before)


def test_one_poll_fills_several_files_of_the_staging_stream(spark):
    raw = Tables(spark, SF).disruptions_raw.withColumn("ingest_ts", F.expr("timestamp_ntz '2024-01-30 12:00:00'")).repartition(12)
    before = folders(spark)
    staged = registry.streamed_staging(SimpleNamespace(spark=spark, disruptions_raw=raw))
    assert staged.count() == raw.select(F.get_json_object("payload", "$.id")).distinct().count()
    (folder,) = folders(spark) - before
    assert len([p for p in (folder / "raw").glob("part-*.parquet")]) > 4


def test_a_delivery_of_readings_is_written_by_many_tasks(spark):
    status = Tables(spark, SF).station_status.repartition(6)
    before = folders(spark)
    changes = registry._changes(SimpleNamespace(spark=spark, station_status=status))
    assert changes.select("batch_id").distinct().count() >= 4
    (folder,) = folders(spark) - before
    assert len(list((folder / "status").glob("part-*.parquet"))) > 8


def _sections(spark, copies):
    return spark.range(copies).selectExpr(
        "cast(id as string) as disruption_id", "'T' as title", "'B' as severity", "'C' as cause", "'stop' as from_stop_name",
        "'town' as from_stop_town", "48.85D as from_lat", "2.35D as from_lon", "48.86D as to_lat", "2.36D as to_lon",
    )


def _stations(spark):
    return spark.range(3).selectExpr(
        "cast(id as string) as station_id", "concat('s', id) as station_name", "id as num_bikes_available", "id as num_docks_available",
        "48.85D + id * 0.001D as lat", "2.35D as lon", "id as station_capacity",
    )


def test_lines_that_read_alike_are_sorted_once(spark):
    """9,000 notices of one text, more than a list of copies holds, are one line of the sort."""
    listing = impact.walking_listing(_sections(spark, 9000), _stations(spark))
    rows = listing.collect()
    assert [r.distance_meters for r in rows] == sorted(r.distance_meters for r in rows)
    assert {n: sum(r.station_name == n for r in rows) for n in ("s0", "s1", "s2")} == {"s0": 9000, "s1": 9000, "s2": 9000}
    plan = listing._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Sort [") < plan.index("Aggregate [")


def test_a_walking_listing_reads_its_sections_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rows in batches:
            read.add(len(rows))
            yield rows

    sections = _sections(spark, 50)
    listing = impact.walking_listing(sections.mapInPandas(counted, sections.schema), _stations(spark))
    assert len(listing.collect()) == 150
    assert read.value == 50


def test_nearest_listing_counts_notices_that_read_alike(spark):
    active = _sections(spark, 7)
    stations = _stations(spark).drop("num_bikes_available", "num_docks_available")
    alike = impact.alike_in_listing(active)
    assert alike.count() == 1
    got = impact.nearest_listing(impact.near_disruptions(alike, stations, columns=alike.columns)).collect()
    assert [r.station_name for r in got] == ["s0"] * 7 + ["s1"] * 3
    full = active.withColumns({"last_update": F.current_timestamp(), "to_stop_name": F.lit("x")})
    assert got == impact.nearest_listing(impact.near_disruptions(full, stations)).collect()


def test_notices_of_a_station_follow_each_other(spark):
    """The columns of a station and its distances come in one run a station, which files hold in a few bytes."""
    more = {"last_update": F.expr("timestamp '2026-01-01'"), "to_stop_name": F.lit("x")}
    near = impact.near_disruptions(_sections(spark, 500).withColumns(more).repartition(3), _stations(spark), digits=3)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")  # as where both sides are large
        rows = near.collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 1500
    assert sum(a.station_id != b.station_id for a, b in zip(rows, rows[1:])) < 20
    assert all(r.distance_to_from_stop_meters == round(r.distance_to_from_stop_meters, 3) for r in rows)
    exact = impact.near_disruptions(_sections(spark, 1).withColumns(more), _stations(spark)).collect()
    assert {(r.station_id, r.distance_to_to_stop_meters) for r in rows} == {(r.station_id, round(r.distance_to_to_stop_meters, 3)) for r in exact}
