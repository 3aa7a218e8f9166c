"""Published tables, closing windows, station changes, as-of joins, guarded writes, repeated replays."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import replay
from kerbside.operators.asof import join_as_of, validity_intervals
from kerbside.sources import ConcurrentLoad, PublishedTable, SeenIds, merge_incremental, path_exists, published, publish_table
from kerbside.streaming import StrictCasts, closed_windows, isolate, late_readings, run_station_changes, settled_totals, windowed_totals, write_guarded
from kerbside.streaming.changes import read_changes, silent_stations, state_of_changes
from kerbside.streaming.windows import close_batch

T0 = datetime(2026, 1, 1)


def rows(spark, *values):
    """(key, month or None, value)"""
    data = [(k, None if m is None else datetime(2026, m, 5), v) for k, m, v in values]
    return spark.createDataFrame(data, "k string, ingest_ts timestamp, v string")


def held(table):
    return sorted(((r.k, r.ingest_ts and r.ingest_ts.month, r.v) for r in table.collect()), key=repr)


def files(path):
    return {str(p.parent.relative_to(path)) for p in path.rglob("part-*") if p.stat().st_size > 800}


def test_readers_see_old_or_new(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.version() == 0
    order = [F.asc("v")]
    table.merge(rows(spark, ("a", 1, "x"), ("b", 2, "x"), ("n", None, "x")), ["k", "ingest_ts"], order, load_id="one")
    pinned = table.read()
    assert table.merge(rows(spark, ("a", 1, "y"), ("m", None, "x")), ["k", "ingest_ts"], order, load_id="two")
    assert held(pinned) == [("a", 1, "x"), ("b", 2, "x"), ("n", None, "x")]
    after = [("a", 1, "y"), ("b", 2, "x"), ("m", None, "x"), ("n", None, "x")]
    assert held(table.read()) == after
    # a repeated load is known by its name
    assert not table.merge(rows(spark, ("a", 1, "z")), ["k", "ingest_ts"], order, load_id="two")
    assert table.version() == 2 and held(table.read()) == after
    assert held(table.read(["202602"])) == [("b", 2, "x")]


def test_a_key_without_the_time_moves_between_months(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.merge(rows(spark, ("a", 1, "old"), ("b", 1, "x"), (None, 3, "x")), ["k"], [F.asc("v")])
    table.merge(rows(spark, ("a", 2, "new"), ("b", None, "no time"), (None, 1, "y")), ["k"], [F.asc("v")])
    assert held(table.read()) == sorted([("a", 2, "new"), ("b", None, "no time"), (None, 1, "y")], key=repr)
    # loads in any order: the newest row stays
    table.merge(rows(spark, ("a", 1, "older"), ("b", 1, "dated")), ["k"], [F.desc_nulls_last("ingest_ts")], newest_wins=True)
    assert held(table.read()) == sorted([("a", 2, "new"), ("b", 1, "dated"), (None, 1, "y")], key=repr)


def test_a_load_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.merge(rows(spark, ("a", 1, "x")), ["k"], [F.asc("v")], load_id="one")
    with monkeypatch.context() as m:
        m.setattr(published, "EPOCH", 0)  # the folders are written, the manifest row is not
        with pytest.raises(ZeroDivisionError):
            table.merge(rows(spark, ("a", 1, "y")), ["k"], [F.asc("v")], load_id="two")
    assert held(table.read()) == [("a", 1, "x")]
    table.merge(rows(spark, ("a", 1, "y")), ["k"], [F.asc("v")], load_id="two")
    assert held(table.read()) == [("a", 1, "y")]


def test_of_two_writers_one_counts(spark, tmp_path, monkeypatch):
    table = PublishedTable(spark, str(tmp_path / "t"))
    names = iter(["b" * 32, "a" * 32, "0" * 32, "1" * 32])

    class Name:
        def __init__(self):
            self.hex = next(names)

    monkeypatch.setattr(published.uuid, "uuid4", Name)
    table._publish(table._with_month(rows(spark, ("a", 1, "first"))), rows(spark).schema, [], None, [], set(), True)
    table._publish(table._with_month(rows(spark, ("a", 1, "second"))), rows(spark).schema, [], None, [], set(), True)
    assert held(table.read()) == [("a", 1, "second")]
    table._publish(table._with_month(rows(spark, ("a", 1, "third"))), rows(spark).schema, [], None, [], set(), True)
    with pytest.raises(ConcurrentLoad):
        table._publish(table._with_month(rows(spark, ("a", 1, "fourth"))), rows(spark).schema, [], None, [], set(), True)
    assert held(table.read()) == [("a", 1, "third")]


def test_old_folders_are_emptied_and_columns_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(published, "EPOCH", 2)
    path = tmp_path / "t"
    table = PublishedTable(spark, str(path))
    for i in range(7):
        table.merge(rows(spark, ("a", 1, str(i)), (f"k{i}", 1, "x")), ["k"], [F.asc("v")])
    assert table.version() == 7 and len(held(table.read())) == 8
    assert len({f.split("/")[0] for f in files(path / "loads")}) <= 2
    wider = rows(spark, ("w", 2, "x")).withColumn("extra", F.lit(1))
    table.merge(wider, ["k"], [F.asc("v")])
    assert {r.extra for r in table.read().collect()} == {None, 1} and table.read().count() == 9
    with pytest.raises(ValueError, match="another type"):
        table.merge(rows(spark, ("w", 2, "x")).withColumn("v", F.lit(1)), ["k"], [F.asc("v")])
    table.merge(rows(spark), ["k"], [F.asc("v")])
    assert table.read().count() == 9
    refreshed = publish_table(rows(spark, ("z", 4, "x")), str(path))
    assert held(refreshed) == [("z", 4, "x")]
    assert held(publish_table(rows(spark), str(tmp_path / "empty"))) == []


def test_lookback_takes_recent_rows_and_rows_without_a_time(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    table.merge(rows(spark, ("a", 3, "x")), ["k", "ingest_ts"], [F.asc("v")], lookback="1 day")
    table.merge(rows(spark, ("b", 1, "x"), ("a", 3, "y"), ("n", None, "x")), ["k", "ingest_ts"], [F.asc("v")], lookback="1 day")
    assert held(table.read()) == [("a", 3, "y"), ("n", None, "x")]


def test_incremental_merge_keeps_rows_without_a_time(spark, tmp_path):
    for lookback in (None, "1 minute"):
        path = str(tmp_path / f"m{lookback}")
        for k in ("n1", "n2"):
            merge_incremental(rows(spark, (k, None, "x"), ("a", 1, k)), path, ["k"], [F.asc("v")], lookback=lookback)
        got = {r.k for r in spark.read.parquet(path).collect()}
        assert got == {"n1", "n2", "a"}


def test_path_exists(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "_SUCCESS").write_text("")
    assert path_exists(spark, str(tmp_path / "x" / "_SUCCESS")) and not path_exists(spark, str(tmp_path / "y"))


# --- closing windows -----------------------------------------------------------------------


def readings(spark, *minutes):
    return spark.createDataFrame(
        [("s", T0 + timedelta(minutes=m), T0 + timedelta(minutes=m), m % 3) for m in minutes],
        "station_id string, event_ts timestamp, ingest_ts timestamp, num_bikes_available int",
    )


def test_windows_close_once_and_late_rows_are_kept(spark, tmp_path):
    path = str(tmp_path / "w")
    batches = [readings(spark, 5, 10, 70), readings(spark, 50, 200), readings(spark, 55, 65, 130), readings(spark, 400)]
    for batch_id, batch in enumerate(batches):
        for _ in range(2):  # every batch is repeated
            close_batch(batch, batch_id, path, "1 hour", None, "30 minutes")
    every = batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3])
    total = {r.window_start: (r.readings, r.bikes_seen, r.empty_readings) for r in windowed_totals(every).collect()}
    settled = {r.window_start: (r.readings, r.bikes_seen, r.empty_readings) for r in settled_totals(spark, path).collect()}
    assert settled == total
    hour = lambda n: T0 + timedelta(hours=n)
    closed = {(r.window_start, r.readings) for r in closed_windows(spark, path).collect()}
    # the first hour closes with the second batch and holds minutes 5, 10 and 50; the third hour had not closed
    # when minute 130 came
    assert closed == {(hour(0), 3), (hour(1), 1), (hour(2), 1), (hour(3), 1)}
    late = sorted((r.event_ts - T0).seconds // 60 for r in late_readings(spark, path).collect())
    assert late == [55, 65]
    assert not settled_totals(spark, path).filter(F.col("window_start") == F.lit(hour(6))).first().closed


def test_readings_without_a_time_belong_to_no_window(spark, tmp_path):
    nothing = readings(spark, 5).withColumn("event_ts", F.lit(None).cast("timestamp")).withColumn("ingest_ts", F.lit(None).cast("timestamp"))
    close_batch(nothing, 0, str(tmp_path / "w"), "1 hour", "30 minutes", "1 hour")
    close_batch(readings(spark, 5), 1, str(tmp_path / "w"), "1 hour", "30 minutes", "1 hour")
    assert settled_totals(spark, str(tmp_path / "w")).count() == 2


# --- station changes -----------------------------------------------------------------------


def test_changes_and_silence(spark, tmp_path):
    def write(n, *rows_):
        schema = "station_id string, event_ts timestamp, ingest_ts timestamp, tie bigint"
        data = [(s, None if e is None else T0 + timedelta(hours=e), T0 + timedelta(hours=i), t) for s, e, i, t in rows_]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        run_station_changes(
            stream, str(tmp_path / "out"), str(tmp_path / "cp"), "tie", "10 hours", "1 hour", {"availableNow": True}
        ).awaitTermination()
        changes = read_changes(spark, str(tmp_path / "out"), stream.schema)
        state = {(r.station_id, r.tie) for r in state_of_changes(changes).collect()}
        return state, {(r.station_id, (r.silent_since - T0).total_seconds() / 3600) for r in silent_stations(changes).collect()}

    assert write(0, ("a", 1, 1, 1), ("a", 1, 1, 2), ("b", None, 2, 3), ("c", 2, 2, 4)) == ({("a", 2), ("b", 3), ("c", 4)}, set())
    # a reading without an event time loses against one with; an older reading changes nothing
    assert write(1, ("b", 2, 2, 5), ("c", None, 3, 6), ("a", 8, 8, 7)) == ({("a", 7), ("b", 5), ("c", 4)}, set())
    assert write(2, ("a", 20, 20, 8)) == ({("a", 8), ("b", 5), ("c", 4)}, {("b", 2.0), ("c", 2.0)})
    assert write(3, ("b", 21, 21, 9)) == ({("a", 8), ("b", 9), ("c", 4)}, {("c", 2.0)})


# --- as-of join ----------------------------------------------------------------------------


def test_as_of(spark):
    day = lambda d, h=0: T0 + timedelta(days=d, hours=h)
    versions = spark.createDataFrame(
        [("a", day(1, 6), "a1"), ("a", day(3), "a2"), ("a", day(3, 12), "a3"), ("b", day(0), "b1"), ("b", None, "no"), (None, day(0), "no"), ("a", day(3), "z")],
        "k string, since timestamp, name string",
    )
    intervals = validity_intervals(versions, ["k"], "since", [F.asc("name")])
    assert {(r.name, r.valid_to) for r in intervals.collect()} == {("a1", day(3)), ("a2", day(3, 12)), ("a3", None), ("b1", None)}
    at = [("a", day(1)), ("a", day(1, 6)), ("a", day(2, 5)), ("a", day(3)), ("a", day(3, 11)), ("a", day(3, 12)), ("a", day(9)), ("b", day(5)), ("c", day(1)), (None, day(1)), ("a", None)]
    left = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(at * 2)], "id int, k string, t timestamp")
    got = sorted((r.id, r.name) for r in join_as_of(left, intervals, ["k"], "t", "since", ["name", "valid_to"]).collect())
    assert got == list(enumerate([None, "a1", "a1", "a2", "a2", "a3", "a3", "b1", None, None, None] * 2))
    for bucket in ("HOUR", "MONTH"):
        assert sorted((r.id, r.name) for r in join_as_of(left, intervals, ["k"], "t", "since", ["name"], bucket).collect()) == got


def test_as_of_spreads_a_hot_key(spark):
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as k", "timestamp '2026-01-01' + make_interval(0, 0, 0, cast(id % 30 as int)) as t")
    versions = spark.createDataFrame([("hot", T0, None, "v")], "k string, since timestamp, valid_to timestamp, name string")
    joined = join_as_of(left, versions, ["k"], "t", "since", ["name"])
    assert joined.filter("name = 'v'").count() == 1000
    assert "hashpartitioning(k" in (plan := joined._jdf.queryExecution().toString()) and "_bucket" in plan


# --- guarded writes ------------------------------------------------------------------------


def test_unwritable_rows_stand_alone(spark, tmp_path):
    frame = spark.range(500).selectExpr("id", "if(id in (7, 311, 499), 'bad', cast(id as string)) as v")
    strict = lambda d: d.withColumn("v", F.col("v").cast("bigint"))
    commits = []

    def commit(ready):
        ready.write.mode("overwrite").parquet(str(tmp_path / "ok"))
        commits.append(1)

    for _ in range(2):  # a repeat leaves the same tables
        write_guarded(frame, strict, commit, lambda d: d.write.mode("overwrite").parquet(str(tmp_path / "dead")))
        dead = spark.read.parquet(str(tmp_path / "dead"))
        assert {(r.id, r.error_type) for r in dead.collect()} == {(i, "CAST_INVALID_INPUT") for i in (7, 311, 499)}
        ids = [r.id for r in spark.read.parquet(str(tmp_path / "ok")).collect()]
        assert sorted(ids) == sorted(set(range(500)) - {7, 311, 499})
    assert len(commits) == 2  # the others are written once a batch
    write_guarded(frame.filter("v <> 'bad'"), strict, commit, lambda d: d.write.mode("overwrite").parquet(str(tmp_path / "dead")))
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 0


def test_refused_texts_cost_one_more_write_however_many(spark, tmp_path):
    frame = spark.range(4000).selectExpr("id", "case id % 4 when 1 then 'bad' when 2 then null else cast(id as string) end as v", "'1' as w")
    commits, buried = [], []

    def commit(ready):
        commits.append(1)
        ready.write.mode("overwrite").parquet(str(tmp_path / "ok"))

    def bury(dead):
        buried.extend((r.id, r.v, r.error_type) for r in dead.collect())

    write_guarded(frame, StrictCasts({"v": "bigint"}), commit, bury, patience=3)
    assert sorted(buried) == [(i, "bad", "CAST_INVALID_INPUT") for i in range(1, 4000, 4)] and len(commits) == 2
    kept = spark.read.parquet(str(tmp_path / "ok"))
    assert dict(kept.dtypes)["v"] == "bigint" and sorted(r.id for r in kept.collect()) == [i for i in range(4000) if i % 4 != 1]


def test_other_errors_are_still_isolated(spark, tmp_path):
    class Picky(StrictCasts):
        def __call__(self, rows):
            return super().__call__(rows).withColumn("one", F.lit(1) / (F.col("id") - 5))

    frame = spark.range(40).selectExpr("id", "if(id in (3, 5), 'bad', cast(id as string)) as v", "if(id = 5, '1', '2') as w")
    buried = []
    write_guarded(
        frame.withColumn("v", F.when(F.col("id") == 5, "5").otherwise(F.col("v"))), Picky({"v": "bigint"}),
        lambda d: d.write.mode("overwrite").parquet(str(tmp_path / "ok")), lambda d: buried.extend((r.id, r.error_type) for r in d.collect()),
    )
    assert sorted(buried) == [(3, "CAST_INVALID_INPUT"), (5, "DIVIDE_BY_ZERO")]
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 38


def test_passing_errors_are_raised(spark):
    def attempt(part):
        raise OSError("disk")

    with pytest.raises(OSError):
        isolate(spark.range(10), attempt)
    with pytest.raises(OSError):
        write_guarded(spark.range(10), lambda d: d, attempt, lambda d: None)


def test_patience_ends(spark):
    frame = spark.range(64).selectExpr("cast(concat('x', id) as string) as v")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        isolate(frame, lambda d: d.select(F.col("v").cast("int")).write.format("noop").mode("overwrite").save(), patience=5)


# --- replay --------------------------------------------------------------------------------


def test_a_finished_run_is_not_planned_anew(spark, tmp_path):
    batch, ledger = str(tmp_path / "batch"), str(tmp_path / "ledger")
    dead = spark.createDataFrame(
        [(f"m{i}", T0 + timedelta(minutes=i), "x", {"a": "b"}) for i in range(6)],
        "message_id string, publish_time timestamp, data string, attributes map<string,string>",
    )

    def run(ledger_rows=None):
        return replay.run_replay(replay.plan_replay(dead, "r1", "sub", max_messages=3, ledger=ledger_rows), batch, ledger, "r1")

    assert run() == 0
    stored = lambda: {r.message_id for r in replay.replayed_messages(spark, batch).collect()}
    assert stored() == {"m0", "m1", "m2"}
    done = spark.createDataFrame([(m,) for m in stored()], "message_id string")
    assert run(done) == 0 and stored() == {"m0", "m1", "m2"}
    assert {r.message_id for r in spark.read.parquet(ledger).collect()} == {"m0", "m1", "m2"}
    # died between the two: the ledger is filled from the stored batch, whatever the new plan says
    import shutil

    shutil.move(ledger, str(tmp_path / "gone"))
    assert run(done) == 0 and stored() == {"m0", "m1", "m2"}
    assert {r.message_id for r in spark.read.parquet(ledger).collect()} == {"m0", "m1", "m2"}


# --- ids that have been seen ---------------------------------------------------------------


def test_a_redelivery_after_a_week_is_dropped(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "ids"), buckets=4)

    def batch(*rows_):
        return spark.createDataFrame(
            [(m, T0 + timedelta(days=d), {"n": n}) for m, d, n in rows_], "message_id string, publish_time timestamp, attributes map<string,string>"
        )

    def new(name, *rows_):
        return sorted(((r.message_id, r.attributes["n"]) for r in seen.fresh(batch(*rows_), name).collect()), key=repr)

    assert new("one", ("a", 0, "1"), ("a", 1, "2"), ("b", 0, "1"), (None, 0, "x"), (None, 0, "x")) == [("a", "1"), ("b", "1"), (None, "x"), (None, "x")]
    assert new("two", ("a", 8, "3"), ("c", 8, "1")) == [("c", "1")]
    assert new("two", ("a", 8, "3"), ("c", 8, "1")) == [("c", "1")]  # a repeated load
    assert new("three") == [] and new("four", ("b", 9, "2"), ("c", 9, "2")) == []
    assert sorted(r.message_id for r in seen.ids().collect()) == ["a", "b", "c"]
    plan = seen.ids().filter("bucket in (1, 2)").join(batch(("a", 0, "1")), "message_id", "left_semi")._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan
