"""Sinks, incremental loads, streams, replay and checks."""

import hashlib
import json
import random
import time
from contextlib import nullcontext
from datetime import datetime, timedelta
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import events as ev
from kerbside.operators import quality, replay
from kerbside.plans import disruptions, hourly, stations
from kerbside.session import stage
from kerbside.sources import (
    append_by_day,
    merge_incremental,
    publish_view,
    read_seed,
    sinks,
    stream_lines,
    write_dead_letters,
    write_ndjson,
)
from kerbside.streaming import enrich_stream, read_live_state, run_curation, run_live_state


def lines(n):
    def one(i):
        body = {"ingest_ts": f"2026-01-{1 + i % 3:02d}T10:00:00Z", "source": "s", "event_type": ev.fx.SNAPSHOT_EVENT_TYPE,
                "key": "k", "payload": {"data": {"stations": [{"station_id": i % 4, "num_bikes_available": i}]}}}
        return json.dumps(body)[: 20 if i % 5 == 4 else None]

    return [one(i) for i in range(n)]


def test_stream_equals_batch_and_live_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(3):
        (tmp_path / "in" / f"{part}.txt").write_text("\n".join(lines(30)[part * 10 : part * 10 + 10]) + "\n")
    once = {"availableNow": True}
    source = stream_lines(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    q = run_curation(source, str(tmp_path / "ok"), str(tmp_path / "dlq"), str(tmp_path / "cp"), once)
    q.awaitTermination()
    rows, dlq = ev.curate(spark.read.text(str(tmp_path / "in")))
    pick = ["station_id", "ingest_ts", "num_bikes_available"]
    streamed = spark.read.parquet(str(tmp_path / "ok"))
    assert sorted(map(repr, streamed.select(*pick).collect())) == sorted(map(repr, rows.select(*pick).collect()))
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == dlq.count() == 6
    # a second run finds nothing new
    run_curation(source, str(tmp_path / "ok"), str(tmp_path / "dlq"), str(tmp_path / "cp"), once).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 24

    status = spark.readStream.schema(streamed.schema).parquet(str(tmp_path / "ok"))
    run_live_state(
        status, str(tmp_path / "state"), str(tmp_path / "cp2"), once, ["num_bikes_available"]
    ).awaitTermination()
    live = {(r["station_id"], r["num_bikes_available"]) for r in read_live_state(spark, str(tmp_path / "state")).collect()}
    batch = stations.latest_state(streamed, [F.desc("num_bikes_available")])
    assert live == {(r["station_id"], r["num_bikes_available"]) for r in batch.collect()}


def raw(spark, *rows):
    payload = '{{"id":"{}","title":"{}","severity":"BLOQUANTE","lastUpdate":"20240130T100000"}}'
    return spark.createDataFrame(
        [(datetime(2024, m, d, 10, n), payload.format(i, t)) for m, d, n, i, t in rows],
        "ingest_ts timestamp, payload string",
    )


def test_incremental_merge(spark, tmp_path):
    path = str(tmp_path / "staged")

    def load(*rows):
        merge_incremental(
            disruptions.stage_disruptions(raw(spark, *rows)), path, ["disruption_id", "ingest_ts"], [F.asc("title")]
        )
        return sorted((r["disruption_id"], r["ingest_ts"].month, r["title"]) for r in spark.read.parquet(path).collect())

    first = [(1, 5, 0, "a", "x"), (2, 5, 0, "b", "x")]
    assert load(*first) == [("a", 1, "x"), ("b", 2, "x")]
    assert load(*first) == [("a", 1, "x"), ("b", 2, "x")]
    # equal keys are replaced inside the lookback, older rows are left alone
    assert load((1, 5, 0, "a", "new"), (2, 5, 0, "b", "new"), (3, 1, 0, "c", "x")) == [
        ("a", 1, "x"), ("b", 2, "new"), ("c", 3, "x"),
    ]


def test_merge_without_a_mark_and_broken_targets(spark, tmp_path):
    path = str(tmp_path / "staged")

    def load(*rows):
        staged = disruptions.stage_disruptions(raw(spark, *rows))
        merge_incremental(staged, path, ["disruption_id", "ingest_ts"], [F.asc("title")], lookback=None)
        return sorted((r["disruption_id"], r["ingest_ts"].month, r["title"]) for r in spark.read.parquet(path).collect())

    load((3, 1, 0, "c", "x"), (1, 5, 0, "a", "x"))
    # older rows than the newest are merged all the same, other months stay
    assert load((1, 5, 0, "a", "new"), (1, 6, 0, "d", "x")) == [("a", 1, "new"), ("c", 3, "x"), ("d", 1, "x")]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="parquet|Parquet|footer"):
        merge_incremental(
            disruptions.stage_disruptions(raw(spark, (1, 5, 0, "a", "x"))), str(broken), ["disruption_id"], [F.asc("title")]
        )
    assert (broken / "part-0.parquet").read_bytes() == b"no parquet"


def test_sinks_and_sources(spark, tmp_path):
    rows, dlq = ev.curate(spark.createDataFrame([(x,) for x in lines(20)], "value string"))
    append_by_day(rows, str(tmp_path / "status"))
    append_by_day(rows, str(tmp_path / "status"))
    back = spark.read.parquet(str(tmp_path / "status"))
    assert back.count() == 32 and back.select("ingest_date").distinct().count() == 3
    write_dead_letters([dlq, dlq], str(tmp_path / "dlq"))
    write_dead_letters([dlq], None)
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 8
    write_ndjson(rows.select("station_id"), str(tmp_path / "nd"), shards=2)
    assert len(list((tmp_path / "nd").glob("part-*"))) == 2
    (tmp_path / "stops.csv").write_text("zda_id,name,lat,lon,town,type\n7,Nation,48.8,2.4,Paris,metro\n")
    seed = read_seed(spark, str(tmp_path / "stops.csv"), schemas.STOPS_REFERENCE)
    assert seed.first()["zda_id"] == 7 and seed.schema["lat"].dataType.simpleString() == "double"
    publish_view(stations.latest_state(spark.read.parquet(str(tmp_path / "status"))), "live_state")
    assert spark.table("live_state").count() == 4
    assert stage(seed, "seed").count() == 1
    enriched = enrich_stream(rows, spark.createDataFrame([("1", "One")], "station_id string, name string"), ["name"])
    assert enriched.filter("name = 'One'").count() == rows.filter("station_id = '1'").count()


def dead(spark, n=6):
    rows = [(str(i), datetime(2024, 1, 1, 0, i), "x", {"replay": "True"} if i % 3 == 0 else
             {"CloudPubSubDeadLetterX": "1", "dlq_test": "true", "keep": "yes"}) for i in range(n)]
    return spark.createDataFrame(rows, "message_id string, publish_time timestamp, data string, attributes map<string,string>")


def test_replay(spark, tmp_path):
    batch, ledger = str(tmp_path / "batch"), str(tmp_path / "ledger")
    plan = replay.plan_replay(dead(spark), "run", "a/b/sub", max_messages=4)
    got = {r["message_id"]: r for r in plan.collect()}
    assert sorted(got) == ["0", "1", "2", "3"] and got["0"]["action"] == "skipped" and not got["0"]["acknowledge"]
    assert got["1"]["attributes"] == {"keep": "yes", "replay": "true", "replay_id": "run", "replay_source": "sub"}
    assert replay.summarise_replay(plan).first().asDict() == {
        "pulled": 4, "republished": 2, "acked": 2, "skipped": 2, "failed": 0,
    }
    assert replay.run_replay(plan, batch, ledger, "run", dry_run=True) == 0 and not (tmp_path / "batch").exists()
    for _ in range(2):  # a repeated run replaces its own batch
        assert replay.run_replay(plan, batch, ledger, "run") == 0
    stored = replay.replayed_messages(spark, batch)
    assert stored.count() == 2
    assert replay.summarise_replay(plan, stored).first()["failed"] == 0
    lost = replay.summarise_replay(plan, stored.filter("message_id = '1'")).first()
    assert (lost["failed"], lost["acked"]) == (1, 1)
    assert replay.plan_replay(dead(spark), "run", "sub", max_messages=None).count() == 6
    again = replay.plan_replay(dead(spark), "run2", "sub", ledger=spark.read.parquet(ledger), ack_skipped=True)
    assert {r["message_id"] for r in again.filter("action = 'republished'").collect()} == {"4", "5"}
    assert replay.summarise_replay(again).first()["acked"] == 4
    assert replay.plan_replay(dead(spark), "r", "s", enabled=False).count() == 0
    assert replay.summarise_replay(replay.plan_replay(dead(spark), "r", "s", dry_run=True)).first()["acked"] == 0
    assert replay.run_replay(plan, batch, "/proc/none/ledger", "run") == 2


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "z")], "k int, v string")
    checks = [quality.Check("m", "k", "unique"), quality.Check("m", "v", "not_null"),
              quality.Check("m", "v", "accepted_values", values=("a",))]
    report = quality.run_checks({"m": df}, checks)
    assert {(r["column"], r["check"]): r["failures"] for r in report.collect()} == {
        ("k", "unique"): 1, ("v", "not_null"): 1, ("v", "accepted_values"): 1,
    }
    with pytest.raises(ValueError, match="m.k unique"):
        quality.require_passing(report)
    quality.require_passing(report.filter("failures > 5"))


def test_hours_around_the_clock_change(spark):
    stamps = [datetime(2024, 10, 27, h, 30) for h in (0, 1, 2)]
    df = spark.createDataFrame([(t.strftime("%Y-%m-%d %H:%M:%S"),) for t in stamps], "t string")
    status = df.select(
        F.to_timestamp("t").alias("ingest_ts"), F.lit(None).cast("timestamp").alias("event_ts"),
        F.lit("1").alias("station_id"), F.lit(0).alias("num_bikes_available"), F.lit(1).alias("num_docks_available"),
    )
    out = hourly.well_covered(hourly.hourly_totals(hourly.snapshot_totals(status)))
    local = sorted((r["hour_local"].hour, r["hour_of_day_local"]) for r in out.collect())
    # the local hour 2 happens twice
    assert local == [(2, 2), (2, 2), (3, 3)]
    offset = hourly.snapshot_totals(status, tz="Asia/Kolkata").select(F.date_format("hour_ts", "HH:mm")).collect()
    assert sorted(r[0] for r in offset) == ["00:30", "01:30", "02:30"]


def _shuffled(spark):
    """Bytes of the shuffle files there are."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.stat().st_size for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data"))


def _texts(spark, n, first=0):
    """Rows of a month, one a minute, with a text that does not compress."""
    text = "concat_ws('', transform(sequence(1, 4), i -> sha2(concat(id, '-', i), 256)))"
    ts = "timestamp_ntz '2024-01-02' + id * interval '1' minute"
    return spark.range(first, first + n).selectExpr("id as k", f"{ts} as ingest_ts", f"{text} as v")


def test_a_load_shuffles_what_is_new_and_removes_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "staged")
    load = partial(merge_incremental, path=path, keys=["k", "ingest_ts"], order=[F.asc("v")])
    before = _shuffled(spark)
    load(_texts(spark, 20_000))
    for _ in range(50):  # removal is not waited for
        if _shuffled(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffled(spark) <= before
    monkeypatch.setattr(sinks, "shuffles_released", lambda _: nullcontext(), raising=False)
    before = _shuffled(spark)
    load(_texts(spark, 20_100))
    assert _shuffled(spark) - before < 1_000_000  # of 5 MB
    assert spark.read.parquet(path).drop("ingest_month").exceptAll(_texts(spark, 20_100)).count() == 0
    assert spark.read.parquet(path).count() == 20_100


def test_merge_of_large_and_small_sides(spark, tmp_path):
    """The side of few rows and the side of many are dealt alike: a key meets itself."""
    path = str(tmp_path / "staged")
    keys, order = ["k", "ingest_ts"], [F.asc("v")]
    merge_incremental(_texts(spark, 3000), path, keys, order, lookback="1 day")
    new = _texts(spark, 40_000, 1000).withColumn("v", F.concat(F.lit("new"), "v"))
    merge_incremental(new.union(new.withColumn("v", F.concat("v", F.lit("z")))), path, keys, order, lookback="1 day")
    got = spark.read.parquet(path)
    assert got.count() == got.select(*keys).distinct().count() == 41_000
    assert got.filter("v like 'new%'").agg(F.min("k"), F.max("k"), F.count("*")).first()[:] == (1560, 40_999, 39_440)
    assert got.filter("v like '%z'").count() == 0


def test_merge_is_what_plain_rules_say(spark, tmp_path):
    """Keys and times repeat and are missing; months and loads overlap."""
    rng, path, there = random.Random(4), str(tmp_path / "staged"), {}
    for load in range(4):
        ts = [None, *(datetime(2024, 1, 30) + timedelta(hours=12 * i) for i in range(5 + 2 * load))]
        rows = [(rng.choice([None, *"abcde"]), rng.choice(ts), f"{load}-{rng.random():.6f}") for _ in range(60)]
        mark = max((t for _, t in there if t), default=datetime(1, 1, 2)) - timedelta(hours=18)
        new = {}
        for k, t, v in rows:
            if t is None or t > mark:
                new[k, t] = min(v, new.get((k, t), v))
        there |= new
        df = spark.createDataFrame(rows, "k string, ingest_ts timestamp_ntz, v string")
        merge_incremental(df, path, ["k", "ingest_ts"], [F.asc("v")], lookback="18 hours")
        got = [((r.k, r.ingest_ts), r.v) for r in spark.read.parquet(path).collect()]
        assert len(got) == len(there) and dict(got) == there


def test_digests_compete_as_bytes(spark):
    """Of equal keys the smallest digest wins, which travels in half the bytes."""
    rows = raw(spark, *[(1, 5, 0, "a", f"t{i}") for i in range(20)])
    staged = disruptions.stage_disruptions(rows)
    first = min(rows.collect(), key=lambda r: hashlib.md5(r.payload.encode()).hexdigest())
    assert [r.title for r in staged.collect()] == [json.loads(first.payload)["title"]]
    assert "unhex" in staged._jdf.queryExecution().optimizedPlan().toString()
