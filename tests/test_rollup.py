"""Prefix scan and hourly figures kept up to date."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kerbside.operators.prefix import running_max
from kerbside.plans import hourly
from kerbside.plans.rollup import HourlyRollup


def test_running_max_is_a_prefix_scan(spark):
    r = random.Random(2)
    rows = [(datetime(2025, 1, 1) + timedelta(hours=37 * i), r.choice([None, r.uniform(0, 10) + i / 50])) for i in range(400)] + [(None, 3.0)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "t timestamp, v double")
    made = running_max(df, "t", "v", "top")
    want, top = {}, 3.0
    for t, v in sorted(((t, v) for t, v in rows if t), key=lambda x: x[0]):
        top = max(top, v) if v is not None else top
        want[t] = top
    got = {row.t: row.top for row in made.collect()}
    assert got == want | {None: 3.0}
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"windowspecdefinition\(_bucket", plan) and not re.search(r"windowspecdefinition\(t#", plan)
    assert running_max(df.limit(0), "t", "v", "top").count() == 0


def test_rollup_equals_the_rebuild(spark, tmp_path):
    r = random.Random(6)
    start = datetime(2025, 1, 31, 20)
    rows = []
    for i in range(600):
        at = start + timedelta(minutes=15 * r.randint(0, 40))
        event = r.choice([None, at + timedelta(minutes=r.randint(0, 20))])
        rows.append((at if i % 50 else None, event, r.choice([None, "s1", "s2", *map(str, range(40000, 40030))]), r.choice([None, 0, 3]), 2))
    schema = "ingest_ts timestamp, event_ts timestamp, station_id string, num_bikes_available bigint, num_docks_available bigint"
    status = spark.createDataFrame(rows, schema).withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(3))).cache()
    rollup = HourlyRollup(spark, str(tmp_path))
    for part in (2, 0, 1):
        assert rollup.add(status.filter(F.col("part") == part), f"file-{part}")
        assert not rollup.add(status.filter(F.col("part") == part), f"file-{part}")
    want = hourly.hourly_totals(hourly.snapshot_totals(status))
    got = hourly.hourly_totals(rollup.snapshots())
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))
    # numbers stay as they were given
    numbers = {x.station_id: x.number for x in rollup.numbers.read().collect()}
    rollup.add(spark.createDataFrame([(start, start, "0", 1, 1)], schema), "late")
    later = {x.station_id: x.number for x in rollup.numbers.read().collect()}
    assert later == numbers | {"0": len(numbers) + 1}


def test_probes_read_footers_alone(spark, tmp_path):
    from kerbside.plans import ops
    from kerbside.sources import read_for_footers

    days = spark.range(100).selectExpr("id * 3600000000 as us", "date_add(date '2025-01-01', cast(id / 24 as int)) as ingest_date", "id as payload")
    days.write.partitionBy("ingest_date").parquet(str(tmp_path / "t"))
    footers = read_for_footers(spark, str(tmp_path / "t"))
    as_of = F.lit("1970-01-06 00:00:00").cast("timestamp_ntz")
    flow, daily = ops.flow_from_footers(footers, "us", as_of), ops.daily_flow_from_footers(footers, "us")
    for probe in (flow, daily):
        plan = probe._jdf.queryExecution().toString()
        assert "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan and "payload" not in plan.split("Physical Plan")[-1]
    row = flow.first()
    assert (row.row_count, row.lag_minutes) == (100, 21 * 60)
    assert sorted(r.row_count for r in daily.collect()) == [4, 24, 24, 24, 24]
    # the caller's session reads as before
    assert "BatchScan" not in spark.read.parquet(str(tmp_path / "t"))._jdf.queryExecution().toString()
