"""Impact comparison on hand-made sections and stations."""

from datetime import datetime

from pyspark.sql import functions as F

from kerbside.operators.latest import latest_by
from kerbside.plans import impact, stations

SECTION = (
    "disruption_id string, cause string, severity string, title string, last_update timestamp, from_stop_name string,"
    " from_lat double, from_lon double, to_stop_name string, to_lat double, to_lon double"
)
A, B, C = ("A", 48.80, 2.30), ("B", 48.85, 2.30), ("C", 48.85, 2.40)
NOWHERE = (None, None, None)


def section(i, start, end, title="Metro 1", minute=0):
    return (f"d{i}", "c", "BLOQUANTE", title, datetime(2024, 1, 30, 10, minute), *start, *end)


def sections(spark, *rows):
    return spark.createDataFrame(list(rows), SECTION)


def facts(spark, *rows):
    """rows: id, point, bikes (None: does not report), capacity"""
    info = spark.createDataFrame(
        [(i, f"c{i}", f"n{i}", p[1], p[2], cap) for i, p, _, cap in rows],
        "station_id string, station_code string, name string, lat double, lon double, capacity bigint",
    )
    state = spark.createDataFrame(
        [(i, b, 0) for i, _, b, _ in rows if b is not None],
        "station_id string, num_bikes_available bigint, num_docks_available bigint",
    )
    return stations.station_facts(state, info)


NETWORK = [("1", A, 2, 10), ("2", B, 5, 10), ("3", C, 9, 10), ("4", B, 3, 0), ("5", B, 4, None), ("6", A, None, 10)]


def test_zone_against_control(spark):
    r = impact.impact_comparison(sections(spark, section(1, A, B)), facts(spark, *NETWORK)).collect()
    assert len(r) == 1
    row = r[0]
    # stations without a usable capacity are counted but not averaged
    assert row["stations_in_impact_zone"] == 5
    assert (row["zone_fill_rate_pct"], row["zone_avg_bikes_available"]) == (35.0, 3.5)
    assert (row["control_fill_rate_pct"], row["control_station_count"], row["fill_rate_delta_pct"]) == (90.0, 1, -55.0)
    assert row["closest_station_distance_m"] == 0.0


def test_empty_control_group(spark):
    r = impact.impact_comparison(sections(spark, section(1, A, B)), facts(spark, *NETWORK[:2])).first()
    assert r["control_station_count"] == 0 and r["control_fill_rate_pct"] is None and r["fill_rate_delta_pct"] is None


def test_both_directions_are_one_disruption(spark):
    rows = [section(1, A, B, minute=1), section(2, B, A, minute=2), section(3, A, B, title="RER B")]
    r = impact.impact_comparison(sections(spark, *rows), facts(spark, *NETWORK)).collect()
    assert sorted(x["disruption_id"] for x in r) == ["d2", "d3"]


def test_unknown_ends_compete_per_title_and_station(spark):
    rows = [section(1, A, NOWHERE, minute=1), section(2, B, NOWHERE, minute=2), section(3, A, NOWHERE, minute=3)]
    got = impact.impact_pairs(sections(spark, *rows), facts(spark, *NETWORK)).collect()
    assert {(x["disruption_id"], x["station_id"]) for x in got} == {
        ("d3", "1"), ("d3", "6"), ("d2", "2"), ("d2", "4"), ("d2", "5"),
    }
    assert all(x["nearest_stop_distance_m"] is None for x in got)
    loose = impact.impact_pairs(sections(spark, *rows), facts(spark, *NETWORK), strict=False).collect()
    assert all(x["nearest_stop_distance_m"] == 0.0 for x in loose)


def test_dropping_repeated_notices_early_changes_nothing(spark):
    ends = [A, B, C, NOWHERE, ("A", 48.81, 2.31)]
    rows = [
        section(n, ends[n % 5], ends[(n * 3 + n // 5) % 5], title=f"Metro {n % 2}", minute=n * 7 % 60)
        for n in range(60)
    ]
    active, live = sections(spark, *rows), facts(spark, *NETWORK)
    late = impact.near_disruptions(active, live)
    late = impact.dedup_undirected(
        late, "from_stop_name", "to_stop_name", ["title", "station_id"], impact._notice_order()
    )
    early = impact.impact_pairs(active, live)
    pick = ("disruption_id", "station_id", "from_stop_name", "to_stop_name", "from_lat", "to_lat")
    key = repr
    assert sorted(map(key, late.select(*pick).collect())) == sorted(map(key, early.select(*pick).collect()))


def test_map_rows(spark):
    comparison = impact.impact_comparison(
        sections(spark, section(1, A, B), section(2, C, NOWHERE, title="RER")), facts(spark, *NETWORK)
    )
    rows = impact.impact_map(comparison).collect()
    assert sorted((r["disruption_id"], r["stop_role"]) for r in rows) == [("d1", "from"), ("d1", "to"), ("d2", "from")]
    assert all(r["objectid"] >= 0 and r["geom_polygon"].startswith("POLYGON((") for r in rows)
    assert {r["geom_point"] for r in rows} == {"POINT(2.3 48.8)", "POINT(2.3 48.85)", "POINT(2.4 48.85)"}


def test_plan_has_no_nested_loop_and_no_python(spark):
    df = impact.impact_comparison(sections(spark, section(1, A, B)), facts(spark, *NETWORK))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert name not in plan


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = latest_by(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r["id"] for r in latest_by(df, ["k"], [F.desc("id")]).collect()} == {97, 98, 99}


def test_pairs_compete_by_numbers(spark):
    """The shuffle that chooses among notices carries no texts of notices and nothing of stations that is not asked for."""
    rows = [section(n, A, B, minute=n) for n in range(3)] + [section(9, ("A", 48.801, 2.30), B, minute=30)]
    network = facts(spark, *NETWORK).select("station_id", "lat", "lon", "fill_rate")
    pairs = impact.impact_pairs(sections(spark, *rows), network)
    assert {(r.disruption_id, r.station_id) for r in pairs.collect()} == {("d9", i) for i in ("1", "2", "4", "5", "6")}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :].splitlines()[0]
    assert "_rank" in window and "title" not in window and "last_update" not in window
