"""Parsing, validation, flattening and dead letters of hand-made lines."""

import json

from pyspark.sql import functions as F

from kerbside.operators import events as ev

TS = "2026-01-24T16:00:00Z"


def station(**members):
    return {"station_id": 123, **members}


def line(stations=None, **changes):
    body = {
        "ingest_ts": TS, "event_ts": TS, "source": "bikeshare", "event_type": "station_status_snapshot",
        "key": "k", "payload": {"data": {"stations": stations}},
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def routed(spark, *lines):
    """Station rows and dead letters, each in the order of the lines (one partition)."""
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    rows, dlq = ev.curate(df)
    return rows.collect(), dlq.collect()


def one_row(spark, **members):
    rows, dlq = routed(spark, line([station(**members)]))
    assert not dlq
    return rows[0]


def test_two_stations(spark):
    full = station(
        stationCode="16107", is_installed=1, is_renting=1, is_returning=1, last_reported=1737734400,
        num_bikes_available=7, num_docks_available=13, num_bikes_available_types=[{"mechanical": 3}, {"ebike": 4}],
    )
    rows, dlq = routed(spark, line([full, {"station_id": "456"}]))
    assert not dlq and len(rows) == 2
    r = next(r for r in rows if r["station_id"] == "123")
    assert (r["station_code"], r["is_installed"], r["is_renting"], r["is_returning"]) == ("16107", 1, 1, 1)
    assert (r["num_bikes_available"], r["num_docks_available"]) == (7, 13)
    assert (r["mechanical_available"], r["ebike_available"]) == (3, 4)
    assert json.loads(r["raw_station_json"]) == full
    assert r["ingest_ts"] == r["event_ts"]


def test_last_reported_is_utc(spark):
    df = spark.createDataFrame([(line([station(last_reported=1737734400)]),)], "value string")
    text = ev.curate(df)[0].select(F.date_format("last_reported_ts", "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert text == "2025-01-24 16:00:00"


def rows_of(spark, cases):
    """One row per element, all in one job."""
    rows, dlq = routed(spark, *[line([station(**members)]) for members in cases])
    assert not dlq and len(rows) == len(cases)
    return rows


def test_bike_types(spark):
    cases = [
    ([{"mechanical": 3}, {"ebike": 4}], (3, 4)),
    ([{"bike_type": "mechanical", "count": 10}, {"bike_type": "electric", "count": 5}], (10, 5)),
    ([], (None, None)),
    (..., (None, None)),
    ("text", (None, None)),
    ([{"mechanical": 3}, {"mechanical": None}], (None, None)),
    ([{"mechanical": 3}, {"mechanical": "5"}, 7, "x"], (5, None)),
    ([{"mechanical": 2, "bike_type": "mechanical", "count": 9}], (9, None)),
    ([{"bike_type": "e-bike"}, {"ebike": True}], (None, 1)),
    ]
    rows = rows_of(spark, [{} if t is ... else {"num_bikes_available_types": t} for t, _ in cases])
    assert [(r["mechanical_available"], r["ebike_available"]) for r in rows] == [e for _, e in cases]


def test_lenient_integers(spark):
    cases = [(5, 5), ("42", 42), (None, None), ("not_a_number", None), (5.9, 5), ("5.9", None), (True, 1), ("true", None),
     (-3, -3), ([1], None), ({"a": 1}, None), ("", None), (" 7 ", 7)]
    rows = rows_of(spark, [{"num_bikes_available": v, "is_renting": v} for v, _ in cases])
    assert [(r["num_bikes_available"], r["is_renting"]) for r in rows] == [(e, e) for _, e in cases]


def test_bad_epochs(spark):
    rows = rows_of(spark, [{"last_reported": v} for v in (None, "not_an_epoch", 10**15, [1])])
    assert [r["last_reported_ts"] for r in rows] == [None] * 4


def test_alternate_names(spark):
    cases = [
    ({"station_code": "b", "numBikesAvailable": 2, "numDocksAvailable": 3}, ("b", 2, 3)),
    ({"stationCode": "", "station_code": 0, "stationcode": "c", "num_bikes_available": None,
          "numBikesAvailable": 4}, ("c", 4, None)),
    ({"stationCode": "0"}, ("0", None, None)),
    ({}, (None, None, None)),
    ]
    rows = rows_of(spark, [m for m, _ in cases])
    got = [(r["station_code"], r["num_bikes_available"], r["num_docks_available"]) for r in rows]
    assert got == [e for _, e in cases]


def test_elements_that_are_no_stations(spark):
    rows, dlq = routed(spark, line([{"num_bikes_available": 1}, 5, "x", None, [1], json.dumps(station())]))
    assert not rows and not dlq
    rows, dlq = routed(spark, line([]))
    assert not rows and not dlq


def test_other_event_types_are_dropped(spark):
    assert routed(spark, line("NOT_A_LIST", event_type="other"), line([station()], event_type="other")) == ([], [])


DEAD = [
    ("   ", "parse_normalize", "ValueError", "Empty input line"),
    ('{"a":', "parse_normalize", "JSONDecodeError", "Invalid JSON"),
    (line([station()]) + " x", "parse_normalize", "JSONDecodeError", "Invalid JSON"),
    (line([station()]) + "] x", "parse_normalize", "JSONDecodeError", "Invalid JSON"),
    (line([station()]) + "," + line([station()]), "parse_normalize", "JSONDecodeError", "Invalid JSON"),
    ("{'a':1}", "parse_normalize", "JSONDecodeError", "Invalid JSON"),
    ("[1,2]", "parse_normalize", "ValueError", "Parsed event is not a JSON object"),
    (json.dumps({"ingest_ts": TS}), "parse_normalize", "ValueError", "Missing source"),
    (line([station()], ingest_ts=...), "parse_normalize", "ValueError", "Missing ingest_ts"),
    (line([station()], ingest_ts=0), "parse_normalize", "ValueError", "Missing ingest_ts"),
    (line([station()], source=False, key=""), "parse_normalize", "ValueError", "Missing source"),
    (line([station()], key=[]), "parse_normalize", "ValueError", "Missing key"),
    (line(payload=None), "parse_normalize", "ValueError", "Missing payload"),
    (line("NOT_A_LIST"), "snapshot_to_station_rows", "ValueError", "payload.data.stations is not a list"),
    (line(None), "snapshot_to_station_rows", "ValueError", "payload.data.stations is not a list"),
    (line(payload=[1]), "snapshot_to_station_rows", "AttributeError", "'list' object has no attribute 'get'"),
    (line(payload=[]), "snapshot_to_station_rows", "ValueError", "payload.data.stations is not a list"),
    (line(payload="text"), "snapshot_to_station_rows", "ValueError", "payload.data.stations is not a list"),
    (line(payload={"data": "x"}), "snapshot_to_station_rows", "AttributeError",
     "'str' object has no attribute 'get'"),
    (line(payload={"data": 5}), "snapshot_to_station_rows", "AttributeError",
     "'int' object has no attribute 'get'"),
    (line(payload={"data": 0}), "snapshot_to_station_rows", "ValueError", "payload.data.stations is not a list"),
    (line([station()], ingest_ts="NOPE"), "bq_insert_curated", "BigQueryInsertError",
     "Invalid timestamp in ingest_ts: NOPE"),
    (line([station(num_docks_available=10**20)]), "bq_insert_curated", "BigQueryInsertError",
     "Integer out of range in num_docks_available"),
]


def test_dead_letters(spark):
    rows, dlq = routed(spark, *[d[0] for d in DEAD])
    assert not rows and len(dlq) == len(DEAD)
    for (text, stage, kind, message), r in zip(DEAD, dlq, strict=True):
        assert (r["stage"], r["error_type"], r["error_message"]) == (stage, kind, message), text
        if stage == "parse_normalize":
            assert r["raw"] == text
        if stage == "snapshot_to_station_rows":
            assert json.loads(r["event_meta"])["source"] == "bikeshare"
            assert json.loads(r["raw"])["key"] == "k"
        if stage == "bq_insert_curated":
            assert json.loads(r["event_meta"]) == {"destination": "station_status"}
            assert json.loads(r["row_json"])["station_id"] == "123"
            assert json.loads(r["sink_errors"])[0]["message"] == message


def test_invalid_utf8_is_a_dead_letter(spark):
    df = spark.createDataFrame([(bytearray(b"\xff{}"),)], "b binary").select(F.col("b").cast("string").alias("value"))
    assert [r["error_type"] for r in ev.curate(df)[1].collect()] == ["UnicodeDecodeError"]


def test_raw_text_is_kept_whole(spark):
    assert routed(spark, "x" * 200_010)[1][0]["raw"] == "x" * 200_010


def test_bad_integers_are_accepted_as_null(spark):
    assert one_row(spark, num_bikes_available="INVALID_NOT_INT")["num_bikes_available"] is None


def test_payload_as_json_text(spark):
    text = json.dumps({"data": {"stations": [station(num_bikes_available=2)]}})
    rows, dlq = routed(spark, line(payload=text))
    assert not dlq and [r["num_bikes_available"] for r in rows] == [2]


def test_payload_normalisation(spark):
    cases = [
        ('{"a": 1}', {"a": 1}), ("plain", {"raw_payload": "plain"}), ("5", {"value": 5}), (7, {"value": 7}),
        ([1], [1]), ({"x": 1}, {"x": 1}), ("[1] x", {"raw_payload": "[1] x"}),
    ]
    df = spark.createDataFrame([(line(payload=p),) for p, _ in cases], "value string").coalesce(1)
    out = ev.normalize_events(ev.parse_events(df)).select(F.to_json("payload")).collect()
    assert [json.loads(r[0]) for r in out] == [e for _, e in cases]


def test_missing_event_time_is_the_ingest_time(spark):
    texts = [(line([station()], event_ts=v),) for v in (..., "", None, 0)]
    df = spark.createDataFrame(texts, "value string")
    assert {r["event_ts"] for r in ev.normalize_events(ev.parse_events(df)).collect()} == {TS}
    assert [r["event_ts"] == r["ingest_ts"] for r in ev.curate(df)[0].collect()] == [True] * 4


def test_counters_and_replay(spark):
    df = spark.createDataFrame([("x",), (line("NO"),), (line([station()]),)], "value string")
    routed_rows = ev.route_snapshots(df)
    counts = {r["stage"]: r["n"] for r in ev.dlq_counts(ev.dead_letters(routed_rows)).collect()}
    assert counts == {"parse_normalize": 1, "snapshot_to_station_rows": 1}
    again = ev.replay_status_dead_letters(ev.dead_letters(routed_rows))
    assert {r["n"] for r in ev.dlq_counts(ev.dead_letters(ev.route_snapshots(again))).collect()} == {1}


def test_integers_beyond_the_column_are_refused(spark):
    big = "99999999999999999999"
    odd = [
        f'{{"station_id":"1","num_bikes_available_types":[{{"mechanical":{big}}}]}}',
        f'{{"station_id":"1","num_bikes_available_types":[{{"bike_type":"ebike","count":{big}}}]}}',
        '{"station_id":"1","num_bikes_available":1e30}',
        f'{{"station_id":"1","numDocksAvailable":{big}}}',
        '{"station_id":"1","num_bikes_available":"1e30","num_docks_available":2.5}',
    ]
    whole = '{{"ingest_ts":"{0}","event_ts":"{0}","source":"s","event_type":"station_status_snapshot","key":"k","payload":{{"data":{{"stations":[{1}]}}}}}}'
    df = spark.createDataFrame([(whole.format(TS, o),) for o in odd], "value string").coalesce(1)
    rows, dead = ev.curate(df)
    assert sorted(r["error_message"] for r in dead.collect()) == [
        f"Integer out of range in {n}"
        for n in ("ebike_available", "mechanical_available", "num_bikes_available", "num_docks_available")
    ]
    assert [(r["num_bikes_available"], r["num_docks_available"]) for r in rows.collect()] == [(None, 2)]


def test_cut_off_lines_are_told_without_a_parser(spark):
    """An object's text that does not end like one is refused by its ends; whatever else is read as before."""
    whole = line([station()])
    lines = [whole, whole[:40], whole[:40] + "long text " * 50_000, f" \t{whole} \n", whole + " x", "[1,2]", "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    assert [r[0] for r in df.select(ev._is_cut_off(F.col("value"))).collect()] == [False, True, True, False, True, False, False]
    rows, dlq = routed(spark, *lines)
    assert len(rows) == 2
    bad = ("JSONDecodeError", "Invalid JSON")
    assert [(r.error_type, r.error_message) for r in dlq[:3]] == [bad] * 3
    assert len(dlq) == 5


def test_times_are_read_once_a_line(spark):
    """Both instants are worked out below the step that makes a row of every station."""
    df = spark.createDataFrame([(line([station(), station()]),)], "value string")
    plan = ev.station_rows(ev.route_snapshots(df))._jdf.queryExecution().optimizedPlan().toString()
    at = [i for i, text in enumerate(plan.splitlines()) if "_ingest_ts_at" in text and "cast(" in text.partition("_ingest_ts_at")[0]]
    stations = [i for i, text in enumerate(plan.splitlines()) if "Generate explode" in text and "stations" in text]
    assert max(at) > min(stations)
