"""Event envelopes: parse, validate, flatten to station rows, and route failures.

One pass per line and no exceptions: every failure becomes a value in the ``error`` column,
so batch and streaming use the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import fixed_values as fx
from kerbside.functions import (
    epoch_seconds,
    evaluate_once,
    is_truthy,
    json_document,
    json_kind,
    json_list,
    json_long,
    json_text,
    json_value,
    long_overflows,
    non_empty,
    strict_json,
    where_present,
)
from kerbside.functions.json_values import MAX_EPOCH_S, MIN_EPOCH_S

STATUS_COLUMNS = (
    "ingest_ts", "event_ts", "station_id", "station_code", "is_installed", "is_renting", "is_returning",
    "last_reported_ts", "num_bikes_available", "num_docks_available", "mechanical_available",
    "ebike_available", "raw_station_json",
)
DLQ_COLUMNS = (
    "dlq_ts", "stage", "error_type", "error_message", "raw", "event_meta", "row_json", "sink_errors",
)
# Members read from a line and from a station element, all as text: one typed parse reads them
# several times faster than a VARIANT, and what a text cannot tell apart goes the VARIANT way.
LINE_SCHEMA = (
    "array<struct<ingest_ts string, event_ts string, source string, event_type string, key string,"
    " payload struct<data struct<stations array<string>>>, line_check string>>"
)
BIKE_TYPES = "array<struct<mechanical string, ebike string, bike_type string, count string>>"
STATION_SCHEMA = (
    "station_id string, stationCode string, station_code string, is_installed string,"
    " is_renting string, is_returning string, last_reported string, num_bikes_available string,"
    " numBikesAvailable string, num_docks_available string, numDocksAvailable string,"
    f" num_bikes_available_types {BIKE_TYPES}"
)
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# texts that are falsy as a number, boolean or container but not as a text
AMBIGUOUS = ("0", "0.0", "-0.0", "false", "[]", "{}")
DLQ_COUNTERS = {
    fx.STAGE_PARSE: "dlq_parse_normalize_count",
    fx.STAGE_MAPPING: "dlq_snapshot_mapping_count",
    fx.STAGE_SINK: "dlq_bq_insert_count",
}


def _error(kind: str | Column, message: str | Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(kind.alias("type"), message.alias("message"))


def _value_error(message: str | Column) -> Column:
    return _error("ValueError", message)


def parse_events(lines: DataFrame) -> DataFrame:
    """Adds ``event`` (VARIANT object) and ``error`` to text lines in column ``value``."""
    return _parse(lines, unless=F.lit(False))


def _parse(lines: DataFrame, unless: Column) -> DataFrame:
    """:func:`parse_events`, leaving both columns NULL where ``unless`` holds."""
    value, event = F.col("value"), F.col("event")
    parsed = evaluate_once(
        lines.withColumn("_wrapped", F.when(~(unless | _is_cut_off(value)), strict_json(value))),
        {"event": json_document(F.col("_wrapped"), value)},
    ).drop("_wrapped")
    # an object's text starts with a brace; cheaper than deriving the document's schema
    is_object = F.ltrim(value, F.lit(" \t\r\n")).startswith("{")
    error = (
        F.when(unless, None)
        .when(~F.is_valid_utf8(value), _error("UnicodeDecodeError", fx.MSG_BAD_UTF8))
        .when(~F.coalesce(value.rlike(r"\S"), F.lit(False)), _value_error(fx.MSG_EMPTY))
        .when(event.isNull(), _error("JSONDecodeError", fx.MSG_BAD_JSON))
        .when(~is_object, _value_error(fx.MSG_NOT_OBJECT))
    )
    return evaluate_once(parsed, {"error": error})


def _is_cut_off(value: Column) -> Column:
    """Whether a text begins like an object and does not end like one, so that no parser need read it."""
    space = F.lit(" \t\r\n")
    return F.ltrim(value, space).startswith("{") & ~F.rtrim(value, space).endswith("}")


def _read_plain(lines: DataFrame) -> DataFrame:
    """Adds ``_plain``: texts and station elements of ordinary lines, NULL for all others.

    Ordinary means: the text is exactly one valid document (its checksum comes back as the next
    element), the required texts are unmistakably present, and there is a list of stations.
    Everything else, valid or not, is left to the exact rules.
    """
    value = F.col("value")
    check = F.crc32(value).cast("string")
    wrapped = F.concat(F.lit("["), value, F.lit(',{"line_check":"'), check, F.lit('"}]'))
    read = lines.withColumn("_read", F.when(~_is_cut_off(value), F.from_json(wrapped, LINE_SCHEMA, JSON_OPTIONS)))
    doc = F.try_element_at("_read", F.lit(1))
    stations = doc["payload"]["data"]["stations"]
    # the cheap tests first: the others read the whole line again
    ordinary = (
        stations.isNotNull()
        & (F.try_element_at("_read", F.lit(2))["line_check"] == check)
        & F.is_valid_utf8(value)
        # a list element that is itself JSON text would look like an object
        & ~value.rlike(r'[\[,]\s*"\s*\{')
        & ~F.coalesce(doc["event_ts"].isin(*AMBIGUOUS), F.lit(False))
    )
    for name in ("ingest_ts", *fx.REQUIRED_TEXT_FIELDS):
        ordinary = ordinary & doc[name].isNotNull() & ~doc[name].isin("", *AMBIGUOUS)
    plain = F.struct(
        doc["ingest_ts"].alias("ingest_ts"),
        F.coalesce(non_empty(doc["event_ts"]), doc["ingest_ts"]).alias("event_ts"),
        *[doc[name].alias(name) for name in fx.REQUIRED_TEXT_FIELDS],
        stations.alias("stations"),
    )
    return evaluate_once(read, {"_plain": F.when(F.coalesce(ordinary, F.lit(False)), plain)}).drop("_read")


def normalize_events(parsed: DataFrame) -> DataFrame:
    """Required fields and payload shape.

    Adds ingest_ts, event_ts, source, event_type, key (text) and payload (VARIANT), all NULL on
    rows with an ``error``. The first missing field, in contract order, names the error.
    """
    return (
        _checked(parsed)
        .withColumn("payload", where_present(F.when(F.col("error").isNull(), F.col("event")), _normal_payload))
        .drop("_payload_kind", "_decoded")
    )


def _checked(parsed: DataFrame) -> DataFrame:
    """Texts and final ``error``; ``_payload_kind`` and, for text payloads, ``_decoded``."""
    texts = ("ingest_ts", "event_ts", *fx.REQUIRED_TEXT_FIELDS)
    event = F.when(F.col("error").isNull(), F.col("event"))
    fields = evaluate_once(parsed, {"_f": where_present(event, _event_fields)})
    f = F.col("_f")
    message = F.concat(F.lit("Missing "), f["missing"])
    fields = fields.withColumn("error", F.coalesce("error", F.when(f["missing"].isNotNull(), _value_error(message))))
    return fields.withColumns(
        {
            **{name: F.when(F.col("error").isNull(), f[name]) for name in texts},
            "_payload_kind": f["payload_kind"],
            "_decoded": f["decoded"],
        }
    ).drop("_f")


def _event_fields(event: Column) -> Column:
    """Struct of the texts of an event, its first missing field, and what its payload is."""
    # A snapshot's first station is reached without copying the payload; only other shapes
    # pay for deriving their type.
    is_snapshot_shape = json_text(event, "$.payload.data.stations[0].station_id").isNotNull()
    kind = F.when(is_snapshot_shape, "OBJECT").otherwise(json_kind(json_value(event, "$.payload")))
    missing = F.when(~is_truthy(event, "$.ingest_ts"), F.lit("ingest_ts"))
    for name in fx.REQUIRED_TEXT_FIELDS:
        missing = missing.when(~is_truthy(event, f"$.{name}"), F.lit(name))
    missing = missing.when(F.coalesce(kind, F.lit("VOID")) == "VOID", F.lit("payload"))
    ingest_ts, text = json_text(event, "$.ingest_ts"), json_text(event, "$.payload")
    event_ts = F.when(is_truthy(event, "$.event_ts"), json_text(event, "$.event_ts")).otherwise(ingest_ts)
    return F.struct(
        missing.alias("missing"),
        kind.alias("payload_kind"),
        ingest_ts.alias("ingest_ts"),
        event_ts.alias("event_ts"),
        *[json_text(event, f"$.{name}").alias(name) for name in fx.REQUIRED_TEXT_FIELDS],
        F.when(kind == "STRING", json_document(strict_json(text), text)).alias("decoded"),
    )


def _normal_payload(event: Column) -> Column:
    """Objects and lists as they are; JSON text decoded; other text and scalars wrapped."""
    kind, decoded = F.col("_payload_kind"), F.col("_decoded")
    payload = json_value(event, "$.payload")
    return (
        F.when(kind.isin("OBJECT", "ARRAY"), payload)
        .when(kind != "STRING", F.to_variant_object(F.struct(payload.alias("value"))))
        .when(decoded.isNull(), F.to_variant_object(F.struct(json_text(event, "$.payload").alias("raw_payload"))))
        .when(json_kind(decoded).isin("OBJECT", "ARRAY"), decoded)
        .otherwise(F.to_variant_object(F.struct(decoded.alias("value"))))
    )


def _has_no_get(kind: Column) -> Column:
    """Error of a document that should be an object but has another type."""
    name = (
        F.when(kind == "ARRAY", "list")
        .when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .otherwise("float")
    )
    return _error("AttributeError", F.concat(F.lit("'"), name, F.lit("' object has no attribute 'get'")))


def _mapping_error(event: Column) -> Column:
    """Why a snapshot has no station list."""
    decoded = F.col("_decoded")
    payload_kind = F.coalesce(json_kind(decoded), F.col("_payload_kind"))
    data = F.coalesce(json_value(decoded, "$.data"), json_value(event, "$.payload.data"))
    payload_truthy = F.when(decoded.isNull(), is_truthy(event, "$.payload")).otherwise(is_truthy(decoded, "$"))
    return (
        F.when((payload_kind == "ARRAY") & payload_truthy, _has_no_get(payload_kind))
        .when((json_kind(data) != "OBJECT") & is_truthy(data, "$"), _has_no_get(json_kind(data)))
        .otherwise(_value_error(fx.MSG_NOT_LIST))
    )


def _integer(text: Column) -> Column:
    """Integer of a text that surely is one; a failing cast would cost an exception per value."""
    return F.when(text.rlike(r"^\s*[+-]?\d{1,18}\s*$"), text.cast("bigint"))


def _is_odd(text: Column) -> Column:
    """Whether only the JSON type tells what a text that is no plain integer counts as.

    A decimal truncates as a number but is nothing as a text, true is 1 or nothing, and too
    large an integer must be reported. Any other text counts as nothing whatever its type.
    """
    return F.coalesce(text.rlike(r"^\s*[+-]?\d(?!\d{0,17}\s*$)|^(true|false)$"), F.lit(False))


def _plain_bikes(types: Column, name: str, kinds: tuple[str, ...]) -> Column:
    """Count of the last entry about one kind, from typed list entries."""

    def by_kind(item: Column) -> Column:
        return F.coalesce(item["bike_type"].isin(*kinds), F.lit(False)) & item["count"].isNotNull()

    last = F.try_element_at(F.filter(types, lambda i: by_kind(i) | i[name].isNotNull()), F.lit(-1))
    return _integer(F.when(by_kind(last), last["count"]).otherwise(last[name]))


def _last_mention(station: Column, name: str, kinds: tuple[str, ...]) -> tuple[Column, Column]:
    """The last entry about one kind of bike, and whether it names the kind beside a count."""
    items = F.coalesce(json_list(station, "$.num_bikes_available_types"), F.array().cast("array<variant>"))

    def by_kind(item: Column) -> Column:
        named = F.coalesce(json_text(item, "$.bike_type").isin(*kinds), F.lit(False))
        return named & json_value(item, "$.count").isNotNull()

    mentions = F.filter(items, lambda i: by_kind(i) | json_value(i, f"$.{name}").isNotNull())
    last = F.try_element_at(mentions, F.lit(-1))
    return last, by_kind(last)


def _exact_bikes(station: Column, name: str, kinds: tuple[str, ...]) -> Column:
    """Its count from a VARIANT element, where a member may be present and null."""
    last, by_kind = _last_mention(station, name, kinds)
    return F.when(by_kind, json_long(last, "$.count")).otherwise(json_long(last, f"$.{name}"))


def _exact_code(station: Column) -> Column:
    """Text of the first truthy code; the last one's text when none is."""
    names = ("stationCode", "station_code")
    truthy = [F.when(is_truthy(station, f"$.{n}"), json_text(station, f"$.{n}")) for n in names]
    return F.coalesce(*truthy, json_text(station, "$.stationcode"))


def _exact_count(station: Column, snake: str, camel: str) -> Column:
    return F.when(json_text(station, f"$.{snake}").isNull(), json_long(station, f"$.{camel}")).otherwise(
        json_long(station, f"$.{snake}")
    )


def _with_station_fields(elements: DataFrame) -> DataFrame:
    """Adds the status fields of column ``station`` (JSON text of a list element).

    Elements without a station id are left out; rows with a NULL ``station`` stay. ``_exact`` holds the element as VARIANT where its texts alone are ambiguous.
    """
    text, s = F.col("station"), F.col("_s")
    types = s["num_bikes_available_types"]
    flags = ("is_installed", "is_renting", "is_returning")
    numbers = (*flags, "last_reported", "num_bikes_available", "numBikesAvailable", "num_docks_available",
               "numDocksAvailable")
    # a count that is not plainly an integer, quoted or not
    ambiguous = text.rlike(r'"(mechanical|ebike|count)"\s*:\s*(?!"?\d{1,18}"?\s*[,}])')
    ambiguous = ambiguous | (types.isNull() & text.contains('"num_bikes_available_types"'))
    for name in numbers:
        ambiguous = ambiguous | _is_odd(s[name])
    for name in ("stationCode", "station_code"):
        ambiguous = ambiguous | F.coalesce(s[name].isin(*AMBIGUOUS), F.lit(False))
    # the all-lowercase spelling cannot share a schema with the camel-case one
    code = F.coalesce(non_empty(s["stationCode"]), non_empty(s["station_code"]))
    ambiguous = ambiguous | (code.isNull() & text.contains('"stationcode"'))
    plain_seconds = _integer(s["last_reported"])
    plain = F.struct(
        s["station_id"].alias("station_id"),
        code.alias("station_code"),
        *[_integer(s[n]).alias(n) for n in flags],
        F.when(plain_seconds.between(MIN_EPOCH_S, MAX_EPOCH_S), F.timestamp_seconds(plain_seconds)).alias(
            "last_reported_ts"
        ),
        _integer(F.coalesce(s["num_bikes_available"], s["numBikesAvailable"])).alias("num_bikes_available"),
        _integer(F.coalesce(s["num_docks_available"], s["numDocksAvailable"])).alias("num_docks_available"),
        _plain_bikes(types, fx.MECHANICAL, (fx.MECHANICAL,)).alias("mechanical_available"),
        _plain_bikes(types, fx.EBIKE, fx.EBIKE_SYNONYMS).alias("ebike_available"),
    )
    read = evaluate_once(elements, {"_s": F.from_json(text, STATION_SCHEMA, JSON_OPTIONS)})
    # rows without an element are dead letters under way
    stations = read.filter(text.isNull() | s["station_id"].isNotNull())
    judged = evaluate_once(stations, {"_exact": F.when(ambiguous, F.try_parse_json(text))})
    exact = where_present(F.col("_exact"), _exact_fields)
    fields = judged.withColumn("_fields", F.when(F.col("_exact").isNotNull(), exact).otherwise(plain))
    return fields.select("*", "_fields.*", text.alias("raw_station_json")).drop("_fields", "_s")


def _exact_fields(v: Column) -> Column:
    return F.struct(
        json_text(v, "$.station_id").alias("station_id"),
        _exact_code(v).alias("station_code"),
        *[json_long(v, f"$.{n}").alias(n) for n in ("is_installed", "is_renting", "is_returning")],
        epoch_seconds(v, "$.last_reported").alias("last_reported_ts"),
        _exact_count(v, "num_bikes_available", "numBikesAvailable").alias("num_bikes_available"),
        _exact_count(v, "num_docks_available", "numDocksAvailable").alias("num_docks_available"),
        _exact_bikes(v, fx.MECHANICAL, (fx.MECHANICAL,)).alias("mechanical_available"),
        _exact_bikes(v, fx.EBIKE, fx.EBIKE_SYNONYMS).alias("ebike_available"),
    )


def _instant(text: Column) -> Column:
    # a bare time of day would be read as today
    return F.when(text.rlike(r"^\s*\d{4}-\d"), F.try_to_timestamp(text))


def _sink_errors() -> Column:
    """Messages for values the typed table cannot hold, in column order; empty when it fits.

    Needs the instants of both times as ``_ingest_ts_at`` and ``_event_ts_at``.
    """
    times = [
        F.when(F.col(f"_{name}_at").isNull(), F.concat(F.lit(f"Invalid timestamp in {name}: "), F.col(name)))
        for name in ("ingest_ts", "event_ts")
    ]
    # too large an integer is never a plain one
    numbers = F.coalesce(where_present(F.col("_exact"), _too_large), F.array().cast("array<string>"))
    return F.concat(F.array_compact(F.array(*times)), numbers)


def _too_large(station: Column) -> Column:
    """Messages for integers, written as such or as integral floats, that no BIGINT column holds."""
    flags = [
        F.when(long_overflows(station, f"$.{n}"), F.lit(f"Integer out of range in {n}"))
        for n in ("is_installed", "is_renting", "is_returning")
    ]
    counts = []
    for snake, camel in (("num_bikes_available", "numBikesAvailable"), ("num_docks_available", "numDocksAvailable")):
        chosen = F.when(json_text(station, f"$.{snake}").isNull(), long_overflows(station, f"$.{camel}")).otherwise(
            long_overflows(station, f"$.{snake}")
        )
        counts.append(F.when(chosen, F.lit(f"Integer out of range in {snake}")))
    bikes = [
        F.when(_bikes_overflow(station, name, kinds), F.lit(f"Integer out of range in {name}_available"))
        for name, kinds in ((fx.MECHANICAL, (fx.MECHANICAL,)), (fx.EBIKE, fx.EBIKE_SYNONYMS))
    ]
    return F.array_compact(F.array(*flags, *counts, *bikes))


def _bikes_overflow(station: Column, name: str, kinds: tuple[str, ...]) -> Column:
    last, by_kind = _last_mention(station, name, kinds)
    return F.coalesce(F.when(by_kind, long_overflows(last, "$.count")).otherwise(long_overflows(last, f"$.{name}")), F.lit(False))


def _station_texts(event: Column) -> Column:
    """JSON texts of the elements of the station list, NULL without a list."""
    stations = F.coalesce(
        json_list(event, "$.payload.data.stations"), json_list(F.col("_decoded"), "$.data.stations")
    )
    return F.transform(stations, lambda st: F.to_json(st))


def flatten_status(events: DataFrame) -> DataFrame:
    """One row per station of every event with a list of stations; anything else gives no row.

    ``events`` needs ingest_ts, event_ts (text) and payload (VARIANT). Timestamps stay text.
    """
    stations = json_list(F.col("payload"), "$.data.stations")
    elements = events.select(
        "ingest_ts",
        F.coalesce(non_empty("event_ts"), F.col("ingest_ts")).alias("event_ts"),
        F.explode(F.transform(stations, lambda st: F.to_json(st))).alias("station"),
    )
    return _with_station_fields(elements.filter(F.col("station").isNotNull())).select(*STATUS_COLUMNS)


def route_snapshots(
    lines: DataFrame, as_of: Column | None = None, destination: str = "station_status"
) -> DataFrame:
    """Every line as its station rows or its dead letter, in one pass.

    Result: the status columns, the dead-letter columns and ``stage`` NULL on good rows. Events
    of other types leave no trace.
    """
    error, plain = F.col("error"), F.col("_plain")
    texts = ("ingest_ts", "event_ts", *fx.REQUIRED_TEXT_FIELDS)
    read = _read_plain(lines)
    checked = _checked(_parse(read, unless=plain.isNotNull()))
    known = checked.withColumns({n: F.coalesce(plain[n], F.col(n)) for n in texts}).filter(
        error.isNotNull() | (F.col("event_type") == fx.SNAPSHOT_EVENT_TYPE)
    )
    usable_event = F.when(error.isNull(), F.col("event"))
    listed = evaluate_once(known, {"_exact_stations": where_present(usable_event, _station_texts)}).withColumn(
        "stations", F.coalesce(plain["stations"], F.col("_exact_stations"))
    )
    unlisted = F.when(error.isNull() & F.col("stations").isNull(), F.col("event"))
    mapped = evaluate_once(listed, {"mapping_error": where_present(unlisted, _mapping_error)})
    is_mapping = F.col("mapping_error").isNotNull()
    failed = error.isNotNull() | is_mapping
    meta = F.to_json(F.struct("source", "event_type", "key", "ingest_ts", "event_ts"))
    # the event as it is after normalisation, whole
    normal_event = F.to_json(F.struct("ingest_ts", "event_ts", "source", "event_type", "key", "payload"))
    mapped = mapped.withColumn("payload", where_present(F.when(is_mapping, F.col("event")), _normal_payload))
    # read once a line, not once a station
    mapped = mapped.withColumns({f"_{name}_at": _instant(F.col(name)) for name in ("ingest_ts", "event_ts")})
    elements = mapped.select(
        "ingest_ts",
        "event_ts",
        "_ingest_ts_at",
        "_event_ts_at",
        F.coalesce("error", "mapping_error").alias("error"),
        F.when(error.isNotNull(), fx.STAGE_PARSE).when(is_mapping, fx.STAGE_MAPPING).alias("stage"),
        F.when(error.isNotNull(), F.make_valid_utf8("value")).when(is_mapping, normal_event).alias("raw"),
        F.when(is_mapping, meta).alias("event_meta"),
        # a dead letter travels as one row without a station
        F.explode(F.when(failed, F.array(F.lit(None).cast("string"))).otherwise(F.col("stations"))).alias("station"),
    )
    # a NULL element of a list is no station, only a dead letter may go without one
    present = elements.filter(F.col("stage").isNotNull() | F.col("station").isNotNull())
    # only a time that cannot be read or a value of the exact rules can be refused
    may_fail = F.col("_ingest_ts_at").isNull() | F.col("_event_ts_at").isNull() | F.col("_exact").isNotNull()
    rows = _with_station_fields(present).withColumn("_sink", F.when(F.col("stage").isNull() & may_fail, _sink_errors()))
    refused = F.coalesce(F.size("_sink") > 0, F.lit(False))
    row_json = F.to_json(F.struct(*STATUS_COLUMNS), {"ignoreNullFields": "false"})
    sink_errors = F.to_json(F.transform("_sink", lambda m: F.struct(m.alias("message"))))
    return rows.select(
        F.col("_ingest_ts_at").alias("ingest_ts"),
        F.col("_event_ts_at").alias("event_ts"),
        *STATUS_COLUMNS[2:],
        (as_of if as_of is not None else F.current_timestamp()).alias("dlq_ts"),
        F.when(refused, fx.STAGE_SINK).otherwise(F.col("stage")).alias("stage"),
        F.when(refused, fx.SINK_ERROR_TYPE).otherwise(F.col("error.type")).alias("error_type"),
        F.when(refused, F.try_element_at("_sink", F.lit(1))).otherwise(F.col("error.message")).alias("error_message"),
        "raw",
        F.when(refused, F.to_json(F.struct(F.lit(destination).alias("destination"))))
        .otherwise(F.col("event_meta"))
        .alias("event_meta"),
        F.when(refused, row_json).alias("row_json"),
        F.when(refused, sink_errors).alias("sink_errors"),
    )


def station_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("stage").isNull()).select(*STATUS_COLUMNS)


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("stage").isNotNull()).select(*DLQ_COLUMNS)


def curate(lines: DataFrame, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(station rows, dead letters) of text lines in column ``value``.

    Both read the same routed rows; a job that writes both should persist or stage
    :func:`route_snapshots` once, as the streaming job does.
    """
    routed = route_snapshots(lines, as_of)
    return station_rows(routed), dead_letters(routed)


def dlq_counts(dlq: DataFrame) -> DataFrame:
    """Dead letters per stage."""
    return dlq.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


def with_dlq_counters(routed: DataFrame, name: str = "dlq") -> DataFrame:
    """Attach per-stage counters, readable after the run (batch) or in query progress (stream)."""
    return routed.observe(name, *[F.count_if(F.col("stage") == s).alias(c) for s, c in DLQ_COUNTERS.items()])


def replay_status_dead_letters(dlq: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Raw text of parse and mapping dead letters as input lines (``value``) for another run.

    ``ledger`` (column ``digest``) holds the digests of texts that were replayed before: a line that
    fails again comes back with the same text, and the loop guard keeps it out of the next replay.
    """
    waiting = dlq.filter(F.col("stage").isin(fx.STAGE_PARSE, fx.STAGE_MAPPING)).select(
        F.col("raw").alias("value"), F.sha2("raw", 256).alias("digest")
    )
    if ledger is not None:
        waiting = waiting.join(ledger.select("digest").distinct(), "digest", "left_anti")
    return waiting.select("value")


def replay_ledger(lines: DataFrame) -> DataFrame:
    """Digests of replayed lines, and of what mapping makes of them: rows for the ledger.

    A line that fails in the mapping stage is stored as its normalised event, which reads differently from
    the line; both texts are remembered.
    """
    again = dead_letters(route_snapshots(lines)).filter(F.col("stage").isin(fx.STAGE_PARSE, fx.STAGE_MAPPING))
    texts = lines.select("value").unionAll(again.select(F.col("raw").alias("value")))
    return texts.select(F.sha2("value", 256).alias("digest")).distinct()
