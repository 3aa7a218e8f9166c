"""From landed documents and pushed messages to raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import fixed_values as fx
from kerbside.functions import (
    evaluate_once,
    is_truthy,
    json_document,
    json_kind,
    json_list,
    json_text,
    json_value,
    non_empty,
    strict_json,
    utc_suffix,
)
from kerbside.operators.latest import latest_by


def _decoded(messages: DataFrame) -> DataFrame:
    """Adds ``text`` (decoded body) and ``event`` (VARIANT); both NULL when undecodable."""
    body = F.expr("try_validate_utf8(cast(try_to_binary(data, 'base64') as string))")
    texts = messages.withColumn("text", F.when(non_empty("data").isNotNull(), body))
    wrapped = texts.withColumn("_wrapped", strict_json(F.col("text")))
    return evaluate_once(wrapped, {"event": json_document(F.col("_wrapped"), F.col("text"))}).drop("_wrapped")


def is_drill(attributes: Column, enabled: bool) -> Column:
    """True for messages that ask for a forced failure, while drills are switched on."""
    if not enabled:
        return F.lit(False)
    return F.coalesce(F.lower(attributes[fx.DRILL_ATTRIBUTE]).isin(*fx.TRUE_WORDS), F.lit(False))


def _refusal(event: Column, path: str, what: str) -> Column:
    """Reason when a member that should be an object is something else that is not empty."""
    value = json_value(event, path)
    return F.when(is_truthy(event, path) & (json_kind(value) != "OBJECT"), F.lit(f"{what} is not an object"))


def _refused_time(event: Column, name: str) -> Column:
    path = f"$.{name}"
    return F.when(
        is_truthy(event, path) & F.try_to_timestamp(json_text(event, path)).isNull(), F.lit(f"Invalid timestamp in {name}")
    )


def _refused_number(stations: Column, name: str, kind: str) -> Column:
    """Reason when a station that would be written has a member the typed column cannot hold."""

    def bad(station: Column) -> Column:
        present = json_text(station, f"$.{name}").isNotNull()
        return _usable_station(station) & present & F.try_variant_get(station, f"$.{name}", kind).isNull()

    return F.when(F.coalesce(F.exists(stations, bad), F.lit(False)), F.lit(f"Invalid value in {name}"))


def push_outcomes(messages: DataFrame, drill_enabled: bool = False) -> DataFrame:
    """Delivery decision per message of the station-information push path.

    ``messages``: message_id, data (base64 text), attributes (map). Adds ``outcome``:
    ``retry`` with a reason (forced failure, an event, payload or data that is no object, or rows the
    typed table refuses: such a message comes back until its attempts are used up), ``rejected`` with a
    reason, ``empty`` (accepted, nothing to write) or ``accepted``; and the decoded ``event``.
    Every message gets exactly one outcome.
    """
    event = F.col("event")
    stations = json_list(event, "$.payload.data.stations")
    # absent and falsy values count as an empty list
    not_a_list = stations.isNull() & is_truthy(event, "$.payload.data.stations")
    usable = F.coalesce(F.exists(stations, _usable_station), F.lit(False))
    failure = F.coalesce(
        F.when(is_drill(F.col("attributes"), drill_enabled), "forced failure"),
        F.when(
            event.isNotNull() & (json_kind(event) != "OBJECT"), "event is not an object"
        ),
        _refusal(event, "$.payload", "payload"),
        _refusal(event, "$.payload.data", "payload.data"),
    )
    reason = (
        F.when(is_drill(F.col("attributes"), drill_enabled), "forced failure")
        .when(non_empty("data").isNull(), "missing message.data")
        .when(event.isNull(), "invalid base64/json")
        .when(F.col("_failure").isNotNull(), F.col("_failure"))
        .when(not_a_list, "payload.data.stations not a list")
    )
    refused = F.coalesce(
        _refused_time(event, "ingest_ts"),
        _refused_time(event, "event_ts"),
        *[_refused_number(stations, n, k) for n, k in (("lat", "double"), ("lon", "double"), ("capacity", "bigint"))],
    )
    judged = evaluate_once(_decoded(messages), {"_failure": failure})
    judged = evaluate_once(judged, {"reason": reason, "_usable": usable}).drop("text")
    judged = evaluate_once(judged, {"_refused": F.when(F.col("reason").isNull() & F.col("_usable"), refused)})
    outcome = (
        F.when(F.col("_failure").isNotNull() & (F.col("reason") == F.col("_failure")), "retry")
        .when(F.col("reason").isNotNull(), "rejected")
        .when(F.col("_refused").isNotNull(), "retry")
        .when(F.col("_usable"), "accepted")
        .otherwise("empty")
    )
    return (
        judged.withColumn("outcome", outcome)
        .withColumn("reason", F.coalesce("reason", "_refused"))
        .drop("_usable", "_failure", "_refused")
    )


def _usable_station(station: Column) -> Column:
    return F.coalesce(F.trim(json_text(station, "$.station_id")) != "", F.lit(False))


def raw_outcomes(messages: DataFrame) -> DataFrame:
    """Messages of the raw path with their row's columns, ``outcome`` and ``reason``.

    ``rejected``: undecodable. ``retry``: an event that is no object, or a row the table refuses
    because a required column is missing or a time unreadable. Else ``accepted``. Each message once.
    """
    event = F.col("event")
    payload = json_value(event, "$.payload")
    rows = _decoded(messages).select(
        *messages.columns,
        "event",
        *[utc_suffix(json_text(event, f"$.{n}")).alias(f"_{n}") for n in ("ingest_ts", "event_ts")],
        *[json_text(event, f"$.{n}").alias(n) for n in ("source", "event_type", "key")],
        # text payloads stay as they are, documents become JSON text
        F.when(json_kind(payload).isin("OBJECT", "ARRAY"), F.to_json(payload))
        .otherwise(json_text(event, "$.payload"))
        .alias("payload"),
        F.md5("text").alias("_digest"),
    )
    rows = rows.withColumns({n: F.try_to_timestamp(f"_{n}") for n in ("ingest_ts", "event_ts")})
    missing = F.lit(None).cast("string")
    for name in reversed(("source", "event_type", "key", "payload")):
        missing = F.when(F.col(name).isNull(), F.lit(f"Missing {name}")).otherwise(missing)
    late = F.when(F.col("_event_ts").isNotNull() & F.col("event_ts").isNull(), F.lit("Invalid timestamp in event_ts"))
    rejected = F.when(non_empty("data").isNull(), "missing message.data").when(event.isNull(), "invalid base64/json")
    retry = (
        F.when(json_kind(event) != "OBJECT", "event is not an object")
        .when(F.col("_ingest_ts").isNull(), "Missing ingest_ts")
        .when(F.col("ingest_ts").isNull(), "Invalid timestamp in ingest_ts")
        .otherwise(F.coalesce(late, missing))
    )
    judged = evaluate_once(rows, {"_rejected": rejected})
    judged = evaluate_once(judged, {"_retry": F.when(F.col("_rejected").isNull(), retry)})
    return judged.select(
        *messages.columns,
        "ingest_ts", "event_ts", "source", "event_type", "key", "payload", "_digest",
        F.when(F.col("_rejected").isNotNull(), "rejected").when(F.col("_retry").isNotNull(), "retry").otherwise("accepted").alias("outcome"),
        F.coalesce("_rejected", "_retry").alias("reason"),
    )


def land_raw(messages: DataFrame) -> DataFrame:
    """Pushed messages as raw event rows that meet the table's contract, one per message id.

    The other messages are in :func:`raw_outcomes`. Redelivered messages share an id and land once.
    """
    rows = (
        raw_outcomes(messages)
        .filter("outcome = 'accepted'")
        .select("message_id", "ingest_ts", "event_ts", "source", "event_type", "key", "payload", "_digest")
    )
    # a message without id cannot be recognised as a duplicate, so it keeps its own group
    keys = ["message_id", F.when(F.col("message_id").isNull(), F.col("_digest"))]
    return latest_by(rows, keys, [F.asc_nulls_last("ingest_ts"), F.asc("_digest")]).drop("_digest")


def _response_document(responses: DataFrame) -> DataFrame:
    """Adds ``_doc``, the response as VARIANT; NULL unless it is exactly one JSON value."""
    wrapped = responses.withColumn("_wrapped", strict_json(F.col("response")))
    return evaluate_once(wrapped, {"_doc": json_document(F.col("_wrapped"), F.col("response"))}).drop("_wrapped")


def explode_disruptions(
    responses: DataFrame, source: str = fx.DISRUPTION_SOURCE, event_type: str = fx.DISRUPTION_EVENT_TYPE
) -> DataFrame:
    """Bulk responses (polled_at, response) as one raw row per disruption.

    Responses that give none because they are broken are in :func:`disruption_response_errors`.
    """
    elements = json_list(F.col("_doc"), "$.disruptions")
    key = json_text(F.col("element"), "$.id")
    return _response_document(responses).select("polled_at", F.explode(elements).alias("element")).select(
        F.col("polled_at").alias("ingest_ts"),
        F.col("polled_at").alias("event_ts"),
        F.lit(source).alias("source"),
        F.lit(event_type).alias("event_type"),
        F.coalesce(key, F.lit(fx.UNKNOWN_KEY)).alias("key"),
        F.to_json("element").alias("payload"),
    )


def disruption_response_errors(responses: DataFrame) -> DataFrame:
    """(polled_at, reason, response) of responses that are no JSON document or have no list of disruptions.

    A document without that member is an empty poll, not an error.
    """
    doc = F.col("_doc")
    reason = (
        F.when(doc.isNull(), fx.MSG_BAD_JSON)
        .when(json_kind(doc) != "OBJECT", "response is not an object")
        .when(
            json_list(doc, "$.disruptions").isNull() & is_truthy(doc, "$.disruptions"), "disruptions is not a list"
        )
    )
    judged = evaluate_once(_response_document(responses), {"reason": reason})
    return judged.filter("reason is not null").select("polled_at", "reason", "response")


def wrap_snapshot(documents: DataFrame, source: str, event_type: str) -> DataFrame:
    """Landed feed documents (collected_at, doc) as event envelopes, one JSON line each."""
    doc = F.try_parse_json("doc")
    # an epoch written as text is not accepted; numbers are
    updated = F.try_variant_get(doc, "$.last_updated", "double")
    is_number = F.coalesce(
        json_kind(json_value(doc, "$.last_updated")).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
        F.lit(False),
    )
    in_range = updated.between(-62_135_596_800.0, 253_402_300_799.0)
    event_ts = F.when(is_number & in_range, F.timestamp_micros((updated * 1_000_000).cast("bigint")))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    envelope = F.to_json(
        F.struct(
            F.date_format("collected_at", iso).alias("ingest_ts"),
            F.date_format("_event_ts", iso).alias("event_ts"),
            F.lit(source).alias("source"),
            F.lit(event_type).alias("event_type"),
            F.concat_ws(":", F.lit(source), F.lit(event_type)).alias("key"),
            F.try_parse_json("doc").alias("payload"),
        ),
        {"ignoreNullFields": "false"},
    )
    return documents.withColumn("_event_ts", event_ts).select(
        F.col("collected_at").alias("ingest_ts"),
        F.col("_event_ts").alias("event_ts"),
        F.lit(source).alias("source"),
        F.lit(event_type).alias("event_type"),
        F.concat_ws(":", F.lit(source), F.lit(event_type)).alias("key"),
        envelope.alias("value"),
    )
