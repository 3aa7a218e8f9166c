"""Disruption feed: typed staging rows and impacted sections with coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import fixed_values as fx
from kerbside.functions import json_list, json_scalar, json_text, non_empty, parse_feed_timestamp
from kerbside.operators.latest import latest_by

SCALAR_MEMBERS = {
    "disruption_id": "id",
    "cause": "cause",
    "severity": "severity",
    "title": "title",
    "short_message": "shortMessage",
    "message_html": "message",
}


PAYLOAD_SCHEMA = (
    "id string, cause string, severity string, title string, shortMessage string, message string,"
    " lastUpdate string, applicationPeriods string, impactedSections string"
)


def project_disruptions(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """Typed columns of raw disruption payloads; ``digest`` orders rows of equal age.

    One typed parse reads all members as text; sub-documents keep their member order.
    """
    payload = F.col("payload")
    read = raw.select("ingest_ts", "payload", F.from_json(payload, PAYLOAD_SCHEMA).alias("_read"))
    return read.select(
        "ingest_ts",
        *[_scalar(F.col("_read"), payload, member).alias(name) for name, member in SCALAR_MEMBERS.items()],
        parse_feed_timestamp(_scalar(F.col("_read"), payload, "lastUpdate"), tz).alias("last_update"),
        F.col("_read.applicationPeriods").alias("application_periods"),
        F.col("_read.impactedSections").alias("impacted_sections"),
        F.md5(payload).alias("digest"),
    )


def _scalar(read: Column, payload: Column, member: str) -> Column:
    """Scalar member as text, NULL for an object or list.

    Only a text that looks like one of those is looked up again with its type.
    """
    text = read[member]
    looks_nested = F.left(text, F.lit(1)).isin("{", "[")
    return F.when(looks_nested, json_scalar(F.try_parse_json(payload), f"$.{member}")).otherwise(text)


def stage_disruptions(raw: DataFrame, tz: str = "UTC") -> DataFrame:
    """One typed row per disruption and poll.

    ``digest`` travels as the bytes it spells, which have the same order.
    """
    competing = project_disruptions(raw, tz).withColumn("digest", F.unhex("digest"))
    return latest_by(competing, ["disruption_id", "ingest_ts"], [F.asc("digest")]).drop("digest")


def latest_disruptions(staged: DataFrame) -> DataFrame:
    """Newest poll of every disruption.

    Straight from :func:`project_disruptions` this also does the staging de-duplication, with
    the same winner, and saves its shuffle.
    """
    order = [F.desc_nulls_last("ingest_ts")]
    if "digest" in staged.columns:
        order.append(F.asc("digest"))
    return latest_by(staged, ["disruption_id"], order)


def _zone_number(stop_area: Column) -> Column:
    return non_empty(F.regexp_extract(stop_area, fx.STOP_AREA_PATTERN, 1)).try_cast("bigint")


def impacted_sections(latest: DataFrame) -> DataFrame:
    """One row per impacted section whose from-stop names a zone."""
    section = F.col("section")
    sections = json_list(F.try_parse_json("impacted_sections"), "$")
    return (
        latest.withColumn("section", F.explode(sections))
        .withColumn("from_zdc_id", _zone_number(json_scalar(section, "$.from.id")))
        .withColumn("to_zdc_id", _zone_number(json_scalar(section, "$.to.id")))
        .filter(F.col("from_zdc_id").isNotNull())
        .select(
            "disruption_id", "ingest_ts", "cause", "severity", "title", "last_update", "from_zdc_id", "to_zdc_id",
        )
    )


def pick_bridge(bridge: DataFrame) -> DataFrame:
    """One stop area per zone: the smallest id."""
    return bridge.groupBy("ZdCId").agg(F.min("ZdAId").alias("ZdAId"))


def resolve_stops(sections: DataFrame, bridge: DataFrame, stops: DataFrame, with_towns: bool = False) -> DataFrame:
    """Names and coordinates (and towns) of both ends of a section; unknown zones stay NULL.

    Bridge and stops are joined once to a small zone table that serves both roles.
    """
    zones = pick_bridge(bridge).join(stops, F.col("ZdAId") == F.col("zda_id"))

    def role(name: str) -> DataFrame:
        return zones.select(
            F.col("ZdCId").alias(f"{name}_zdc_id"),
            F.col("name").alias(f"{name}_stop_name"),
            *([F.col("town").alias(f"{name}_stop_town")] if with_towns else []),
            F.col("lat").alias(f"{name}_lat"),
            F.col("lon").alias(f"{name}_lon"),
        )

    return (
        sections.join(role("from"), "from_zdc_id", "left")
        .join(role("to"), "to_zdc_id", "left")
        .select(
            "disruption_id", "ingest_ts", "cause", "severity", "title", "last_update",
            "from_zdc_id", "from_stop_name", "from_lat", "from_lon",
            "to_zdc_id", "to_stop_name", "to_lat", "to_lon",
            *(["from_stop_town", "to_stop_town"] if with_towns else []),
        )
    )


def disruption_sections(
    staged: DataFrame,
    bridge: DataFrame,
    stops: DataFrame,
    severities: tuple[str, ...] = (fx.SEVERITY_BLOCKING,),
    with_towns: bool = False,
) -> DataFrame:
    """Impacted sections of disruptions whose newest poll has one of the severities.

    All polls compete for the newest, but only those of the wanted severities bring their texts along;
    ``digest``, where there is one, travels as the bytes it spells, which have the same order.
    """
    wanted = F.col("severity").isin(*severities)
    texts = ("severity", "cause", "title", "last_update", "impacted_sections")
    digest = [F.unhex("digest").alias("digest")] if "digest" in staged.columns else []
    competing = staged.select("disruption_id", "ingest_ts", *[F.when(wanted, F.col(c)).alias(c) for c in texts], *digest)
    latest = latest_disruptions(competing).filter(F.col("severity").isNotNull())
    return resolve_stops(impacted_sections(latest), bridge, stops, with_towns)


def active_sections(sections: DataFrame) -> DataFrame:
    """Sections of rail disruptions in the newest batch, with a usable from-stop.

    The newest batch is judged among the given sections, so pass them staged: they are read
    twice, once for the newest time and once for the rows.
    """
    newest = sections.agg((F.max("ingest_ts") - F.expr(f"interval {fx.ACTIVE_WINDOW}")).alias("since"))
    return sections.filter(
        ~F.col("title").rlike(fx.BUS_TITLE_PATTERN)
        & (F.col("ingest_ts") >= newest.scalar())
        & F.col("from_lat").between(*fx.FROM_STOP_LAT_RANGE)
        & F.col("from_lon").between(*fx.FROM_STOP_LON_RANGE)
    )


def line_and_periods(staged: DataFrame) -> DataFrame:
    """Newest row per disruption with the line named in its title, one row per application period."""
    period = F.col("period")
    return (
        latest_disruptions(staged)
        .withColumn("line_name", non_empty(F.regexp_extract("title", r"^(.*?) :", 1)))
        .withColumn("period", F.explode_outer(json_list(F.try_parse_json("application_periods"), "$")))
        .select(
            "disruption_id",
            "severity",
            "line_name",
            parse_feed_timestamp(json_text(period, "$.begin")).alias("period_begin"),
            parse_feed_timestamp(json_text(period, "$.end")).alias("period_end"),
        )
    )
