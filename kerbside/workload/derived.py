"""Mobility tables derived from whole parquet tables.

Each definition is one SQL text for both engines; the few spellings that differ are tokens.
Remainders in it vary values between rows, they never leave rows out.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = ("customer", "events", "lineitem", "orders", "part")

_SPARK = {
    "<TS>": "timestamp_ntz",
    "<BUCKET15>": "cast(window(ts, '15 minutes').start as timestamp_ntz)",
    "<ISO>": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "<EPOCH>": "unix_seconds(cast(ts as timestamp))",
    # Spark's encoder breaks lines
    "<BASE64": "translate(base64(cast(",
    "BASE64>": r" as binary)), '\r\n', '')",
}
_DUCKDB = {
    "<TS>": "timestamp",
    "<BUCKET15>": "time_bucket(interval 15 minute, ts)",
    "<ISO>": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
    "<EPOCH>": "cast(epoch(date_trunc('second', ts)) as bigint)",
    "<BASE64": "to_base64(encode(",
    "BASE64>": "))",
}

_LAT = "48.815e0 + ({k} * 7919 % 9973) / 9973.0e0 * 0.09e0"
_LON = "2.255e0 + ({k} * 104729 % 9967) / 9967.0e0 * 0.16e0"
_STATION_LAT = _LAT.format(k="c_custkey")
_STATION_LON = _LON.format(k="c_custkey")
_STATION_ID = (
    "case when c_custkey % 17 = 3 then 'closed-' || cast(c_custkey as string) else cast(c_custkey as string) end"
)

DEFINITIONS = {
    # one reading per event; snapshots are 15-minute buckets, some readings lack an event time
    "station_status": """
select <BUCKET15> as ingest_ts,
       case when event_id % 97 = 96 then null else ts end as event_ts,
       cast(user_id as string) as station_id,
       cast(floor(value) as bigint) % 40 as num_bikes_available,
       40 - cast(floor(value) as bigint) % 40 as num_docks_available,
       cast(floor(value) as bigint) % 40 - cast(floor(value) as bigint) % 3 as mechanical_available,
       cast(floor(value) as bigint) % 3 as ebike_available,
       event_id
from <T:events>""",
    # two versions of every station; some are unknown to the status feed, some lack a capacity
    "station_information": f"""
select <TS> '2024-01-29 03:10:00' as ingest_ts, <TS> '2024-01-29 03:10:00' as event_ts,
       {_STATION_ID} as station_id, 'c' || cast(c_custkey as string) as station_code, c_name as name,
       {_STATION_LAT} as lat, {_STATION_LON} as lon, cast(5 as bigint) as capacity,
       c_mktsegment as address, '750' || lpad(cast(c_nationkey as string), 2, '0') as post_code
from <T:customer>
union all
select <TS> '2024-01-30 03:10:00', case when c_custkey % 29 = 28 then null else <TS> '2024-01-30 03:10:00' end,
       {_STATION_ID}, 'c' || cast(c_custkey as string), c_name,
       {_STATION_LAT}, {_STATION_LON},
       case when c_custkey % 43 = 42 then null when c_custkey % 40 = 39 then 0 else 10 + c_custkey % 50 end,
       c_mktsegment, '750' || lpad(cast(c_nationkey as string), 2, '0')
from <T:customer>""",
    # stops, some far outside the region
    "stops_reference": """
select p_partkey as zda_id, p_name || ' ' || cast(p_partkey as string) as name,
       48.815e0 + (p_partkey * 6151 % 9949) / 9949.0e0 * 0.09e0
         + case when p_partkey % 23 = 0 then 1.0e0 else 0.0e0 end as lat,
       2.255e0 + (p_partkey * 3571 % 9941) / 9941.0e0 * 0.16e0 as lon,
       p_brand as town, p_type as type
from <T:part>""",
    # two stop areas per zone
    "zone_bridge": "select p_partkey as ZdAId, cast(floor(p_partkey / 2) as bigint) as ZdCId from <T:part>",
    # one disruption per order, polled once per line; two lines can share a poll
    "disruptions_raw": """
select <TS> '2024-01-30 12:00:00' + (k % 48 + poll) * interval '10' minute as ingest_ts,
       'transit' as source, 'disruption' as event_type, 'd-' || cast(k as string) as key,
       '{"applicationPeriods":[{"begin":"20240130T0' || cast(k % 10 as string) || '0000","end":"20240131T230000"}'
       || case when k % 4 = 0 then ',{"begin":"20240201T060000","end":"oops"}' else '' end
       || '],"cause":' || case when k % 37 = 0 then '{"code":1}' when ls = 'O' then '"TRAVAUX"' else '"PERTURBATION"' end
       || ',"id":"d-' || cast(k as string) || '","impactedSections":'
       || case when k % 31 = 0 then 'null' when k % 11 = 0 then '[]' else
          '[{"from":{"id":"stop_area:IDFM:' || cast(fz as string) || '"},"lineId":"line:IDFM:C01371"'
          || case when k % 13 = 0 then '' else ',"to":{"id":"stop_area:IDFM:' || cast(tz as string) || '"}' end || '}'
          || case when k % 3 = 0 then ',{"from":{"id":"stop_area:IDFM:' || cast(tz as string)
             || '"},"lineId":"line:IDFM:C01371","to":{"id":"stop_area:IDFM:' || cast(fz as string) || '"}}' else '' end
          || ']' end
       || ',"lastUpdate":"20240130T' || lpad(cast(8 + k % 4 as string), 2, '0')
       || lpad(cast((k + ln * 7) % 60 as string), 2, '0') || '00","message":"<p>Notice ' || cast(ln as string)
       || '</p>","severity":"'
       || case rf when 'A' then 'BLOQUANTE' when 'N' then 'PERTURBEE' else 'INFORMATION' end
       || '","shortMessage":"Notice","title":'
       || case when k % 53 = 0 then 'null' else '"' || case k % 5 when 0 then 'Bus 165 : Travaux'
            when 1 then 'Metro 7 : Trafic interrompu' when 2 then 'RER B : Trafic interrompu'
            when 3 then 'Tramway T3a : Travaux' else 'Metro 13 : Trafic interrompu' end || '"' end || '}' as payload
from (select l_orderkey as k, l_linenumber as ln, l_returnflag as rf, l_linestatus as ls,
             cast(floor((l_linenumber - 1) / 2) as bigint) as poll,
             case when l_orderkey % 19 = 0 then 900000 + l_orderkey else l_partkey % 100 end as fz,
             (l_partkey * 7 + 5) % 100 as tz
      from <T:lineitem>) a""",
    # one line per event; every kind of dead letter occurs
    "envelopes": """
select event_id,
       case when event_id % 503 = 502 then substr(j, 1, 40) || repeat('long text ', 25000)
            when event_id % 101 = 100 then substr(j, 1, 40) when event_id % 79 = 78 then j || ' x'
            when event_id % 73 = 72 then '   ' when event_id % 71 = 70 then '[1,2]' else j end as value
from (select event_id,
 '{"ingest_ts":"' || case when event_id % 113 = 112 then 'NOPE' else iso end || '","event_ts":'
 || case when event_id % 97 = 96 then '""' else '"' || iso || '"' end
 || case when event_id % 103 = 102 then '' else ',"source":"bikeshare"' end
 || ',"event_type":"' || case when event_id % 109 = 108 then 'other' else 'station_status_snapshot' end
 || '","key":"bikeshare:station_status_snapshot","payload":{"data":'
 || case when event_id % 89 = 88 then '"text"' else '{"stations":'
 || case when event_id % 107 = 106 then '"NOT_A_LIST"' else
 '[{"station_id":' || cast(user_id as string) || ',"stationCode":"c' || cast(user_id as string)
 || '","is_installed":1,"is_renting":' || case when event_id % 61 = 60 then 'true' else '1' end
 || ',"is_returning":1,"last_reported":' || cast(ep as string)
 || ',"num_bikes_available":' || case when event_id % 67 = 66 then '99999999999999999999' else cast(b as string) end
 || ',"num_docks_available":' || cast(40 - b as string)
 || ',"num_bikes_available_types":[{"mechanical":' || cast(b - b % 3 as string) || '},{"ebike":' || cast(b % 3 as string) || '}]},'
 || '{"station_id":"' || cast(user_id + 1 as string) || '","station_code":"d' || cast(user_id + 1 as string)
 || '","numBikesAvailable":"' || cast(b as string)
 || '","numDocksAvailable":"bad","num_bikes_available_types":[{"bike_type":"mechanical","count":' || cast(b as string)
 || '},{"bike_type":"e-bike","count":1}]},{"num_bikes_available":5}]' end || '}' end || '}}' as j
 from (select event_id, user_id, cast(floor(value) as bigint) % 40 as b, <ISO> as iso, <EPOCH> as ep from <T:events>) a) b""",
    # feed documents as collected, some without a usable update time
    "feed_documents": """
select ts as collected_at, event_id,
       '{"data":{"stations":[{"station_id":' || cast(user_id as string) || '}]}'
       || case event_id % 7 when 5 then '' when 6 then ',"last_updated":"soon"' when 4 then ',"last_updated":null'
          else ',"last_updated":' || cast(<EPOCH> - 30 as string) end || ',"ttl":60}' as doc
from <T:events>""",
    # bulk disruption responses, one per order
    "bulk_responses": """
select o_orderdate as polled_at, o_orderkey,
       case when o_orderkey % 10 = 9 then '{"status":"empty"}' when o_orderkey % 17 = 16 then '{"disruptions":[{"id":'
            when o_orderkey % 19 = 18 then '[1]' when o_orderkey % 23 = 22 then '{"disruptions":"none"}'
            when o_orderkey % 29 = 28 then '{"disruptions":[]} tail' else
       '{"disruptions":[{"cause":"TRAVAUX","id":"d-' || cast(o_orderkey as string) || '"},{"cause":"PERTURBATION"}'
       || case when o_orderkey % 3 = 0 then ',{"id":"e-' || cast(o_custkey as string) || '","severity":"BLOQUANTE"}' else '' end
       || ']}' end as response
from <T:orders>""",
    # pushed metadata messages, one per customer, some redelivered under the same id
    "info_messages": f"""
select 'm-' || cast(case when c_custkey % 10 = 9 then c_custkey - 1 else c_custkey end as string) as message_id,
       <TS> '2024-01-30 03:10:00' as publish_time,
       case when c_custkey % 29 = 28 then '' when c_custkey % 31 = 30 then '@@@@' else <BASE64 j BASE64> end as data,
       '{{"origin":"poller"' || case when c_custkey % 41 = 40 then ',"dlq_test":"Yes"' else '' end || '}}' as attributes,
       1 + c_custkey % 7 as attempt
from (select c_custkey,
 case when c_custkey % 23 = 22 then '{{"broken"' when c_custkey % 47 = 46 then '[1,2]'
      when c_custkey % 53 = 52 then '{{"event_type":"station_information","ingest_ts":"2024-01-30T03:10:00+00:00","key":"k","payload":"text","source":"bikeshare"}}'
      else
 '{{"event_ts":"2024-01-30T03:09:00+00:00","event_type":"station_information","ingest_ts":"'
 || case when c_custkey % 59 = 58 then 'NOPE' else '2024-01-30T03:10:00+00:00' end || '"'
 || ',"key":"bikeshare:station_information","payload":{{"data":{{"stations":'
 || case when c_custkey % 37 = 36 then '"NOPE"' when c_custkey % 43 = 42 then '[]' else
 '[{{"address":"' || c_mktsegment || '","capacity":' || cast(10 + c_custkey % 50 as string)
 || ',"lat":' || case when c_custkey % 61 = 60 then '"abc"' else '48.5' end || ',"lon":2.25,"name":"' || c_name || '","postCode":"75001"'
 || case when c_custkey % 3 = 0 then '' else ',"stationCode":"s' || cast(c_custkey as string) || '"' end
 || ',"station_id":' || cast(c_custkey as string) || '}},{{"station_id":" "}}]' end
 || '}}}},"source":"bikeshare"}}' end as j, c_name
 from <T:customer>) a""",
    # dead-lettered push messages
    "push_dlq": """
select 'station-info-sub' as subscription_name, cast(event_id as string) as message_id, ts as publish_time,
 '{"test":' || cast(event_id as string) || '}' as data,
 '{"origin":"' || event_type || '"' || case when event_id % 5 = 0 then ',"replay":"TRUE"' else '' end
 || case when event_id % 3 = 0 then ',"dlq_test":"true"' else '' end
 || ',"CloudPubSubDeadLetterSourceDeliveryCount":"5","CloudPubSubDeadLetterSourceTopicPublishTime":"' || <ISO>
 || '"}' as attributes
from <T:events>""",
}


def _fill(text: str, tokens: dict[str, str], tables: dict[str, str]) -> str:
    for name, sql in tables.items():
        text = text.replace(f"<T:{name}>", sql)
    for token, sql in tokens.items():
        text = text.replace(token, sql)
    return text


def duckdb_sql(name: str) -> str:
    """Definition of a derived table for the checking engine."""
    return _fill(DEFINITIONS[name], _DUCKDB, {t: t for t in SOURCES}).strip()


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that is too small to be split by files.

    Larger inputs already come in more pieces than there are cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class Tables:
    """Derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def _view(self, table: str) -> str:
        path = f"{self._dir}/{table}.parquet"
        name = f"kerbside_{table}_{zlib.crc32(path.encode())}"
        _spread(self.spark.read.parquet(path)).createOrReplaceTempView(name)
        return name

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DEFINITIONS:
            raise AttributeError(name)
        text = DEFINITIONS[name]
        views = {t: self._view(t) for t in SOURCES if f"<T:{t}>" in text}
        df = self.spark.sql(_fill(text, _SPARK, views))
        if name in ("info_messages", "push_dlq"):
            df = df.withColumn("attributes", F.from_json("attributes", "map<string,string>"))
        return df
