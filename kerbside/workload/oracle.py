"""The registered queries in plain SQL, for checking with DuckDB."""

from __future__ import annotations

import re

from kerbside.workload.derived import DEFINITIONS, duckdb_sql

AS_OF = "timestamp '2024-02-01 00:00:00'"
RADIUS = "2.0e0 * 6371010.0e0"


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle metres, NULL for an unknown point (least() would skip the NULL)."""
    h = (
        f"(sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2))"
    )
    return f"{RADIUS} * asin(case when {h} > 1 then 1.0e0 else sqrt({h}) end)"


def _strict(fn: str, a: str, b: str) -> str:
    return f"case when {a} is null or {b} is null then null else {fn}({a}, {b}) end"


def _near(lat: str, lon: str, limit: str) -> str:
    """Distance test that is false, not an error, for unknown points."""
    return f"coalesce({_distance(lat, lon, 's.lat', 's.lon')} {limit}, false)"


def _newest(table: str, extra: str = "") -> str:
    return f"""select * exclude (rn) from (select *, row_number() over (
      partition by station_id order by event_ts desc nulls last, ingest_ts desc nulls last{extra}) as rn from {table})
    where rn = 1"""


def _member(doc: str, path: str) -> str:
    """Scalar member as text."""
    return (
        f"case when json_type(json_extract({doc}, '{path}')) in ('OBJECT', 'ARRAY') then null"
        f" else json_extract_string({doc}, '{path}') end"
    )


def _document(doc: str, path: str) -> str:
    return (
        f"case when json_type(json_extract({doc}, '{path}')) = 'NULL' then null"
        f" else cast(json_extract({doc}, '{path}') as varchar) end"
    )


def _stamp(text: str) -> str:
    return f"try_strptime({text}, '%Y%m%dT%H%M%S')"


def _zone_id(path: str) -> str:
    return f"try_cast(nullif(regexp_extract({_member('section', path)}, 'stop_area:IDFM:(\\d+)', 1), '') as bigint)"


def _instant(text: str) -> str:
    return f"try_strptime({text}, '%Y-%m-%dT%H:%M:%SZ')"


_STATION = "json_extract(station, '$.{}')"
_LONG = "try_cast(json_extract_string(station, '$.{}') as bigint)"


def _int(name: str) -> str:
    text = f"json_extract_string(station, '$.{name}')"
    return f"case {text} when 'true' then 1 when 'false' then 0 else try_cast({text} as bigint) end"


def _bikes(kinds: str, name: str) -> str:
    return f"""(select case when json_extract_string(i, '$.bike_type') in ({kinds}) and json_exists(i, '$.count')
        then try_cast(json_extract_string(i, '$.count') as bigint)
        else try_cast(json_extract_string(i, '$.{name}') as bigint) end
      from (select unnest(json_extract(station, '$.num_bikes_available_types[*]')) as i,
                   generate_subscripts(json_extract(station, '$.num_bikes_available_types[*]'), 1) as pos)
      where json_exists(i, '$.{name}')
         or (json_extract_string(i, '$.bike_type') in ({kinds}) and json_exists(i, '$.count'))
      order by pos desc limit 1)"""


SECTION = (
    "disruption_id, cause, severity, title, last_update,"
    " from_stop_name, from_lat, from_lon, to_stop_name, to_lat, to_lon"
)
ZONE = SECTION.replace("title", "disruption_title")
NOTICE_ORDER = (
    "last_update desc nulls last, from_stop_name asc nulls first, disruption_id asc nulls first,"
    " to_stop_name asc nulls first, from_lat asc nulls first, from_lon asc nulls first,"
    " to_lat asc nulls first, to_lon asc nulls first, cause asc nulls first, severity asc nulls first"
)

# Intermediate results by name; each may use the derived tables and the ones before it.
STEPS = {
    # events
    "parsed": """select event_id, value, case when json_valid(value) then cast(value as json) end as j from envelopes""",
    "checked": """select *, case when trim(value) = '' then 'ValueError' when j is null then 'JSONDecodeError'
             when json_type(j) <> 'OBJECT' then 'ValueError'
             when coalesce(json_extract_string(j, '$.source'), '') = '' then 'ValueError' end as error_type,
        case when trim(value) = '' then 'Empty input line' when j is null then 'Invalid JSON'
             when json_type(j) <> 'OBJECT' then 'Parsed event is not a JSON object'
             when coalesce(json_extract_string(j, '$.source'), '') = '' then 'Missing source' end as error_message
      from parsed""",
    "good": """select event_id, j, json_extract_string(j, '$.ingest_ts') as ingest_ts,
        coalesce(nullif(json_extract_string(j, '$.event_ts'), ''), json_extract_string(j, '$.ingest_ts')) as event_ts,
        json_extract_string(j, '$.source') as source, json_extract_string(j, '$.event_type') as event_type,
        json_extract_string(j, '$.key') as key,
        json_type(json_extract(j, '$.payload.data')) as data_type,
        json_type(json_extract(j, '$.payload.data.stations')) as stations_type
      from checked where error_message is null""",
    "elements": """select event_id, ingest_ts, event_ts, event_type,
        unnest(json_extract(j, '$.payload.data.stations[*]')) as station from good where stations_type = 'ARRAY'""",
    "flat": f"""select event_id, ingest_ts, event_ts, event_type, station,
        json_extract_string(station, '$.station_id') as station_id,
        coalesce(nullif(json_extract_string(station, '$.stationCode'), ''),
                 nullif(json_extract_string(station, '$.station_code'), ''),
                 json_extract_string(station, '$.stationcode')) as station_code,
        {_int('is_installed')} as is_installed, {_int('is_renting')} as is_renting,
        {_int('is_returning')} as is_returning,
        cast(to_timestamp({_LONG.format('last_reported')}) at time zone 'UTC' as timestamp) as last_reported_ts,
        case when json_extract_string(station, '$.num_bikes_available') is not null then {_int('num_bikes_available')}
             else {_int('numBikesAvailable')} end as num_bikes_available,
        case when json_extract_string(station, '$.num_docks_available') is not null then {_int('num_docks_available')}
             else {_int('numDocksAvailable')} end as num_docks_available,
        {_bikes("'mechanical'", 'mechanical')} as mechanical_available,
        {_bikes("'ebike', 'electric', 'e-bike'", 'ebike')} as ebike_available
      from elements where json_extract_string(station, '$.station_id') is not null""",
    "sunk": f"""select *, case when {_instant('ingest_ts')} is null then 'Invalid timestamp in ingest_ts: ' || ingest_ts end as bad_ingest,
        case when {_instant('event_ts')} is null then 'Invalid timestamp in event_ts: ' || event_ts end as bad_event,
        case when num_bikes_available is null
              and regexp_full_match(json_extract_string(station, '$.num_bikes_available'), '[+-]?\\d{{19,}}')
             then 'Integer out of range in num_bikes_available' end as bad_bikes
      from flat where event_type = 'station_status_snapshot'""",
    "accepted": "select * from sunk where bad_ingest is null and bad_event is null and bad_bikes is null",
    "mapping_errors": """select *, case when data_type = 'VARCHAR' and json_extract_string(j, '$.payload.data') <> ''
          then 'AttributeError' else 'ValueError' end as error_type,
        case when data_type = 'VARCHAR' and json_extract_string(j, '$.payload.data') <> ''
          then '''str'' object has no attribute ''get''' else 'payload.data.stations is not a list' end as error_message
      from good where event_type = 'station_status_snapshot' and coalesce(stations_type, '') <> 'ARRAY'""",
    # pushed messages
    "decoded": """select *, try(decode(from_base64(data))) as text from info_messages""",
    "pushed": """select *, case when data <> '' and json_valid(text) then cast(text as json) end as event from decoded""",
    "decided": """select *, case when lower(json_extract_string(attributes, '$.dlq_test')) in ('true', '1', 'yes') then 'forced failure'
             when coalesce(data, '') = '' then 'missing message.data' when event is null then 'invalid base64/json'
             when json_type(event) <> 'OBJECT' then 'event is not an object'
             when json_type(json_extract(event, '$.payload')) not in ('OBJECT', 'NULL') then 'payload is not an object'
             when json_type(json_extract(event, '$.payload.data.stations')) not in ('ARRAY', 'NULL')
             then 'payload.data.stations not a list'
             when usable and bad_time then 'Invalid timestamp in ingest_ts'
             when usable and bad_lat then 'Invalid value in lat' end as reason
      from (select *, event_time is not null and try_cast(event_time as timestamp) is null as bad_time,
          coalesce(len(list_filter(json_extract(event, '$.payload.data.stations[*]'),
            lambda s: coalesce(trim(json_extract_string(s, '$.station_id')), '') <> '')), 0) > 0 as usable,
          coalesce(len(list_filter(json_extract(event, '$.payload.data.stations[*]'),
            lambda s: json_extract_string(s, '$.lat') is not null and try_cast(json_extract_string(s, '$.lat') as double) is null)), 0) > 0 as bad_lat
        from (select *, replace(replace(json_extract_string(event, '$.ingest_ts'), '+00:00', ''), 'T', ' ') as event_time from pushed))""",
    "raw_judged": """select *, case when coalesce(data, '') = '' or event is null then 'rejected'
          when json_type(event) <> 'OBJECT' or try_cast(event_time as timestamp) is null then 'retry' else 'accepted' end as outcome,
        case when coalesce(data, '') = '' then 'missing message.data' when event is null then 'invalid base64/json'
          when json_type(event) <> 'OBJECT' then 'event is not an object'
          when try_cast(event_time as timestamp) is null then 'Invalid timestamp in ingest_ts' end as reason
      from (select *, replace(replace(json_extract_string(event, '$.ingest_ts'), '+00:00', ''), 'T', ' ') as event_time from pushed)""",
    "responses": """select *, case when json_valid(response) then cast(response as json) end as doc from bulk_responses""",
    # stations
    "state": _newest("station_status", ", event_id desc"),
    "info": _newest("station_information"),
    "facts": """select i.station_id, i.station_code, i.name as station_name, i.lat, i.lon, i.capacity as station_capacity,
        s.num_bikes_available, s.num_docks_available, s.station_id is not null as reports,
        case when i.capacity > 0 then cast(s.num_bikes_available as double) / i.capacity end as fill_rate
      from info i left join state s on i.station_id = s.station_id""",
    # hourly
    "snapshots": """select ingest_ts, date_trunc('hour', coalesce(event_ts, ingest_ts)) as hour_ts,
        count(distinct station_id) as stations_reporting, cast(sum(num_bikes_available) as bigint) as total_bikes,
        cast(sum(num_docks_available) as bigint) as total_docks,
        count(*) filter (where num_bikes_available = 0) as empty_stations
      from station_status group by 1, 2""",
    "hours": """select hour_ts, avg(total_bikes) as avg_total_bikes_available, max(total_bikes) as peak_total_bikes_available,
        min(total_bikes) as min_total_bikes_available, avg(total_docks) as avg_total_docks_available,
        avg(stations_reporting) as avg_stations_reporting, avg(empty_stations) as avg_empty_stations,
        max(empty_stations) as peak_empty_stations, count(*) as snapshot_samples
      from snapshots group by 1""",
    "hourly": """select *, max(avg_stations_reporting) over (order by hour_ts rows unbounded preceding) as total_stations_known
      from hours""",
    "coverage": """select *, timezone('Europe/Paris', timezone('UTC', hour_ts)) as hour_local,
        case when total_stations_known <> 0 then avg_stations_reporting / total_stations_known end as avg_coverage_ratio
      from hourly""",
    "covered": """select *, cast(hour_local as date) as date_local, cast(extract(hour from hour_local) as integer) as hour_of_day_local
      from coverage where avg_coverage_ratio >= 0.99""",
    # disruptions
    "projected": f"""select ingest_ts, {_member('payload', '$.id')} as disruption_id, {_member('payload', '$.cause')} as cause,
        {_member('payload', '$.severity')} as severity, {_member('payload', '$.title')} as title,
        {_member('payload', '$.shortMessage')} as short_message, {_member('payload', '$.message')} as message_html,
        {_stamp(_member('payload', '$.lastUpdate'))} as last_update,
        {_document('payload', '$.applicationPeriods')} as application_periods,
        {_document('payload', '$.impactedSections')} as impacted_sections, md5(payload) as digest
      from disruptions_raw""",
    "staged": """select * exclude (rn, digest) from (select *, row_number() over (
        partition by disruption_id, ingest_ts order by digest) as rn from projected) where rn = 1""",
    "latest": """select * exclude (rn) from (select *, row_number() over (
        partition by disruption_id order by ingest_ts desc) as rn from staged) where rn = 1""",
    "unnested": """select *, unnest(json_extract(impacted_sections, '$[*]')) as section from latest""",
    "keyed": f"""select *, {_zone_id('$.from.id')} as from_zdc_id, {_zone_id('$.to.id')} as to_zdc_id from unnested""",
    "zones": """select b.zdc, s.name, s.lat, s.lon, s.town
      from (select ZdCId as zdc, min(ZdAId) as zda from zone_bridge group by 1) b join stops_reference s on s.zda_id = b.zda""",
    "located": """select k.disruption_id, k.ingest_ts, k.cause, k.severity, k.title, k.last_update,
        k.from_zdc_id, f.name as from_stop_name, f.lat as from_lat, f.lon as from_lon,
        k.to_zdc_id, t.name as to_stop_name, t.lat as to_lat, t.lon as to_lon, f.town as from_stop_town
      from keyed k left join zones f on k.from_zdc_id = f.zdc left join zones t on k.to_zdc_id = t.zdc
      where k.from_zdc_id is not null""",
    "sections": "select * exclude (from_stop_town) from located where severity = 'BLOQUANTE'",
    "both_sections": "select * from located where severity in ('BLOQUANTE', 'PERTURBEE')",
    "active": """select * from sections where not regexp_matches(title, '^Bus ')
        and ingest_ts >= (select max(ingest_ts) from sections) - interval 30 minute
        and from_lat between 48.6 and 49.1 and from_lon between 2.0 and 2.7""",
    "both_active": """select * from both_sections where not regexp_matches(title, '^Bus ')
        and ingest_ts >= (select max(ingest_ts) from both_sections) - interval 30 minute
        and from_lat between 48.6 and 49.1 and from_lon between 2.0 and 2.7""",
    # impact
    "near": f"""select {', '.join('d.' + c.strip() for c in SECTION.split(','))},
        s.station_id, s.station_code, s.station_name, s.station_capacity, s.fill_rate, s.num_bikes_available, s.reports,
        {_distance('d.from_lat', 'd.from_lon', 's.lat', 's.lon')} as distance_to_from_stop_meters,
        {_distance('d.to_lat', 'd.to_lon', 's.lat', 's.lon')} as distance_to_to_stop_meters
      from active d join facts s
        on {_near('d.from_lat', 'd.from_lon', '<= 750')} or {_near('d.to_lat', 'd.to_lon', '<= 750')}""",
    "both_pairs": f"""select * exclude (rn) from (select *, row_number() over (partition by title,
          {_strict('least', 'from_stop_name', 'to_stop_name')}, {_strict('greatest', 'from_stop_name', 'to_stop_name')},
          station_id order by {NOTICE_ORDER}) as rn
        from (select {', '.join('d.' + c.strip() for c in SECTION.split(','))}, s.station_id, s.fill_rate
          from both_active d join facts s
            on {_near('d.from_lat', 'd.from_lon', '<= 750')} or {_near('d.to_lat', 'd.to_lon', '<= 750')})) where rn = 1""",
    "pairs": f"""select * exclude (rn), {_strict('least', 'distance_to_from_stop_meters', 'distance_to_to_stop_meters')} as nearest_m
      from (select *, row_number() over (partition by title,
          {_strict('least', 'from_stop_name', 'to_stop_name')}, {_strict('greatest', 'from_stop_name', 'to_stop_name')},
          station_id order by {NOTICE_ORDER}) as rn from near) where rn = 1""",
    "usable": """select *, num_bikes_available as bikes from facts where reports and station_capacity > 0""",
    "control": """select avg(fill_rate) as control_fill, avg(bikes) as control_bikes, count(*) as control_station_count
      from usable where station_id not in (select station_id from pairs)""",
    "zone_stats": f"""select {', '.join('p.' + c.strip() + (' as disruption_title' if c.strip() == 'title' else '') for c in SECTION.split(','))},
        count(distinct p.station_id) as stations_in_impact_zone, avg(u.fill_rate) as zone_fill, avg(u.bikes) as zone_bikes,
        min(p.nearest_m) as closest_station_distance_m
      from pairs p left join usable u on p.station_id = u.station_id
      group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11""",
    "comparison": f"""select {ZONE}, stations_in_impact_zone, round(closest_station_distance_m, 3) as closest_station_distance_m,
        round(zone_fill * 100, 1) as zone_fill_rate_pct, round(zone_bikes, 1) as zone_avg_bikes_available,
        round(control_fill * 100, 1) as control_fill_rate_pct, round(control_bikes, 1) as control_avg_bikes_available,
        control_station_count, round((zone_fill - control_fill) * 100, 1) as fill_rate_delta_pct
      from zone_stats cross join control""",
    "stop_notices": """select from_lat, from_lon, count(*) as notices from both_sections where from_lat is not null group by 1, 2""",
    "ring_pairs": f"""select zone, station_id, fill_rate, notices from (
      select s.station_id, s.fill_rate, d.notices,
        {_distance('d.from_lat', 'd.from_lon', 's.lat', 's.lon')} as m
      from stop_notices d join facts s on {_near('d.from_lat', 'd.from_lon', '<= 2000')} where s.reports) p
      join (values ('impact', -1.0, 750.0), ('control', 1000.0, 2000.0)) z(zone, low, high)
        on m >= low and m <= high and not (zone = 'impact' and m = high)""",
    # replay
    "pulled": """select *, coalesce(lower(json_extract_string(attributes, '$.replay')), '') = 'true' as seen
      from push_dlq order by publish_time, message_id limit 50""",
}


VERSIONS = """(select *, lead(valid_from) over (partition by station_id order by valid_from) as valid_to
        from (select station_id, ingest_ts as valid_from, name, capacity from station_information))"""
AS_OF_JOIN = f"""select s.event_id, s.station_id, v.valid_from, v.valid_to, v.name, v.capacity
      from station_status s asof left join {VERSIONS} v
        on s.station_id = v.station_id and coalesce(s.event_ts, s.ingest_ts) >= v.valid_from"""


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b\w+\b", re.sub(r"'[^']*'", "''", sql)))
    return [n for n in (*DEFINITIONS, *STEPS) if n in words]


def _compose(body: str) -> str:
    """``body`` with every derived table and step it needs, in dependency order."""
    done: dict[str, str] = {}

    def add(name: str, sql: str) -> None:
        for needed in _needs(sql):
            if needed != name and needed not in done:
                add(needed, STEPS.get(needed) or duckdb_sql(needed))
        done[name] = sql

    add("result", body)
    result = done.pop("result")
    ctes = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in done.items())
    return f"with {ctes}\n{result}" if ctes else result


NEAR = f"""select {SECTION}, station_id, station_code, station_name, station_capacity,
        round(distance_to_from_stop_meters, 3) as distance_to_from_stop_meters,
        round(distance_to_to_stop_meters, 3) as distance_to_to_stop_meters from near"""
_STATUS = (
    "station_id, station_code, is_installed, is_renting, is_returning, last_reported_ts,"
    " num_bikes_available, num_docks_available, mechanical_available, ebike_available"
)
_CURATED = f"select {_instant('ingest_ts')} as ingest_ts, {_instant('event_ts')} as event_ts, {_STATUS} from accepted"
_NO_TEXT = "cast(null as varchar)"
_DLQ_STAGES = """select 'parse_normalize' as stage from checked where error_message is not null
    union all select 'snapshot_to_station_rows' from mapping_errors
    union all select 'bq_insert_curated' from sunk where bad_ingest is not null or bad_event is not null or bad_bikes is not null"""

BODIES = {
    "normalized_events": """select event_id, ingest_ts, event_ts, source, event_type, key,
        case when stations_type = 'ARRAY' then cast(json_array_length(json_extract(j, '$.payload.data.stations')) as bigint) end as n_elements
      from good""",
    "rejected_events": "select event_id, error_type, error_message from checked where error_message is not null",
    "curated_status": _CURATED,
    "flattened_status": f"select ingest_ts, event_ts, {_STATUS} from flat",
    "raw_station_members": f"""select {_instant('ingest_ts')} as ingest_ts, station_id,
        try_cast(json_extract_string(station, '$.last_reported') as bigint) as raw_last_reported,
        json_extract_string(station, '$.numDocksAvailable') as raw_docks from accepted""",
    "dead_letters_parse": f"""select 'parse_normalize' as stage, error_type, error_message, value as raw,
        {_NO_TEXT} as event_meta, {_NO_TEXT} as row_json, {_NO_TEXT} as sink_errors
      from checked where error_message is not null""",
    "dead_letters_mapping": f"""select 'snapshot_to_station_rows' as stage, error_type, error_message,
        '{{"source":"' || source || '","event_type":"' || event_type || '","key":"' || key || '","ingest_ts":"' || ingest_ts
          || '","event_ts":"' || event_ts || '"}}' as event_meta, {_NO_TEXT} as row_json, data_type is null as no_data, ingest_ts as raw_ingest_ts, event_ts as raw_event_ts,
        key as raw_key
      from mapping_errors""",
    "dead_letters_sink": f"""select 'bq_insert_curated' as stage, 'BigQueryInsertError' as error_type,
        coalesce(bad_ingest, bad_event, bad_bikes) as error_message, {_NO_TEXT} as raw,
        '{{"destination":"station_status"}}' as event_meta,
        '[' || array_to_string([ '{{"message":"' || m || '"}}' for m in [bad_ingest, bad_event, bad_bikes] if m is not null ], ',') || ']' as sink_errors,
        ingest_ts as row_ingest_ts, event_ts as row_event_ts, station_id as row_station_id
      from sunk where bad_ingest is not null or bad_event is not null or bad_bikes is not null""",
    "dead_letter_counts": f"select stage, count(*) as n from ({_DLQ_STAGES}) group by 1",
    "replayed_dead_letters": f"""select stage, count(*) as n from ({_DLQ_STAGES})
      where stage <> 'bq_insert_curated' group by 1""",
    "dead_letter_inspection": f"""select {AS_OF} as dlq_ts, 'parse_normalize' as stage, error_type,
        substr(error_message, 1, 100) as error_msg, value as raw
      from checked where error_message like '%Missing source%' order by error_type, error_msg, raw limit 10""",
    "streamed_status": _CURATED,
    "curated_table": f"select *, cast(ingest_ts as date) as ingest_date from ({_CURATED})",
    "dead_letter_table": f"select stage, count(*) as n from ({_DLQ_STAGES}) group by 1",
    "ndjson_round_trip": _CURATED,
    "seed_round_trip": "select zda_id, name, lat, lon, town, type from stops_reference",
    # landing
    "landed_raw": """select message_id, ingest_ts, event_ts, source, event_type, key, payload from (
      select *, row_number() over (partition by message_id order by ingest_ts nulls last, digest) as rn from (
        select message_id,
          cast(replace(replace(json_extract_string(event, '$.ingest_ts'), '+00:00', ''), 'T', ' ') as timestamp) as ingest_ts,
          cast(replace(replace(json_extract_string(event, '$.event_ts'), '+00:00', ''), 'T', ' ') as timestamp) as event_ts,
          json_extract_string(event, '$.source') as source, json_extract_string(event, '$.event_type') as event_type,
          json_extract_string(event, '$.key') as key,
          case when json_type(json_extract(event, '$.payload')) = 'VARCHAR' then json_extract_string(event, '$.payload')
               else cast(json_extract(event, '$.payload') as varchar) end as payload,
          md5(text) as digest from raw_judged where outcome = 'accepted')) where rn = 1""",
    "landing_dead_letters": """select outcome, reason, count(*) as messages from raw_judged group by 1, 2""",
    "disruption_errors": """select polled_at, case when doc is null then 'Invalid JSON'
          when json_type(doc) <> 'OBJECT' then 'response is not an object' else 'disruptions is not a list' end as reason, response
      from responses where doc is null or json_type(doc) <> 'OBJECT' or json_type(json_extract(doc, '$.disruptions')) = 'VARCHAR'""",
    "push_decisions": """select case when reason in ('forced failure', 'event is not an object', 'payload is not an object',
            'Invalid timestamp in ingest_ts', 'Invalid value in lat') then 'retry' when reason is not null then 'rejected'
          when usable then 'accepted' else 'empty' end as outcome, reason, count(*) as messages from decided group by 1, 2""",
    "landed_station_information": """select timestamp '2024-01-30 03:10:00' as ingest_ts, timestamp '2024-01-30 03:09:00' as event_ts,
        json_extract_string(s, '$.station_id') as station_id, coalesce(json_extract_string(s, '$.stationCode'), '') as station_code,
        json_extract_string(s, '$.name') as name, cast(json_extract_string(s, '$.lat') as double) as lat,
        cast(json_extract_string(s, '$.lon') as double) as lon, cast(json_extract_string(s, '$.capacity') as bigint) as capacity,
        json_extract_string(s, '$.address') as address, json_extract_string(s, '$.postCode') as post_code
      from (select unnest(json_extract(event, '$.payload.data.stations[*]')) as s from decided
            where usable and coalesce(reason, 'forced failure') = 'forced failure' and not bad_time and not bad_lat)
      where trim(json_extract_string(s, '$.station_id')) <> ''""",
    "exhausted_deliveries": """select 'station-info-sub' as subscription_name, message_id, publish_time,
        cast(octet_length(try(from_base64(data))) as bigint) as data_bytes, json_extract_string(attributes, '$.origin') as origin
      from decided where reason is not null and attempt >= 5""",
    "disruption_feed_rows": """select polled_at as ingest_ts, polled_at as event_ts, 'idfm_disruptions' as source,
        'disruption' as event_type, coalesce(json_extract_string(e, '$.id'), 'unknown') as key, cast(e as varchar) as payload
      from (select polled_at, unnest(json_extract(doc, '$.disruptions[*]')) as e from responses)""",
    "snapshot_envelopes": """select ingest_ts, event_ts, 'bikeshare' as source, 'station_status_snapshot' as event_type,
        'bikeshare:station_status_snapshot' as key,
        '{"ingest_ts":"' || strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '","event_ts":'
        || coalesce('"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') || '"', 'null')
        || ',"source":"bikeshare","event_type":"station_status_snapshot","key":"bikeshare:station_status_snapshot","payload":'
        || doc || '}' as value
      from (select collected_at as ingest_ts, doc,
              cast(to_timestamp(try_cast(json_extract_string(doc, '$.last_updated') as bigint)) at time zone 'UTC' as timestamp) as event_ts
            from feed_documents)""",
    # stations
    "latest_state": "select * from state",
    "streamed_live_state": "select * from state",
    "latest_information": "select * from info",
    "latest_enriched": """select s.*, i.name, i.lat, i.lon, i.capacity, i.address
      from state s left join info i on s.station_id = i.station_id""",
    "live_kpis": """select cast(sum(mechanical_available) as bigint) as total_mechanical, cast(sum(ebike_available) as bigint) as total_ebikes,
        cast(sum(num_docks_available) as bigint) as total_docks, count(*) as stations_reporting from state""",
    "district_availability": """select i.post_code, count(*) as stations, cast(sum(s.num_bikes_available) as bigint) as bikes,
        round(case when sum(i.capacity) <> 0 then cast(sum(s.num_bikes_available) * 100 as double) / cast(sum(i.capacity) as double) end, 1) as fill_pct
      from state s join info i on s.station_id = i.station_id group by 1""",
    "history_size": """select count(*) as history_rows, count(distinct station_id) as latest_rows from station_status""",
    "station_count": "select count(distinct station_id) as total_stations from station_information",
    "daily_stations": """select cast(ingest_ts as date) as ingest_date, count(distinct station_id) as stations_count
      from station_information group by 1 order by 1 desc limit 7""",
    "status_freshness": f"""select max(ingest_ts) as last_ingest,
        cast(floor(epoch({AS_OF} - max(ingest_ts)) / 60) as bigint) as lag_minutes from station_status""",
    "status_flow_from_footers": f"""select count(*) as row_count, min(ingest_ts) as first_ingest, max(ingest_ts) as last_ingest,
        cast(floor(epoch({AS_OF} - max(ingest_ts)) / 60) as bigint) as lag_minutes from station_status""",
    "daily_flow_from_footers": """select cast(ingest_ts as date) as ingest_date, count(*) as row_count, max(ingest_ts) as last_ingest
      from station_status group by 1""",
    "temporal_baseline": """select station_id, cast(dayofweek(coalesce(event_ts, ingest_ts)) + 1 as integer) as weekday,
        cast(hour(coalesce(event_ts, ingest_ts)) as integer) as hour_of_day,
        round(avg(num_bikes_available), 6) as usual_bikes, count(*) as samples from station_status group by 1, 2, 3""",
    "hourly_depletion": """select station_id, date_trunc('hour', ts) as hour_ts, count(*) as readings,
        arg_min(num_bikes_available, (ts, event_id)) - arg_max(num_bikes_available, (ts, event_id)) as bikes_lost
      from (select *, coalesce(event_ts, ingest_ts) as ts from station_status) group by 1, 2""",
    # hourly
    "snapshot_totals": "select * from snapshots",
    "hourly_aggregate": "select * from hourly",
    "hourly_from_partials": "select * from hourly",
    "hourly_coverage": "select * from coverage",
    "hourly_well_covered": "select * from covered",
    "availability_trend": """select hour_local, avg_total_bikes_available, peak_total_bikes_available,
        min_total_bikes_available from covered""",
    "empty_station_trend": """select hour_local, avg_empty_stations, peak_empty_stations, avg_stations_reporting,
        avg_coverage_ratio from covered""",
    "windowed_status_totals": """select time_bucket(interval 30 minute, ts) - shift as window_start, count(*) as readings,
        cast(sum(num_bikes_available) as bigint) as bikes_seen, count(*) filter (where num_bikes_available = 0) as empty_readings
      from (select *, coalesce(event_ts, ingest_ts) as ts from station_status)
        cross join (values (interval 0 minute), (interval 30 minute)) w(shift) group by 1""",
    "streamed_windowed_totals": """select time_bucket(interval 30 minute, ts) - shift as window_start, count(*) as readings,
        cast(sum(num_bikes_available) as bigint) as bikes_seen, count(*) filter (where num_bikes_available = 0) as empty_readings
      from (select *, coalesce(event_ts, ingest_ts) as ts from station_status)
        cross join (values (interval 0 minute), (interval 30 minute)) w(shift) group by 1""",
    "streamed_closing_windows": """select window_start, count(*) as readings
      from (select time_bucket(interval 30 minute, ts) - shift as window_start, max(ts) over () as newest
            from (select coalesce(event_ts, ingest_ts) as ts from station_status)
              cross join (values (interval 0 minute), (interval 30 minute)) w(shift))
      where window_start + interval 1 hour <= newest - interval 2 hour group by 1""",
    "changed_stations": "select * from state",
    "stations_fallen_silent": """select station_id, epoch_ms(epoch_us(seen) // 1000) as silent_since
      from (select station_id, coalesce(event_ts, ingest_ts) as seen from state)
      where epoch_us(seen) // 1000 + 86400000 <= (select epoch_us(max(coalesce(event_ts, ingest_ts))) // 1000 from station_status) - 3600000""",
    "streamed_enrichment": """select s.event_id, s.station_id, i.name, i.lat, i.lon, i.capacity
      from station_status s left join info i on s.station_id = i.station_id""",
    "station_versions": f"select * from {VERSIONS}",
    "enriched_as_of": AS_OF_JOIN,
    "streamed_enrichment_as_of": AS_OF_JOIN,
    "guarded_rows": """select event_id, cast(station_id as bigint) as number from station_status where event_id % 4999 <> 998""",
    "guarded_dead_letters": f"""select {AS_OF} as dlq_ts, 'CAST_INVALID_INPUT' as error_type, event_id
      from station_status where event_id % 4999 = 998""",
    "streamed_message_ids": "select distinct message_id from info_messages",
    "redelivered_messages": "select distinct message_id from info_messages",
    "streamed_redeliveries": "select distinct message_id from info_messages",
    # disruptions
    "staged_disruptions": "select * from staged",
    "incremental_staging": "select * from staged",
    "streamed_staging": "select * from staged",
    "published_staging": """select *, 'after' as reader from staged
      union all select *, 'before' from staged where ingest_ts < timestamp '2024-01-30 16:00:00'""",
    "merged_across_months": """select ingest_ts, key, payload from (
        select *, row_number() over (partition by key order by ingest_ts desc, payload) as rn
        from (select polled_at as ingest_ts, coalesce(json_extract_string(e, '$.id'), 'unknown') as key, cast(e as varchar) as payload
              from (select polled_at, unnest(json_extract(doc, '$.disruptions[*]')) as e from responses)))
      where rn = 1""",
    "published_refresh": "select * from hourly",
    "disruption_sections": "select * from sections",
    "active_sections": "select * from active",
    "disruption_periods": f"""select disruption_id, severity, nullif(regexp_extract(title, '^(.*?) :', 1), '') as line_name,
        {_stamp("json_extract_string(p, '$.begin')")} as period_begin, {_stamp("json_extract_string(p, '$.end')")} as period_end
      from (select *, unnest(json_extract(application_periods, '$[*]')) as p from latest)""",
    "disruptions_by_severity": "select severity, count(*) as disruptions from latest group by 1",
    "disruption_timeline": """select date_trunc('hour', ingest_ts) as hour_ts, severity, count(distinct disruption_id) as disruptions
      from staged group by 1, 2""",
    "raw_flow": """select count(*) as row_count, min(ingest_ts) as first_ingest, max(ingest_ts) as last_ingest from disruptions_raw""",
    "poll_counts": "select count(*) as total_rows, count(distinct ingest_ts) as distinct_polls from staged",
    # impact
    "stations_near_disruptions": NEAR,
    "stations_near_disruptions_split": NEAR,
    "impact_comparison": "select * from comparison",
    "impact_map": """select ('0x' || substr(md5(disruption_id || '_' || stop_role), 1, 15))::bigint as objectid, *,
        'POINT(' || cast(lon as varchar) || ' ' || cast(lat as varchar) || ')' as geom_point
      from (select disruption_id, disruption_title, cause, severity, last_update, stop_role,
          case stop_role when 'from' then from_stop_name else to_stop_name end as stop_name,
          case stop_role when 'from' then from_lat else to_lat end as lat,
          case stop_role when 'from' then from_lon else to_lon end as lon,
          stations_in_impact_zone, closest_station_distance_m, zone_fill_rate_pct, zone_avg_bikes_available,
          control_fill_rate_pct, control_avg_bikes_available, control_station_count, fill_rate_delta_pct
        from comparison cross join (values ('from'), ('to')) r(stop_role))
      where lat is not null and lon is not null""",
    "far_zone_polygons": """select zda_id, cast(case when not polar and 180.0e0 - abs(lon) < half then 2 else 1 end as integer) as parts,
        true as closed, polar as over_pole, true as on_the_map
      from (select zda_id, lon, abs(lat) + degrees(2000.0e0 / 6371010.0e0) >= 90 as polar,
              degrees(asin(least(1.0e0, sin(2000.0e0 / 6371010.0e0) / cos(radians(lat))))) as half
            from (select zda_id, case when turned > 180 then turned - 360 else turned end as lon,
                    case when zda_id % 8 = 0 then -89.98e0 - zda_id % 20 / 1000.0e0 when zda_id % 4 = 0 then 89.98e0 + zda_id % 20 / 1000.0e0 else lat end as lat
                  from (select *, (lon * 40 + 179.0e0) - 4 * floor((lon * 40 + 179.0e0) / 4) + 178.0e0 as turned from stops_reference)))""",
    "impact_kpis": """select round(near_fill * 100, 1) as avg_fill_near_disruptions_pct,
        round(control_fill * 100, 1) as avg_fill_elsewhere_pct, round((near_fill - control_fill) * 100, 1) as avg_delta_pct,
        (select count(distinct disruption_id) from pairs) as active_disruptions,
        control_station_count as control_stations, affected_stations
      from control cross join (select avg(u.fill_rate) as near_fill, count(*) as affected_stations
        from (select distinct station_id from pairs) p left join usable u on p.station_id = u.station_id)""",
    "impact_classes": """select disruption_id, from_stop_name, to_stop_name, fill_rate_delta_pct,
        case when fill_rate_delta_pct >= 0 then 'none' when fill_rate_delta_pct > -15 then 'moderate'
             when fill_rate_delta_pct is not null then 'high' end as impact_class from comparison""",
    "impact_by_severity": f"""select severity, count(distinct disruption_id) as disruptions, round(avg(delta), 2) as avg_delta_pct
      from (select {SECTION}, round((avg(u.fill_rate) - any_value(c.fill)) * 100, 1) as delta
        from both_pairs p left join usable u on p.station_id = u.station_id
          cross join (select avg(fill_rate) as fill from usable where station_id not in (select station_id from both_pairs)) c
        group by {SECTION}) group by 1""",
    "impact_zone_polygons": """select ('0x' || substr(md5(disruption_id || '_' || stop_role || '_' || coalesce(from_stop_name, '')
          || '_' || coalesce(to_stop_name, '')), 1, 15))::bigint as objectid, stop_role, 33 as points, true as closed,
        cast(750 as double) as nearest_corner_m, cast(750 as double) as farthest_corner_m
      from (select *, case stop_role when 'from' then from_lat else to_lat end as lat
        from comparison cross join (values ('from'), ('to')) r(stop_role)) where lat is not null""",
    "lowest_stations": """select station_id, any_value(station_name) as station_name,
        round(any_value(fill_rate) * 100, 1) as fill_rate_pct, count(*) as zones
      from pairs where fill_rate is not null group by 1 order by fill_rate_pct, station_id limit 10""",
    "nearest_stations": f"""select title, from_stop_name, station_name, station_capacity,
        round({_strict('least', 'distance_to_from_stop_meters', 'distance_to_to_stop_meters')}) as nearest_stop_distance_m
      from near order by nearest_stop_distance_m nulls first, title nulls first, from_stop_name nulls first,
        station_name nulls first, station_capacity nulls first limit 10""",
    "ring_comparison": """select zone, count(distinct station_id) as station_count,
        round(sum(fill_rate * notices) / sum(case when fill_rate is not null then notices end) * 100, 1) as avg_availability_pct
      from ring_pairs group by 1""",
    "walking_listing": f"""select d.title as disruption, d.severity, d.cause, d.from_stop_name as transit_stop,
        d.from_stop_town as town, s.station_name, s.num_bikes_available, s.num_docks_available, round({_distance('d.from_lat', 'd.from_lon', 's.lat', 's.lon')}) as distance_meters
      from both_sections d join facts s on {_near('d.from_lat', 'd.from_lon', '< 750')}""",
    # replay
    "replay_plan": """select message_id, publish_time, data,
        case when seen then array_to_string(list_sort([k || '=' || json_extract_string(attributes, '$.' || k) for k in json_keys(attributes)]), ';')
          else array_to_string(list_sort(list_concat(
            [k || '=' || json_extract_string(attributes, '$.' || k) for k in json_keys(attributes)
             if not starts_with(k, 'CloudPubSubDeadLetter') and k not in ('dlq_test', 'replay')],
            ['replay=true', 'replay_id=run-1', 'replay_source=hold-sub'])), ';') end as attributes,
        case when seen then 'skipped' else 'republished' end as action, not seen as acknowledge from pulled""",
    "second_replay": "select cast(0 as bigint) as lines",
    "replay_summary": """select count(*) as pulled, count(*) filter (where not seen) as republished, count(*) as acked,
        count(*) filter (where seen) as skipped, cast(0 as bigint) as failed
      from (select coalesce(lower(json_extract_string(attributes, '$.replay')), '') = 'true' as seen from push_dlq)""",
    "replay_repeated": """select message_id, 'run-1' as run_id from pulled where not seen
      union all select message_id, 'run-2' from (
        select message_id, coalesce(lower(json_extract_string(attributes, '$.replay')), '') = 'true' as again from push_dlq
        where message_id not in (select message_id from pulled where not seen)
        order by publish_time, message_id limit 50)
      where not again""",
    "original_publish_times": """select message_id, try_strptime(
        json_extract_string(attributes, '$.CloudPubSubDeadLetterSourceTopicPublishTime'), '%Y-%m-%dT%H:%M:%SZ') as original_publish_time
      from push_dlq""",
    # quality
    "quality_report": f"""
      select 'hourly_aggregate' as model, 'hour_ts' as "column", 'unique' as "check",
             (select count(*) from (select hour_ts from hourly group by 1 having count(*) > 1)) as failures
      union all select 'hourly_aggregate', 'hour_ts', 'not_null', (select count(*) from hourly where hour_ts is null)
      union all select 'hourly_aggregate', 'avg_total_bikes_available', 'not_null',
                       (select count(*) from hourly where avg_total_bikes_available is null)
      union all select 'hourly_aggregate', 'snapshot_samples', 'not_null', (select count(*) from hourly where snapshot_samples is null)
      union all select 'hourly_coverage', 'hour_ts', 'unique',
                       (select count(*) from (select hour_ts from coverage group by 1 having count(*) > 1))
      union all select 'hourly_coverage', 'hour_ts', 'not_null', (select count(*) from coverage where hour_ts is null)
      union all select 'hourly_well_covered', 'hour_ts', 'unique',
                       (select count(*) from (select hour_ts from covered group by 1 having count(*) > 1))
      union all select 'hourly_well_covered', 'hour_ts', 'not_null', (select count(*) from covered where hour_ts is null)
      union all select 'stops_reference', 'zda_id', 'unique',
                       (select count(*) from (select zda_id from stops_reference group by 1 having count(*) > 1))
      union all select 'stops_reference', 'zda_id', 'not_null', (select count(*) from stops_reference where zda_id is null)
      union all select 'station_status', 'event_ts', 'not_null', (select count(*) from station_status where event_ts is null)
      union all select 'station_status', 'station_id', 'unique',
                       (select count(*) from (select station_id from station_status group by 1 having count(*) > 1))
      union all select 'station_status', 'ingest_ts', 'fresh',
                       (select case when max(ingest_ts) >= {AS_OF} - interval 15 minute then 0 else 1 end from station_status)
      union all select 'disruptions_raw', 'event_type', 'accepted_values',
                       (select count(*) from disruptions_raw where event_type <> 'disruption')""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _compose(body) for name, body in BODIES.items()}
