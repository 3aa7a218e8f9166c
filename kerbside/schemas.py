"""Column types of the tables this package reads and writes, as DDL texts for ``.schema(...)``."""

RAW_EVENTS = (
    "ingest_ts timestamp NOT NULL, event_ts timestamp, source string NOT NULL, event_type string NOT NULL,"
    " key string NOT NULL, payload string NOT NULL"
)

STATION_STATUS = (
    "ingest_ts timestamp NOT NULL, event_ts timestamp, station_id string NOT NULL, station_code string,"
    " is_installed bigint, is_renting bigint, is_returning bigint, last_reported_ts timestamp,"
    " num_bikes_available bigint, num_docks_available bigint, mechanical_available bigint,"
    " ebike_available bigint, raw_station_json string"
)

STATION_INFORMATION = (
    "ingest_ts timestamp NOT NULL, event_ts timestamp, station_id string NOT NULL, station_code string, name string,"
    " lat double, lon double, capacity bigint, address string, post_code string, raw_station_json string"
)

DEAD_LETTERS = (
    "dlq_ts timestamp NOT NULL, stage string NOT NULL, error_type string NOT NULL, error_message string NOT NULL,"
    " raw string, event_meta string, row_json string, sink_errors string"
)

PUSH_DEAD_LETTERS = (
    "subscription_name string, message_id string, publish_time timestamp, data binary,"
    " attributes map<string,string>"
)

STOPS_REFERENCE = "zda_id bigint, name string, lat double, lon double, town string, type string"

ZONE_BRIDGE = "ZdAId bigint, ZdCId bigint"

STAGED_DISRUPTIONS = (
    "ingest_ts timestamp, disruption_id string, cause string, severity string, title string,"
    " short_message string, message_html string, last_update timestamp, application_periods string,"
    " impacted_sections string"
)
