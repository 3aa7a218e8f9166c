"""Values that are part of the data contract.

Fixed values: these must be spelled exactly like this for results to be right.
"""

# Event routing
SNAPSHOT_EVENT_TYPE = "station_status_snapshot"
REQUIRED_TEXT_FIELDS = ("source", "event_type", "key")

# Dead-letter stages, error types and messages
STAGE_PARSE = "parse_normalize"
STAGE_MAPPING = "snapshot_to_station_rows"
STAGE_SINK = "bq_insert_curated"
SINK_ERROR_TYPE = "BigQueryInsertError"
MSG_EMPTY = "Empty input line"
MSG_NOT_OBJECT = "Parsed event is not a JSON object"
MSG_NOT_LIST = "payload.data.stations is not a list"
MSG_BAD_JSON = "Invalid JSON"
MSG_BAD_UTF8 = "Invalid UTF-8"

# Names of the bike kinds in the station feed
MECHANICAL = "mechanical"
EBIKE = "ebike"
EBIKE_SYNONYMS = ("ebike", "electric", "e-bike")

# Disruption feed
DISRUPTION_SOURCE = "idfm_disruptions"
DISRUPTION_EVENT_TYPE = "disruption"
UNKNOWN_KEY = "unknown"
FEED_TIMESTAMP_FORMAT = "yyyyMMdd'T'HHmmss"
STOP_AREA_PATTERN = r"stop_area:IDFM:(\d+)"
SEVERITY_INFORMATION = "INFORMATION"
SEVERITY_DISTURBED = "PERTURBEE"
SEVERITY_BLOCKING = "BLOQUANTE"
BUS_TITLE_PATTERN = "^Bus "

# Impact analysis
WALKING_RADIUS_M = 750.0
ACTIVE_WINDOW = "30 minutes"
FROM_STOP_LAT_RANGE = (48.6, 49.1)
FROM_STOP_LON_RANGE = (2.0, 2.7)
CONTROL_RING_M = (1000.0, 2000.0)
COVERAGE_THRESHOLD = 0.99
CIVIL_ZONE = "Europe/Paris"
HIGH_IMPACT_DELTA_PCT = -15.0
EARTH_RADIUS_M = 6_371_010.0

# Push delivery and replay
TRUE_WORDS = ("true", "1", "yes")
DEAD_LETTER_ATTRIBUTE_PREFIX = "CloudPubSubDeadLetter"
ORIGINAL_PUBLISH_TIME_ATTRIBUTE = "CloudPubSubDeadLetterSourceTopicPublishTime"
DRILL_ATTRIBUTE = "dlq_test"
REPLAY_ATTRIBUTE = "replay"
REPLAY_ID_ATTRIBUTE = "replay_id"
REPLAY_SOURCE_ATTRIBUTE = "replay_source"
MAX_REPLAY_MESSAGES = 50
MAX_DELIVERY_ATTEMPTS = 5
