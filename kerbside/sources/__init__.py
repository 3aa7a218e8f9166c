from kerbside.sources.landing import (
    disruption_response_errors,
    explode_disruptions,
    land_raw,
    push_outcomes,
    raw_outcomes,
    wrap_snapshot,
)
from kerbside.sources.published import ConcurrentLoad, PublishedTable
from kerbside.sources.readers import (
    path_exists,
    read_for_footers,
    read_lines,
    read_seed,
    stream_kafka,
    stream_lines,
)
from kerbside.sources.seen import SeenIds
from kerbside.sources.sinks import (
    append_by_day,
    merge_incremental,
    publish_table,
    publish_view,
    push_dead_letters,
    write_dead_letters,
    write_ndjson,
)

__all__ = [
    "ConcurrentLoad",
    "PublishedTable",
    "SeenIds",
    "append_by_day",
    "disruption_response_errors",
    "explode_disruptions",
    "land_raw",
    "merge_incremental",
    "path_exists",
    "publish_table",
    "publish_view",
    "push_dead_letters",
    "push_outcomes",
    "raw_outcomes",
    "read_for_footers",
    "read_lines",
    "read_seed",
    "stream_kafka",
    "stream_lines",
    "wrap_snapshot",
    "write_dead_letters",
    "write_ndjson",
]
