from kerbside.streaming.changes import (
    read_changes,
    run_station_changes,
    silent_stations,
    state_of_changes,
    station_changes,
)
from kerbside.streaming.curation import run_curation
from kerbside.streaming.guarded import StrictCasts, isolate, run_guarded, write_guarded
from kerbside.streaming.live import (
    deduplicate_stream,
    enrich_stream,
    read_live_state,
    run_append,
    run_deduplicated,
    run_enrichment_as_of,
    run_live_state,
)
from kerbside.streaming.staging import run_disruption_staging
from kerbside.streaming.windows import (
    closed_windows,
    late_readings,
    run_closing_windows,
    settled_totals,
    windowed_totals,
)

__all__ = [
    "StrictCasts",
    "closed_windows",
    "deduplicate_stream",
    "enrich_stream",
    "isolate",
    "late_readings",
    "read_changes",
    "read_live_state",
    "run_append",
    "run_closing_windows",
    "run_curation",
    "run_deduplicated",
    "run_disruption_staging",
    "run_enrichment_as_of",
    "run_guarded",
    "run_live_state",
    "run_station_changes",
    "settled_totals",
    "silent_stations",
    "state_of_changes",
    "station_changes",
    "windowed_totals",
    "write_guarded",
]
