from indicator_engine.streaming.events import (
    EVENT_SCHEMA,
    absorb,
    absorb_batch,
    drain,
    ingest,
    land,
    merge_events,
    read_event_table,
    read_events,
    rejects,
    stamp,
    summary_by_year,
)

__all__ = [
    "EVENT_SCHEMA",
    "absorb",
    "absorb_batch",
    "drain",
    "ingest",
    "land",
    "merge_events",
    "read_event_table",
    "read_events",
    "rejects",
    "stamp",
    "summary_by_year",
]
