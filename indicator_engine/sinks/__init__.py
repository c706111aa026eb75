from indicator_engine.sinks.tables import (
    AUDIT_SCHEMA,
    REJECTED,
    LoadAudit,
    Table,
    append,
    audit_frame,
    ensure_schema,
    export_csv,
    land_raw,
    overwrite,
    publish,
    publish_partitions,
    record,
)

__all__ = [
    "AUDIT_SCHEMA",
    "REJECTED",
    "LoadAudit",
    "Table",
    "append",
    "audit_frame",
    "ensure_schema",
    "export_csv",
    "land_raw",
    "overwrite",
    "publish",
    "publish_partitions",
    "record",
]
