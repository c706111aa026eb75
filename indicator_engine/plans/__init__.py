from indicator_engine.plans.layers import (
    Lakehouse,
    extract_all,
    land_all,
    load_gold,
    load_health,
    load_silver,
    lost_by_load,
    record_loads,
    run_quality,
)

__all__ = [
    "Lakehouse",
    "extract_all",
    "land_all",
    "load_gold",
    "load_health",
    "load_silver",
    "lost_by_load",
    "record_loads",
    "run_quality",
]
