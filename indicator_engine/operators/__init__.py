from indicator_engine.operators.documented import (
    apply_updates,
    attach_region_target,
    health,
    indicator_from_scores,
    priority_list,
)
from indicator_engine.operators.facts import (
    coverage_profile,
    entity_year_fact,
    region_year_fact,
    sample_indicator,
    yearly_means,
)
from indicator_engine.operators.integrate import integrate
from indicator_engine.operators.lookup import lookup, missing_from
from indicator_engine.operators.products import evolution, latest_indicator, region_summary, target_vs_result
from indicator_engine.operators.sampling import ordered_sample, preview
from indicator_engine.operators.targets import keyed_targets, latest_by_key, national_targets, unpivot_targets

__all__ = [
    "apply_updates",
    "attach_region_target",
    "coverage_profile",
    "entity_year_fact",
    "evolution",
    "health",
    "indicator_from_scores",
    "integrate",
    "keyed_targets",
    "latest_by_key",
    "latest_indicator",
    "lookup",
    "missing_from",
    "national_targets",
    "ordered_sample",
    "preview",
    "priority_list",
    "region_summary",
    "region_year_fact",
    "sample_indicator",
    "target_vs_result",
    "unpivot_targets",
    "yearly_means",
]
