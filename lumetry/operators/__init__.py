from .lookup import lamp_cities, with_city
from .quality import drop_resent, drop_resent_at_once, out_of_band_rate, with_derived_current, with_out_of_band
from .revisions import latest_revision
from .summaries import (
    added_grains,
    cost_grains,
    cost_summary,
    grain_sums,
    grown,
    meter_summary,
    rollup_of_means,
    rollup_of_totals,
)

__all__ = [
    "added_grains",
    "cost_grains",
    "cost_summary",
    "drop_resent",
    "drop_resent_at_once",
    "grain_sums",
    "grown",
    "lamp_cities",
    "latest_revision",
    "meter_summary",
    "out_of_band_rate",
    "rollup_of_means",
    "rollup_of_totals",
    "with_city",
    "with_derived_current",
    "with_out_of_band",
]
