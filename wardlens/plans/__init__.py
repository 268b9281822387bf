"""Plans: multi-step jobs (quality indicators, publishing) and the registered
query catalog."""

from wardlens.plans.indicators import (bed_utilization_rate, compute_indicators,
                                       first_encounter_complication_rate,
                                       indicator_report, provider_workload_index,
                                       readmission_rate, validate_period)
from wardlens.plans.publish import (publish_indicators, publish_periods, read_indicators,
                                    sweep_published)

__all__ = [
    "bed_utilization_rate", "compute_indicators", "first_encounter_complication_rate",
    "indicator_report", "provider_workload_index", "publish_indicators", "publish_periods",
    "read_indicators", "readmission_rate", "sweep_published", "validate_period",
]
