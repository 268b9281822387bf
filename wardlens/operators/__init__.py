"""Operators: derivations, role reports, joins and data-quality checks.

Every operator is a function from DataFrames to a DataFrame built from
built-in column functions, so Catalyst plans it and it runs unchanged from a
laptop to a cluster.
"""

from wardlens.operators.clinical import (chronic_complications, costliest_stays,
                                         risk_tier, risk_tiers)
from wardlens.operators.derive import (derive_model, readmission_days,
                                       with_catchment_area, with_length_of_stay,
                                       with_readmission_flag)
from wardlens.operators.experience import satisfaction_gap
from wardlens.operators.infection import (complaint_clusters, infection_exposure,
                                          vaccination_gaps)
from wardlens.operators.quality import (duplicate_keys, foreign_key_report, key_report,
                                        length_report, length_violations,
                                        not_null_report, null_violations, orphans)
from wardlens.operators.regional import average_los, cost_by_type, referral_rejection
from wardlens.operators.revenue import claim_lag, denial_rate
from wardlens.operators.supply import expiry_watch, inventory_value, low_stock

__all__ = [
    "average_los", "chronic_complications", "claim_lag",
    "complaint_clusters", "cost_by_type", "costliest_stays", "denial_rate", "derive_model",
    "duplicate_keys", "expiry_watch", "foreign_key_report", "infection_exposure",
    "inventory_value", "key_report", "length_report",
    "length_violations",
    "low_stock", "not_null_report", "null_violations", "orphans",
    "readmission_days", "referral_rejection", "risk_tier", "risk_tiers",
    "satisfaction_gap", "vaccination_gaps", "with_catchment_area",
    "with_length_of_stay", "with_readmission_flag",
]
