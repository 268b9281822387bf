"""Column-level building blocks (built-in Spark functions only)."""

from wardlens.functions.columns import (contains_any, date_id_order, in_period,
                                        label_by_lists,
                                        matches_lower, severity, value_order,
                                        yes_no)
from wardlens.functions.exact import (avg_diff_half_up, amount, avg_half_up,
                                      avg_money, epoch_day, half_up_div, money,
                                      pct_half_up)

__all__ = [
    "amount", "avg_diff_half_up", "avg_half_up", "avg_money", "contains_any", "date_id_order",
    "epoch_day", "half_up_div", "in_period", "label_by_lists", "matches_lower",
    "money", "pct_half_up", "severity", "value_order", "yes_no",
]
