from tillroll.functions.dates import (is_weekend, month_start, week_id, week_monday_based, week_start,
                                     weekday_sunday1)
from tillroll.functions.money import exact_sum, line_total, mean_of, money, opposite_signs, ratio
from tillroll.functions.predicates import (all_not_null, any_of, contains_ci, is_blank, untrimmed)

__all__ = [
    "is_weekend", "month_start", "week_id", "week_monday_based", "week_start", "weekday_sunday1",
    "exact_sum", "line_total", "mean_of", "money", "opposite_signs", "ratio",
    "all_not_null", "any_of", "contains_ci", "is_blank", "untrimmed",
]
