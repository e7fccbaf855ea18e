from wattlane.functions.calendar import (
    day_name, hour_of_day, month_start, seconds_since_midnight, slot_ceil, slot_floor, to_timestamp_dayfirst,
    week_status,
)
from wattlane.functions.numbers import (
    clip, clean_nan, coerce_numeric, in_range_or_null, is_infinite, mixed_label, nonnegative_or_null, ratio,
    residual, z_score,
)
from wattlane.functions.text import (
    binary_code, category_rank, in_domain_or_null, nonzero_entries, normalise_category, sentinel_to_null,
)

__all__ = [
    "binary_code", "category_rank", "clean_nan", "clip", "coerce_numeric", "day_name", "hour_of_day",
    "in_domain_or_null", "in_range_or_null", "is_infinite", "mixed_label", "month_start", "nonnegative_or_null",
    "nonzero_entries", "normalise_category", "ratio", "residual", "seconds_since_midnight", "sentinel_to_null",
    "slot_ceil", "slot_floor", "to_timestamp_dayfirst", "week_status", "z_score",
]
