"""Default column names and domains of the energy data. Every operator takes
names as arguments; these are only their defaults."""

from __future__ import annotations

# Column names of the energy readings.
TIMESTAMP = "date"
TARGET = "usage_kwh"
ENERGY_COLUMNS = [
    "usage_kwh",
    "lagging_current_reactive_power_kvarh",
    "leading_current_reactive_power_kvarh",
    "co2_tco2",
]
POWER_FACTOR_COLUMNS = ["lagging_current_power_factor", "leading_current_power_factor"]
MEASURES = ENERGY_COLUMNS + POWER_FACTOR_COLUMNS
NUMERIC_COLUMNS = MEASURES + ["nsm"]
KEY_COLUMNS = ["date", "week_status", "day_status_num", "day_of_week", "load_type"]

# Headers that normalise badly, and the intended names.
HEADER_FIXES = {
    "usage_k_wh": "usage_kwh",
    "co2_t_co2": "co2_tco2",
    "lagging_current_reactive_power_k_varh": "lagging_current_reactive_power_kvarh",
    "leading_current_reactive_power_k_varh": "leading_current_reactive_power_kvarh",
}

# Category domains, in rank order.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEK_STATUS = ["Weekday", "Weekend"]
LOAD_TYPES = ["Light_Load", "Medium_Load", "Maximum_Load"]

# Text fragment found in a load type -> its category, tested in this order.
LOAD_TYPE_RULES = [("LIGHT", "Light_Load"), ("MEDIUM", "Medium_Load"), ("MAX", "Maximum_Load")]

# Text read as missing by the CSV source (own list plus the usual pandas tokens).
NULL_TOKENS = [
    "", " ", "nan", "NaN", "NAN", "null", "NULL", "N/A", "NA",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "None", "n/a",
]

# Text read as missing by the feature builder; exact, case-sensitive.
SENTINELS = [
    "bad", "unknown", "n/a", "na", "none", "null", "missing", "?", "--",
    "invalid", "error", "NAN", "nan",
]

# Name fragments that mark a time-like feature.
TIME_KEYWORDS = ["date", "fecha", "time", "timestamp", "hour", "minute", "second"]

# Configured features of the scoring input.
NUMERIC_FEATURES = [
    "lagging_current_reactive_power_kvarh",
    "leading_current_reactive_power_kvarh",
    "co2_tco2",
    "lagging_current_power_factor",
    "leading_current_power_factor",
    "nsm",
    "mixed_type_col",
]
CATEGORICAL_FEATURES = ["week_status", "day_of_week", "load_type"]

STEP_SECONDS = 900
