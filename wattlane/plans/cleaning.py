"""Cleaning of raw readings, and the checks that follow it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane import defaults as D
from wattlane.functions import (
    binary_code, coerce_numeric, day_name, in_domain_or_null, in_range_or_null, mixed_label, nonnegative_or_null,
    normalise_category, ratio, seconds_since_midnight, to_timestamp_dayfirst, week_status,
)
from wattlane.operators.cap import cap_iqr
from wattlane.operators.dedupe import dedupe_by_time, duplicate_counts
from wattlane.operators.grid import full_grid, slot_counts
from wattlane.operators.impute import impute_by_hierarchy, impute_by_ratio, impute_mode_by_key
from wattlane.operators.names import column_or_null, keys_first, normalise_names
from wattlane.operators.profile import rule_violations
from wattlane.operators.quantiles import exact_quantiles
from wattlane.session import choose_method, settle, unnest
from wattlane.sources.tables import ORDINAL

MIXED = "mixed_type_col"
LEVELS = [["load_type", "day_of_week"], ["day_of_week"], []]


def convert_types(df: DataFrame, ts: str = D.TIMESTAMP, numeric: Sequence[str] = tuple(D.NUMERIC_COLUMNS)) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {c: coerce_numeric(F.col(c), types[c]) for c in numeric if c in types}
    if isinstance(types[ts], T.StringType):
        changes[ts] = to_timestamp_dayfirst(F.col(ts))
    elif not isinstance(types[ts], T.TimestampNTZType):
        changes[ts] = F.col(ts).cast("timestamp_ntz")
    return df.withColumns(changes)


def clean_categories(df: DataFrame, ts: str = D.TIMESTAMP) -> DataFrame:
    """Day, week status and load type on their domains; the raw texts are kept as ``*_raw``."""
    day = day_name(F.col(ts))
    load = normalise_category(column_or_null(df, "load_type"))
    raw = {f"{c}_raw": column_or_null(df, c) for c in ("day_of_week", "week_status", "load_type")}
    return df.withColumns(raw).withColumns({
        "day_of_week": in_domain_or_null(day, D.DAYS),
        "week_status": week_status(day),
        "load_type": in_domain_or_null(load, D.LOAD_TYPES),
    })


def apply_physical_rules(df: DataFrame, nonnegative: Sequence[str] = tuple(D.ENERGY_COLUMNS),
                         percent: Sequence[str] = tuple(D.POWER_FACTOR_COLUMNS)) -> DataFrame:
    """Energies are not negative and power factors lie in [0, 100]; what breaks a rule is null."""
    rules = {c: nonnegative_or_null(F.col(c)) for c in nonnegative if c in df.columns}
    rules |= {c: in_range_or_null(F.col(c), 0, 100) for c in percent if c in df.columns}
    return df.withColumns(rules)


def split_mixed(df: DataFrame, column: str = MIXED) -> DataFrame:
    if column not in df.columns:
        return df
    dtype = df.schema[column].dataType
    number = coerce_numeric(F.col(column), dtype)
    return df.withColumns({f"{column}_num": number, f"{column}_label": mixed_label(F.col(column), number)})


def typed_readings(raw: DataFrame, ts: str = D.TIMESTAMP) -> DataFrame:
    """Names, types and categories; no row is dropped yet."""
    return clean_categories(convert_types(normalise_names(raw), ts), ts)


@dataclass
class Cleaned:
    clean: DataFrame
    counts: DataFrame          # rows read, without date, duplicates, kept
    grid: DataFrame | None = None


def clean(raw: DataFrame, ts: str = D.TIMESTAMP, ordinal: Sequence[str] | None = None, strategy: str = "first",
          cap_k: float = 1.5, with_grid: bool = False, method: str = "auto") -> Cleaned:
    """The whole cleaning of raw readings.

    Statistics need the table as it stands after deduplication and range rules, so it
    is written once at that point. Each later statistic (ratio, medians, quartiles,
    modes) is then a column-pruned scan, not a repeat of the shuffle.
    """
    method = choose_method(raw, method)
    ordinal = list(ordinal or [ORDINAL])
    typed = typed_readings(raw, ts)
    unique = dedupe_by_time(typed, ts, ordinal, strategy)
    unique = unique.withColumn("nsm", seconds_since_midnight(F.col(ts)))
    ruled = settle(apply_physical_rules(unique), "ruled")

    filled = impute_by_ratio(ruled, "co2_tco2", "usage_kwh", method) if {
        "co2_tco2", "usage_kwh"} <= set(ruled.columns) else ruled
    filled = unnest(impute_by_hierarchy(filled, D.MEASURES, LEVELS, method), method, "filled")
    capped = split_mixed(cap_iqr(filled, D.ENERGY_COLUMNS, cap_k, method))
    labelled = impute_mode_by_key(capped, "load_type", "day_of_week", D.LOAD_TYPES, method)
    final = labelled.withColumn("day_status_num", binary_code(F.col("week_status")))
    final = settle(keys_first(final.drop(*ordinal)), "clean") if with_grid else keys_first(final.drop(*ordinal))

    grid = None
    if with_grid:
        grid = keys_first(full_grid(final, ts, "load_type", [c for c in D.MEASURES if c in final.columns],
                                    D.STEP_SECONDS, method))
    return Cleaned(final, cleaning_counts(typed, ts, strategy), grid)


def cleaning_counts(typed: DataFrame, ts: str, strategy: str = "first") -> DataFrame:
    """Rows read, rows without a timestamp, duplicates and rows kept."""
    counts = duplicate_counts(typed.select(ts), [ts])
    duplicates = F.col("n_surplus") if strategy == "first" else F.col("n_members")
    return counts.select(
        F.col("n_rows").alias("n_original"), F.col("n_no_key").alias("n_na_date"), duplicates.alias("n_duplicates"),
        (F.col("n_rows") - F.col("n_no_key") - F.col("n_surplus")).alias("n_final"))


def qa_report(df: DataFrame, ts: str, nonnegative: Sequence[str], percent: Sequence[str] = (), nsm: str | None = None,
              ratio_of: tuple[str, str] | None = None, step: int = D.STEP_SECONDS, method: str = "auto") -> DataFrame:
    """``(metric, value)``: cadence, nsm range, signs, percent range and ratio quantiles."""
    method = choose_method(df, method)
    slots = slot_counts(df.select(ts), ts, step).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
        for name in ("n_expected", "n_missing")])))
    rules = {f"{c}_negative": F.col(c) < 0 for c in nonnegative}
    rules |= {f"{c}_outside_percent": (F.col(c) < 0) | (F.col(c) > 100) for c in percent}
    if nsm:
        rules["nsm_outside_day"] = (F.col(nsm) < 0) | (F.col(nsm) >= 86400)
        rules["nsm_not_multiple"] = F.col(nsm) % step != 0
    out = slots
    if rules:
        out = out.unionByName(rule_violations(df, rules).select(
            F.col("rule").alias("metric"), F.col("n").cast("double").alias("value")))
    if ratio_of:
        pairs = df.select(ratio(F.col(ratio_of[0]), F.col(ratio_of[1])).alias("ratio"))
        q = exact_quantiles(pairs, ["ratio"], [0.1, 0.5, 0.9], (), method)
        out = out.unionByName(q.select(F.inline(F.array(*[
            F.struct(F.lit(f"ratio_q{p}").alias("metric"), F.col("q")[i].alias("value"))
            for i, p in enumerate((10, 50, 90))]))))
    return out
