"""The exploratory report: every table behind its figures, and the summary lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane import defaults as D
from wattlane.functions import hour_of_day
from wattlane.operators.impute import median_ratio
from wattlane.operators.profile import numeric_columns, profile_columns
from wattlane.operators.ranks import spearman_matrix, strongest_partners
from wattlane.operators.summaries import (
    box_numbers, daily_sum, group_mean, histogram, monthly_median_ratio, top_rows,
)
from wattlane.session import choose_method, stage


def summary_lines(df: DataFrame, ts: str, value: str, other: str, category: str, matrix: DataFrame,
                  method: str = "auto") -> DataFrame:
    """The executive summary as ``(section, item, value)``; values are doubles or null for text items."""
    def lines(rows: DataFrame, section: str, item, value) -> DataFrame:
        return rows.select(F.lit(section).alias("section"), item.cast("string").alias("item"),
                           value.cast("double").alias("value"))

    span = df.agg(F.count("*").alias("n"), F.min(ts).alias("a"), F.max(ts).alias("b"))
    by_hour = group_mean(df, hour_of_day(F.col(ts)), "hour", value)
    by_day = group_mean(df, F.col("day_of_week"), "day_of_week", value)
    by_category = group_mean(df, F.col(category), category, value)
    parts = [
        lines(span, "rows", F.lit("n"), F.col("n")),
        lines(span, "first", F.col("a"), F.lit(None)),
        lines(span, "last", F.col("b"), F.lit(None)),
        lines(strongest_partners(matrix, value, 6), "correlation", F.col("column"), F.col("rho")),
        lines(top_rows(by_hour, "mean", ["hour"], 5), "peak_hour", F.col("hour"), F.round("mean", 2)),
        lines(by_day, "day_of_week", F.col("day_of_week"), F.round("mean", 2)),
        lines(by_category, category, F.col(category), F.round("mean", 2)),
        lines(median_ratio(df, other, value, method), "median_ratio", F.lit(f"{other}/{value}"), F.col("ratio")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def eda_tables(df: DataFrame, ts: str = D.TIMESTAMP, value: str = D.TARGET, other: str = "co2_tco2",
               category: str = "load_type", measures: Sequence[str] = tuple(D.MEASURES), bins: int = 60,
               method: str = "auto") -> dict[str, DataFrame]:
    """Named result tables; write them with ``write_results``."""
    method = choose_method(df, method)
    matrix = stage(spearman_matrix(df, numeric_columns(df)), method, "spearman")
    return {
        "data_quality": profile_columns(df),
        "daily": daily_sum(df, ts, value),
        "mean_by_hour": group_mean(df, hour_of_day(F.col(ts)), "hour", value),
        "mean_by_day_of_week": group_mean(df, F.col("day_of_week"), "day_of_week", value),
        "mean_by_category": group_mean(df, F.col(category), category, value),
        "spearman": matrix,
        "ratio_by_month": monthly_median_ratio(df, ts, other, value, method),
        "distributions": histogram(df, measures, bins),
        "box_by_category": box_numbers(df, value, category, 1.5, method),
        "summary": summary_lines(df, ts, value, other, category, matrix, method),
    }
