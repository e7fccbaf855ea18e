"""Regular time grid: generation, completion, gap listing and label filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.defaults import STEP_SECONDS
from wattlane.functions import (
    binary_code, day_name, seconds_since_midnight, slot_ceil, slot_floor, week_status,
)
from wattlane.operators.impute import impute_by_hierarchy
from wattlane.session import choose_method, settle


def time_grid(df: DataFrame, ts: str, step: int = STEP_SECONDS) -> DataFrame:
    """Every slot from floor(min) to ceil(max), both ends included.

    Days are generated first and spread over the cluster; each then yields its own
    slots, so no task or array holds the whole series.
    """
    bounds = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).select(
        slot_floor(F.col("a"), step).alias("a"), slot_ceil(F.col("b"), step).alias("b"))
    days = bounds.where(F.col("a").isNotNull()).select(
        "a", "b", F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("day")).repartition("day")
    start = F.col("day").cast("timestamp_ntz")
    last = start + F.make_dt_interval(secs=F.lit(86400 - step))
    slots = F.sequence(F.greatest("a", start), F.least("b", last), F.make_dt_interval(secs=F.lit(step)))
    return days.select(F.explode(slots).alias(ts))


def missing_slots(df: DataFrame, ts: str, step: int = STEP_SECONDS) -> DataFrame:
    """Grid slots with no reading exactly on them. Readings are reduced to distinct
    times before the shuffle, so a busy slot sends one row per task."""
    return time_grid(df, ts, step).join(df.select(ts).distinct(), ts, "left_anti")


def slot_counts(df: DataFrame, ts: str, step: int = STEP_SECONDS) -> DataFrame:
    """One row: expected, filled and missing slots."""
    seen = df.select(ts).where(F.col(ts).isNotNull()).groupBy(ts).agg(F.lit(1).alias("_seen"))
    return time_grid(df, ts, step).join(seen, ts, "left").agg(
        F.count("*").alias("n_expected"), F.count("_seen").alias("n_filled"),
        (F.count("*") - F.count("_seen")).alias("n_missing"))


def complete_grid(df: DataFrame, ts: str, step: int = STEP_SECONDS) -> DataFrame:
    """Left join of the table onto its grid: off-grid rows disappear, gaps become
    rows of nulls. ``df`` must have one row per timestamp. It is written first, because
    the ends of the grid and the join both read it."""
    df = settle(df, "series")
    joined = time_grid(df, ts, step).join(df, ts, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns])


def fill_label(df: DataFrame, ts: str, label: str) -> DataFrame:
    """Forward fill inside each day, then backward fill over the whole series.

    The backward fill crosses midnight. Row windows stay inside a day; only the
    table of days (one row per calendar day) is ordered as a whole. The table is written
    first, because the rows and the days are two passes over it.
    """
    df = settle(df, "unlabelled")
    day = F.col(ts).cast("date")
    per_day = Window.partitionBy("_day").orderBy(ts)
    rows = (
        df.withColumn("_day", day)
        .withColumn("_ff", F.last(label, ignorenulls=True).over(per_day.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_bf", F.first("_ff", ignorenulls=True).over(
            per_day.rowsBetween(0, Window.unboundedFollowing)))
    )
    days = df.groupBy(day.alias("_day")).agg(
        F.min_by(label, F.when(F.col(label).isNotNull(), F.col(ts))).alias("_fd"))
    later = Window.orderBy("_day").rowsBetween(1, Window.unboundedFollowing)
    carry = days.select("_day", F.first("_fd", ignorenulls=True).over(later).alias("_next"))
    filled = F.coalesce("_bf", "_next")
    return rows.join(carry, "_day", "left").select(
        *[filled.alias(c) if c == label else F.col(f"`{c}`") for c in df.columns])


def calendar_columns(df: DataFrame, ts: str, step: int = STEP_SECONDS) -> DataFrame:
    """Day name, weekday/weekend, its 0/1 code and seconds since midnight."""
    day = day_name(F.col(ts))
    return df.withColumns({
        "day_of_week": day,
        "week_status": week_status(day),
        "day_status_num": binary_code(week_status(day)),
        "nsm": seconds_since_midnight(F.col(ts), step),
    })


def full_grid(df: DataFrame, ts: str, label: str, measures: Sequence[str], step: int = STEP_SECONDS,
              method: str = "auto") -> DataFrame:
    """The table on its complete grid: calendar columns rebuilt, labels filled,
    measures imputed by (label, day), then day, then globally."""
    method = choose_method(df, method)
    filled = fill_label(calendar_columns(complete_grid(df, ts, step), ts, step), ts, label)
    filled = settle(filled, "grid")
    return impute_by_hierarchy(filled, measures, [[label, "day_of_week"], ["day_of_week"], []], method)
