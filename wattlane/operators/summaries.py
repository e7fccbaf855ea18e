"""Calendar and group aggregates, extremes, value counts, histograms, box-plot numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions import month_start, ratio
from wattlane.operators.cap import iqr_fences
from wattlane.operators.quantiles import group_quantile
from wattlane.session import choose_method, stage


def daily_sum(df: DataFrame, ts: str, value: str, name: str = "total") -> DataFrame:
    """Sum per calendar day; a day without rows counts 0."""
    sums = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.sum(value).alias("_s"))
    bounds = df.agg(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b")).where("a is not null")
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.join(sums, "day", "left").select("day", F.coalesce("_s", F.lit(0.0)).alias(name))


def group_mean(df: DataFrame, key: Column, key_name: str, value: str, name: str = "mean") -> DataFrame:
    """Mean per observed group; rows with a null key are left out."""
    return df.select(key.alias(key_name), value).where(F.col(key_name).isNotNull()).groupBy(key_name).agg(
        F.avg(value).alias(name))


def monthly_median_ratio(df: DataFrame, ts: str, numerator: str, denominator: str,
                         method: str = "auto") -> DataFrame:
    pairs = df.select(month_start(F.col(ts)).alias("month"),
                      ratio(F.col(numerator), F.col(denominator)).alias("ratio")).where(F.col("ratio").isNotNull())
    return group_quantile(pairs, ["ratio"], 0.5, ["month"], choose_method(df, method)).withColumnRenamed(
        "ratio", "median_ratio")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def top_rows(df: DataFrame, score: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k rows with the highest score; equal scores follow ``ties`` ascending."""
    return df.orderBy(F.desc(score), *ties).limit(k)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 60) -> DataFrame:
    """Equal-width counts per column: ``(metric, bin, low, high, n)``, empty bins included.

    The maximum belongs to the last bin. A constant column gets a unit-wide range.
    """
    columns = list(columns)
    limits = df.agg(*[F.struct(F.min(c).cast("double").alias("a"), F.max(c).cast("double").alias("b")).alias(f"_l{i}")
                      for i, c in enumerate(columns)])
    limits = limits.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"_l{i}.a").alias("a"), F.col(f"_l{i}.b").alias("b"))
        for i, c in enumerate(columns)]))).where("a is not null")
    flat = F.col("a") == F.col("b")
    limits = limits.select("metric", F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"),
                           F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"))
    packed = limits.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("a", "b"))))).scalar()
    index = [F.when(F.col(c).isNotNull(), F.least(F.width_bucket(
        F.col(c).cast("double"), packed[c]["a"], packed[c]["b"], F.lit(bins)), F.lit(bins))).cast("long")
        for c in columns]
    counts = (
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), i.alias("bin"))
                                     for c, i in zip(columns, index)])))
        .where(F.col("bin").isNotNull()).groupBy("metric", "bin").agg(F.count("*").alias("n"))
    )
    width = (F.col("b") - F.col("a")) / bins
    frame = limits.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"))
    return frame.join(counts, ["metric", "bin"], "left").select(
        "metric", "bin", (F.col("a") + width * (F.col("bin") - 1)).alias("low"),
        (F.col("a") + width * F.col("bin")).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def box_numbers(df: DataFrame, value: str, by: str, k: float = 1.5, method: str = "auto") -> DataFrame:
    """Quartiles and whiskers per group; a whisker is the extreme value within k IQR."""
    method = choose_method(df, method)
    source = df.select(by, value).dropna()
    fences = iqr_fences(source, [value], k, [by], method)
    medians = group_quantile(source, [value], 0.5, [by], method).withColumnRenamed(value, "median")
    stats = stage(fences.join(medians, by), method, "box")
    rows = source.join(stats.select(by, "low", "high"), by)
    whiskers = rows.groupBy(by).agg(
        F.min(F.when(F.col(value) >= F.col("low"), F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col(value) <= F.col("high"), F.col(value))).alias("whisker_high"))
    return stats.join(whiskers, by).select(by, "n", "q1", "median", "q3", "whisker_low", "whisker_high")
