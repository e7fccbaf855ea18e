"""Imputation: by group hierarchy, by ratio, by the most frequent value of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.functions import category_rank, ratio
from wattlane.operators.quantiles import group_quantile, level_quantile
from wattlane.session import choose_method, stage


def impute_by_hierarchy(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]],
                        method: str = "auto") -> DataFrame:
    """Fill nulls with the median of the first level that has one.

    One sketch scan and one count scan serve all columns and levels. Group medians are joined back, so
    the table itself is never shuffled for a small set of groups, and a null key
    matches no group. The empty level is the global median.
    """
    columns = [c for c in columns if c in df.columns]
    method = choose_method(df, method)
    fills = {c: [F.col(c)] for c in columns}
    out = df
    if method == "direct" or not columns:
        tables = [group_quantile(df, columns, 0.5, level, method) for level in levels]
    else:
        tables = level_quantile(df, columns, levels)
    for depth, (level, medians) in enumerate(zip(levels, tables)):
        if not level:
            packed = medians.select(F.struct(*columns).alias("m")).scalar()
            for c in columns:
                fills[c].append(packed.getField(c))
            continue
        renamed = medians.select(*level, *[F.col(c).alias(f"_m{depth}_{c}") for c in columns])
        out = out.join(renamed, list(level), "left")
        for c in columns:
            fills[c].append(F.col(f"_m{depth}_{c}"))
    filled = {c: F.coalesce(*fills[c]) for c in columns}
    return out.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])


def median_ratio(df: DataFrame, numerator: str, denominator: str, method: str = "auto") -> DataFrame:
    """One row: exact median of numerator / denominator over rows where both are positive."""
    pairs = df.select(ratio(F.col(numerator), F.col(denominator)).alias("ratio"))
    return group_quantile(pairs, ["ratio"], 0.5, [], choose_method(df, method))


def impute_by_ratio(df: DataFrame, column: str, base: str, method: str = "auto") -> DataFrame:
    """Fill a null measure with base * median(column / base). With no valid pair
    the factor is null and nothing changes."""
    factor = median_ratio(df, column, base, method).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), F.col(base) * factor))


def mode_by_key(df: DataFrame, column: str, key: str, domain: Sequence[str] | None = None) -> DataFrame:
    """Most frequent value per key. Ties go to the earlier value in ``domain``, or
    to the smaller value without one. Counting per (key, value) first leaves at
    most one row per pair, so a hot key costs nothing."""
    counts = (
        df.where(F.col(column).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, column).agg(F.count("*").alias("_n"))
    )
    rank = category_rank(F.col(column), domain) if domain else F.col(column)
    return counts.groupBy(key).agg(F.min_by(column, F.struct(-F.col("_n"), rank)).alias("mode"))


def impute_mode_by_key(df: DataFrame, column: str, key: str, domain: Sequence[str] | None = None,
                       method: str = "auto") -> DataFrame:
    modes = stage(mode_by_key(df, column, key, domain), choose_method(df, method), "modes")
    joined = df.join(modes, key, "left")
    fill = F.coalesce(F.col(column), F.col("mode"))
    return joined.select(*[fill.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])
