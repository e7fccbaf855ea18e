"""Duplicate handling by timestamp (or any key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def dedupe_by_time(df: DataFrame, ts: str, ordinal: Sequence[str], strategy: str = "first") -> DataFrame:
    """One row per timestamp; rows without one are dropped.

    ``first`` keeps the row with the smallest ordinal. ``aggregate`` takes the
    mean of the numeric columns and the first non-null value of the others.
    """
    if strategy == "first":
        return keep_first(df.where(F.col(ts).isNotNull()), [ts], ordinal)
    if strategy == "aggregate":
        return merge_duplicates(df.where(F.col(ts).isNotNull()), [ts], ordinal)
    raise ValueError(f"unknown strategy {strategy!r}")


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """``row_number() = 1`` per key. Spark limits each group before the shuffle
    (WindowGroupLimit), so a key with very many copies sends one row per task."""
    order = Window.partitionBy(*keys).orderBy(*ordinal)
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def merge_duplicates(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Partial aggregates on both sides of the shuffle; no group is collected."""
    rank = F.struct(*ordinal)
    aggs = []
    for field in df.schema.fields:
        if field.name in keys or field.name in ordinal:
            continue
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            aggs.append(F.avg(c).alias(field.name))
        else:
            aggs.append(F.min_by(c, F.when(c.isNotNull(), rank)).alias(field.name))
    return df.groupBy(*keys).agg(*aggs)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows with no key, surplus copies, and all members of duplicated keys."""
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    groups = df.withColumn("_keyed", keyed).groupBy(*keys, "_keyed").agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~F.col("_keyed"), F.col("n"))), F.lit(0)).alias("n_no_key"),
        F.coalesce(F.sum(F.when(F.col("_keyed"), F.col("n") - 1)), F.lit(0)).alias("n_surplus"),
        F.coalesce(F.sum(F.when(F.col("_keyed") & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("n_members"),
    )


def duplicate_row_share(df: DataFrame) -> DataFrame:
    """Full-row duplicates beyond the first copy, and their percentage."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        (F.sum(F.col("_n") - 1) * 100.0 / F.sum("_n")).alias("pct_duplicates"),
    )
