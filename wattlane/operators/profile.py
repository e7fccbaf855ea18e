"""Data-quality profile, column statistics and rule violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile_columns(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Type, rows, missing, percent missing and distinct values per column.

    Exact distinct counts come from one long aggregate (column, value) per data type, whose values are
    folded on the map side, so rows are not copied whole for every column and each pass reads
    the columns of its type only.
    """
    names, fields = df.columns, df.schema.fields
    if exact_distinct:
        kinds: dict[str, list[int]] = {}
        for i, f in enumerate(fields):
            kinds.setdefault(f.dataType.simpleString(), []).append(i)
        counts = None
        for members in kinds.values():
            rows = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{names[i]}`").alias("v")) for i in members])))
            part = rows.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("m")).groupBy("i").agg(
                F.sum("m").alias("present"), F.count(F.lit(1)).alias("n_unique"))
            counts = part if counts is None else counts.unionByName(part)
    else:
        wide = df.agg(*[F.struct(F.lit(i).alias("i"), F.count(F.col(f"`{c}`")).alias("present"),
                                 F.approx_count_distinct(F.col(f"`{c}`")).alias("n_unique")).alias(f"_p{i}") for i, c in enumerate(names)])
        counts = wide.select(F.inline(F.array(*[f"_p{i}" for i in range(len(names))])))
    columns = df.sparkSession.createDataFrame(pa.table({
        "i": pa.array(range(len(names)), pa.int32()), "column": names, "dtype": [f.dataType.simpleString() for f in fields]}))
    missing = F.col("n") - F.coalesce("present", F.lit(0))
    rows = columns.join(counts, "i", "left").withColumn("n", df.agg(F.count(F.lit(1))).scalar())
    return rows.select(
        "column", "dtype", "n", missing.alias("missing"), F.bround(F.try_divide(missing * 100.0, "n"), 3).alias("pct_missing"),
        F.coalesce("n_unique", F.lit(0)).alias("n_unique")).orderBy(F.desc("pct_missing"), "column")


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, min, max, mean, sample deviation and variance per column, in one aggregate.
    A constant column has exactly zero spread, whatever the order of summation."""
    def spread(v: Column, of: Column) -> Column:
        return F.when((F.min(v) == F.max(v)) & (F.count(v) > 1), 0.0).otherwise(of)

    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("metric"), F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.avg(v).alias("mean"), spread(v, F.stddev_samp(v)).alias("sd"),
            spread(v, F.var_samp(v)).alias("variance")).alias(f"_s{i}"))
    return df.agg(*aggs).select(F.inline(F.array(*[f"_s{i}" for i in range(len(columns))])))


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, n)``: rows for which each predicate holds, in one pass."""
    names = list(rules)
    wide = df.agg(*[F.count_if(rules[name]).alias(f"_v{i}") for i, name in enumerate(names)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_v{i}").alias("n")) for i, name in enumerate(names)])))
