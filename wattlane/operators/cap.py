"""Outlier capping at quartile fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.functions import clip
from wattlane.operators.quantiles import exact_quantiles
from wattlane.session import choose_method, stage


def iqr_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5, by: Sequence[str] = (),
               method: str = "auto") -> DataFrame:
    """``(*by, metric, n, q1, q3, low, high)`` per column (and group)."""
    q = exact_quantiles(df, columns, [0.25, 0.75], by, method)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(*by, "metric", "n", q1.alias("q1"), q3.alias("q3"),
                    (q1 - F.lit(k) * (q3 - q1)).alias("low"), (q3 + F.lit(k) * (q3 - q1)).alias("high"))


def cap_iqr(df: DataFrame, columns: Sequence[str], k: float = 1.5, method: str = "auto") -> DataFrame:
    """Clip every column at its own fences; one aggregate serves all columns and
    its one-row result enters the projection as a scalar subquery."""
    columns = [c for c in columns if c in df.columns]
    method = choose_method(df, method)
    fences = stage(iqr_fences(df, columns, k, (), method), method, "fences")
    packed = fences.agg(F.map_from_entries(F.collect_list(
        F.struct("metric", F.struct("low", "high")))).alias("f")).scalar()
    return df.select(*[
        clip(F.col(c), packed[c]["low"], packed[c]["high"]).alias(c) if c in columns else F.col(f"`{c}`")
        for c in df.columns])


def clip_at(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Clip at stored bounds; used where the statistics are fixed, as on a stream."""
    return df.withColumns({c: clip(F.col(c), F.lit(low), F.lit(high)) for c, (low, high) in bounds.items()})
