"""Sparse vectors of any width, and ridge regression on them, without a list of the width on the driver.

Levels and coefficients are tables by number. Ridge regression solves its normal equations by conjugate
gradients: the products of features that occur together are added up once, and each step joins the direction
to them. The driver sees a few numbers a step.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.session import settle

ROW = "_row"
STEPS = 500         # conjugate gradients end by then
PRECISE = 1e-10     # or when the residual has shrunk by this factor


@F.arrow_udf(VectorUDT())
def _as_vector(parts: pa.Array) -> pa.Array:
    """A vector is stored as such a struct."""
    return parts


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """Indices must ascend. Without names of the entries, which a wide vector has too many of."""
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).cast("int").alias("size"),
                     indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    return _as_vector(parts)


def number_levels(values: DataFrame) -> DataFrame:
    """``(column, value, place)`` from distinct ``(column, value)``: the place of each value in its column, from 0 in
    alphabetical order. Dealt by ranges, numbered inside each, and moved on by what lies before."""
    ordered = values.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    ordered = settle(ordered.withColumn("_id", F.monotonically_increasing_id()), "levels")
    part = F.shiftright("_id", 33).alias("part")
    cells = ordered.groupBy("column", part).agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(cells.select("column", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("_by")), "offsets")
    return ordered.withColumn("part", part).join(offsets, ["column", "part"]).select(
        "column", "value", (F.col("_id") + F.col("_by")).alias("place"))


def entries(features: str) -> Column:
    """Of a vector column the ``(j, x)`` that are not 0, as an array."""
    v = F.unwrap_udt(F.col(features))
    index = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.arrays_zip(index.alias("j"), v["values"].alias("x"))
    return F.filter(pairs, lambda e: e["x"] != 0)


def entry_rows(df: DataFrame, features: str, label: str) -> DataFrame:
    """``(y, e)``, the label and the entries of each row, written once as several passes read them."""
    return settle(df.select(F.col(label).alias("y"), entries(features).alias("e")), "entries")


def products(rows: DataFrame) -> float:
    """How many products of entries a row has in the mean, to tell sparse vectors from dense ones."""
    n = F.size("e").cast("double")
    return rows.agg(F.avg(n * n)).first()[0] or 0.0


def solve_ridge(rows: DataFrame, alpha: float, fit_intercept: bool) -> tuple[DataFrame, float]:
    """``(j, w)`` and the intercept, from ``entry_rows``. A feature that is 0 in every row has no row: its coefficient is 0."""
    s = rows.agg(F.count("*").alias("n"), F.count("y").alias("known"), F.avg("y").alias("mean")).first()
    if s["known"] < s["n"]:
        raise ValueError("labels must not be null")
    n, mean = max(s["n"], 1), (s["mean"] or 0.0) if fit_intercept else 0.0

    long = rows.select("y", "e", F.inline("e"))
    gram = settle(long.select(F.col("j"), "x", F.explode("e").alias("o")).groupBy("j", F.col("o.j").alias("k")).agg(
        F.sum(F.col("x") * F.col("o.x")).alias("g")), "gram")
    scale = gram.where("j = k").select("j", (F.col("g") + F.lit(alpha)).alias("d"))
    sums = long.groupBy("j").agg((F.sum("x") if fit_intercept else F.lit(0.0)).alias("sx"),
                                 F.sum(F.col("x") * (F.col("y") - F.lit(mean))).alias("b"))
    state = sums.join(scale, "j").withColumns({"m": F.col("sx") / n, "w": F.lit(0.0), "r": F.col("b")}).where("d > 0")
    state = settle(state.withColumn("p", F.col("r") / F.col("d")).select("j", "d", "m", "w", "r", "p"), "ridge")
    dot = state.agg(F.sum(F.col("r") * F.col("p")).alias("rz"), F.sum(F.col("m") * F.col("p")).alias("mp")).first()
    rz, first = dot["rz"] or 0.0, dot["rz"] or 0.0
    for _ in range(STEPS):
        if rz <= PRECISE ** 2 * first or rz == 0:
            break
        drawn = gram.join(state.select(F.col("j").alias("k"), "p"), "k").groupBy("j").agg(F.sum(F.col("g") * F.col("p")).alias("gp"))
        pulled = F.col("gp") + F.lit(alpha) * F.col("p") - F.lit(n * (dot["mp"] or 0.0)) * F.col("m")
        step = settle(state.join(drawn, "j").select("j", "d", "m", "w", "r", "p", pulled.alias("ap")), "step")
        length = rz / step.agg(F.sum(F.col("p") * F.col("ap"))).first()[0]
        moved = step.withColumns({"w": F.col("w") + F.lit(length) * F.col("p"), "r": F.col("r") - F.lit(length) * F.col("ap")})
        rest = moved.agg(F.sum(F.col("r") * F.col("r") / F.col("d"))).first()[0]
        turned = F.col("r") / F.col("d") + F.lit(rest / rz) * F.col("p")
        state, rz = moved.withColumn("p", turned).drop("ap"), rest
        dot = state.agg(F.sum(F.col("m") * F.col("p")).alias("mp")).first()
    else:
        warnings.warn(f"ridge regression ended after {STEPS} steps at a residual of {(rz / first) ** 0.5:.1e}", stacklevel=2)
    intercept = mean - (state.agg(F.sum(F.col("m") * F.col("w"))).first()[0] or 0.0)
    return settle(state.select("j", "w"), "coefficients"), intercept


def predict_linear(df: DataFrame, features: str, coefficients: DataFrame, intercept: float, out: str = "prediction") -> DataFrame:
    """Adds the products of each row's entries with their coefficients, added up, and the intercept."""
    many = df.select(F.size(entries(features)).alias("n")).agg(F.max("n")).first()[0] or 0
    if many <= 1:  # then nothing is to be added up
        one = F.get(entries(features), F.lit(0))
        rows = df.withColumns({"_j": one["j"], "_x": one["x"]})
        found = rows.join(coefficients.select(F.col("j").alias("_j"), F.col("w").alias("_w")), "_j", "left")
        return found.withColumn(out, F.lit(intercept) + F.coalesce(F.col("_x") * F.col("_w"), F.lit(0.0))).drop("_j", "_x", "_w")
    rows = settle(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    sums = rows.select(ROW, F.inline(entries(features))).join(coefficients, "j").groupBy(ROW).agg(F.sum(F.col("x") * F.col("w")).alias("_s"))
    return rows.join(sums, ROW, "left").withColumn(out, F.lit(intercept) + F.coalesce("_s", F.lit(0.0))).drop(ROW, "_s")


def fill_places(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds for each text column ``_place_<i>``, null where its value is no level."""
    for i, c in enumerate(columns):
        mine = levels.where(F.col("column") == i).select(F.col("value").alias("_v"), F.col("place").alias(f"_place_{i}"))
        df = df.join(mine, F.col(f"`{c}`") == F.col("_v"), "left").drop("_v")
    return df
