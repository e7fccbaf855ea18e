"""Exact quantiles (linear interpolation), global or by group.

``percentile`` keeps every distinct value of a group in one task, which is fine
for a small table and not for a large one. Large inputs go through two bounded
passes instead:

1. a mergeable sketch per group brackets each wanted rank between two values; it is
   merged in two steps, so no task meets the sketches of all input partitions;
2. one more scan counts what lies below each bracket and keeps the distinct
   values inside, which is about two margins of the rows.

Brackets are cut into cells, so the last sort touches only the one or two cells
that hold a wanted rank, however large the group is. The ranks are then read off
exactly. A bracket that misses its rank is detected and widened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.session import choose_method, gather, settle

#: Size of the sketches (their rank error is about 0.0013) and half width of a bracket in rank.
SKETCH_SIZE = 4_096
MARGIN = 0.004
#: Groups are sketched in so many parts by input partition before the parts are merged.
PARTS = 64
CELLS = 4096
#: Column of the levels of grouping a row belongs to.
PLACES = "_places"


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    by: Sequence[str] = (), method: str = "auto") -> DataFrame:
    """One row per group and column: ``(*by, metric, n, q)``; ``q`` aligns with
    ``probabilities``. Rows with a null key belong to no group."""
    columns, by, probabilities = list(columns), list(by), [float(p) for p in probabilities]
    source = df.select(*by, *columns)
    if by:
        source = source.dropna(subset=by)
    if choose_method(df, method) == "direct":
        return _direct(source, columns, probabilities, by)
    return _bracketed(source, columns, probabilities, by)


def group_quantile(df: DataFrame, columns: Sequence[str], probability: float = 0.5, by: Sequence[str] = (),
                   method: str = "auto") -> DataFrame:
    """One row per group, one column per measure, holding one exact quantile."""
    columns, by = list(columns), list(by)
    method = choose_method(df, method)
    if method == "direct":
        source = df.dropna(subset=by) if by else df
        aggs = [F.percentile(F.col(c).cast("double"), F.lit(probability)).alias(c) for c in columns]
        return source.groupBy(*by).agg(*aggs)
    long = exact_quantiles(df, columns, [probability], by, method)
    aggs = [F.max(F.when(F.col("metric") == c, F.col("q")[0])).alias(c) for c in columns]
    return _kept(long.groupBy(*by).agg(*aggs), not by, "quantile")[0]


def level_quantile(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]],
                   probability: float = 0.5) -> list[DataFrame]:
    """``group_quantile`` of every level (a list of keys, perhaps empty) from one sketch scan and
    one count scan: sketches are made for the finest keys and merged upwards."""
    columns, levels = list(columns), [list(level) for level in levels]
    source = df.select(_places(df, levels).alias(PLACES), *columns)
    long = _bracketed(source, columns, [float(probability)], ["_level", "_key"])
    aggs = [F.max(F.when(F.col("metric") == c, F.col("q")[0])).alias(c) for c in columns]
    wide, _ = _kept(long.groupBy("_level", "_key").agg(*aggs), False, "quantile")
    return [wide.where(F.col("_level") == i).select(*[F.col("_key")[k].alias(k) for k in level], *columns)
            for i, level in enumerate(levels)]


def _places(df: DataFrame, levels: list[list[str]]) -> Column:
    """The levels whose keys a row has, each with its key (null in the columns of other levels)."""
    keys = list(dict.fromkeys(k for level in levels for k in level))

    def place(i, level):
        key = F.struct(F.lit(i).alias("_i"), *[(F.col(k) if k in level else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys])
        known = reduce(lambda a, k: a & F.col(k).isNotNull(), level, F.lit(True))
        return F.when(known, F.struct(F.lit(i).alias("_level"), key.alias("_key")))

    return F.array_compact(F.array(*[place(i, level) for i, level in enumerate(levels)]))


def _at_places(rows: DataFrame) -> DataFrame:
    """Each row once per place, under ``_level`` and ``_key``; rows without places as they are."""
    if PLACES not in rows.columns:
        return rows
    return rows.select(*[c for c in rows.columns if c != PLACES], F.inline(PLACES))


def _kept(table: DataFrame, bounded: bool, name: str) -> tuple[DataFrame, pa.Table | None]:
    """A table of statistics: inside the plan if it is small, else a file. One known to be small is not written first."""
    return gather(table if bounded else settle(table, name))


def _unpivot_structs(columns: Sequence[str], fields) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), *fields(c)) for c in columns]))


def _direct(source: DataFrame, columns, probabilities, by) -> DataFrame:
    grid = F.array(*[F.lit(p) for p in probabilities])
    aggs = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggs += [F.count(value).alias(f"_n{i}"), F.percentile(value, grid).alias(f"_q{i}")]
    wide = source.groupBy(*by).agg(*aggs)
    index = {c: i for i, c in enumerate(columns)}
    return wide.select(*by, _unpivot_structs(columns, lambda c: [
        F.col(f"_n{index[c]}").alias("n"), F.col(f"_q{index[c]}").alias("q")]))


def _keys(source: DataFrame, by) -> list[str]:
    return [PLACES] if PLACES in source.columns else by


def _long(source: DataFrame, columns, by) -> DataFrame:
    rows = source.select(*_keys(source, by), _unpivot_structs(columns, lambda c: [F.col(c).cast("double").alias("v")]))
    return _at_places(rows.where(F.col("v").isNotNull()))


def _bracketed(source: DataFrame, columns, probabilities, by, margin: float = MARGIN) -> DataFrame:
    group = [*by, "metric"]
    brackets, few = _kept(_sketch(source, columns, probabilities, by, margin), not by, "brackets")
    counts = settle(_reduce(source, brackets, columns, probabilities, by), "counts")
    found, rows = _kept(_read_off(counts, brackets, group), few is not None, "found")
    wanted = len(probabilities) * (brackets.count() if few is None else few.num_rows)
    got = found.agg(F.sum("got")).first()[0] if rows is None else pc.sum(rows.column("got")).as_py()
    if (got or 0) < wanted:
        return _bracketed(source, columns, probabilities, by, margin * 32)  # a bracket has missed its rank
    return found.drop("got")


def _read_off(counts: DataFrame, brackets: DataFrame, group: list[str]) -> DataFrame:
    """``(*group, n, q, got)`` from the counts inside the brackets; ``got`` ranks were inside."""
    targets = brackets.select(*group, "n", F.posexplode("p").alias("i", "p"))
    position = F.col("p") * (F.col("n") - 1)
    targets = (
        targets.withColumn("pos", position)
        .withColumn("r_low", F.floor("pos")).withColumn("r_high", F.ceil("pos"))
    )

    # At most len(p) * (CELLS + 2) rows per group reach this window.
    cell_order = Window.partitionBy(*group).orderBy("gap", "inside", "cell")
    cells = (
        counts.groupBy(*group, "gap", "inside", "cell").agg(F.sum("m").alias("size"))
        .withColumn("upto", F.sum("size").over(cell_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("upto") - F.col("size"))
    )
    holds = (F.col("before") <= F.col("r_high")) & (F.col("upto") > F.col("r_low"))
    hit = (cells.join(targets.select(*group, "r_low", "r_high"), group).where(holds)
           .groupBy(*group, "gap", "inside", "cell").agg(F.max("before").alias("before")))

    in_cell = Window.partitionBy(*group, "gap", "cell").orderBy("v")
    ranked = (
        counts.where("inside").join(hit.where("inside").drop("inside"), [*group, "gap", "cell"])
        .withColumn("upto", F.col("before") + F.sum("m").over(
            in_cell.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*group, "v", "upto", (F.col("upto") - F.col("m")).alias("before"))
    )
    holds_low = (F.col("before") <= F.col("r_low")) & (F.col("upto") > F.col("r_low"))
    holds_high = (F.col("before") <= F.col("r_high")) & (F.col("upto") > F.col("r_high"))
    # Every value met is a number, infinite or NaN but never null, so a null is a rank that no value held.
    picked = (
        ranked.join(targets, group).where(holds_low | holds_high)
        .groupBy(*group, "n", "i", "pos", "r_low", "r_high")
        .agg(F.max(F.when(holds_low, F.col("v"))).alias("low"), F.max(F.when(holds_high, F.col("v"))).alias("high"))
    )
    value = F.when(F.col("r_low") == F.col("r_high"), F.col("low")).otherwise(
        (F.col("r_high") - F.col("pos")) * F.col("low") + (F.col("pos") - F.col("r_low")) * F.col("high"))
    both = F.col("low").isNotNull() & F.col("high").isNotNull()
    return picked.groupBy(*group, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("x")))), lambda s: s["x"]).alias("q"),
        F.count_if(both).alias("got")).select(*group, "n", "q", "got")


def _sketch(source, columns, probabilities, by, margin) -> DataFrame:
    """Per group and column: count, and a [low, high] bracket per probability."""
    low = [max(p - margin, 0.0) for p in probabilities]
    high = [min(p + margin, 1.0) for p in probabilities]
    partial, merged = [], []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        partial += [F.count(value).alias(f"_n{i}"), F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}"),
                    F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(SKETCH_SIZE)).alias(f"_s{i}")]
        merged += [F.sum(f"_n{i}").alias(f"_n{i}"), F.min(f"_min{i}").alias(f"_min{i}"), F.max(f"_max{i}").alias(f"_max{i}"),
                   F.kll_merge_agg_double(F.when(F.kll_sketch_get_n_double(f"_s{i}") > 0, F.col(f"_s{i}")), F.lit(SKETCH_SIZE)).alias(f"_s{i}")]
    index = {c: i for i, c in enumerate(columns)}

    def fields(c):
        i = index[c]
        lo = [F.col(f"_min{i}") if p - margin <= 0 else F.coalesce(F.col(f"_e{i}")[k], F.col(f"_min{i}")) for k, p in enumerate(probabilities)]
        hi = [F.col(f"_max{i}") if p + margin >= 1 else F.coalesce(F.col(f"_e{i}")[len(low) + k], F.col(f"_max{i}")) for k, p in enumerate(probabilities)]
        return [F.col(f"_n{i}").alias("n"), F.array(*lo).alias("lo"), F.array(*hi).alias("hi")]

    # One set of quantiles per sketch serves both edges of all brackets.
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("_part")
    keys = _keys(source, by)
    parts = source.select(*keys, *dict.fromkeys(columns), part).groupBy(*keys, "_part").agg(*partial)
    wide = _at_places(parts).groupBy(*by).agg(*merged)
    edges = F.array(*[F.lit(e) for e in [*low, *high]])
    wide = wide.withColumns({f"_e{i}": F.when(F.kll_sketch_get_n_double(f"_s{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", edges))
                             for i in range(len(columns))})
    return wide.select(*by, _unpivot_structs(columns, fields)).where(F.col("n") > 0).withColumn(
        "p", F.array(*[F.lit(p) for p in probabilities]))


def _reduce(source, brackets, columns, probabilities, by) -> DataFrame:
    """Count rows by (gap, inside, cell, v). ``gap`` is the number of brackets that
    end below the value; outside a bracket v collapses to null, so a group leaves
    few rows. (gap, inside, cell, v) sorts exactly as the values do."""
    group = [*by, "metric"]
    # Brackets by rising probability: those whose upper end lies below the value are counted, the next may hold it.
    order = sorted(range(len(probabilities)), key=probabilities.__getitem__)
    ranked = brackets.select(*group, F.array(*[F.struct(F.col("lo")[k].alias("lo"), F.col("hi")[k].alias("hi")) for k in order]).alias("b"))
    rows = _long(source, columns, by).join(ranked, group)
    gap = sum(((F.col("v") > F.col("b")[k]["hi"]).cast("int") for k in range(1, len(order))), (F.col("v") > F.col("b")[0]["hi"]).cast("int"))
    rows = rows.select(*group, "v", gap.alias("gap"), F.get("b", gap).alias("at"))
    place = F.try_divide(F.col("v") - F.col("at.lo"), F.col("at.hi") - F.col("at.lo")) * CELLS
    cell = F.when(F.isnan(place), CELLS).otherwise(F.least(F.floor(place), F.lit(CELLS)))
    inside = F.coalesce(F.col("v") >= F.col("at.lo"), F.lit(False))
    rows = rows.select(*group, "gap", inside.alias("inside"), F.when(inside, F.coalesce(cell, F.lit(0))).otherwise(0).cast("int").alias("cell"),
                       F.when(inside, F.col("v")).alias("v"))
    return rows.groupBy(*group, "gap", "inside", "cell", "v").agg(F.count("*").alias("m"))
