"""Average ranks with ties, and the Spearman matrix, without a global sort window.

All ranked columns become one long table (row, metric, value) that is dealt once, by ranges
of (metric, value, row): a value that fills a third of the table is spread like any other, as
the row is part of the key. Each partition is read in order and gives every row the number
of smaller and of equal values it has seen there. One small row per partition and metric
then says how many rows lie before it and how its first and last value go on in the
neighbours, which turns local numbers into ranks. The long table of ranks is turned back
into rows once, whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.session import settle, spread

ROW = "_row"
HOLD = 20_000  # rows of one value that wait in a task for its end


def _tie_runs(metric: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Where a new value or metric begins; NaN equals NaN."""
    same = (v[1:] == v[:-1]) | (np.isnan(v[1:]) & np.isnan(v[:-1]))
    return np.concatenate([[True], (metric[1:] != metric[:-1]) | ~same])


def _count_in_order(batches, masks: int, hold: int):
    """Per row of a partition in order of (metric, v): how many rows of the partition and metric
    are smaller, and how many equal, among all rows and among those of each mask. Of a run of more
    than ``hold`` equal values the rows pass on without the second; its last ones have it."""
    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    metric, before = None, np.zeros(masks, np.int64)
    passed = np.zeros(masks, np.int64)  # rows of the run that goes on that have passed already
    names = [ROW, "metric", "v", "part", *[f"{k}{i}" for i in range(masks) for k in ("less", "same")]]

    def weights(rows: pa.Table) -> np.ndarray:
        return np.column_stack([np.ones(rows.num_rows, np.int64), *[
            rows.column(f"m{i}").to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, masks)]])

    def open_run(rows: pa.Table):
        nonlocal passed
        n = rows.num_rows
        passed = passed + weights(rows).sum(axis=0)
        less = before if rows.column("metric")[0].as_py() == metric else np.zeros(masks, np.int64)
        columns = [rows.column(c) for c in (ROW, "metric", "v")] + [pa.array(np.full(n, part, np.int32))]
        for i in range(masks):
            columns += [pa.array(np.full(n, less[i])), pa.nulls(n, pa.int64())]
        return pa.table(columns, names=names).combine_chunks().to_batches()

    def counted(rows: pa.Table):
        nonlocal metric, before, passed
        m, v = rows.column("metric").to_numpy(), rows.column("v").to_numpy()
        weight = weights(rows)
        start = np.flatnonzero(_tie_runs(m, v))
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(m))))
        equal = np.add.reduceat(weight, start, axis=0)
        equal[0] += passed
        passed = np.zeros(masks, np.int64)
        smaller = np.cumsum(equal, axis=0) - equal
        fresh = np.flatnonzero(np.concatenate([[m[start[0]] != metric], m[start[1:]] != m[start[:-1]]]))
        base = np.zeros_like(smaller)
        if len(fresh):
            base[fresh[0]:] = np.repeat(-smaller[fresh], np.diff(np.append(fresh, len(start))), axis=0)
        base[:fresh[0] if len(fresh) else len(start)] = before
        smaller = smaller + base
        metric, before = m[-1], smaller[-1] + equal[-1]
        columns = [rows.column(c) for c in (ROW, "metric", "v")] + [pa.array(np.full(len(m), part, np.int32))]
        for i in range(masks):
            columns += [pa.array(smaller[run, i]), pa.array(equal[run, i])]
        return pa.table(columns, names=names).combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        # The last run may go on in the next batch: its rows wait.
        starts = np.flatnonzero(_tie_runs(rows.column("metric").to_numpy(), rows.column("v").to_numpy()))
        if starts[-1]:
            yield from counted(rows.slice(0, starts[-1]))
        rest = rows.slice(starts[-1])
        if rest.num_rows > hold:
            yield from open_run(rest.slice(0, rest.num_rows - 1))
            rest = rest.slice(rest.num_rows - 1)
        held = rest.combine_chunks().to_batches()
    if held:
        yield from counted(pa.Table.from_batches(held))


def numbered_rows(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table written once with a number for each row, which stays the same from then on, and
    which of its columns have nulls, counted on the way."""
    seen = Observation()
    rows = spread(df).observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    out = settle(rows.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    return out, [c for i, c in enumerate(df.columns) if seen.get[f"n{i}"] < seen.get["rows"]]


def row_counts(numbered: DataFrame, columns: Sequence[str], partial: Sequence[str] = ()) -> DataFrame:
    """``(_row, metric, v, below0, equal0, below1, ...)``: for every row and column (``metric`` counts the
    columns) that is not null how many rows have smaller and how many equal values, itself included,
    among all rows, and among the rows where each ``partial`` column is present."""
    masks = 1 + len(partial)
    present = [F.col(f"`{p}`").isNotNull().alias(f"m{i}") for i, p in enumerate(partial, 1)]
    rows = numbered.select(ROW, *present, F.inline(F.array(*[
        F.struct(F.lit(i).alias("metric"), (F.col(f"`{c}`").cast("double") + 0.0).alias("v")) for i, c in enumerate(columns)])))
    ordered = rows.where(F.col("v").isNotNull()).repartitionByRange("metric", "v", ROW).sortWithinPartitions("metric", "v")
    schema = f"{ROW} long, metric int, v double, part int" + "".join(f", less{i} long, same{i} long" for i in range(masks))
    hold = HOLD
    local = settle(ordered.mapInArrow(lambda b: _count_in_order(b, masks, hold), schema), "ordered")

    ended = local.where(F.col("same0").isNotNull())
    first = F.struct(*[f"same{i}" for i in range(masks)])
    last = F.struct(*[f"{k}{i}" for i in range(masks) for k in ("less", "same")])
    cells = settle(ended.groupBy("metric", "part").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.min_by(first, "v").alias("first"), F.max_by(last, "v").alias("last")), "cells")
    # A row per partition and metric, and per long run and value at an edge of a partition, reaches these windows.
    earlier = Window.partitionBy("metric").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = Window.partitionBy("metric", "v").orderBy("part")
    size = lambda i: F.col(f"last.less{i}") + F.col(f"last.same{i}")
    edges = cells.select("metric", "part", F.inline(F.array_distinct(F.array(
        F.struct(F.col("low").alias("v"), *[F.col(f"first.same{i}").alias(f"n{i}") for i in range(masks)]),
        F.struct(F.col("high").alias("v"), *[F.col(f"last.same{i}").alias(f"n{i}") for i in range(masks)])))))
    long = ended.where(F.col("same0") > hold).groupBy("metric", "part", "v").agg(*[F.max(f"same{i}").alias(f"n{i}") for i in range(masks)])
    edges = edges.unionByName(long).dropDuplicates(["metric", "part", "v"])

    def beyond(i: int, frame) -> Column:
        return F.coalesce(F.sum(f"n{i}").over(frame), F.lit(0))

    ties = edges.select("metric", "part", "v", *[f"n{i}" for i in range(masks)], *[
        beyond(i, frame).alias(f"{k}{i}") for i in range(masks)
        for k, frame in (("ahead", runs.rowsBetween(Window.unboundedPreceding, -1)), ("behind", runs.rowsBetween(1, Window.unboundedFollowing)))])
    offsets = cells.select("metric", "part", *[F.coalesce(F.sum(size(i)).over(earlier), F.lit(0)).alias(f"offset{i}") for i in range(masks)])
    placed = local.join(offsets, ["metric", "part"]).join(ties, ["metric", "part", "v"], "left")

    def counts(i: int) -> list[Column]:
        ahead, behind = (F.coalesce(F.col(f"{k}{i}"), F.lit(0)) for k in ("ahead", "behind"))
        return [(F.col(f"offset{i}") + F.col(f"less{i}") - ahead).alias(f"below{i}"), (F.coalesce(f"same{i}", f"n{i}") + ahead + behind).alias(f"equal{i}")]

    return placed.select(ROW, "metric", "v", *[c for i in range(masks) for c in counts(i)])


def row_ranks(numbered: DataFrame, columns: Sequence[str], partial: Sequence[str] = ()) -> DataFrame:
    """``(_row, metric, r0, r1, ...)``: the average ranks that follow from ``row_counts``."""
    return row_counts(numbered, columns, partial).select(ROW, "metric", *[
        (F.col(f"below{i}") + (F.col(f"equal{i}") + 1) / 2.0).alias(f"r{i}") for i in range(1 + len(partial))])


def rank_average(df: DataFrame, column: str, out: str = "rank") -> DataFrame:
    """Adds the 1-based average rank of ``column``; a null has no rank, NaN is the largest value."""
    numbered, _ = numbered_rows(df)
    ranks = row_ranks(numbered, [column]).select(ROW, F.col("r0").alias(out))
    return numbered.join(ranks, ROW, "left").drop(ROW)


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(col_a, col_b, rho, n)`` for every ordered pair, over pairwise complete rows.

    A rank within a pair depends on the partner only through its nulls, so columns without
    nulls share one set of ranks.
    """
    columns = list(columns)
    numbered, partial = numbered_rows(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]))
    masks = 1 + len(partial)
    ranks = row_ranks(numbered, columns, partial)
    rows = ranks.groupBy(ROW).agg(*[
        F.max(F.when(F.col("metric") == m, F.col(f"r{i}"))).alias(f"r{m}_{i}") for m in range(len(columns)) for i in range(masks)])

    def rank(m: int, partner: str) -> Column:
        return F.col(f"r{m}_{partial.index(partner) + 1 if partner in partial else 0}")

    aggs, pairs = [], []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            # Among the rows where the partner is missing a rank means nothing.
            both = F.col(f"r{i}_0").isNotNull() & F.col(f"r{j}_0").isNotNull()
            x, y = F.when(both, rank(i, columns[j])), F.when(both, rank(j, a))
            # corr() raises on a constant column in ANSI mode; here that pair is null. Ranks
            # that are not all equal have a variance of at least 1/4, so 1/8 separates rounding.
            vx, vy = F.var_pop(x), F.var_pop(y)
            rho = F.when((vx > 0.125) & (vy > 0.125), F.covar_pop(x, y) / F.sqrt(vx * vy))
            aggs += [rho.alias(f"c{i}_{j}"), F.count_if(both).alias(f"n{i}_{j}")]
            pairs += [(i, j)] if i == j else [(i, j), (j, i)]
    wide = rows.agg(*aggs)
    cells = [F.struct(F.lit(columns[i]).alias("col_a"), F.lit(columns[j]).alias("col_b"),
                      F.col(f"c{min(i, j)}_{max(i, j)}").alias("rho"), F.col(f"n{min(i, j)}_{max(i, j)}").alias("n"))
             for i, j in pairs]
    return wide.select(F.inline(F.array(*cells)))


def strongest_partners(matrix: DataFrame, target: str, k: int) -> DataFrame:
    """The k columns most correlated with ``target`` (itself included, as in a sorted matrix column)."""
    return matrix.where(F.col("col_b") == target).orderBy(F.desc_nulls_last("rho"), "col_a").limit(k).select(
        F.col("col_a").alias("column"), "rho")
