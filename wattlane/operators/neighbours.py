"""Exact k-nearest-neighbour regression as a distributed join.

Pivots, as many as the square root of the rows, cut the train rows into cells; rows are led to
a pivot over a coarse level of the square root of those. Any pivot will do for a row, because
only the true distance to it is used. Cells that lie near each other are packed into blocks of
bounded size. Two passes answer the queries:

1. a query meets the blocks of the nearest cells that together hold k rows, and its k-th best
   distance there is a radius that holds its neighbours;
2. the triangle inequality leaves the blocks with cells that reach into that radius, less the
   ones met already.

A query travels once per block, and queries that meet the same block come in pieces of bounded
size. In a block neighbouring queries are answered together: the nearest cells give a radius,
the triangle inequality drops cells, a matrix product tells which rows of the others can count,
and only for those are the distances taken dimension by dimension. No pair is emitted that is
not among a block's best, and no cell is ever handled by a single task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.session import settle, spread

QUERY_BLOCK = 16_384
TRAIN_BLOCK = 65_536
BLOCK_NUMBERS = 1 << 22  # numbers in the vectors of a block: wide ones make fewer rows
CHUNK = 1 << 21          # distances held at once
PART = 8_192             # rows whose distances are taken before the reach is looked at again
SEED = 4_096             # rows looked at first, for a reach
PAIRS = 65_536           # pairs whose exact distances are taken at once
NEIGHBOURS = 128         # queries answered at once
MAX_TASKS = 8_192
ROUNDING = 2.3e-16
#: The pivots travel with the tasks: so many at most, which 4 billion rows reach.
MAX_PIVOTS = 65_536
SLACK = 1e-9  # relative room for rounding in the triangle inequality


def _distances(queries: np.ndarray, rows: np.ndarray, p: float = 2) -> np.ndarray:
    """Minkowski distances, one dimension at a time so no third axis is held in memory."""
    total = np.zeros((len(queries), len(rows)))
    for d in range(queries.shape[1]):
        gap = np.abs(queries[:, d, None] - rows[None, :, d])
        total += gap if p == 1 else gap ** p
    return total if p == 1 else np.sqrt(total) if p == 2 else total ** (1 / p)


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    if column.null_count:
        raise ValueError("a vector is null")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Pivots:
    """Two levels: coarse pivots, and for each the fine ones that lie nearest to it."""

    def __init__(self, vectors: np.ndarray, p: float):
        self.vectors, self.p = vectors, p
        self.coarse = vectors[::max(1, math.isqrt(len(vectors)))]
        home = np.concatenate([_distances(vectors[i:i + 1024], self.coarse, p).argmin(axis=1) for i in range(0, len(vectors), 1024)])
        order = np.argsort(home, kind="stable")
        self.under = np.split(order, np.searchsorted(home[order], np.arange(1, len(self.coarse))))

    def along(self) -> list[int]:
        """The pivots in an order in which those that follow each other mostly lie near each other."""
        left, out, at = np.arange(len(self.coarse)), [], 0
        while len(left):
            here, left = left[at], np.delete(left, at)
            out += self.under[here].tolist()
            if len(left):
                at = int(_distances(self.coarse[here:here + 1], self.coarse[left], self.p).argmin())
        return out

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A near pivot of each row, and the distance to it."""
        cell, r = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for start in range(0, len(rows), 4096):
            part = slice(start, start + 4096)
            above = _distances(rows[part], self.coarse, self.p).argmin(axis=1)
            for c in np.unique(above):
                here = start + np.flatnonzero(above == c)
                d = _distances(rows[here], self.vectors[self.under[c]], self.p)
                best = d.argmin(axis=1)
                cell[here], r[here] = self.under[c][best], d[np.arange(len(here)), best]
        return cell, r


def _pivots(train: DataFrame, wanted: int, p: float) -> Pivots | None:
    """One vector per hash bucket: distinct by construction, at most ``wanted`` rows after the partial aggregate.
    Which one another hash says: the least vector would be one with a small first number in every bucket."""
    bucket = F.pmod(F.xxhash64("vec"), F.lit(wanted))
    picked = train.groupBy(bucket.alias("b")).agg(F.min(F.struct(F.hash("vec"), "vec")).alias("v")).orderBy("b").select("v.vec").toArrow()
    return Pivots(_matrix(picked.column("vec").combine_chunks()), p) if picked.num_rows else None


def _with_cell(df: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds ``cell`` and ``r``, the distance to its pivot."""

    @F.pandas_udf("cell int, r double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            cell, r = pivots.assign(np.stack(vectors.to_numpy())) if len(vectors) else (np.zeros(0), np.zeros(0))
            yield pd.DataFrame({"cell": cell.astype("int32"), "r": r})

    return df.withColumn("_p", nearest("vec")).select("*", "_p.cell", "_p.r").drop("_p")


class Cells:
    """Sizes and radii of the cells that have rows, and the blocks of rows they are packed into.

    Cells that lie near each other share a block of at most ``block`` rows; a cell above that has
    ``pieces`` blocks of its own from ``first`` on."""

    def __init__(self, pivots: Pivots, ids: np.ndarray, sizes: np.ndarray, radii: np.ndarray, block: int):
        along = {c: i for i, c in enumerate(pivots.along())}
        order = np.argsort([along[c] for c in ids], kind="stable")
        self.vectors, self.p = pivots.vectors[ids[order]], pivots.p
        self.ids, self.sizes, self.radii = ids[order], sizes[order], radii[order]
        self.place = {c: i for i, c in enumerate(self.ids.tolist())}
        self.pieces = -(-self.sizes // block)
        self.first, self.rows = np.zeros(len(ids), np.int64), []
        filled = block
        for i, (n, pieces) in enumerate(zip(self.sizes.tolist(), self.pieces.tolist())):
            if filled + n > block or pieces > 1:
                self.first[i], filled = len(self.rows), 0
                self.rows += [0] * pieces
            else:
                self.first[i] = len(self.rows) - 1
            filled = block if pieces > 1 else filled + n
            for j in range(pieces):
                self.rows[self.first[i] + j] += -(-n // pieces)

    def nearest(self, gap: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
        """Per query the nearest cell, and the blocks of the nearest cells that together hold ``k`` rows, or of all."""
        near = gap.argmin(axis=1)
        home = [[b] for b in self.first[near].tolist()]
        for i in np.flatnonzero((self.sizes[near] < k) | (self.pieces[near] > 1)):
            order = np.argsort(gap[i], kind="stable")
            home[i] = self.blocks(order[:int(np.searchsorted(np.cumsum(self.sizes[order]), k)) + 1])
        return near, home

    def blocks(self, places: np.ndarray) -> list[int]:
        """The blocks that hold these cells."""
        return sorted({b for i in places for b in range(self.first[i], self.first[i] + self.pieces[i])})

    def beyond(self, gap: np.ndarray, reach: np.ndarray, home: list[list[int]]) -> list[list[int]]:
        """Per query the blocks with a cell within reach, but for those at home."""
        heads, starts = np.unique(self.first, return_index=True)  # a block's cells follow each other
        row, head = np.nonzero(np.logical_or.reduceat(self.reached(gap, reach), starts, axis=1))
        out: list[list[int]] = [[] for _ in home]
        for i, b, pieces in zip(row.tolist(), heads[head].tolist(), self.pieces[starts][head].tolist()):
            out[i] += [x for x in range(b, b + pieces) if x not in home[i]]
        return out

    def reached(self, gap: np.ndarray, radius: np.ndarray, places=slice(None)) -> np.ndarray:
        """Which of these cells can hold a row within ``radius``, if their pivots lie ``gap`` away."""
        r = self.radii[places]
        return gap - r <= radius[:, None] + SLACK * (gap + r + radius[:, None])


def _runs(rows: int, width: int) -> range:
    """Starts of slices whose distances to ``width`` rows stay small in memory."""
    return range(0, rows, _step(width))


def _step(width: int) -> int:
    return max(1, CHUNK // max(1, width))


def _placed(wanted: DataFrame, cells: Cells, k: int) -> DataFrame:
    """Adds ``near``, the cell whose pivot is nearest, and ``home``, the blocks of the nearest cells with k rows."""
    def place(batches):
        for batch in batches:
            vectors, near, home = _matrix(batch.column(1)), [np.zeros(0, np.int64)], []
            for start in _runs(len(vectors), len(cells.ids)):
                n, h = cells.nearest(_distances(vectors[start:start + _step(len(cells.ids))], cells.vectors, cells.p), k)
                near.append(n)
                home += h
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(near), pa.int32()), pa.array(home, pa.list_(pa.int32()))], [*batch.schema.names, "near", "home"])

    return wanted.mapInArrow(place, "qid long, vec array<double>, near int, home array<int>")


def _beyond(bounded: DataFrame, cells: Cells) -> DataFrame:
    """The blocks each query has yet to meet within its ``reach``; a vector travels once here, however many they are."""
    def route(batches):
        for batch in batches:
            vectors, reach, out = _matrix(batch.column("vec")), batch.column("reach").to_numpy(), []
            home = batch.column("home").to_pylist()
            for start in _runs(len(vectors), len(cells.ids)):
                part = slice(start, start + _step(len(cells.ids)))
                out += cells.beyond(_distances(vectors[part], cells.vectors, cells.p), reach[part], home[part])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("qid", "vec", "near", "reach")), pa.array(out, pa.list_(pa.int32()))],
                                             ["qid", "vec", "near", "reach", "blocks"])

    return bounded.mapInArrow(route, "qid long, vec array<double>, near int, reach double, blocks array<int>")


def _best(distances: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``top`` smallest of each row, equal ones by column; infinite ones never."""
    top = min(top, distances.shape[1])
    last = np.partition(distances, top - 1, axis=1)[:, top - 1]
    row, column = np.nonzero((distances <= last[:, None]) & np.isfinite(distances))
    keep = _first(row, column, distances[row, column], top)
    return row[keep], column[keep]


def _first(row: np.ndarray, tie: np.ndarray, distance: np.ndarray, top: int) -> np.ndarray:
    """Where the ``top`` smallest distances of each row stand, in order; equal ones by ``tie``."""
    order = np.lexsort((tie, distance, row))
    row = row[order]
    return order[np.arange(len(row)) - np.searchsorted(row, row) < top]


class _Rows:
    """The rows of a block, cell by cell, each cell's by id."""

    def __init__(self, table: pa.Table, cells: Cells):
        place = np.array([cells.place[c] for c in table.column("cell").to_pylist()])
        order = np.lexsort((table.column("tid").to_numpy(), place))
        self.table, self.cells = table.take(order), cells
        self.vectors = _matrix(self.table.column("vec").combine_chunks())
        # Ids count among equal distances, and those of several cells mix.
        self.rank = np.argsort(np.argsort(self.table.column("tid").to_numpy(), kind="stable"), kind="stable")
        self.places, self.starts, self.counts = np.unique(place[order], return_index=True, return_counts=True)
        # Taken from the middle the rounding of the quick distances is small.
        self.middle = self.vectors.mean(axis=0)
        self.moved = self.vectors - self.middle
        self.square = np.einsum("ij,ij->i", self.moved, self.moved)

    def of(self, chosen: np.ndarray) -> np.ndarray:
        """Rows of the chosen ones of the block's cells."""
        return np.concatenate([np.arange(s, s + c) for s, c in zip(self.starts[chosen], self.counts[chosen])] or [np.zeros(0, np.int64)])

    def scores(self, wanted: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What orders the rows by distance but for rounding, and how much that may be off, per query: for
        p = 2 squares by a matrix product, else the distances themselves."""
        p = self.cells.p
        if p != 2:
            return _distances(wanted, self.vectors[at], p), np.zeros(len(wanted))
        moved = wanted - self.middle
        square, most = np.einsum("ij,ij->i", moved, moved), self.square[at].max(initial=0.0)
        with np.errstate(invalid="ignore", over="ignore"):
            found = moved @ self.moved[at].T
            found *= -2
            found += square[:, None]
            found += self.square[at]
        return found, ROUNDING * (moved.shape[1] + 8) * (square + most + np.abs(self.middle).max(initial=0.0) ** 2)

    def exact(self, wanted: np.ndarray, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distances pair by pair, added up dimension by dimension like those of ``_distances``."""
        p, out = self.cells.p, np.zeros(len(at))
        for start in range(0, len(at), PAIRS):
            part = slice(start, start + PAIRS)
            a, b, total = wanted[query[part]], self.vectors[at[part]], np.zeros(len(at[part]))
            for d in range(a.shape[1]):
                gap = np.abs(a[:, d] - b[:, d])
                total += gap if p == 1 else gap ** p
            out[part] = total if p == 1 else np.sqrt(total) if p == 2 else total ** (1 / p)
        return out

    def search(self, wanted: np.ndarray, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, row, distance)``: the k nearest rows within ``reach`` of each query; all lie near one another."""
        gap = _distances(wanted, self.cells.vectors[self.places], self.cells.p)
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        met = np.zeros(len(self.places), bool)
        if not np.isfinite(reach).all():  # the nearest cells first: they give a reach
            order = np.argsort(gap.min(axis=0), kind="stable")
            enough = order[:int(np.searchsorted(np.cumsum(self.counts[order]), max(2 * k, SEED))) + 1]
            met[enough] = True
            kept = self.nearest(wanted, self.of(np.flatnonzero(met)), reach, k, kept)
            reach = self.kth(kept, reach, k)
        with np.errstate(invalid="ignore"):
            open_ = self.cells.reached(gap, reach, self.places) | ~np.isfinite(reach)[:, None]
        rest = np.flatnonzero(open_.any(axis=0) & ~met)
        # A few cells at a time, so that the reach shrinks and the distances stay small in memory.
        for part in np.split(rest, np.searchsorted(np.cumsum(self.counts[rest]), np.arange(PART, self.counts[rest].sum() + PART, PART))):
            if len(part):
                kept = self.nearest(wanted, self.of(part), reach, k, kept)
                reach = self.kth(kept, reach, k)
        return kept

    def kth(self, kept, reach: np.ndarray, k: int) -> np.ndarray:
        """The distance of the k-th kept row of each query, if there are so many."""
        row, _, distance = kept
        n, ends = np.bincount(row, minlength=len(reach)), np.searchsorted(row, np.arange(len(reach)), side="right")
        full = n >= k
        out = reach.copy()
        out[full] = np.minimum(reach[full], distance[ends[full] - 1])
        return out

    def nearest(self, wanted: np.ndarray, at: np.ndarray, reach: np.ndarray, k: int, kept):
        """The k best of ``kept`` and of the rows ``at`` within ``reach``."""
        rows, columns = [kept[0]], [kept[1]]
        distances = [kept[2]]
        for start in _runs(len(wanted), len(at)):
            part = slice(start, start + _step(len(at)))
            score, off = self.scores(wanted[part], at)
            with np.errstate(invalid="ignore", over="ignore"):
                limit = reach[part] if self.cells.p != 2 else reach[part] ** 2 * (1 + SLACK)
                limit = np.where(np.isfinite(limit), limit + off, np.inf)
                if len(at) > k and not np.isfinite(limit).all():
                    limit = np.minimum(limit, np.partition(score, k - 1, axis=1)[:, k - 1] + 2 * off)
                # What is no number, as from infinite ones, is left to the exact distance.
                row, column = np.nonzero((score <= limit[:, None]) | np.isnan(score))
            row = row + start
            d = self.exact(wanted, row, at[column])
            near = np.isfinite(d) & (d <= reach[row])
            rows.append(row[near]), columns.append(at[column[near]]), distances.append(d[near])
        row, column, distance = (np.concatenate(x) for x in (rows, columns, distances))
        keep = _first(row, self.rank[column], distance, k)
        return row[keep], column[keep], distance[keep]


def _block_join(cells: Cells, k: int):
    schema = pa.schema([("qid", pa.int64()), ("dist", pa.float64()), ("tid", pa.int64()), ("y", pa.float64())])

    def nearest_in_block(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not (queries.num_rows and rows.num_rows):
            return schema.empty_table()
        queries, block, parts = queries.sort_by("near"), _Rows(rows, cells), []
        wanted = _matrix(queries.column("vec").combine_chunks())
        reach = queries.column("reach").to_numpy() if "reach" in queries.column_names else np.full(len(wanted), np.inf)
        for start in range(0, len(wanted), NEIGHBOURS):  # they lie near one another, so they reach the same cells
            part = slice(start, start + NEIGHBOURS)
            row, at, distance = block.search(wanted[part], reach[part], k)
            parts.append(pa.table([queries.column("qid").take(pa.array(start + row)), pa.array(distance),
                                   block.table.column("tid").take(pa.array(at)), block.table.column("y").take(pa.array(at))], schema=schema))
        return pa.concat_tables(parts).combine_chunks()

    return nearest_in_block


def _search(rows: DataFrame, routed: DataFrame, cells: Cells, k: int, stats: dict, name: str) -> DataFrame:
    """The k best of every query in each of the blocks it was sent to, piece by piece of the queries."""
    asked = {r["block"]: r["count"] for r in routed.groupBy("block").count().collect()}  # a row per block at most
    stats[f"{name}_query_copies"] = sum(asked.values())
    plan = [(b, -(-n // QUERY_BLOCK)) for b, n in asked.items()]
    stats[f"{name}_train_copies"] = sum(cells.rows[b] * q for b, q in plan)
    blocks = rows.sparkSession.createDataFrame(pa.table(
        [pa.array(x, pa.int32()) for x in (zip(*plan) if plan else ([], []))], names=["block", "q_blocks"]))
    left = routed.join(blocks, "block").withColumn("qb", F.pmod(F.xxhash64("qid"), "q_blocks").cast("int")).drop("q_blocks")
    right = rows.join(blocks, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"), "cell", "tid", "vec", "y")
    keys = ["block", "qb"]
    # A block is much work and few bytes: left to itself the engine would put many into one task.
    tasks = min(MAX_TASKS, max(1, 3 * sum(q for _, q in plan)))
    left, right = (x.repartition(tasks, *keys) for x in (left, right))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _block_join(cells, k), "qid long, dist double, tid long, y double")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("dist", "tid")
    return found.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).drop("_k")


def nearest_neighbours(train: DataFrame, queries: DataFrame, vector: str, label: str, train_id: str, query_id: str,
                       k: int = 50, p: float = 2, n_pivots: int | None = None, stats: dict | None = None) -> DataFrame:
    """``(qid, dist, tid, y)``: the k nearest train rows of every query, ties by train id.

    Both ids must be unique integers. Vectors are arrays of double; ``p`` >= 1 is the Minkowski
    order. ``stats`` is told the rows, queries, cells, and how many copies of either travelled
    in the first pass (``home``) and the second (``reach``).
    """
    stats = {} if stats is None else stats
    rows = train.select(F.col(train_id).cast("long").alias("tid"), F.col(vector).cast("array<double>").alias("vec"),
                        F.col(label).cast("double").alias("y"))
    if n_pivots is None:
        n_pivots = min(MAX_PIVOTS, max(1, math.isqrt(train.count())))
    pivots = _pivots(rows.select("vec"), n_pivots, p)
    if pivots is None:
        return rows.select(F.lit(0).cast("long").alias("qid"), F.lit(0.0).alias("dist"), "tid", "y").where("false")
    # Of identical vectors only the k lowest ids can ever be chosen.
    rows = rows.withColumn("_c", F.row_number().over(Window.partitionBy("vec").orderBy("tid"))).where(F.col("_c") <= k).drop("_c")
    rows = settle(_with_cell(rows, pivots), "knn-train")
    wanted = spread(queries.select(F.col(query_id).cast("long").alias("qid"), F.col(vector).cast("array<double>").alias("vec")))

    found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("r")).orderBy("cell").toArrow()
    ids, n, r = (found.column(c).to_numpy() for c in ("cell", "n", "r"))
    cells = Cells(pivots, ids, n, r, max(1, min(TRAIN_BLOCK, BLOCK_NUMBERS // max(1, pivots.vectors.shape[1]))))
    stats.update(rows=int(n.sum()), cells=len(ids))
    layout = rows.sparkSession.createDataFrame(pa.table([pa.array(x, pa.int32()) for x in (cells.ids, cells.first, cells.pieces)],
                                                        names=["cell", "first", "pieces"]))
    rows = rows.join(layout, "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("tid"), "pieces")).cast("int").alias("block"), "cell", "tid", "vec", "y")

    wanted = settle(_placed(wanted, cells, k), "knn-query")
    near = settle(_top(_search(rows, wanted.select("qid", "vec", "near", F.explode("home").alias("block")), cells, k, stats, "home"), k), "near")
    if len(cells.rows) == 1:
        stats.update(reach_query_copies=0, reach_train_copies=0)
        return near
    # With fewer than k rows in all a query has met them all: nothing lies beyond.
    reach = near.groupBy("qid").agg(F.max("dist").alias("reach"))
    bounded = settle(_beyond(wanted.join(reach, "qid").select("qid", "vec", "near", "home", "reach"), cells), "reach")
    more = _search(rows, bounded.select("qid", "vec", "near", "reach", F.explode("blocks").alias("block")), cells, k, stats, "reach")
    return _top(near.unionByName(more), k)


def knn_predict(train: DataFrame, queries: DataFrame, vector: str, label: str, train_id: str, query_id: str,
                k: int = 50, weights: str = "distance", p: float = 2, n_pivots: int | None = None) -> DataFrame:
    """``(qid, prediction)``. With distance weights an exact match overrides all others."""
    near = nearest_neighbours(train, queries, vector, label, train_id, query_id, k, p, n_pivots)
    if weights == "uniform":
        return near.groupBy("qid").agg(F.avg("y").alias("prediction"))
    if weights != "distance":
        raise ValueError(f"unknown weights {weights!r}")
    exact = F.avg(F.when(F.col("dist") == 0, F.col("y")))
    inverse = F.try_divide(F.lit(1.0), F.col("dist"))
    weighted = F.try_divide(F.sum(F.col("y") * inverse), F.sum(inverse))
    return near.groupBy("qid").agg(F.coalesce(exact, weighted).alias("prediction"))
