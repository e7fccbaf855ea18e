"""SimHash near-duplicates, found with BK-trees.

Fingerprints are computed in one map. Distinct fingerprints are dealt to shards by the
pigeonhole: 64 bits cut into ``radius + 1`` blocks, and two fingerprints within the radius
agree on a whole block, so each goes to one shard per block. In a shard they form a
BK-tree, whose children hang on edges keyed by their integer Hamming distance to the
parent, and a query follows only the edges within the radius of its own distance. A shard
of more than ``TREE`` members is cut into trees of that size, and its members as queries
into pieces of about ``TASK_ROWS``; each piece meets a copy of each tree, so both have a
proven bound and no task holds a whole hot shard.

A task answers many shards at once: building and searching are done level by level over a
forest, in numpy. It returns, instead of every pair, one star per set of linked
fingerprints, which keeps all connections. Components then come from alternating large
and small stars over those edges, each round written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import buckets, col, documents, fresh, query, whole_text
from wattlane.session import settle

#: Most members of one tree, and about how many rows a task searches.
TREE = 20_000
TASK_ROWS = 50_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the shingles' hashes; zero for a text without words."""
    found = text.translate(LOWER).split()  # of bytes: blanks and \\x09 to \\x0d
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(found[i:i + words]), seed) for i in range(n)), np.uint64, n)
    bits = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = np.ascontiguousarray(hashes[i:i + 65536]).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                 seed: int = 42) -> DataFrame:
    """``id_col``, ``th`` (xxhash64 of the text) and ``fp``, the fingerprint as a signed long. Null
    text counts as empty."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("th", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t or b"", words, seed) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "th", "fp"])

    text = whole_text(text_col)
    return docs.select(col(id_col), F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(run, schema)


class Forest:
    """BK-trees over the groups of ``keys``, one root each, built level by level."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        node_value, node_parent, node_edge = [], [], []
        roots_key = np.empty(0, keys.dtype)
        group = keys  # first the tree, later parent * 65 + edge
        made = 0
        first_level = True
        while len(values):
            order = np.argsort(group, kind="stable")
            group, values = group[order], values[order]
            lead = np.concatenate([[True], group[1:] != group[:-1]])
            heads = np.flatnonzero(lead)
            if first_level:
                roots_key = group[heads]
                node_parent.append(np.full(len(heads), -1))
                node_edge.append(np.zeros(len(heads), np.int64))
                first_level = False
            else:
                node_parent.append(group[heads] // 65)
                node_edge.append(group[heads] % 65)
            node_value.append(values[heads])
            node = made + np.cumsum(lead) - 1
            made += len(heads)
            rest = ~lead
            distance = np.bitwise_count(values[rest] ^ values[heads][node[rest] - (made - len(heads))]).astype(np.int64)
            group, values = node[rest] * 65 + distance, values[rest]
        self.roots_key = roots_key
        self.value = np.concatenate(node_value) if node_value else np.empty(0, np.uint64)
        parent = np.concatenate(node_parent) if node_parent else np.empty(0, np.int64)
        edge = np.concatenate(node_edge) if node_edge else np.empty(0, np.int64)
        slot = np.where(parent < 0, -1, parent * 65 + edge)
        self.child = np.argsort(slot, kind="stable")
        self.slot = slot[self.child]

    def search(self, keys: np.ndarray, values: np.ndarray, radius: int):
        """Yields (query number, node value) of all nodes within the radius, by level."""
        root = np.searchsorted(self.roots_key, keys)
        root = np.minimum(root, max(len(self.roots_key) - 1, 0))
        q = np.flatnonzero(self.roots_key[root] == keys) if len(self.roots_key) else np.empty(0, np.int64)
        node = root[q]
        while len(q):
            d = np.bitwise_count(values[q] ^ self.value[node]).astype(np.int64)
            near = d <= radius
            yield q[near], self.value[node[near]]
            low = np.searchsorted(self.slot, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.slot, node * 65 + np.minimum(d + radius, 64), side="right")
            many = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            q, node = np.repeat(q, many), self.child[at]


def least_labels(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label``, a star over positions, with the links ``a``-``b`` merged in."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        low, high = np.minimum(la[open_], lb[open_]), np.maximum(la[open_], lb[open_])
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def _stars(radius: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("tree").to_numpy()
        fps = table.column("fp").to_numpy().view(np.uint64)
        inside, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("inside", "asks"))
        forest = Forest(keys[inside], fps[inside])
        values, position = np.unique(fps, return_inverse=True)
        label = np.arange(len(values))
        queries = np.flatnonzero(asks)
        for start in range(0, len(queries), 8192):
            part = queries[start:start + 8192]
            for q, near in forest.search(keys[part], fps[part], radius):
                label = least_labels(position[part][q], np.searchsorted(values, near), label)
        linked = np.flatnonzero(label != np.arange(len(values)))
        return pa.table({"a": values[linked].view(np.int64), "b": values[label[linked]].view(np.int64)})

    return run


def link_stars(nodes: DataFrame, radius: int = 2, tree: int = TREE, task_rows: int = TASK_ROWS) -> DataFrame:
    """Edges (a, b) that connect whatever values of ``fp`` lie within the radius."""
    blocks = radius + 1
    cut = [round(i * 64 / blocks) for i in range(blocks + 1)]
    key = F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.expr(f"shiftrightunsigned(fp, {lo}) & {(1 << (hi - lo)) - 1 if hi - lo < 64 else -1}L").alias("part"))
        for i, (lo, hi) in enumerate(zip(cut, cut[1:]))])
    shards = nodes.select("fp", F.explode(key).alias("k")).select("fp", "k.block", "k.part")
    crowded = settle(shards.groupBy("block", "part").count().where("count > 1"), "shards")
    trees = F.expr(f"cast(ceil(count / {tree}) as int)")
    pieces = F.expr(f"cast(ceil(count / {task_rows}) as int)")
    rows = int(crowded.agg(F.sum(F.col("count") * (trees + pieces - 1))).first()[0] or 0)
    n = buckets(rows, task_rows)
    dealt = (
        shards.join(crowded, ["block", "part"])
        .withColumn("own", F.pmod(F.xxhash64("fp"), trees).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("fp", F.lit("piece")), pieces).cast("int"))
        # A member asks every tree, in its own piece, and stands in its own tree, in every piece.
        .withColumn("at", F.explode(F.array_distinct(F.concat(
            F.transform(F.sequence(F.lit(0), trees - 1), lambda t: F.struct(t.alias("tree"), F.col("mine").alias("piece"))),
            F.transform(F.sequence(F.lit(0), pieces - 1), lambda p: F.struct(F.col("own").alias("tree"), p.alias("piece")))))))
        .select(F.xxhash64("block", "part", "at.tree", "at.piece").alias("tree"), "fp",
                (F.col("own") == F.col("at.tree")).alias("inside"), (F.col("mine") == F.col("at.piece")).alias("asks")))
    return (dealt.withColumn("bucket", F.pmod("tree", F.lit(n)))
            .groupBy("bucket").applyInArrow(_stars(radius), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (a, b): the smallest node reachable.
    Alternates large and small stars until an edge list repeats itself."""
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a != b").distinct()
        edges = settle(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(20, 0)))")).first()
        if now == mark or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    radius: int = 2, seed: int = 42, tree: int = TREE) -> DataFrame:
    """One row per input row: its id, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id reachable over links of at most ``radius`` differing bits.

    Shingles of ``words`` words, lower-cased in ASCII; a shorter text is one shingle, a text
    without words (null or empty too) has fingerprint zero and links like any other. Null ids
    are never the smallest; a component of only null ids has a null ``component_id``.
    Repeated rows each return. An empty table gives an empty result; other columns are
    ignored.
    """
    prints, of_print = _grouped(docs, id_col, text_col, words, radius, seed, tree)
    lowest = of_print.groupBy("root").agg(F.min("least.id").alias("component_id"))
    of_print = settle(of_print.join(lowest, "root").select("fp", "component_id"), "components")
    # Both sides are files: adaptive execution splits a fingerprint that many rows share.
    return prints.join(of_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs, id_col, text_col, words, radius, seed, tree) -> tuple[DataFrame, DataFrame]:
    """Rows (id, th, fp), and per fingerprint its least row, known ids first, and its root."""
    prints = settle(fingerprints(docs, id_col, text_col, words, seed), "prints")
    row = F.struct(F.col("id").isNull().alias("unknown"), "id", "th")
    nodes = settle(prints.groupBy("fp").agg(F.min(row).alias("least")), "nodes")
    stars = components(link_stars(nodes, radius, tree))
    return prints, nodes.join(stars, nodes.fp == stars.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                         radius: int = 2, seed: int = 42, tree: int = TREE) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest known id, of equal
    ids the one with the smaller text hash, of rows that repeat id and text any one."""
    prints, of_print = _grouped(docs, id_col, text_col, words, radius, seed, tree)
    least = of_print.groupBy("root").agg(F.min("least").alias("least")).select("least.id", "least.th")
    return keep_rows(docs, prints, least, id_col, text_col)


def keep_rows(docs: DataFrame, prints: DataFrame, least: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` named by ``least`` (id, th), once each; ``prints`` has id and th of all rows."""
    of, th = fresh(docs, "of", "th")
    keep = settle(least.select("id", "th"), "keepers").toDF(of, th)
    kept = docs.join(keep, col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(whole_text(text_col)) == F.col(th)), "left_semi")
    twice = prints.groupBy("id", "th").count().where("count > 1")
    if twice.isEmpty():
        return kept
    return kept.withColumn(th, F.xxhash64(whole_text(text_col))).dropDuplicates([id_col, th]).drop(th)


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))
