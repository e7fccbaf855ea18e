"""A prefix trie over conversations, found with vertical bitmaps.

Conversations are dealt to shards of bounded size. A shard indexes (position, turn) to a
bitset of its conversations. Its trie is walked depth first: a node is the bitset of its
members, and intersecting it with the postings of the next position gives the children,
popcounts the members, and intersecting it with the conversations of that length the ends.
A node is named by a digest chained along its turns, so the nodes of all shards meet by
name: members are added up, however many shards a common beginning has.

Sums over subtrees take one pass for each power of two up to the greatest depth: every
node carries the names of its ancestors 1, 2, 4, ... levels up, and in pass k adds what it
has to the ancestor 2^k above, a counting aggregate combined on the map side. The ids that
end in a node are streamed in order through one digest and never gathered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.llm.common import buckets, col, query
from wattlane.session import settle

#: About how many turns a shard holds.
SHARD_TURNS = 20_000

ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv, pos, key, n_bytes``: the turns of each conversation numbered from 1.

    Order is by turn, null first, equal turns by role and text; a null role or text is empty.
    ``key`` is the md5 digest of role and text, ``n_bytes`` the UTF-8 length of the text. Rows
    without a conversation id belong to no conversation.
    """
    role, text = F.coalesce(col(role_col), F.lit("")), F.coalesce(col(text_col), F.lit(""))
    rows = conversations.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select(
        "conv", F.row_number().over(order).cast("long").alias("pos"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))).alias("key"),
        F.octet_length("text").cast("long").alias("n_bytes"))


def _borrowed(conv: Column) -> Column:
    """How many turns a conversation takes over from the first of its family."""
    return F.crc32(conv.cast("string")) % 9


def spliced(turns: DataFrame, family: int = 5) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % ``family``, h being crc32
    of the decimal id modulo 9, then the own turns after the first h. A conversation that is
    left without a turn stays as one row of position 0 without a key."""
    ids = turns.select("conv").distinct().withColumn("h", _borrowed(F.col("conv")))
    lead = turns.where("pos <= 8").withColumnRenamed("conv", "first")
    taken = ids.withColumn("first", F.col("conv") - F.col("conv") % family).join(lead, "first").where("pos <= h").select(
        "conv", F.lit(0).alias("part"), "pos", "key", "n_bytes")
    own = turns.where(F.col("pos") > _borrowed(F.col("conv"))).select("conv", F.lit(1).alias("part"), "pos", "key", "n_bytes")
    return taken.union(own).union(_bare(ids))


def _bare(ids: DataFrame) -> DataFrame:
    """A row for each conversation, whether or not it has turns."""
    return ids.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"),
                      F.lit(0).cast("long").alias("n_bytes"))


def bits(members: int) -> list[int]:
    """The places of the bits set, ascending."""
    data = np.frombuffer(members.to_bytes((members.bit_length() + 7) // 8 or 1, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()


def walk(convs: list[int], turns: list[list[int]], keys: list[bytes], sizes: list[int]):
    """The nodes of one shard's trie, depth first. ``turns`` has, for each of the ascending
    ``convs``, its turns as numbers into ``keys`` and ``sizes``. Yields name, depth, names of the
    ancestors 1, 2, 4, ... levels up, members, smallest member, bytes of the last text, ids ending here."""
    postings: dict[tuple[int, int], int] = {}
    length: dict[int, int] = {}
    for i, seq in enumerate(turns):
        length[len(seq)] = length.get(len(seq), 0) | 1 << i
        for at in enumerate(seq):
            postings[at] = postings.get(at, 0) | 1 << i
    path: list[bytes] = []
    stack = [((1 << len(convs)) - 1, 0, ROOT, 0)] if convs else []
    while stack:
        members, depth, name, size = stack.pop()
        path[depth:] = [name]
        ancestors, step = [], 1
        while step <= depth:
            ancestors.append(path[depth - step])
            step *= 2
        ending = members & length.get(depth, 0)
        yield (name, depth, ancestors, members.bit_count(), convs[(members & -members).bit_length() - 1], size,
               [convs[i] for i in bits(ending)])
        left = members ^ ending
        while left:
            turn = turns[(left & -left).bit_length() - 1][depth]
            child = left & postings[depth, turn]
            left ^= child
            stack.append((child, depth + 1, hashlib.blake2b(name + keys[turn], digest_size=16).digest(), sizes[turn]))


NODE = "node binary, depth long, up array<binary>, n_convs long, conv long, n_bytes long, ends array<long>"


def _shard_nodes(table: pa.Table) -> pa.Table:
    table = table.sort_by([("conv", "ascending"), ("part", "ascending"), ("pos", "ascending")])
    coded = table.column("key").combine_chunks().dictionary_encode()
    keys = coded.dictionary.to_pylist()
    real = np.flatnonzero(table.column("part").to_numpy() >= 0)
    number = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    sizes = np.zeros(len(keys), np.int64)
    sizes[number[real]] = table.column("n_bytes").to_numpy()[real]
    convs, place = np.unique(table.column("conv").to_numpy(), return_inverse=True)
    cuts = np.cumsum(np.bincount(place[real], minlength=len(convs)))[:-1]
    turns = [x.tolist() for x in np.split(number[real], cuts)]
    rows = list(walk(convs.tolist(), turns, keys, sizes.tolist()))
    kinds = [pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                    names=["node", "depth", "up", "n_convs", "conv", "n_bytes", "ends"])


def _end_digests(batches):
    """Digest of the comma-joined ids of each node; rows come in order of node and id."""
    node, digest = None, None
    for batch in batches:
        names, ids = batch.column(0), batch.column(1).to_pylist()
        done_names, done = [], []
        for i, name in enumerate(names.to_pylist()):
            if name != node:
                if digest is not None:
                    done_names.append(node)
                    done.append(digest.hexdigest())
                node, digest = name, hashlib.sha256(str(ids[i]).encode())
            else:
                digest.update(b",%d" % ids[i])
        yield pa.RecordBatch.from_arrays([pa.array(done_names, pa.binary()), pa.array(done, pa.string())], ["node", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct beginning of the conversations in ``turns`` (conv, part, pos, key,
    n_bytes; turns are in order of part and pos, and part -1 only names a conversation):
    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, members but one times the
    bytes of the last text), ``ends_sha256`` of the ids that end in the node, and ``node`` and
    ``parent``, hex names.

    Names are 128-bit digests. A conversation is held, as 16 bytes a turn, by one task. Rows that
    repeat a turn are turns of their own. Without conversations there is no node, not even a root.
    """
    turns = settle(turns, "spliced")
    n = buckets(turns.count(), shard_turns)
    dealt = turns.withColumn("shard", F.pmod(F.xxhash64("conv"), F.lit(n)))
    parts = settle(dealt.groupBy("shard").applyInArrow(_shard_nodes, NODE), "parts")
    nodes = settle(parts.groupBy("node", "depth", "up", "n_bytes").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv")), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("up")[0].alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    joined = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    sums = settle(joined.select("node", "up", "n_children", (F.col("n_children") == 0).cast("long").alias("leaves"),
                                ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")), "sums")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for k in range(deepest.bit_length()):
        below = sums.where(F.size("up") > k).groupBy(F.col("up")[k].alias("node")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        sums = settle(sums.join(below, "node", "left").select(
            "node", "up", "n_children", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "sums")
    ends = parts.select("node", F.explode("ends").alias("conv")).repartition("node").sortWithinPartitions("node", "conv").mapInArrow(
        _end_digests, "node binary, ends_sha256 string")
    # Both sides are files: adaptive execution splits a parent of many children.
    named = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (nodes.withColumn("parent", F.when(F.col("depth") > 0, F.col("up")[0])).join(named, "parent", "left")
            .join(sums.drop("up"), "node").join(ends, "node", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
                    F.lower(F.hex("node")).alias("node"), F.lower(F.hex("parent")).alias("parent")))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of a table of turns as it stands; see ``ordered_turns`` and ``prefix_trie``.
    Other columns are ignored, whatever their names."""
    turns = settle(ordered_turns(conversations, conv_col, turn_col, role_col, text_col), "turns")
    said = turns.select("conv", F.lit(1).alias("part"), "pos", "key", "n_bytes")
    return prefix_trie(said, shard_turns)


@query("op12_conversation_trie", """
    WITH table_of AS (
        SELECT list_transform(range(256), lambda i: list_reduce(
            range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT conv_id, xor(list_reduce(range(1, length(s) + 1), lambda c, j: xor(c >> 8, t[(xor(c, ascii(s[j])) & 255) + 1]),
                                        4294967295), 4294967295) % 9 AS h
        FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM turns), table_of),
    spliced AS (
        SELECT i.conv_id, 0 AS part, b.pos, b.role, b.text
        FROM ids i JOIN turns b ON b.conv_id = i.conv_id - i.conv_id % 5 AND b.pos <= i.h
        UNION ALL
        SELECT t.conv_id, 1, t.pos, t.role, t.text FROM turns t JOIN ids i ON i.conv_id = t.conv_id AND t.pos > i.h),
    said AS (
        SELECT i.conv_id, coalesce(list(md5(strlen(role) || ':' || role || text) ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS keys,
               coalesce(list(strlen(text) ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS sizes
        FROM ids i LEFT JOIN spliced s ON s.conv_id = i.conv_id GROUP BY i.conv_id),
    prefixes AS (
        SELECT conv_id, depth, md5(array_to_string(keys[1:depth], '')) AS path, len(keys) = depth AS ends,
               CASE WHEN depth > 0 THEN md5(array_to_string(keys[1:depth - 1], '')) END AS up,
               CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS n_bytes
        FROM (SELECT conv_id, keys, sizes, unnest(range(len(keys) + 1)) AS depth FROM said)),
    nodes AS (
        SELECT path, depth, up, n_bytes, count(*) AS n_convs, min(conv_id) AS conv_id,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM prefixes GROUP BY path, depth, up, n_bytes),
    kids AS (SELECT up AS path, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
    valued AS (
        SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n_convs - 1) * n.n_bytes AS saved
        FROM nodes n LEFT JOIN kids k USING (path)),
    sums AS (
        SELECT p.path, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(v.saved) AS saved
        FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.path)
    SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, CAST(v.n_children AS BIGINT) AS n_children,
           CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, v.ends_sha256
    FROM valued v JOIN sums s USING (path) LEFT JOIN nodes u ON u.path = v.up""")
def op12_conversation_trie(spark, sf_dir):
    turns = settle(ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    return prefix_trie(spliced(turns)).drop("node", "parent")
