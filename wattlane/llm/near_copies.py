"""Near copies by shingle Jaccard: MinHash bands propose, the shingle sets decide.

A text is the set of the hashes of its five-word shingles. Sixty-four bits of SimHash cannot
tell 0.8: such pairs differ by about 10 bits, and pigeonhole blocks for that radius are a few
bits wide. So candidates are the sets that share one of ``BANDS`` bands of ``ROWS`` minima;
a pair at 0.8 shares none with a chance of (1 - 0.8 ** 6) ** 32, or 6 in 100,000.

Candidates are compared in two rounds, which keep a large group of copies linear. First every
member of a band meets the least member of that band. Then, in bands whose members are not
all connected yet, members of different components meet if they share one of their rarest
shingles: two sets at 0.8 have more than 0.8 of their shingles in common, so whatever order
all sets are read in, the first fifth of each holds a common one. With rare shingles first,
texts that merely share a passage do not meet at all. In a few turns each set first meets one
of another component only, which joins most of a large group; then the rest meet. Each pair is confirmed by the exact
Jaccard similarity of the two sets, and components are those of the confirmed pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import col, whole_text
from wattlane.llm.simhash import LOWER, components, keep_rows
from wattlane.session import settle

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
#: Turns in which sets meet one other each, before those still apart meet in pairs.
TURNS = 3

_draw = np.random.default_rng(42)
FACTORS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the shingles; a shorter text is one shingle, a text without words none."""
    found = text.translate(LOWER).split()
    digest, known = xxhash.xxh64_intdigest, {}
    h = np.fromiter((known.get(w) or known.setdefault(w, digest(w)) for w in found), np.uint64, len(found))
    wide = min(words, len(found))
    if not wide:
        return h
    out = np.zeros(len(h) - wide + 1, np.uint64)
    for i in range(wide):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i:len(h) - wide + 1 + i]
    out ^= out >> np.uint64(32)
    return np.unique(out * np.uint64(0x94D049BB133111EB))


def bands(found: np.ndarray) -> list[int]:
    """One signed key per band; none for an empty set."""
    if not len(found):
        return []
    least = np.full(len(FACTORS), np.uint64((1 << 64) - 1))
    for i in range(0, len(found), 1024):
        least = np.minimum(least, (found[i:i + 1024, None] * FACTORS + OFFSETS).min(axis=0))
    return [xxhash.xxh64_intdigest(least[i * ROWS:(i + 1) * ROWS].tobytes(), i) - (1 << 63) for i in range(BANDS)]


def _name(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("found").alias("fa")).hint("merge"), "a") \
        .join(sets.select(F.col("sid").alias("b"), F.col("found").alias("fb")).hint("merge"), "b")
    shared = F.size(F.array_intersect("fa", "fb"))
    return both.where(shared >= similarity * (F.size("fa") + F.size("fb") - shared)).select("a", "b")


def rare_shingles(loose: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``s, sid, n``: of each set of ``loose`` (sid, n), read by rising frequency, the first shingles, of which
    it shares one with any set this similar."""
    tokens = loose.join(sets.hint("merge"), "sid").select("sid", "n", F.explode("found").alias("s"))
    often = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("often"))
    lead = F.col("n") - F.ceil(similarity * F.col("n") - 1e-9) + 1
    return settle(tokens.join(often.hint("merge"), "s").groupBy("sid", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "s"))).alias("all"))
        .select("sid", "n", F.explode(F.slice("all", F.lit(1), lead.cast("int"))).alias("x"))
        .where("x.often > 1").select("x.s", "sid", "n"), "rare")


def _mixed(rare: DataFrame, stars: DataFrame) -> DataFrame:
    """``s, sid, n, root`` where sets of different roots share the shingle."""
    placed = settle(rare.join(stars.hint("merge"), rare.sid == stars.node, "left").select(
        "s", "sid", "n", F.coalesce("root", "sid").alias("root")), "rare")
    mixed = placed.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("s")
    return settle(placed.join(mixed.hint("merge"), "s"), "mixed")


def star_pairs(mixed: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Pairs ``a, b``: every set with one that shares the shingle and has another root. Which one that is
    depends on a hash of the sets and the turn, so each turn tries others."""
    place = F.struct(F.xxhash64("sid", F.lit(turn)).alias("h"), "sid", "n", "root")
    least = mixed.groupBy("s").agg(F.min(place).alias("one"))
    led = settle(mixed.join(least.hint("merge"), "s"), "led")
    second = led.where(F.col("root") != F.col("one.root")).groupBy("s").agg(F.min(place).alias("two"))
    other = F.when(F.col("root") != F.col("one.root"), F.col("one")).otherwise(F.col("two"))
    return led.join(second.hint("merge"), "s").select("sid", "n", other.alias("o")).where(_close(F.col("n"), F.col("o.n"), similarity)).select(
        F.least("sid", "o.sid").alias("a"), F.greatest("sid", "o.sid").alias("b")).distinct()


def rare_pairs(mixed: DataFrame, similarity: float) -> DataFrame:
    """All pairs ``a, b`` of different roots that share a shingle."""
    x, y = (mixed.select("s", *[F.col(c).alias(c + e) for c in ("sid", "n", "root")]) for e in ("_a", "_b"))
    return x.join(y.hint("merge"), "s").where(
        (F.col("sid_a") < F.col("sid_b")) & (F.col("root_a") != F.col("root_b")) & _close(F.col("n_a"), F.col("n_b"), similarity)
    ).select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()


def _close(m, n, similarity: float):
    """Sets whose sizes are further apart cannot be similar enough."""
    return F.least(m, n) >= similarity * F.greatest(m, n)


def near_copy_roots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: float = SIMILARITY) -> DataFrame:
    """``id, th, root``: rows with one ``root`` are near copies, linked by pairs of at least ``similarity``."""
    texts = docs.select(col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("th", F.xxhash64("text"))

    def sign(batches):
        for batch in batches:
            sets = [shingles(t or b"", words) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_name(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64()))],
                ["id", "th", "sid", "n", "bands"])

    def spell(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                sets = [shingles(t or b"", words) for t in batch.column(0)[i:i + 256].cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_name(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["sid", "found"])

    prints = settle(texts.select("id", "th", "text").mapInArrow(sign, T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("th", T.LongType()), T.StructField("sid", T.BinaryType()),
        T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])), "prints")
    nodes = prints.groupBy("sid").agg(F.first("n").alias("n"), F.min("th").alias("th"), F.first("bands").alias("bands"))
    members = settle(nodes.select("sid", "n", "th", F.explode("bands").alias("band")), "members")
    shared = settle(members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("sid", "n")).alias("first"))
                    .where("size > 1").select("band", "first"), "shared")
    members = settle(members.join(shared.hint("merge"), "band"), "crowded")
    wanted = members.select("th").distinct()
    sets = settle(texts.join(wanted.hint("merge"), "th", "left_semi").select("text")
                  .mapInArrow(spell, "sid binary, found array<bigint>").dropDuplicates(["sid"]), "sets")

    first = members.where((F.col("sid") != F.col("first.sid")) & _close(F.col("n"), F.col("first.n"), similarity)) \
        .select(F.col("first.sid").alias("a"), F.col("sid").alias("b")).distinct()
    edges = settle(_confirmed(first, sets, similarity), "links")
    stars = components(edges)

    placed = settle(members.join(stars.hint("merge"), members.sid == stars.node, "left").select(
        "band", "sid", "n", F.coalesce("root", "sid").alias("root"), (F.col("sid") == F.col("first.sid")).alias("met")), "placed")
    rest = placed.where("not met")
    open_ = settle(rest.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                   .where("low != high").select("band"), "open")
    loose = settle(rest.join(open_.hint("merge"), "band").select("sid", "n").distinct(), "loose")
    rare = rare_shingles(loose, sets, similarity)
    mixed = _mixed(rare, stars)
    # A group of copies that the first round left in parts grows together by stars, whose number grows with
    # the sets and not with their pairs; what is still apart then meets pair by pair.
    for turn in range(TURNS):
        more = settle(_confirmed(star_pairs(mixed, similarity, turn), sets, similarity), "links")
        if more.isEmpty():
            break
        edges = edges.unionByName(more)
        stars = components(edges)
        mixed = _mixed(rare, stars)
    more = settle(_confirmed(rare_pairs(mixed, similarity), sets, similarity), "links")
    if not more.isEmpty():
        stars = components(edges.unionByName(more))
    return settle(prints.select("id", "th", "sid").join(stars.hint("merge"), F.col("sid") == stars.node, "left")
                  .select("id", "th", F.coalesce("root", "sid").alias("root")), "roots")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                     similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near copies, with all its columns, chosen as ``drop_near_duplicates`` does.

    Words are lower-cased in ASCII; texts without words (null or empty too) are copies of each other.
    An empty table gives an empty result.
    """
    roots = near_copy_roots(docs, id_col, text_col, words, similarity)
    least = roots.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "th")).alias("least"))
    return keep_rows(docs, roots, least.select("least.id", "least.th"), id_col, text_col)
