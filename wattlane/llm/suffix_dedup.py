"""Substring deduplication by threshold-bounded interval expansion on Burrows-Wheeler
transforms.

Windows of ``length`` bytes that are equal must meet in one task. Each window is keyed by
the least hash of the grams inside it, so equal windows have equal keys; a run of windows
with one key travels as one segment of text. A key seen once in the corpus cannot belong
to a repeated window, and such segments, the bulk of a clean corpus, never travel. A key
that very many runs share is refined by further hash functions, as often as its count
asks, which splits hot passages exactly: equal windows still have equal keys. What stays
together then and is too much for one transform, the windows that stick out of a hot
passage into many surroundings, is told apart by the digest of each whole window, counted
over the table.

In a task the segments form one text with a separator behind each. From its suffix array
comes the Burrows-Wheeler transform, and backward extension, breadth first, derives the
common prefixes by increasing value: an interval of suffixes starting with some string is
extended to the left by each preceding byte, and where an extension ends at a boundary not
yet known, the boundary's common prefix is the number of rounds so far. The rounds stop at
``length``; boundaries still open then have a common prefix of at least ``length`` and
the suffixes beside them start repeated strings. Segments are deduplicated before they
travel and carry the number of their copies, so an interval that holds one segment of
weight two is a repeat as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import buckets, col, documents, query
from wattlane.session import settle

LENGTH = 400
GRAM = 128
#: Bytes of segments in one transform; windows hashed at a time; runs of a key before it is refined.
TASK_BYTES = 1_500_000
CHUNK = 1 << 18
HOT_RUNS = 1_000
MOST_LEVELS = 16

BASE = np.uint64(0x9E3779B97F4A7C15)
SEPARATOR = 0xFF  # occurs in no UTF-8 text
SPAN_ROWS = "sid binary, begins array<bigint>, stops array<bigint>"


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class WindowKeys:
    """Least gram hashes of all windows of a text, under any number of hash functions."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.wide = length, gram, length - gram + 1
        n = CHUNK + length + 1
        with np.errstate(over="ignore"):
            self.power = np.concatenate([[np.uint64(1)], np.full(n, BASE).cumprod(dtype=np.uint64)])
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.back = np.concatenate([[np.uint64(1)], np.full(n, inverse).cumprod(dtype=np.uint64)])

    def grams(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:len(data)], out=sums[1:])
        return (sums[self.gram:] - sums[:-self.gram]) * self.back[:len(data) - self.gram + 1]

    @staticmethod
    def mix(h: np.ndarray, function: int) -> np.ndarray:
        h = h * np.uint64((0xBF58476D1CE4E5B9 + 2 * function * 0x632BE59BD9B4E019) & ((1 << 64) - 1))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
        return h

    def least(self, h: np.ndarray) -> np.ndarray:
        """Minimum over each ``wide`` neighbours, from running minima of blocks."""
        w = self.wide
        m = len(h) - w + 1
        block = np.concatenate([h, np.full(-len(h) % w, np.uint64((1 << 64) - 1))]).reshape(-1, w)
        ahead = np.minimum.accumulate(block, axis=1).ravel()
        behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(behind[:m], ahead[w - 1:w - 1 + m])

    def runs(self, text: bytes):
        """Yields keys, starts, ends (of window starts) and occurrences, piece by piece. A run
        whose key has two places counts two: it may repeat a window by itself."""
        data = np.frombuffer(text, np.uint8)
        last = len(data) - self.length + 1
        for at in range(0, max(last, 0), CHUNK):
            h = self.mix(self.grams(data[at:min(at + CHUNK, last) + self.length - 1]), 0)
            least = self.least(h)
            cut = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            end = np.append(cut[1:], len(least))
            key = least[cut]
            view = np.lib.stride_tricks.sliding_window_view(h, self.wide)
            left, right = np.empty(len(cut), np.int64), np.empty(len(cut), np.int64)
            for i in range(0, len(cut), 2048):
                s = slice(i, i + 2048)
                left[s] = cut[s] + (view[cut[s]] == key[s, None]).argmax(axis=1)
                right[s] = end[s] + self.wide - 2 - (view[end[s] - 1][:, ::-1] == key[s, None]).argmax(axis=1)
            yield key.view(np.int64), cut + at, end + at, 1 + (left != right)

    def refine(self, text: bytes, start: int, end: int, key: int, levels: int):
        """Cuts a run by ``levels`` more hash functions: (key, start, end) of each part."""
        for at in range(start, end, CHUNK):
            to = min(at + CHUNK, end)
            grams = self.grams(np.frombuffer(text, np.uint8)[at:to + self.length - 1])
            mixed = np.full(to - at, key, np.int64).view(np.uint64)
            for function in range(1, levels + 1):
                mixed = self.mix(mixed ^ self.least(self.mix(grams, function)), function)
            cut = np.flatnonzero(np.concatenate([[True], mixed[1:] != mixed[:-1]]))
            stop = np.append(cut[1:], len(mixed))
            yield from zip(mixed[cut].view(np.int64).tolist(), (cut + at).tolist(), (stop + at).tolist())


def suffix_array(text: np.ndarray, next_separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the rank of each; every separator is a letter of its own, ordered
    by place. Ranks by eight bytes, then doubling of what is still tied."""
    n = len(text)
    packed = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        packed = (packed << np.uint64(8 * shift)) | np.concatenate([packed[shift:], np.zeros(shift, np.uint64)])
    packed = packed[:n]
    gap = next_separator - np.arange(n)
    ends = gap < 8
    packed[ends] &= np.uint64((1 << 64) - 1) << (np.uint64(8) * (7 - gap[ends]).astype(np.uint64))
    order = np.argsort(packed, kind="stable")
    ordered = packed[order]
    lead = np.concatenate([[True], ordered[1:] != ordered[:-1]]) | ends[order]
    del packed, ordered
    first = np.maximum.accumulate(np.where(lead, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    tied = ~lead
    tied[:-1] |= ~lead[1:]
    slots = np.flatnonzero(tied)
    known = 8
    while len(slots):
        held = order[slots]
        key = (rank[held] << 32) | rank[held + known]
        sort = np.argsort(key, kind="stable")
        held, key = held[sort], key[sort]
        order[slots] = held
        lead = np.concatenate([[True], key[1:] != key[:-1]])
        # separators differ, so what ties after doubling has none within reach
        rank[held] = np.maximum.accumulate(np.where(lead, slots, 0))
        tied = ~lead
        tied[:-1] |= ~lead[1:]
        slots = slots[tied]
        known *= 2
    return order, rank


def open_boundaries(text: np.ndarray, order: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Boundaries between suffixes (b: between b - 1 and b) whose common prefix has at least
    ``length`` bytes: those that ``length`` rounds of backward extension leave open."""
    n = len(text)
    before = order - 1
    before[before < 0] = n - 1  # the last place is a separator
    bwt, to = text[before], rank[before]
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    counts = np.bincount(text, minlength=256)
    separators = int(counts[SEPARATOR])
    letters = np.flatnonzero(counts[:SEPARATOR])
    high = np.cumsum(counts[letters])
    low = high - counts[letters]
    single = np.arange(n - separators, n)
    low, high = np.concatenate([low, single]), np.concatenate([high, single + 1])
    for _ in range(length):
        fresh = ~known[high]
        low, high = low[fresh], high[fresh]
        known[high] = True
        if not len(low):
            break
        width = high - low
        one = width == 1
        at = low[one]
        at = at[bwt[at] != SEPARATOR]
        next_low, next_high = to[at], to[at] + 1
        if not one.all():
            low, width = low[~one], width[~one]
            places = np.repeat(low - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
            owner = np.repeat(np.arange(len(low)), width)
            real = bwt[places] != SEPARATOR
            places, owner = places[real], owner[real]
            if len(places):
                target = to[places]
                sort = np.argsort(target)
                target, owner, byte = target[sort], owner[sort], bwt[places][sort]
                lead = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])]))
                next_low = np.concatenate([next_low, target[lead]])
                next_high = np.concatenate([next_high, target[np.append(lead[1:], len(target)) - 1] + 1])
        low, high = next_low, next_high
    return np.flatnonzero(~known)


def covered(segments: list[bytes], weights: list[int], length: int) -> list[tuple[list[int], list[int]]]:
    """Per segment, the runs of bytes under windows that occur at least twice in all."""
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    separators = np.flatnonzero(text == SEPARATOR)
    sizes = np.diff(separators, prepend=-1)
    segment = np.repeat(np.arange(len(segments)), sizes)
    order, rank = suffix_array(text, separators[segment])
    repeated = np.zeros(len(text), bool)
    b = open_boundaries(text, order, rank, length)
    repeated[order[b]] = True
    repeated[order[b - 1]] = True
    many = np.asarray(weights)[segment] > 1
    repeated |= many & (separators[segment] - np.arange(len(text)) >= length)
    at = np.flatnonzero(repeated)
    if not len(at):
        return [([], []) for _ in segments]
    of = segment[at]
    lead = np.concatenate([[True], (of[1:] != of[:-1]) | (np.diff(at) > length)])
    first = np.flatnonzero(lead)
    start, stop = at[first], at[np.append(first[1:], len(at)) - 1] + length
    base = (separators - sizes + 1)[of[first]]
    out: list[tuple[list[int], list[int]]] = [([], []) for _ in segments]
    for s, a, z in zip(of[first].tolist(), (start - base).tolist(), (stop - base).tolist()):
        out[s][0].append(a)
        out[s][1].append(z)
    return out


def _expand(length: int):
    def run(table: pa.Table) -> pa.Table:
        segments = table.column("segment").to_pylist()
        spans = covered(segments, table.column("copies").to_pylist(), length) if segments else []
        return pa.table({"sid": table.column("sid"), "begins": pa.array([s for s, _ in spans], pa.list_(pa.int64())),
                         "stops": pa.array([e for _, e in spans], pa.list_(pa.int64()))}).filter(
            pa.array([bool(s) for s, _ in spans], pa.bool_()))

    return run


def _union(begins, stops) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(zip(begins, stops)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def _by_digest(segments: DataFrame, length: int) -> DataFrame:
    """The rows of ``_expand`` for segments that are too many for one transform: a window whose
    digest occurs twice in all. Equal windows have one key, so no other segment can hold them."""
    def windows(batches):
        for batch in batches:
            for sid, copies, segment in zip(*(batch.column(c).to_pylist() for c in ("sid", "copies", "segment"))):
                last = len(segment) - length + 1
                for at in range(0, last, CHUNK):
                    places = range(at, min(at + CHUNK, last))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([sid] * len(places), pa.binary()), pa.array([copies] * len(places), pa.int64()),
                         pa.array(places, pa.int64()), pa.array([digest(segment[i:i + length]) for i in places], pa.binary())],
                        ["sid", "copies", "at", "window"])

    def join_windows(batches):
        for batch in batches:
            found = [_union(at, [a + length for a in at]) for at in batch.column("at").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid"), pa.array([[a for a, _ in s] for s in found], pa.list_(pa.int64())),
                 pa.array([[z for _, z in s] for s in found], pa.list_(pa.int64()))], ["sid", "begins", "stops"])

    found = segments.select("sid", "copies", "segment").mapInArrow(windows, "sid binary, copies long, at long, window binary")
    repeats = settle(found.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window"), "windows")
    return (found.join(repeats, "window", "left_semi").groupBy("sid").agg(F.collect_list("at").alias("at"))
            .mapInArrow(join_windows, SPAN_ROWS))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, task_bytes: int = TASK_BYTES, hot_runs: int = HOT_RUNS,
                   with_text: bool = False, stats: dict | None = None) -> DataFrame:
    """One row per input row: its id, ``n_bytes`` (UTF-8), ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept_sha256`` of the bytes left, and with ``with_text`` those bytes
    as ``kept`` (binary: a cut may fall inside a character).

    A byte goes when a ``length``-byte string covers it that also starts anywhere else in the
    table, overlaps included; matches never cross rows. Null text counts as empty; texts
    shorter than ``length`` stay whole. ``stats`` is told the bytes of the largest transform. Ids may be null or repeated: rows are told apart by
    their text alone, and copies of a text share one answer. An empty table gives an empty
    result; other columns are ignored.
    """
    if not 8 <= gram < length:
        raise ValueError("gram must be at least 8 and below length")
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType

    def cut_runs(batches):
        windows = WindowKeys(length, gram)
        for batch in batches:
            ids, sizes, shas, lists = [], [], [], ([], [], [], [])
            for t in batch.column(1).cast(pa.binary()).to_pylist():
                t = t or b""
                parts = list(windows.runs(t))
                for i, to in enumerate(lists):
                    to.append(np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64))
                ids.append(digest(t))
                sizes.append(len(t))
                shas.append(hashlib.sha256(t).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int32())),
                 pa.array(lists[2], pa.list_(pa.int32())), pa.array(lists[3], pa.list_(pa.int32()))],
                ["id", "tid", "n_bytes", "sha", "key", "start", "stop", "places"])

    rows = settle(texts.mapInArrow(cut_runs, T.StructType([
        T.StructField("id", id_type), T.StructField("tid", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("sha", T.StringType()), T.StructField("key", T.ArrayType(T.LongType())),
        *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("start", "stop", "places")]])), "runs")

    # One row per distinct text with its copies: a text that fills the table folds on the map side.
    distinct = rows.groupBy("tid").agg(F.count(F.lit(1)).alias("copies"), F.first("key").alias("key"), F.first("start").alias("start"),
                                       F.first("stop").alias("stop"), F.first("places").alias("places"))
    runs = settle(distinct.select("tid", "copies", F.explode(F.arrays_zip("key", "start", "stop", "places")).alias("r"))
                  .select("tid", "copies", "r.key", "r.start", "r.stop", "r.places"), "keys")
    repeated_keys = settle(runs.groupBy("key").agg(F.sum(F.col("places") * F.col("copies")).alias("n"),
                                                   F.sum(F.col("stop") - F.col("start") + length).alias("bytes"))
                           .where("n > 1"), "repeated")
    levels = F.least(F.greatest(F.ceil(F.log2(F.col("n") / hot_runs)), F.lit(0)), F.lit(MOST_LEVELS)).cast("int")
    # Only segments of such keys may be too much for one transform.
    large = (levels > 0) | (F.col("bytes") > task_bytes)
    candidates = settle(
        runs.join(repeated_keys, "key").groupBy("tid").agg(
            F.max("copies").alias("copies"),
            F.collect_list(F.struct("start", "stop", "key", levels.alias("levels"), large.alias("large"))).alias("runs")), "candidates")

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            found = [(digest(t), press.compress(t)) for t in batch.column(0).cast(pa.binary()).to_pylist()
                     if t is not None and len(t) >= length]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()),
                                              pa.array([x for _, x in found], pa.binary())], ["tid", "packed"])

    packed = texts.select("text").mapInArrow(pack, "tid binary, packed binary").groupBy("tid").agg(F.first("packed").alias("packed"))
    sources = settle(packed.join(candidates, "tid"), "sources")

    def segments_of(batch, larges=(False, True)):
        windows, unpress = None, zstandard.ZstdDecompressor()
        for tid, press, copies, its in zip(*(batch.column(c).to_pylist() for c in ("tid", "packed", "copies", "runs"))):
            its = [run for run in its if run["large"] in larges]
            text = unpress.decompress(press) if its else b""
            for run in its:
                parts = [(run["key"], run["start"], run["stop"])]
                if run["levels"]:
                    windows = windows or WindowKeys(length, gram)
                    parts = windows.refine(text, run["start"], run["stop"], run["key"], run["levels"])
                for key, start, stop in parts:
                    segment = text[start:stop + length - 1]
                    yield tid, copies, key, start, digest(segment), segment

    def cut_segments(large):
        def run(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    found = list(segments_of(batch.slice(i, 256), (large,)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[2] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                         pa.array([x[4] for x in found], pa.binary()), pa.array([x[5] for x in found], pa.binary())],
                        ["key", "copies", "sid", "segment"])

        return run

    def segments_by_key(rows, large):
        return (rows.mapInArrow(cut_segments(large), "key long, copies long, sid binary, segment binary")
                .groupBy("key", "sid", "segment").agg(F.sum("copies").alias("copies")))

    def place_segments(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                found = [(t, s, d) for t, _, _, s, d, _ in segments_of(batch.slice(i, 256))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.int64()),
                     pa.array([x[2] for x in found], pa.binary())], ["tid", "at", "sid"])

    total = int(candidates.select(F.explode("runs").alias("r")).agg(
        F.sum(F.col("r.stop") - F.col("r.start") + length - 1)).first()[0] or 0)
    segments, apart = segments_by_key(sources, False), None
    if not repeated_keys.where(large).isEmpty():
        candid = settle(segments_by_key(sources.where(F.exists("runs", lambda r: r["large"])), True), "large")
        crowded = settle(candid.groupBy("key").agg(F.sum(F.octet_length("segment") + 1).alias("n"))
                         .where(F.col("n") > task_bytes).select("key"), "crowded")
        segments = segments.unionByName(candid.join(crowded, "key", "left_anti"))
        apart = _by_digest(candid.join(crowded, "key", "left_semi"), length)
    segments = segments.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets(total, task_bytes))))
    if stats is not None:  # bytes of the largest transform
        stats["largest"] = segments.groupBy("bucket").agg(F.sum(F.octet_length("segment") + 1).alias("n")).agg(F.max("n")).first()[0]
    spans = segments.groupBy("bucket").applyInArrow(_expand(length), SPAN_ROWS)
    spans = settle(spans if apart is None else spans.unionByName(apart), "spans")
    placed = sources.mapInArrow(place_segments, "tid binary, at long, sid binary").join(spans, "sid").select(
        "tid", F.expr("transform(begins, x -> x + at)").alias("begins"), F.expr("transform(stops, x -> x + at)").alias("stops"))
    cuts = settle(placed.groupBy("tid").agg(F.flatten(F.collect_list("begins")).alias("begins"),
                                            F.flatten(F.collect_list("stops")).alias("stops")), "cuts")

    def cut_texts(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            for press, begins, stops in zip(*(batch.column(c).to_pylist() for c in ("packed", "begins", "stops"))):
                text, gone = unpress.decompress(press), _union(begins, stops)
                edges = [0, *[e for pair in gone for e in pair], len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))
                found.append((len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            a, b, c, d = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()), pa.array(d, pa.binary())],
                ["tid", "n_removed", "n_spans", "cut_sha", "cut"])

    answers = settle(
        sources.select("tid", "packed").join(cuts, "tid")
        .mapInArrow(cut_texts, "tid binary, n_removed long, n_spans long, cut_sha string, cut binary"), "answers")
    out = rows.select("id", "tid", "n_bytes", "sha").join(answers, "tid", "left")
    result = [F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
              F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256")]
    if not with_text:
        return out.select(*result)
    whole = texts.select(F.coalesce("text", F.lit("")).cast("binary").alias("whole"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    whole = whole.groupBy("sha").agg(F.first("whole").alias("whole"))
    return out.join(whole, "sha").select(*result, F.coalesce("cut", "whole").alias("kept"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    return repeated_spans(documents(spark, sf_dir))
