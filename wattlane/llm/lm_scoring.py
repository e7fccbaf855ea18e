"""Language-model scores by a weighted backoff automaton.

States are the n-grams a text can end in, arcs carry the log-probability of a word in a
state, and a failure arc leads from a state to that of one word less, at the weight the
smoothing leaves for words unseen there. Reading a text is one traversal from left to
right: take the word's arc if the state has one, else follow failure arcs, adding up.

The automaton of a corpus grows with the corpus, so no task holds it whole. Documents are
cut into blocks of bounded bytes, each written once as a list of its distinct words and the
sequence of their numbers. A block sends its distinct n-grams, with its training counts,
to shards of bounded size; a shard adds up the counts of all blocks and answers each block
in the order it asked, so answers are bare counts. Of the n-grams of three words and more only
those are asked for whose two parts are known to other blocks: the others occur nowhere
else. From the answers a block compiles the slice of the automaton that its texts can
reach, and walks all its texts through it at once.

Words are matched by their bytes; longer n-grams by 64-bit names chained along their words.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import buckets, col, documents, held_out, query, whole_text
from wattlane.session import settle

#: Bytes of text in a block, entries of a shard, and tokens walked before a text is cut.
BLOCK_BYTES = 4 << 20
SHARD_ENTRIES = 1 << 20
PIECE = 256
#: What smoothing adds to an n-gram's context, for contexts of one word, two words and so on.
STRENGTH = (100.0, 30.0)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _zipped(data: bytes) -> bytes:
    return struct.pack("<q", len(data)) + pa.Codec("zstd").compress(data, asbytes=True)


def _unzipped(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], decompressed_size=struct.unpack("<q", blob[:8])[0], asbytes=True)


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, the ones that are always zero left out, zipped."""
    numbers = numbers.astype("<u8")
    width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
    planes = numbers.view(np.uint8).reshape(-1, 8).T[:width]
    return struct.pack("<qb", len(numbers), width) + _zipped(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    n, width = struct.unpack("<qb", blob[:9])
    planes = np.zeros((8, n), np.uint8)
    planes[:width] = np.frombuffer(_unzipped(blob[9:]), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()  # of bytes: blanks and \x09 to \x0d


def _blocks(batches):
    """A row per block. Word 0 is the end of a text, which no word of a text equals."""
    block = TaskContext.get().partitionId() << 32
    size, known, ids, held, lengths, sequence = 0, {b"": 0}, [], [], [], []

    def row():
        numbers = np.concatenate(sequence)
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([held], pa.list_(pa.bool_())),
             pa.array([lengths], pa.list_(pa.int64())), pa.array([len(numbers)]), pa.array([_zipped(b"\n".join(known))]), pa.array([pack(numbers)])],
            ["block", "ids", "held", "lengths", "tokens", "words", "sequence"])

    for batch in batches:
        for i, (out, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())):
            found = [known.setdefault(w, len(known)) for w in words_of(text)]
            found.append(0)
            ids.append(batch.column(0).slice(i, 1))
            held.append(out)
            lengths.append(len(found))
            sequence.append(np.array(found, np.int64))
            size += len(text)
            if size >= BLOCK_BYTES:
                yield row()
                block += 1
                size, known, ids, held, lengths, sequence = 0, {b"": 0}, [], [], [], []
    if ids:
        yield row()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Block:
    """The texts of a block: words, sequence of their numbers, starts of the texts in it, and
    for every order the distinct n-grams in ascending order of their names."""

    def __init__(self, words: list[bytes], sequence: np.ndarray, lengths: np.ndarray, held: np.ndarray, order: int):
        self.words, self.sequence, self.lengths = words, sequence, lengths
        self.starts = np.cumsum(lengths) - lengths
        self.names = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
        train = np.repeat(~held, lengths)
        self.counts = [np.bincount(sequence, train, len(words)).astype(np.int64)]
        self.distinct = [self.names]
        #: Which n-gram ends at a position (-1: the text is too short there), and where one first does.
        self.at, self.first = [sequence], [None]
        place = np.arange(len(sequence)) - np.repeat(self.starts, lengths)
        name = self.names[sequence]
        for n in range(2, order + 1):
            longer = np.zeros(len(sequence), np.uint64)
            longer[1:] = _mix(name[:-1], self.names[sequence[1:]])
            name = longer
            here = np.flatnonzero(place >= n - 1)
            distinct, first, inverse = np.unique(name[here], return_index=True, return_inverse=True)
            at = np.full(len(sequence), -1)
            at[here] = inverse
            self.distinct.append(distinct)
            self.at.append(at)
            self.first.append(here[first])
            self.counts.append(np.bincount(inverse, train[here], len(distinct)).astype(np.int64))

    @classmethod
    def read(cls, row: dict, order: int) -> Block:
        return cls(_unzipped(row["words"]).split(b"\n"), unpack(row["sequence"]).astype(np.int64),
                   np.array(row["lengths"], np.int64), np.array(row["held"], bool), order)

    def by_shard(self, n: int, shards: int, which: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
        """The n-grams of order n, or ``which`` of them, as (shard, their numbers), each shard's in a fixed order."""
        which = np.arange(len(self.distinct[n - 1])) if which is None else which
        shard = ((self.distinct[n - 1][which] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        return [(int(shard[part[0]]), which[part]) for part in np.split(order, cuts) if len(part)]

    def open(self, n: int, shared: list[np.ndarray]) -> np.ndarray:
        """The n-grams of order n that other blocks may hold, given which shorter ones they do hold."""
        if n < 3:
            return np.arange(len(self.distinct[n - 1]))
        first, parts, elsewhere = self.first[n - 1], self.at[n - 2], shared[n - 2]
        return np.flatnonzero(elsewhere[parts[first - 1]] & elsewhere[parts[first]])

    def told(self, orders: int, shards: int, answers: list[dict]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Corpus counts of the n-grams of one to ``orders`` words, and whether other blocks hold them."""
        heard = {(a["n"], a["shard"]): a["counts"] for a in answers}
        totals: list[np.ndarray] = []
        shared: list[np.ndarray] = []
        for n in range(1, orders + 1):
            total, elsewhere = self.counts[n - 1].copy(), np.zeros(len(self.counts[n - 1]), bool)
            for shard, part in self.by_shard(n, shards, self.open(n, shared)):
                answer = unpack(heard[n, shard]).astype(np.int64)
                total[part], elsewhere[part] = answer >> 1, answer & 1 > 0
            totals.append(total)
            shared.append(elsewhere)
        return totals, shared


ASKED = "n int, shard long, block long, grams binary, counts binary"


def _questions(block: Block, number: int, n: int, shards: int, shared: list[np.ndarray]) -> pa.RecordBatch:
    parts = block.by_shard(n, shards, block.open(n, shared))
    names = block.distinct[n - 1]
    grams = [_zipped(b"\n".join([block.words[i] for i in part])) if n == 1 else
             pack(np.diff(names[part], prepend=np.uint64(0))) for _, part in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array([n] * len(parts), pa.int32()), pa.array([s for s, _ in parts], pa.int64()),
         pa.array([number] * len(parts), pa.int64()), pa.array(grams, pa.binary()),
         pa.array([pack(block.counts[n - 1][part]) for _, part in parts], pa.binary())],
        ["n", "shard", "block", "grams", "counts"])


def _asked(batches, orders, shards):
    for batch in batches:
        for row in batch.to_pylist():
            block = Block.read(row, orders)
            for n in range(1, orders + 1):
                yield _questions(block, row["block"], n, shards, [])


def _asked_longer(n: int, shards: int):
    def ask(block_rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = block_rows.to_pylist()[0]
        block = Block.read(row, n)
        return pa.Table.from_batches([_questions(block, row["block"], n, shards, block.told(n - 1, shards, answers.to_pylist())[1])])

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """What a shard's n-grams count in all blocks, told to each block, doubled, plus one if other blocks
    hold it; and for words, in a row without a block, how many training tokens and distinct training
    words there are."""
    n, shard = table.column("n")[0].as_py(), table.column("shard")[0].as_py()
    blocks = table.column("block").to_pylist()
    counts = [unpack(x) for x in table.column("counts").to_pylist()]
    if n == 1:
        number: dict[bytes, int] = {}
        asked = [np.array([number.setdefault(w, len(number)) for w in _unzipped(x).split(b"\n")], np.int64)
                 for x in table.column("grams").to_pylist()]
        total = np.zeros(len(number), np.int64)
    else:
        names = [np.cumsum(unpack(x)) for x in table.column("grams").to_pylist()]
        distinct, inverse = np.unique(np.concatenate(names), return_inverse=True)
        asked = np.split(inverse, np.cumsum([len(x) for x in names])[:-1])
        total = np.zeros(len(distinct), np.int64)
    askers = np.zeros(len(total), np.int64)
    for at, c in zip(asked, counts):
        total[at] += c.astype(np.int64)  # a block asks for an n-gram once
        askers[at] += 1
    answers = [pack(2 * total[at] + (askers[at] > 1)) for at in asked]
    tokens, known = [None] * len(blocks), [None] * len(blocks)
    if n == 1:
        blocks, answers = blocks + [None], answers + [None]
        tokens, known = tokens + [int(total.sum())], known + [int((total > 0).sum())]
    return pa.table([pa.array(blocks, pa.int64()), pa.array([n] * len(blocks), pa.int32()), pa.array([shard] * len(blocks), pa.int64()),
                     pa.array(answers, pa.binary()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64())],
                    names=["block", "n", "shard", "counts", "tokens", "known"])


class Automaton:
    """The slice of the automaton that a block's texts reach.

    ``counts`` has, for each order, the corpus counts of the block's n-grams. State 0 is the
    root, which has an arc for every word of the block, known or not; any other state is an
    n-gram that was seen and goes on. The probability of w after h is
    (c(hw) + strength p(w | h less its first word)) / (c(h) + strength): seen n-grams are arcs of that
    weight, the others are reached by failure arcs of weight strength / (c(h) + strength).
    """

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, known: int, strength: tuple[float, ...]):
        order, width = len(counts), len(block.words)
        self.width = width
        p = (counts[0] + 0.5) / (tokens + 0.5 * (known + 1))
        self.base = np.log10(p)
        offset = 1
        word = np.arange(width)
        #: The state in which a text is after the n-gram: its own, or else that of its longest seen end.
        after = np.where((counts[0] > 0) & (word > 0), offset + word, 0) if order > 1 else np.zeros(width, np.int64)
        state = [np.array([0]), after]
        keys, weights, targets = [word], [self.base], [after]
        self.fail, self.cost = [np.array([0])], [np.array([0.0])]
        for n in range(2, order + 1):
            s = strength[min(n, len(strength) + 1) - 2]
            self.fail.append(np.zeros(width, np.int64) if n == 2 else shorter_state)
            self.cost.append(np.log10(s / (counts[n - 2] + s)))
            first = block.first[n - 1]
            context, ending, word = block.at[n - 2][first - 1], block.at[n - 2][first], block.sequence[first]
            p = (counts[n - 1] + s * p[ending]) / (counts[n - 2][context] + s)
            seen = counts[n - 1] > 0
            shorter_state = after[ending]
            if n < order:
                offset += len(counts[n - 2])
                after_longer = np.where(seen & (word > 0), offset + np.arange(len(first)), shorter_state)
            else:
                after_longer = shorter_state
            keys.append(after[context][seen] * width + word[seen])
            weights.append(np.log10(p[seen]))
            targets.append(after_longer[seen])
            after = after_longer
        self.fail, self.cost = np.concatenate(self.fail), np.concatenate(self.cost)
        key = np.concatenate(keys)
        by_key = np.argsort(key, kind="stable")
        self.key, self.weight, self.target = key[by_key], np.concatenate(weights)[by_key], np.concatenate(targets)[by_key]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Reads a word in each state: the next states, and the log-probabilities."""
        score = np.zeros(len(state))
        out = np.zeros(len(state), np.int64)
        open_ = np.arange(len(state))
        while len(open_):
            key = state * self.width + word
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[arc] == key
            score[open_[hit]] += self.weight[arc[hit]]
            out[open_[hit]] = self.target[arc[hit]]
            open_, state, word = open_[~hit], state[~hit], word[~hit]
            score[open_] += self.cost[state]
            state = self.fail[state]
        return out, score

    def read(self, sequence: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: int) -> np.ndarray:
        """Log-probability of each text, all read side by side. A long text is read in pieces; a
        piece walks in over the words before it, after which its state is that of one traversal."""
        pieces = -(-lengths // PIECE)
        text = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[text] + nth * PIECE
        end = np.minimum(begin + PIECE, (starts + lengths)[text])
        at = np.maximum(begin - (order - 1), starts[text])
        by_length = np.argsort(at - end, kind="stable")
        text, begin, end, at = (x[by_length] for x in (text, begin, end, at))
        state, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        for t in range(int((end - at).max(initial=0))):
            open_ = int(np.searchsorted(at - end, -t))  # pieces longer than t come first
            here = at[:open_] + t
            state[:open_], score = self.step(state[:open_], sequence[here])
            total[:open_] += np.where(here >= begin[:open_], score, 0.0)
        return np.bincount(text, total, len(starts))


def _scores(block_rows: pa.Table, answers: pa.Table, order, shards, tokens, known, strength, id_type) -> pa.Table:
    row = block_rows.to_pylist()[0]
    block = Block.read(row, order)
    counts, _ = block.told(order, shards, answers.to_pylist())
    automaton = Automaton(block, counts, tokens, known, strength)
    sums = np.add.reduceat
    n_docs = len(block.lengths)
    return pa.table([pa.array(row["ids"], id_type), pa.array(row["held"]), pa.array(block.lengths),
                     pa.array(sums((counts[0] > 0).astype(np.int64)[block.sequence], block.starts)),
                     pa.array(np.full(n_docs, tokens)), pa.array(sums(automaton.base[block.sequence], block.starts)),
                     pa.array(automaton.read(block.sequence, block.starts, block.lengths, order))],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3,
              strength: tuple[float, ...] = STRENGTH, modulus: int = 5, remainder: int = 1) -> DataFrame:
    """One row per input row: its id, ``held_out`` (crc32 of the id as text, modulo ``modulus``, is
    ``remainder``; the text was not learnt from), ``n_tokens`` (words and one end), ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` (words by themselves) and
    ``score``, the log10 probability of the text under n-grams of ``order`` words.

    Every training text counts, every n-gram of it is kept. Null text counts as empty: the end
    alone. A null id is never held out. Repeated rows each count and each return. If nothing is
    left to learn from, every token has the same probability. An empty table gives an empty
    result; other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if order < 1 or not strength or min(strength) <= 0:
        raise ValueError("order and strength must be positive")
    id_type = docs.schema[id_col].dataType
    rows = docs.select(col(id_col).alias("id"), held_out(id_col, modulus, remainder).alias("held"), whole_text(text_col).alias("text"))
    block_row = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("held", T.ArrayType(T.BooleanType())),
        T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("tokens", T.LongType()),
        T.StructField("words", T.BinaryType()), T.StructField("sequence", T.BinaryType())])
    # Written once: a block stays the same whatever is recomputed later.
    blocks = settle(rows.mapInArrow(_blocks, block_row), "blocks")
    shards = buckets(blocks.agg(F.sum("tokens")).first()[0] or 0, SHARD_ENTRIES)
    answered = "block long, n int, shard long, counts binary, tokens long, known long"
    asked = blocks.mapInArrow(lambda b: _asked(b, min(order, 2), shards), ASKED)
    answers = settle(asked.groupBy("n", "shard").applyInArrow(_answer, answered), "answers")
    tokens, known = answers.where("block is null").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    told = answers.where("block is not null").select("block", "n", "shard", "counts")
    for n in range(3, order + 1):
        asked = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_asked_longer(n, shards), ASKED)
        more = settle(asked.groupBy("n", "shard").applyInArrow(_answer, answered), "answers")
        told = told.unionByName(more.select("block", "n", "shard", "counts"))
    arrow_id = to_arrow_type(id_type)
    out = T.StructType([T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
                        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    scored = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        lambda b, a: _scores(b, a, order, shards, tokens, known, strength, arrow_id), out)
    return scored.withColumnRenamed("id", id_col)


@query("op11_lm_scoring", r"""
    WITH table_of AS (
        SELECT list_transform(range(256), lambda i: list_reduce(
            range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
    texts AS (
        SELECT doc_id, xor(list_reduce(range(1, length(s) + 1), lambda c, j: xor(c >> 8, t[(xor(c, ascii(s[j])) & 255) + 1]),
                                       4294967295), 4294967295) % 5 = 1 AS held_out,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x20\x09-\x0D]+') || [''] AS words
        FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents), table_of),
    tokens AS (
        SELECT doc_id, held_out, i, words[i] AS w, words[i - 1] AS v, words[i - 2] AS u
        FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM texts)),
    c1 AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
    c2 AS (SELECT v, w, count(*) AS c FROM tokens WHERE NOT held_out AND i > 1 GROUP BY v, w),
    c3 AS (SELECT u, v, w, count(*) AS c FROM tokens WHERE NOT held_out AND i > 2 GROUP BY u, v, w),
    total AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) AS known FROM c1),
    one AS (
        SELECT t.*, n, coalesce(a.c, 0) AS c_w, (coalesce(a.c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (known + 1)) AS p1
        FROM tokens t LEFT JOIN c1 a USING (w), total),
    two AS (
        SELECT o.*, coalesce(b.c, 0) AS c_vw,
               CASE WHEN i > 1 THEN (coalesce(b.c, 0) + 100 * p1) / (coalesce(a.c, 0) + 100) ELSE p1 END AS p2
        FROM one o LEFT JOIN c2 b USING (v, w) LEFT JOIN c1 a ON a.w = o.v),
    three AS (
        SELECT o.*, CASE WHEN i > 2 THEN (coalesce(d.c, 0) + 30 * p2) / (coalesce(b.c, 0) + 30) ELSE p2 END AS p3
        FROM two o LEFT JOIN c3 d USING (u, v, w) LEFT JOIN c2 b ON b.v = o.u AND b.w = o.v)
    SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(*) FILTER (c_w > 0) AS n_known, any_value(n) AS train_tokens,
           round(sum(log10(p1)), 6) AS base_score, round(sum(log10(p3)), 6) AS score
    FROM three GROUP BY doc_id""")
def op11_lm_scoring(spark, sf_dir):
    scores = lm_scores(documents(spark, sf_dir))
    return scores.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})
