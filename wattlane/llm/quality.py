"""Quality classifier: a generalised additive model with pairwise interactions.

Spark turns each text into a fixed row of statistics. The model is fitted on a bounded
sample of labelled rows by cyclic boosting: round after round, feature after feature, a
shallow tree over the feature's bins is fitted to the gradient and added, damped, to the
feature's lookup table; then the pairs of features that explain most of what is left get
two-dimensional tables in the same way. Scoring is bin look-ups and additions over whole
batches. The tables are a few thousand numbers whatever the size of the corpus.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import col, documents, held_out, query
from wattlane.session import settle

#: Bound of the labelled sample the model is fitted on.
SAMPLE = 20_000
FEATURES = ["log_bytes", "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "blank_share",
            "line_share", "symbol_share", "mark_share", "shout_share", "pipe_share", "unique_share", "repeat_share",
            "top_share", "odd_end_share", "short_share", "high_byte_share", "punctuation_share", "title_share"]

_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SYMBOL = b"#$%&*+<=>@\\^_`{}~[]/"
_PUNCTUATION = b".,;:?'\"()-"
_HIGH = bytes(range(128, 256))
_ENDS = re.compile(rb"[^\w\s.,;:?!'\")\x80-\xff](?=\s|$)")


def statistics(text: bytes) -> list[float]:
    """The features of a text; every one is defined for an empty text too."""
    n, words = len(text), text.split()
    k = len(words)
    each = max(n, 1), max(k, 1)
    without = lambda letters: n - len(text.translate(None, letters))
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    letters = n - without(b" \t\r\n\x0b\x0c")
    return [
        math.log1p(n), math.log1p(k), letters / each[1], math.log1p(max(map(len, words), default=0)),
        without(_UPPER) / each[0], without(_DIGIT) / each[0], (n - letters) / each[0], text.count(b"\n") / each[1],
        without(_SYMBOL) / each[0], text.count(b"!") / each[1], sum(map(bytes.isupper, words)) / each[1],
        text.count(b"|") / each[1], len(distinct) / each[1], repeats / each[1], max(distinct.values(), default=0) / each[1],
        len(_ENDS.findall(text)) / each[1], sum(len(w) < 3 for w in words) / each[1], without(_HIGH) / each[0],
        without(_PUNCTUATION) / each[0], sum(map(bytes.istitle, words)) / each[1]]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``x``, the features of the whole text; null counts as empty."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            rows = [statistics(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], [id_col, "x"])

    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features; their sum is a logit."""

    bins: int = 48
    rounds: int = 120
    pairs: int = 8
    pair_rounds: int = 40
    pair_bins: int = 8
    rate: float = 0.1
    leaves: int = 3
    ridge: float = 5.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    base: float = 0.0

    def _binned(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A step function over ordered bins: splits by gain until ``leaves`` remain."""
        cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
        value = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + self.ridge)
        cuts = [0, len(g)]
        while len(cuts) <= self.leaves:
            best = (1e-9, None)
            for a, b in zip(cuts, cuts[1:]):
                at = np.arange(a + 1, b)
                if len(at):
                    gain = value(a, at) + value(at, b) - value(a, b)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), a + 1 + i)
            if best[1] is None:
                break
            cuts = sorted([*cuts, best[1]])
        out = np.zeros(len(g))
        for a, b in zip(cuts, cuts[1:]):
            out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + self.ridge)
        return out

    def _pair_tree(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """The best cut of each axis makes four leaves; their values and gain."""
        cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

        def quarters(c):
            a = c[:-1, :-1]
            b, d, e = c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1]
            return a, b, d, e - a - b - d

        qg, qh = quarters(cg), quarters(ch)
        gain = sum(x ** 2 / (y + self.ridge) for x, y in zip(qg, qh))
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        value = [x[i, j] / (y[i, j] + self.ridge) for x, y in zip(qg, qh)]
        out = np.empty_like(g)
        out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = value
        return out, float(gain[i, j]) - float(cg[-1, -1] ** 2 / (ch[-1, -1] + self.ridge))

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        cuts = lambda k: [np.unique(np.quantile(c, np.arange(1, k) / k)) if len(y) else np.empty(0) for c in x.T]
        self.edges, self.coarse = cuts(self.bins), cuts(self.pair_bins)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        if not len(y) or share in (1e-3, 1 - 1e-3):
            return self
        at = self._binned(x, self.edges)
        logit = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j, b in enumerate(at):
                p = 1 / (1 + np.exp(-logit))
                size = len(self.tables[j])
                step = self.rate * self._tree(np.bincount(b, y - p, size), np.bincount(b, p * (1 - p), size))
                self.tables[j] += step
                logit += step[b]
        wide = self._binned(x, self.coarse)
        p = 1 / (1 + np.exp(-logit))

        def grid(i, j, weight):
            shape = len(self.coarse[i]) + 1, len(self.coarse[j]) + 1
            return np.bincount(wide[i] * shape[1] + wide[j], weight, shape[0] * shape[1]).reshape(shape)

        usable = [j for j, e in enumerate(self.coarse) if len(e)]
        gains = {(i, j): self._pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)))[1]
                 for i in usable for j in usable if i < j}
        chosen = sorted(gains, key=lambda k: (-gains[k], k))[:self.pairs]
        self.pair_tables = {k: np.zeros((len(self.coarse[k[0]]) + 1, len(self.coarse[k[1]]) + 1)) for k in chosen}
        for _ in range(self.pair_rounds):
            for i, j in chosen:
                p = 1 / (1 + np.exp(-logit))
                step = self.rate * self._pair_tree(grid(i, j, y - p), grid(i, j, p * (1 - p)))[0]
                self.pair_tables[i, j] += step
                logit += step[wide[i], wide[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.base)
        for table, b in zip(self.tables, self._binned(x, self.edges)):
            logit += table[b]
        wide = self._binned(x, self.coarse)
        for (i, j), table in self.pair_tables.items():
            logit += table[wide[i], wide[j]]
        return 1 / (1 + np.exp(-logit))


def fit_quality(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                sample: int = SAMPLE) -> AdditiveModel:
    """Fitted on at most ``sample`` labelled rows outside the held-out class, chosen by a hash of
    the id. Null labels are passed over; of several labels for an id the largest counts."""
    known = (labels.where(col(label_col).isNotNull() & ~held_out(id_col, 3, 1))
             .groupBy(col(id_col).alias("label_id")).agg(F.max(col(label_col)).alias("label")))
    taken = known.join(features, F.col("label_id") == col(id_col)).select(
        F.xxhash64("label_id", F.lit("quality")).alias("order"), "label_id", "x", "label").orderBy("order", "label_id").limit(sample)
    rows = taken.select("x", "label").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return AdditiveModel().fit(x, rows.column("label").to_numpy().astype(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: its id, ``held_out`` (crc32 of the id as text, modulo 3, is 1; its
    label was not learnt from), ``score`` and ``predicted``.

    Null text counts as empty and is scored like any. A null id is never held out and has no
    label. Repeated rows each return. Without any usable label, or with labels of one kind,
    all scores are the same. An empty table gives an empty result; other columns are ignored.
    """
    features = settle(feature_table(docs, id_col, text_col), "features")
    model = fit_quality(features, labels, id_col, label_col, sample)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], [id_col, "score"])

    return features.mapInArrow(run, schema).select(
        col(id_col), held_out(id_col, 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_quality")
def op8_quality(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
