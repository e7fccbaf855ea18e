"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads bytes forwards and backwards, labels every position and pools the
positions' log probabilities over the document. It is trained in numpy by backpropagation
through time on a bounded sample: pieces of texts from every part of the document, equally
many documents of each language. For prediction every text is cut, whole, into stretches
of ``STEPS`` bytes; the stretches of a batch run side by side, so a step is one matrix
product over thousands of positions and a long document costs what its bytes cost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import col, documents, held_out, query

#: Bound of the sample: documents of each language, and pieces of each document.
DOCS_PER_LANGUAGE = 500
PIECES = 4
STEPS = 48
#: Stretches that run side by side.
SIDE_BY_SIDE = 2048
UNDETERMINED = "und"

LETTER = regex.compile(r"\p{L}")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Direction:
    """One recurrent layer: update and reset gates and candidate, side by side in the columns.
    A byte enters as a row of ``w``; ``u`` maps the state to the gates, ``v`` to the candidate."""

    w: np.ndarray
    u: np.ndarray
    v: np.ndarray

    @classmethod
    def start(cls, hidden: int, rng) -> Direction:
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        return cls(0.3 * init(257, 3 * hidden), init(hidden, 2 * hidden), init(hidden, hidden))

    def forward(self, steps: np.ndarray, keep: bool):
        """States after each step (steps x rows x hidden); with ``keep``, what training needs."""
        k = self.v.shape[0]
        h = np.zeros((steps.shape[1], k), np.float32)
        out = np.empty((len(steps), steps.shape[1], k), np.float32)
        saved = []
        for t, byte in enumerate(steps):
            x = self.w[byte]
            gates = h @ self.u
            gates += x[:, :2 * k]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :k], gates[:, k:]
            c = (r * h) @ self.v
            c += x[:, 2 * k:]
            np.tanh(c, out=c)
            if keep:
                saved.append((byte, h, z, r, c))
            h = h + z * (c - h)
            out[t] = h
        return out, saved

    def backward(self, saved: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of w, u, v given those of the states: backpropagation through time."""
        gw, gu, gv = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.v)
        gh = np.zeros_like(grad[0])
        for t in range(len(saved) - 1, -1, -1):
            byte, h, z, r, c = saved[t]
            gh = gh + grad[t]
            gc = gh * z * (1 - c * c)
            gz = gh * (c - h) * z * (1 - z)
            rh = r * h
            grh = gc @ self.v.T
            gr = grh * h * r * (1 - r)
            gates = np.concatenate([gz, gr], axis=1)
            gv += rh.T @ gc
            gu += h.T @ gates
            np.add.at(gw, byte, np.concatenate([gates, gc], axis=1))
            gh = gh * (1 - z) + grh * r + gates @ self.u.T
        return [gw, gu, gv]


class ByteTagger:
    """The network: two directions and a softmax over languages at every position.
    Byte 256 stands for padding, whose positions count for nothing."""

    PAD = 256

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction.start(hidden, rng), Direction.start(hidden, rng)
        self.out = (rng.standard_normal((2 * hidden + 1, len(languages))) * 0.1).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.u, self.ahead.v, self.back.w, self.back.u, self.back.v, self.out]

    def _forward(self, rows: np.ndarray, keep: bool):
        steps = np.ascontiguousarray(rows.T)
        a, saved_a = self.ahead.forward(steps, keep)
        b, saved_b = self.back.forward(steps[::-1], keep)
        k = a.shape[2]
        logits = a.reshape(-1, k) @ self.out[:k]
        logits += b[::-1].reshape(-1, k) @ self.out[k:2 * k]
        logits += self.out[-1]
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return steps, logits.reshape(*steps.shape, -1), a, b, saved_a, saved_b

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Per row, the sum of its positions' log probabilities."""
        steps, logp, *_ = self._forward(rows, False)
        logp[steps == self.PAD] = 0
        return logp.sum(axis=0)

    def loss_and_gradients(self, rows: np.ndarray, labels: np.ndarray):
        steps, logp, a, b, saved_a, saved_b = self._forward(rows, True)
        real = steps != self.PAD
        n = max(int(real.sum()), 1)
        g = np.exp(logp)
        g[:, np.arange(len(labels)), labels] -= 1
        g *= real[:, :, None] / np.float32(n)
        loss = -float((logp[:, np.arange(len(labels)), labels] * real).sum()) / n
        k = a.shape[2]
        both = np.concatenate([a, b[::-1]], axis=2)
        flat = g.reshape(-1, g.shape[2])
        g_out = np.concatenate([both.reshape(-1, 2 * k).T @ flat, flat.sum(axis=0, keepdims=True)])
        g_both = (flat @ self.out[:2 * k].T).reshape(both.shape)
        return loss, [*self.ahead.backward(saved_a, g_both[:, :, :k]),
                      *self.back.backward(saved_b, g_both[::-1, :, k:]), g_out]

    def fit(self, rows: np.ndarray, labels: np.ndarray, epochs: int = 3, batch: int = 128, rate: float = 0.02,
            least_steps: int = 150, seed: int = 7) -> ByteTagger:
        """Adam over shuffled batches, for ``epochs`` or at least ``least_steps`` steps."""
        rng = np.random.default_rng(seed)
        weights = self.parameters()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        per_epoch = max(1, -(-len(rows) // batch))
        total = max(epochs * per_epoch, least_steps) if len(rows) else 0
        order = np.empty(0, np.int64)
        for step in range(1, total + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(rows))])
            take, order = order[:batch], order[batch:]
            _, grads = self.loss_and_gradients(rows[take], labels[take])
            scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum(float((g * g).sum()) for g in grads)))))
            speed = rate * min(1.0, 2 * (1 - (step - 1) / total))
            for w, g, m, v in zip(weights, grads, first, second):
                g = g * np.float32(scale)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (speed * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Pooled probabilities of each text: the mean over all its positions, sharpened by the
        number of positions up to one stretch, so short texts stay uncertain."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.empty(0, np.int64)
        pieces = -(-sizes // STEPS)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(pieces)[:-1]]), pieces) if len(texts) else owner
        begin = starts[owner] + nth * STEPS
        size = np.minimum(starts[owner] + sizes[owner] - begin, STEPS)
        place = np.arange(STEPS)
        for i in range(0, len(owner), SIDE_BY_SIDE):
            s = slice(i, i + SIDE_BY_SIDE)
            at = begin[s, None] + place
            # As wider numbers first: 256 does not fit into a byte and would wrap to 0.
            rows = np.where(place < size[s, None], data[np.minimum(at, len(data) - 1)].astype(np.int16), self.PAD)
            np.add.at(sums, owner[s], self.log_probabilities(rows))
        pooled = sums / np.maximum(sizes, 1)[:, None] * np.minimum(sizes, STEPS)[:, None]
        pooled -= pooled.max(axis=1, keepdims=True) if len(texts) else 0
        p = np.exp(pooled)
        return p / p.sum(axis=1, keepdims=True)


def training_rows(texts: list[bytes], keys: list[str], pieces: int = PIECES) -> tuple[np.ndarray, np.ndarray]:
    """Stretches at hashed places of whole texts, padded, and the number of each one's text."""
    rows, of = [], []
    for i, (text, key) in enumerate(zip(texts, keys)):
        for p in range(min(pieces, -(-len(text) // STEPS))):
            room = max(len(text) - STEPS, 0) + 1
            at = int.from_bytes(hashlib.blake2b(f"{key}:{p}".encode(), digest_size=8).digest(), "big") % room
            piece = text[at:at + STEPS]
            rows.append(np.concatenate([np.frombuffer(piece, np.uint8), np.full(STEPS - len(piece), ByteTagger.PAD, np.int16)]))
            of.append(i)
    return (np.array(rows, np.int16) if rows else np.empty((0, STEPS), np.int16)), np.array(of, np.int64)


def fit_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = DOCS_PER_LANGUAGE) -> ByteTagger | None:
    """The network fitted on about ``per_language`` documents of each language outside the held-out
    class, chosen by a hash of id and text; None when no document has a language."""
    known = docs.where(col(lang_col).isNotNull() & (F.octet_length(col(text_col)) > 0) & ~held_out(id_col, 5, 0)).select(
        col(id_col).cast("string").alias("id"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return None
    languages = sorted(sizes)
    chance = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("id", "text", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(draw < chance).select("id", "text", "lang").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("id", "ascending"), ("text", "ascending")])
    texts = [t.as_py() for t in rows.column("text").cast(pa.binary())]
    pieces, of = training_rows(texts, [f"{i}" for i in rows.column("id").to_pylist()])
    number = {k: i for i, k in enumerate(languages)}
    labels = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    return ByteTagger(languages).fit(pieces, labels[of] if len(of) else labels)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """One row per input row: its id, ``held_out`` (crc32 of the id as text, modulo 5, is 0; its
    language was not learnt), ``lang_pred`` and ``score``, the pooled probability.

    Text that is null or has no letter is ``und`` with score 0, and so is every text when no
    document has a language. Rows without a language are predicted like others. Ids may be
    null (never held out) or repeated. An empty table gives an empty result; other columns
    are ignored.
    """
    model = fit_language_id(docs, id_col, text_col, lang_col, per_language)
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    return _tag(texts, model, "text", "lang_pred", "score").select(
        F.col("id").alias(id_col), held_out("id", 5, 0).alias("held_out"), "lang_pred", "score")


def tag_languages(docs: DataFrame, lang: str = "lang_pred", score: str = "lang_score", id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` with all their columns, and as ``lang`` and ``score`` what ``language_id``
    gives them, without a join. A column of one of these names in the input is an error."""
    return _tag(docs, fit_language_id(docs, id_col, text_col, lang_col, per_language), text_col, lang, score)


def _tag(docs: DataFrame, model: ByteTagger | None, text_col: str, lang: str, score: str) -> DataFrame:
    names = docs.columns
    if {lang, score} & set(names):
        raise ValueError(f"the input has a column {lang!r} or {score!r} already")
    place = names.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = part.column(place).to_pylist()
                found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                real = [k for k, t in enumerate(texts) if model is not None and t and LETTER.search(t)]
                if real:
                    p = model.predict([texts[k].encode() for k in real])
                    for k, best, row in zip(real, p.argmax(axis=1), p):
                        found[k], scores[k] = model.languages[best], float(row[best])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], schema.names)

    # By place: names with dots or blanks cannot be looked up.
    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, schema)


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    return language_id(documents(spark, sf_dir))
