"""Scores of the backoff automaton against counts kept in plain dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_brute import texts_of

from wattlane.llm import lm_scoring
from wattlane.llm.lm_scoring import STRENGTH, lm_scores


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def brute(rows, order=3, strength=STRENGTH):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows}
    counts = Counter()
    for i, t in rows:
        if not held[i]:
            w = tokens(t)
            counts.update(tuple(w[k:k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    known = sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 0.5) / (total + 0.5 * (known + 1))
        s = strength[len(gram) - 2]
        return (counts[gram] + s * p(gram[1:])) / (counts[gram[:-1]] + s)

    out = []
    for i, t in rows:
        w = tokens(t)
        grams = [tuple(w[max(0, k - order + 1):k + 1]) for k in range(len(w))]
        out.append((i, held[i], len(w), sum(counts[x,] > 0 for x in w), total,
                    sum(math.log10(p((x,))) for x in w), sum(math.log10(p(g)) for g in grams)))
    return sorted(out, key=repr)


def same(df, want):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    got = sorted((tuple(r[n] for n in names) + (r.base_score, r.score) for r in df.collect()), key=lambda r: repr(r[:5]))
    want = sorted(want, key=lambda r: repr(r[:5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    # Rows alike in all but their scores may stand in another order.
    for k in (5, 6):
        assert np.allclose(sorted(g[k] for g in got), sorted(w[k] for w in want), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_of_awkward_rows(awkward, order):
    same(lm_scores(awkward, order=order), brute(texts_of(awkward), order))


def test_blocks_shards_and_pieces_change_nothing(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{int(rng.expovariate(0.05))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 40, 700])))) for i in range(60)]
    for name, value in (("BLOCK_BYTES", 500), ("SHARD_ENTRIES", 300), ("PIECE", 7)):
        monkeypatch.setattr(lm_scoring, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.base_score, r.score) for r in lm_scores(docs).collect()}
    for i, *_, base, score in brute(rows):
        assert got[i] == pytest.approx((base, score), rel=1e-9)


def test_unknown_words_follow_failure_arcs(spark):
    docs = spark.createDataFrame([(0, "a b a c a b"), (2, "b a b b")], "doc_id long, text string")
    lines = [f"a b {x}" for x in ("a", "b", "c", "zz")] + ["a b"]
    ids = [i for i in range(3_000, 9_000) if zlib.crc32(str(i).encode()) % 5 == 1][:len(lines) + 1]
    asked = spark.createDataFrame(list(zip(ids, [*lines, ""])), "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm_scores(docs.union(asked)).collect()}
    rows = [(0, "a b a c a b"), (2, "b a b b")] + list(zip(ids, lines))
    want = {i: s for i, *_, s in brute(rows)}
    assert all(score[i] == pytest.approx(want[i]) for i in ids[:-1])


def test_held_out_texts_are_not_learnt(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r.asDict() for r in lm_scores(docs).collect()}
    from pyspark.sql import functions as F

    other = docs.withColumn("text", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, "other words").otherwise(F.col("text")))
    changed = {r.doc_id: r.asDict() for r in lm_scores(other).collect()}
    assert all(whole[i] == changed[i] for i in whole if not whole[i]["held_out"]) and any(r["held_out"] for r in whole.values())


def test_context_helps_on_texts_with_structure(spark):
    rng = random.Random(2)
    after = {w: [rng.randrange(30) for _ in range(3)] for w in range(30)}

    def text():
        out = [rng.randrange(30)]
        for _ in range(50):
            out.append(rng.choice(after[out[-1]]))
        return " ".join(f"w{w}" for w in out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    held = [r for r in lm_scores(docs).collect() if r.held_out]
    assert len(held) > 30 and sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_empty_tables(empty, spark):
    assert lm_scores(empty).count() == 0
    only_held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r, = lm_scores(spark.createDataFrame([(only_held, None)], "doc_id long, text string")).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 1, 0, 0, 0.0, 0.0)
