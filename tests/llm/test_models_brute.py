"""Fitted models applied by hand: scores looked up table by table, the network run position by position."""

import math
import re
import zlib

import numpy as np
import pytest
from llm_brute import texts_of

import __spark_entry__ as entry
from wattlane.llm import language_id, quality


def features(text):
    """The statistics of a text, each from its definition."""
    data = text.encode()
    words, n = data.split(), max(len(data), 1)
    k = max(len(words), 1)
    count = lambda chars: sum(b in chars for b in data)
    capitals = [w for w in words if any(65 <= b <= 90 for b in w)]
    shouted = [w for w in capitals if not any(97 <= b <= 122 for b in w)]
    return {
        "log_bytes": math.log(1 + len(data)), "log_words": math.log(1 + len(words)), "mean_word": sum(map(len, words)) / k,
        "longest_word": math.log(1 + max([len(w) for w in words], default=0)), "upper_share": count(range(65, 91)) / n,
        "digit_share": count(range(48, 58)) / n, "blank_share": count(b" \t\r\n\x0b\x0c") / n, "line_share": count(b"\n") / k,
        "symbol_share": count(b"#$%&*+<=>@\\^_`{}~[]/") / n, "mark_share": count(b"!") / k, "shout_share": len(shouted) / k,
        "pipe_share": count(b"|") / k, "unique_share": len(set(words)) / k, "repeat_share": sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / k,
        "top_share": max([words.count(w) for w in set(words)], default=0) / k,
        "odd_end_share": len(re.findall(rb"[^\w\s.,;:?!'\")\x80-\xff](?=\s|$)", data)) / k,
        "short_share": sum(len(w) < 3 for w in words) / k, "high_byte_share": count(range(128, 256)) / n,
        "punctuation_share": count(b".,;:?'\"()-") / n, "title_share": sum(w.istitle() for w in words) / k}


def looked_up(model, x):
    logit = model.base
    for j, table in enumerate(model.tables):
        logit += table[sum(e <= x[j] for e in model.edges[j])]
    for (i, j), table in model.pair_tables.items():
        logit += table[sum(e <= x[i] for e in model.coarse[i])][sum(e <= x[j] for e in model.coarse[j])]
    return 1 / (1 + math.exp(-logit))


def test_quality_of_the_table(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_quality(quality.feature_table(docs), labels)
    got = {r.doc_id: r for r in entry.queries()["op8_quality"](spark, sf).collect()}
    rows = texts_of(docs)
    assert len(got) == len(rows) and len(model.pair_tables) > 0
    for i, t in rows:
        want = looked_up(model, [features(t)[name] for name in quality.FEATURES])
        assert got[i].score == pytest.approx(want, abs=1e-9), i
        assert got[i].predicted == (want >= 0.5) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_quality_of_awkward_rows(awkward, labels):
    model = quality.fit_quality(quality.feature_table(awkward), labels)
    got = sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9), r.held_out) for r in quality.quality_scores(awkward, labels).collect())
    want = sorted((i is None, i or 0, round(looked_up(model, [features(t)[n] for n in quality.FEATURES]), 9),
                   i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, t in texts_of(awkward))
    assert got == want


def states(layer, data):
    """One direction of the network over bytes, one position after the other."""
    k = layer.v.shape[0]
    w, u, v = (x.astype(np.float64) for x in (layer.w, layer.u, layer.v))
    h, out = np.zeros(k), []
    for byte in data:
        gates = 1 / (1 + np.exp(-(w[byte][:2 * k] + h @ u)))
        z, r = gates[:k], gates[k:]
        h = (1 - z) * h + z * np.tanh(w[byte][2 * k:] + (r * h) @ v)
        out.append(h)
    return out


def by_position(model, text):
    data, total = text.encode(), 0
    for at in range(0, len(data), language_id.STEPS):
        piece = list(data[at:at + language_id.STEPS])
        # What reads backwards meets the padding of a short piece first.
        padded = piece + [model.PAD] * (language_id.STEPS - len(piece))
        ahead, back = states(model.ahead, piece), states(model.back, padded[::-1])[::-1]
        for a, b in zip(ahead, back):
            logits = np.concatenate([a, b, [1.0]]) @ model.out.astype(np.float64)
            logits -= logits.max()
            total = total + logits - math.log(np.exp(logits).sum())
    pooled = total / len(data) * min(len(data), language_id.STEPS)
    p = np.exp(pooled - pooled.max())
    return p / p.sum()


def test_languages_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.fit_language_id(docs)
    got = {r.doc_id: r for r in entry.queries()["op10_language_id"](spark, sf).collect()}
    rows = texts_of(docs)
    assert len(got) == len(rows)
    for i, t in rows:
        if not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        elif len(t) < 6_000:
            p = by_position(model, t)
            assert got[i].score == pytest.approx(p.max(), abs=2e-3), i
            assert p.max() - p[model.languages.index(got[i].lang_pred)] < 2e-3


def test_languages_of_awkward_rows(awkward):
    model = language_id.fit_language_id(awkward)
    texts = {}
    for i, t in texts_of(awkward):
        texts.setdefault(i, []).append(t)
    for r in language_id.language_id(awkward).collect():
        found = []
        for t in texts[r.doc_id]:
            if len(t) > 20_000:
                found.append(True)
            elif not any(c.isalpha() for c in t):
                found.append((r.lang_pred, r.score) == ("und", 0.0))
            else:
                p = by_position(model, t)
                found.append(abs(p.max() - r.score) < 2e-3)
        assert any(found), (r, [t[:40] for t in texts[r.doc_id]], model and [by_position(model, t).round(4) for t in texts[r.doc_id] if t and len(t) < 9000])
