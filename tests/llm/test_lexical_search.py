"""Ranked search against plain dictionaries, and the exactness of its blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from wattlane.llm import lexical_search as ls
from wattlane.llm.lexical_search import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    bags = [(i, Counter(split(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked = Counter(split(text))
        scores = []
        for (i, bag), n in zip(bags, sizes):
            if n:
                m = 75 + (25 * n * n_docs) // n_terms
                scores.append((sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                                   * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t, k in asked.items() if t in bag), i))
        best = sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1]))[:top]
        out += [(item, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def found(df, item="item_id"):
    return sorted((tuple(r) for r in df.select(item, "rank", "doc_id", "score").collect()), key=repr)


def test_awkward_rows(awkward, bench):
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    more = bench.union(bench.sparkSession.createDataFrame([(9, "the of AND ein der x"), (10, "x x x 日本語 текст"), (11, "½ 7")], bench.schema))
    items = [tuple(r) for r in more.collect()]
    assert found(lexical_search(awkward, more)) == brute(docs, items)


@pytest.mark.parametrize("bounds", [{}, {"ITEMS": 3, "DOCS": 4, "TERMS": 2}, {"ITEM_BYTES": 1, "DOCS": 1, "TERMS": 1}])
def test_tiles_change_nothing(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(ls, name, value)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(25)]
    docs = [(rng.randrange(10 ** 6), " ".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(70)]
    docs += [(2_000_000 - i, "w1 w2 w3") for i in range(30)]  # ties beyond the last place
    items = [(i, " ".join(rng.choices(words, k=5))) for i in range(6)] + [(99, "w1 w2 w3")]
    got = lexical_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                         spark.createDataFrame(items, "item_id long, text string"), top=5)
    assert found(got) == brute(docs, items, 5)


def test_sums_of_a_block_stay_exact():
    """Weights that would pass 2^53 in one block are dealt to several, and add up again."""
    weights = np.array([30_000, 29_999, 0, 7])
    term, item, times = np.array([0, 1, 2, 3]), np.zeros(4, np.int64), np.array([10 ** 6, 10 ** 6, 5, 3])
    parts = ls.blocks(weights, times, item, term, 1)
    assert len(parts) > 3
    assert all(m.sum(axis=1).max() * ls.IMPACT < 2 ** 53 for _, m in parts)
    total = Counter()
    for t, m in parts:
        total.update(dict(zip(t.tolist(), m[0].astype(np.int64).tolist())))
    assert total == {0: 30_000 * 10 ** 6, 1: 29_999 * 10 ** 6, 3: 21}


def test_a_term_repeated_beyond_measure(spark):
    docs, items = [(1, "a b"), (2, "a a c"), (3, "c d")], [(7, "a " * 400_000 + "c")]
    got = lexical_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == brute(docs, items)


def test_empty_tables(awkward, empty, bench):
    assert lexical_search(empty, bench).count() == 0
    assert lexical_search(awkward, bench.limit(0)).count() == 0
    assert lexical_search(awkward, bench.where("text is null")).columns == ["item_id", "rank", "doc_id", "score"]
