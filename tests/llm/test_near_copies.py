"""Near copies of five-word Jaccard 0.8 and more, against brute force."""

import random

import pytest
from llm_brute import WORDS as FEW
from llm_brute import brute_print

import corpus_pipeline
from wattlane.llm import near_copies
from wattlane.llm.near_copies import drop_near_copies, near_copy_roots

WORDS = [a + b for a in FEW for b in FEW]


def brute_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_links(rows, least=0.8):
    sets = {i: brute_set(t) for i, t in rows}
    return [(a, b) for a in sets for b in sets if a < b and
            (sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]))]


def brute_groups(rows):
    root = {i: i for i, _ in rows}
    for a, b in brute_links(rows):
        old, new = root[b], root[a]
        root = {i: new if r == old else r for i, r in root.items()}
    groups = {}
    for i, r in root.items():
        groups.setdefault(r, set()).add(i)
    return sorted(map(sorted, groups.values()))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    """Families of copies with edits around the threshold, and passages that make look-alikes."""
    rng = random.Random(9)
    rows = ["", " ", "Two words", "two  WORDS", "two word"]
    for n in (40, 120, 300):
        for _ in range(6):
            base = [rng.choice(WORDS) for _ in range(n)]
            rows += [edited(rng, base, rng.randrange(1, max(2, n // 60) + 1)) for _ in range(8)]
            rows += [edited(rng, base[:n // 2] + [rng.choice(WORDS) for _ in range(n // 2)], 0) for _ in range(3)]
    return list(enumerate(rows))


def test_groups_against_brute_force(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    groups = {}
    for r in near_copy_roots(docs).collect():
        groups.setdefault(bytes(r.root), set()).add(r.id)
    want = brute_groups(planted)
    assert sorted(map(sorted, groups.values())) == want
    kept = drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [g[0] for g in want] and kept.columns == docs.columns


def test_bands_recall_pairs_at_the_threshold(planted):
    links = [(a, b) for a, b in brute_links(planted) if planted[a][1].strip()]
    keys = {i: near_copies.bands(near_copies.shingles(t.encode())) for i, t in planted}
    met = sum(any(x == y for x, y in zip(keys[a], keys[b])) for a, b in links)
    assert len(links) > 100 and met >= 0.999 * len(links)


def test_pipeline_drops_copies_beyond_two_bits(spark, sf, planted):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(1)
    rows = [r for r in planted if len(r[1].split()) > 100]
    assert sum((brute_print(rows[0][1]) ^ brute_print(t)).bit_count() > 2 for _, t in rows[1:8]) > 3
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        if name in ("simhash", "decontamination"):
            docs = stage(spark, docs, sf)
    assert brute_links([(r.doc_id, r.text) for r in docs.collect()]) == []


@pytest.mark.parametrize("n", [150, 300, 600])
def test_texts_that_share_a_passage_make_no_pairs(spark, n, monkeypatch):
    """Documents with 200 of 260 words in common share bands but no rare shingle: compared pairs grow linearly."""
    rng = random.Random(n)
    passage = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)]
    own = lambda: [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(30)]
    rows = [(i, " ".join(own() + passage + own())) for i in range(n)]
    compared, confirmed = [], near_copies._confirmed
    monkeypatch.setattr(near_copies, "_confirmed", lambda pairs, *a: compared.append(pairs.count()) or confirmed(pairs, *a))
    roots = near_copy_roots(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({bytes(r.root) for r in roots}) == n
    assert 2 <= len(compared) <= 5 and compared[0] <= 8 * n and max(compared[1:]) <= n


def test_rare_pairs_recall_components_that_bands_left_apart(spark):
    """A chain of edits: the least member of a band links few of its members, the rest meet by rare shingles."""
    rng = random.Random(12)
    base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        base = list(base)
        base[rng.randrange(150)] = rng.choice(WORDS) + rng.choice(WORDS)
        rows.append((i, " ".join(base)))
    groups = {}
    for r in near_copy_roots(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        groups.setdefault(bytes(r.root), set()).add(r.id)
    assert sorted(map(sorted, groups.values())) == brute_groups(rows)


def test_a_large_group_of_copies_makes_few_pairs(spark, monkeypatch):
    """400 copies of one text, each with its own edits, around the threshold: one group, without all pairs of it."""
    rng = random.Random(3)
    base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)]
    rows = [(i, edited(rng, base, rng.randrange(1, 6))) for i in range(400)]
    compared, confirmed = [], near_copies._confirmed
    monkeypatch.setattr(near_copies, "_confirmed", lambda pairs, *a: compared.append(pairs.count()) or confirmed(pairs, *a))
    groups = {}
    for r in near_copy_roots(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        groups.setdefault(bytes(r.root), set()).add(r.id)
    assert sorted(map(sorted, groups.values())) == brute_groups(rows)
    # Most of these lie just below the threshold and have to be told apart pair by pair: still half of all 79,800.
    assert sum(compared[:-1]) < 30 * 400 and sum(compared) < 400 * 399 / 4


def test_empty_table(spark):
    assert drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
