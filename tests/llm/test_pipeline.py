"""The pipeline's stages, each held against brute force on its own input."""

import pytest
from llm_brute import brute_components, brute_print

import __spark_entry__ as entry
import corpus_pipeline
from wattlane.llm import line_dedup
from wattlane.session import settle


def five_words(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf), name)
        out.append((name, docs))
    return {name: df.collect() for name, df in out}, {name: df.columns for name, df in out}


def test_columns(steps):
    columns = steps[1]
    assert all(columns[n] == columns["documents"] for n, _ in corpus_pipeline.STAGES[:-1])


def test_language_stage_keeps_clean_documents(steps):
    rows = steps[0]
    kept = {r.doc_id for r in rows["language_id"]}
    assert all(r.doc_id in kept for r in rows["documents"] if any(c.isalpha() for c in r.text))
    assert not any(r.text.strip().isdigit() for r in rows["language_id"])


def test_line_stage(steps, spark):
    rows = steps[0]
    before = {r.doc_id: r.text for r in rows["language_id"]}
    for r in rows["line_dedup"]:
        lines = iter(before[r.doc_id].split("\n"))
        assert all(line in lines for line in r.text.split("\n")) and r.n_chars == len(r.text)
    count = {}
    for t in before.values():
        for line in set(t.split("\n")):
            count[line] = count.get(line, 0) + 1
    left = {}
    for r in rows["line_dedup"]:
        for line in r.text.split("\n"):
            left[line] = left.get(line, 0) + 1
    long = [x for x in count if len(x.split()) >= line_dedup.MIN_TOKENS]
    need = lambda x: line_dedup.LONG_DOCS if len(x.split()) > line_dedup.LONG_WORDS else line_dedup.MIN_DOCS
    assert all(left.get(x, 0) <= 1 for x in long if count[x] >= need(x))
    rare = [x for x in long if count[x] < need(x) and not any(c.isdigit() for c in x)]
    assert sum(left.get(x, 0) == count[x] for x in rare) >= 0.98 * len(rare)


def test_near_duplicate_stage(steps):
    """Nothing similar stays, and what goes was linked, pair by pair, to what stays."""
    rows = steps[0]
    texts = {r.doc_id: r.text for r in rows["line_dedup"]}
    kept = {r.doc_id for r in rows["simhash"]}
    sets = {i: five_words(t) for i, t in texts.items()}
    prints = {i: brute_print(t, 5) for i, t in texts.items()}
    of = brute_components(prints)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    first = {}
    near += [(i, first.setdefault(of[prints[i]], i)) for i in texts]
    for a, b in near:
        root[find(a)] = find(b)
    groups = {}
    for i in texts:
        groups.setdefault(find(i), set()).add(i)
    # Fingerprints fold first, so links of a text that went then are lost to the second step: never more rows than groups demand.
    assert all(len(g & kept) >= 1 for g in groups.values())
    assert not any(a in kept and b in kept for a, b in near if a != b)


def test_leak_stage(steps, spark, sf):
    rows = steps[0]
    asked = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {r.doc_id for r in rows["decontamination"]} == {r.doc_id for r in rows["simhash"] if not any(a in r.text for a in asked)}


def test_mixture_stage(steps):
    rows = steps[0]
    text = {r.doc_id: r.text for r in rows["decontamination"]}
    assert all(text[r.doc_id] == r.text for r in rows["mixing"])
    assert 0.6 < len(rows["mixing"]) / len(rows["decontamination"]) < 1.5


def test_run_gives_the_last_stage(steps, spark, sf):
    got = entry.queries()["pipeline"](spark, sf).collect()
    assert sorted((r.doc_id, r.mix_copy) for r in got) == sorted((r.doc_id, r.mix_copy) for r in steps[0]["mixing"])
