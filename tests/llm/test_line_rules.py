"""The pipeline's stages on small tables made for one rule each."""

import corpus_pipeline
from wattlane.session import settle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name, spark, docs, sf=""):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf)


def left(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    return [r.text for r in stage("line_dedup", spark, docs).orderBy("doc_id").collect()]


def test_identical_lines_go_whatever_their_digits(spark):
    line = "Tel. 030 1234 5678"
    assert left(spark, [f"own {w}\n{line}" for w in ("a", "b", "c")] + ["own d\nTel. 030 9999 5678"]) == [
        f"own a\n{line}", "own b", "own c", "own d\nTel. 030 9999 5678"]


def test_fields_whose_values_recur_generalise(spark):
    lines = [f"Posted on this public site by {n} in {c} early today" for n in ("Ann", "Bob", "Eve") for c in ("Bonn", "Kiel", "Ulm")]
    assert [t.count("Posted") for t in left(spark, [f"own {i}\n{x}" for i, x in enumerate(lines)])] == [1] + [0] * 8


def run(spark, docs, sf):
    counts = {}
    for name, f in corpus_pipeline.STAGES:
        docs = settle(f(spark, docs, sf), name)
        counts[name] = docs
    return counts


def test_awkward_table(spark, sf, awkward):
    """Null, empty and wordless texts have no language and go first; every later stage takes what is left."""
    docs = awkward.withColumn("lang", awkward["lang"])
    steps = run(spark, docs, sf)
    before = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {(r.doc_id, r.text) for r in steps["language_id"].collect()}
    assert kept <= set(before) and not any(t is None or not t.strip() or t == "7" for _, t in kept)
    assert all(steps[n].columns == docs.columns for n, _ in corpus_pipeline.STAGES[:-1])
    once = [r.text for r in steps["simhash"].collect()]
    assert len(once) == len(set(once)) > 0
    assert {r.text for r in steps["mixing"].collect()} <= set(once)


def test_empty_table(spark, sf, empty):
    assert all(df.count() == 0 for df in run(spark, empty, sf).values())
    assert len(corpus_pipeline.STAGES) in (4, 5)
