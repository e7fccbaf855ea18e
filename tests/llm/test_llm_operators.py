"""Training-data operators against brute force, on edge cases and on the smallest tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_brute import answers, awkward_texts, brute_components, brute_print, sentence, small, texts_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wattlane.llm import decontamination, exact_dedup, language_id, license_scan, line_dedup, mixing, quality, simhash
from wattlane.llm import suffix_dedup, token_counts

# --- exact duplicates ---------------------------------------------------------------------------

@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups(awkward, keep):
    groups = defaultdict(list)
    for i, t in texts_of(awkward):
        groups[t].append(i)
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        k = (min if keep == "min" else max)(known) if known else None
        want += [(i, k, len(ids), i == k, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    got = answers(exact_dedup.exact_groups(awkward, keep=keep), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=repr)


def test_salts_make_no_row_without_partner(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    assert {(r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()} == {(0, 5000)}


# --- repeated strings ---------------------------------------------------------------------------

def brute_spans(rows, length):
    places = Counter()
    data = [t.encode() for _, t in rows]
    for b in data:
        places.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if places[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


SPANS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [1000, 1])
def test_repeated_spans(spark, hot):
    rng = random.Random(hot)
    passage = sentence(rng, 12)
    texts = awkward_texts()[:4] + ["ab" * 200, "ab" * 30, "z" * 61] + [
        sentence(rng, 20) + " " + passage + " " + sentence(rng, rng.randrange(12)) for _ in range(40)]
    texts += [texts[9], texts[9], texts[12][5:90], "é" * 50]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, key int")
    got = suffix_dedup.repeated_spans(docs, length=40, gram=16, hot_runs=hot, task_bytes=3000, with_text=True)
    assert answers(got, *SPANS) == brute_spans(texts_of(docs), 40)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


@pytest.mark.parametrize("n", [200, 800])
def test_a_hot_passage(spark, n):
    """One passage in n texts of other words. Its inner parts fold; the windows at its edges meet in one
    transform, which holds less than a segment and a half of each text."""
    rng = random.Random(n)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(1_000))
    other = lambda size: "".join(rng.choice("ijklmnop ") for _ in range(size))
    rows = [(i, other(300) + passage + other(300)) for i in range(n)] + [(n, passage[100:600]), (n + 1, other(900))]
    stats = {}
    got = answers(suffix_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), hot_runs=20, task_bytes=20_000, stats=stats),
                  "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    texts = [t.encode() for _, t in rows]
    seen = Counter(hash(t[k:k + 400]) for t in texts for k in range(len(t) - 399))
    want = []
    for i, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if seen[hash(t[k:k + 400])] > 1:
                gone[k:k + 400] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((i, len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=repr) and want[0][2] >= 1_000 and want[-1][2] == 0
    assert stats["largest"] < 1.5 * 2 * 670 * n


@pytest.mark.parametrize("n", [200, 800])
def test_the_edges_of_a_hot_passage_share_no_transform(spark, n):
    """However many texts share a passage, the largest transform stays within what one is meant to hold."""
    rng = random.Random(n)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(1_000))
    other = lambda size: "".join(rng.choice("ijklmnop ") for _ in range(size))
    rows = [(i, other(300) + passage + other(300)) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(3)] + [(n + 3, passage[:700]), (n + 4, "ab" * 9_000 + "c"), (n + 5, "ab" * 15_000)]
    stats = {}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = answers(suffix_dedup.repeated_spans(docs, hot_runs=20, task_bytes=20_000, stats=stats), *SPANS)
    assert got == brute_spans(rows, 400)
    assert stats["largest"] < 3 * 20_000  # keys of at most 20,000 bytes, some of which meet


def test_repeated_spans_of_the_tables(spark, sf):
    docs = small(spark, sf)
    rows = [r for r in texts_of(docs) if len(r[1]) < 6000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(suffix_dedup.repeated_spans(docs), *SPANS) == brute_spans(rows, 400)


def test_interval_expansion_against_all_pairs():
    rng = random.Random(5)
    segments = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))).encode() for _ in range(25)]
    for length in (3, 8, 17):
        got = suffix_dedup.covered(segments, [1] * len(segments), length)
        want = brute_spans([(i, s.decode()) for i, s in enumerate(segments)], length)
        assert [(sum(z - a for a, z in zip(*g)), len(g[0])) for g in got] == [(w[2], w[3]) for w in sorted(want)]


# --- near duplicates ----------------------------------------------------------------------------

def brute_near(rows):
    prints = {t: brute_print(t) for _, t in rows}
    of = brute_components(prints)
    least = {}
    for i, t in rows:
        if i is not None:
            k = of[prints[t]]
            least[k] = min(least.get(k, i), i)
    return sorted([(i, f"{prints[t]:016x}", least.get(of[prints[t]])) for i, t in rows], key=repr)


def test_near_duplicates(awkward):
    rows = texts_of(awkward)
    assert answers(simhash.near_duplicates(awkward), "doc_id", "fingerprint", "component_id") == brute_near(rows)


def test_near_duplicates_of_the_tables(spark, sf):
    docs = small(spark, sf)
    assert answers(entry.queries()["op6_simhash"](spark, sf), "doc_id", "fingerprint", "component_id") == brute_near(texts_of(docs))


@pytest.mark.parametrize("tree, task_rows", [(20_000, 50_000), (7, 50_000), (7, 11), (20_000, 5)])
def test_trees_lose_no_link(spark, tree, task_rows):
    rng = random.Random(tree)
    values = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(12):
            values.add(x)
            x ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    stars = simhash.components(simhash.link_stars(spark.createDataFrame(rows, "fp long"), tree=tree, task_rows=task_rows))
    got = {r.node: r.root for r in stars.collect()}
    mark = lambda v: v % (1 << 64)
    groups = defaultdict(set)
    for (v,) in rows:
        groups[got.get(v, v)].add(mark(v))
    want = defaultdict(set)
    for v, r in brute_components({v: v for v in values}).items():
        want[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_one_of_each_group_stays(awkward):
    rows = texts_of(awkward)
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    prints = {t: brute_print(t) for _, t in rows}
    of = brute_components(prints)
    groups = Counter(of[prints[r.text or ""]] for r in kept.collect())
    assert set(groups) == {of[prints[t]] for _, t in rows} and set(groups.values()) == {1}


# --- token counts -------------------------------------------------------------------------------

def brute_tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return sorted([(i, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False)), n > 1024) for i, t in rows], key=repr)


def count(docs):
    import public_tokenizers

    return answers(token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")), "doc_id", "n_bytes", "n_tokens", "over_limit")


def test_token_counts(spark, awkward, sf):
    assert count(awkward) == brute_tokens(texts_of(awkward))
    assert answers(entry.queries()["op7_token_counts"](spark, sf), "doc_id", "n_bytes", "n_tokens", "over_limit") == brute_tokens(texts_of(small(spark, sf)))


@pytest.mark.parametrize("letters", [
    "aZ 09'st\n\t.,!_-éßñ²½ªµ \x85\x1c\x1f\x00ƀɏ", "a 1.́٠Ⅰあ   ﻿\U0001d7d8\U0001f600'll"])
def test_pre_tokens_against_the_tokeniser(letters):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(len(letters))
    split = token_counts.PreTokens([])
    for _ in range(500):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert [t[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(t)] == split.split(t)[0]


# --- licences -----------------------------------------------------------------------------------

def brute_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for phrase, label in license_scan.BASE_PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def descend(tokens):
    """The expression by recursive descent: names, level, and is it well formed?"""
    tokens, names = list(tokens), set()

    def choice():
        value = both()
        while tokens[:1] == ["or"]:
            tokens.pop(0)
            value = min(value, both())
        return value

    def both():
        value = single()
        while tokens[:1] == ["and"]:
            tokens.pop(0)
            value = max(value, single())
        return value

    def single():
        if tokens[:1] == ["("]:
            tokens.pop(0)
            value = choice()
            assert tokens.pop(0) == ")"
            assert tokens[:1] != ["with"]
            return value
        name = tokens.pop(0)
        assert name not in ("or", "and", "with") and name[0].isalnum()
        names.add(name)
        value = next((k for k, of in license_scan.IDENTIFIERS.items() if name.rstrip("+") in of and name.count("+") < 2), 3)
        if tokens[:1] == ["with"]:
            tokens.pop(0)
            exception = tokens.pop(0)
            assert exception not in ("or", "and", "with") and exception[0].isalnum() and tokens[:1] != ["with"]
            names.add(exception)
            if value == 2 and exception in license_scan.EXCEPTIONS:
                value = 1
        return value

    try:
        value = choice()
        assert not tokens
        return names, value
    except (AssertionError, IndexError):
        return None


def brute_labels(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    has = lambda phrase: any(words[i:i + len(phrase.split())] == phrase.split() for i in range(len(words)))
    base = {x for p, x in license_scan.BASE_PHRASES.items() if has(p)}
    labels = base | {x for p, x in license_scan.OTHER_PHRASES.items() if has(p)}
    score = 0.9 if base else 0.6 if labels else 0.0
    if has("spdx license identifier"):
        score = max(score, 0.3)
        for line in text.lower().split("\n"):
            for found in re.findall(r"spdx[^0-9a-z]+license[^0-9a-z]+identifier[^0-9a-z(]*(.*)", line):
                tokens = re.findall(r"\(|\)|[a-z0-9][a-z0-9.+:-]*|\S", re.sub(r"(\*/|-->|#+)\s*$", "", found.strip()))
                value = descend(tokens)
                if value is None:
                    labels.add("invalid-expression")
                    continue
                known = {n for n in value[0] if any(n.removesuffix("+") in of for of in license_scan.IDENTIFIERS.values())
                         or n in license_scan.EXCEPTIONS or n.startswith(("licenseref-", "documentref-"))}
                labels |= known | {("terms-permissive", "terms-weak", "terms-strong", "terms-unknown")[value[1]]}
                score = 1.0 if known == value[0] else score
                labels |= set() if known == value[0] else {"unknown-identifier"}
    return ",".join(sorted(labels)), score


def test_labels_of_random_notices(spark):
    rng = random.Random(13)
    names = ["MIT", "GPL-2.0-only", "Apache-2.0", "LGPL-2.1+", "CC-BY-NC-4.0", "LicenseRef-x", "hello", "EPL-2.0"]
    parts = names + ["OR", "AND", "WITH", "(", ")", "Classpath-exception-2.0", "no-exception", ",", "*/"]
    phrases = [*license_scan.BASE_PHRASES, *license_scan.OTHER_PHRASES]
    rows = []
    for i in range(300):
        expression = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) if i % 2 else " OR ".join(
            rng.choice(names) + rng.choice(["", " WITH Classpath-exception-2.0", " AND MIT"]) for _ in range(rng.randrange(1, 4)))
        notice = rng.choice(phrases).title().replace(" ", rng.choice([" ", ", ", "\n", "-"]))
        rows.append((i, rng.choice(["", notice + "\n", f"some {notice} here\n"]) + rng.choice(["", f"// SPDX-License-Identifier: {expression}\nnext"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(license_scan.license_scan(docs), "doc_id", "labels", "score") == sorted([(i, *brute_labels(t)) for i, t in rows], key=repr)


def test_license_scan(spark, awkward, sf):
    for docs in (awkward, small(spark, sf)):
        want = sorted([(i, *brute_scan(t)) for i, t in texts_of(docs)], key=repr)
        assert answers(license_scan.license_scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
        want = sorted([(i, *brute_labels(t)) for i, t in texts_of(docs)], key=repr)
        assert answers(license_scan.license_scan(docs), "doc_id", "labels", "score") == want
    rows = {r.doc_id: r for r in license_scan.license_scan(awkward).collect()}
    assert rows[13].labels == "classpath-exception-2.0,gpl-2.0-only,mit,terms-permissive" and rows[13].score == 1.0
    assert rows[14].labels == "apache,cc-by,cc-by-nc,gpl" and rows[14].base_labels == "apache,cc-by,gpl"


@pytest.mark.parametrize("text, names, level", [
    ("MIT", {"mit"}, 0), ("MIT AND GPL-3.0", {"mit", "gpl-3.0"}, 2), ("MIT OR GPL-3.0 AND MPL-2.0", {"mit", "gpl-3.0", "mpl-2.0"}, 0),
    ("(MIT OR GPL-3.0) AND MPL-2.0", {"mit", "gpl-3.0", "mpl-2.0"}, 1), ("GPL-2.0+ WITH Bison-exception-2.2 */", {"gpl-2.0+", "bison-exception-2.2"}, 1),
    ("LicenseRef-own", {"licenseref-own"}, 3), ("CC-BY-NC-4.0 OR CC-BY-4.0", {"cc-by-nc-4.0", "cc-by-4.0"}, 0)])
def test_expressions(text, names, level):
    assert license_scan.evaluate(text) == (names, level)


@pytest.mark.parametrize("text", ["", "MIT OR", "(MIT", "MIT)", "MIT GPL-2.0", "AND MIT", "( )", "MIT WITH (A OR B)", "MIT, BSD"])
def test_malformed_expressions(text):
    assert license_scan.evaluate(text) is None


# --- language and quality -----------------------------------------------------------------------

def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    net = language_id.ByteTagger(["a", "b", "c"], hidden=3)
    for d in (net.ahead, net.back):
        d.w, d.u, d.v = (x.astype(np.float64) for x in (d.w, d.u, d.v))
    net.out = net.out.astype(np.float64)
    rows = rng.integers(0, 257, (4, 6)).astype(np.int16)
    y = np.array([0, 1, 2, 1])
    _, grads = net.loss_and_gradients(rows, y)
    for w, g in zip(net.parameters(), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w.shape) if w.shape[0] != 257 else (rows[rng.integers(4), rng.integers(6)], rng.integers(w.shape[1]))
            old, e = w[at], 1e-3
            w[at] = old + e
            up = net.loss_and_gradients(rows, y)[0]
            w[at] = old - e
            down = net.loss_and_gradients(rows, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * e) - g[at]) < 2e-4


def test_language_held_out_accuracy(spark):
    rows = entry.queries()["op10_language_id"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    real = [r for r in rows if re.search(r"[^\W\d_]", r.text)]
    assert len(real) > 100 and sum(r.lang == r.lang_pred for r in real) / len(real) > 0.95
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r not in real)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = entry.queries()["op8_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9
    assert sum((r.score >= 0.5) == bool(r.quality) for r in rows) / len(rows) > 0.9


def test_labels_of_held_out_rows_are_not_learnt(spark, sf):
    docs, labels = small(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (answers(quality.quality_scores(docs, x), "doc_id", "score") for x in (labels, turned))
    assert one == two


# --- lines, leaks, mixture ----------------------------------------------------------------------

def lines_left(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in line_dedup.line_dedup(docs).orderBy("doc_id").collect()]


def test_lines_generalise(spark):
    texts = [f"only here {w} stands this line of its own\nPosted at {i} by user nr {i * 7} on the board\nsee also the page of {w} for more" for i, w in
             enumerate(["sun", "moon", "star", "sky"])]
    left = lines_left(spark, texts)
    assert left[0] == texts[0]
    assert all("Posted" not in t and "see also" not in t for t in left[1:])


@pytest.mark.parametrize("names, cities", [(3, 3), (9, 9), (2, 30)])
def test_fields_whose_values_recur_generalise(spark, names, cities):
    """Whether a token is a constant depends on its share of the leaf, not on how often it recurs."""
    pairs = [(n, c) for n in range(names) for c in range(cities) if names * cities < 20 or n == c or names == 2]
    texts = [f"own {chr(97 + i % 26)}{chr(97 + i // 26)}\nPosted on this public site by {'ABCDEFGHI'[n]}nn in {chr(97 + c % 26)}{chr(97 + c // 26)}city early today" for i, (n, c) in enumerate(pairs)]
    assert [t.count("Posted") for t in lines_left(spark, texts)] == [1] + [0] * (len(texts) - 1)


def test_identical_lines_go_whatever_they_hold(spark):
    tel, short, rare = "Tel. 030 1234 5678", "Thank you", "Good bye"
    texts = [f"mine {i:02d}a\n{short}" + (f"\n{tel}" if i < 3 else "") + (f"\n{rare}" if i < 19 else "") for i in range(20)]
    left = lines_left(spark, texts)
    assert [short in t for t in left] == [True] + [False] * 19
    assert [tel in t for t in left] == [True] + [False] * 19
    assert [rare in t for t in left] == [True] * 19 + [False]


@pytest.mark.parametrize("words, stays", [(51, False), (50, True)])
def test_long_lines_recur_from_two_documents(spark, words, stays):
    line = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words))
    assert lines_left(spark, [f"one\n{line}", f"two\n{line}", "three"]) == [f"one\n{line}", f"two\n{line}" if stays else "two", "three"]


def test_awkward_lines(awkward, spark):
    """Only texts that hold a recurring line change: the long text and the shared one stand in two
    documents each, and of each the one with the smaller id (null first) keeps it."""
    before, after = texts_of(awkward), line_dedup.line_dedup(awkward)
    assert after.columns == awkward.columns + ["n_lines", "n_dropped"]
    rows = [(r.doc_id, r.text, r.n_dropped) for r in after.collect()]
    awk = awkward_texts()
    first, changed = {}, []
    for i, t in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)):
        if len(t.split()) > 50 and "\n" not in t:
            (changed if t in first and first[t] != i else [first.setdefault(t, i)]).append((i, t))
    want = sorted([(i, "" if (i, t or "") in changed else t) for i, t in [(r.doc_id, r.text) for r in awkward.collect()]], key=repr)
    assert sorted([(i, t) for i, t, _ in rows], key=repr) == want and len(awk) + 1 == len(rows) and len(changed) >= 2


CLASHING = ["of", "th", "gone", "mix_source", "mix_first", "mix_cdf", "mix_draw", "lang_pred", "found_lang", "found_score", "_of", "at", "m", "leaf"]


def test_clashing_names(spark, bench):
    docs = spark.createDataFrame([(1, "a b c d e\nf"), (2, "a b c d e\nf g"), (2, None)], "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in CLASHING} | {"source": F.lit("s"), "lang": F.lit("en")})
    for name, df in {"lines": line_dedup.line_dedup(docs), "leaks": decontamination.drop_contaminated(docs, bench.withColumns({c: F.lit(1) for c in CLASHING})),
                     "near": simhash.drop_near_duplicates(docs), "mix": mixing.mix_sources(docs),
                     "language": language_id.tag_languages(docs, "found", "found_2")}.items():
        assert df.columns[:len(docs.columns)] == docs.columns, name
        assert all(r[c] == c for r in df.collect() for c in CLASHING), name


def test_reparameterised_questions(spark, bench):
    docs = spark.createDataFrame([
        (1, "x y alpha beta gamma delta 7 km zeta eta theta iota z"), (2, "alpha beta gamma delta 5 miles zeta eta theta iota"),
        (3, "alpha beta gamma other 5 km zeta eta words iota"), (4, None), (5, "so one two three four five six seven")], "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontamination.benchmark_overlap(docs, bench).collect()}
    assert got == {1: (True, "1"), 2: (True, "1"), 3: (False, ""), 4: (False, ""), 5: (True, "null")}


def test_slots_must_agree(spark):
    items = spark.createDataFrame([(1, "add 3 to 3 and give back 3 again now")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "add 8 to 8 and give back 8 again now"), (2, "add 8 to 9 and give back 8 again now")], "doc_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontamination.benchmark_overlap(docs, items).collect()} == {1: True, 2: False}


def test_one_altered_slot_spoils_only_its_windows(spark):
    rng = random.Random(6)
    words = [rng.choice("abcdefgh") * rng.randrange(3, 9) for _ in range(200)]
    words[20] = words[120] = "77"
    words[60], words[61] = "Berlin", "Paris"
    item = " ".join(words)
    altered = " ".join("78" if i == 120 else w for i, w in enumerate(words))
    other = " ".join({"77": "5", "Berlin": "Rome", "Paris": "Oslo"}.get(w, w) for w in words)
    mixed = " ".join("x" if i % 4 == 0 else w for i, w in enumerate(words))
    docs = [(1, altered), (2, item.upper()), (3, item.title()), (4, item.lower()), (5, other), (6, "so " + item + " it is"), (7, mixed), (8, "77 " * 3_000)]
    items = [(1, item), (2, "1 2 3 4 5 6 7 8 9 10 11 12")]
    got = {r.doc_id: r for r in decontamination.benchmark_overlap(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [i for i, r in sorted(got.items()) if r.contaminated] == [1, 2, 3, 4, 5, 6]
    assert got[1].overlap >= 190 / 196 and got[7].overlap < 0.2 and got[8].overlap == 0


def test_leaks_are_found_and_clean_documents_stay(spark, sf):
    docs, items = small(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    asked = [r.text for r in items.collect()]
    got = {r.doc_id: r.contaminated for r in entry.queries()["op3_decontamination"](spark, sf).collect()}
    assert all(got[i] == any(a in t for a in asked) for i, t in texts_of(docs))


def test_mixture_meets_the_targets(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"),
                                      F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("source"))
    targets = spark.createDataFrame([("rare", 3.0), ("hot", 1.0), ("none", 5.0)], "source string, weight double")
    got = {r.source: r["count"] for r in mixing.mix_sources(docs, targets).groupBy("source").count().collect()}
    assert abs(got["rare"] / sum(got.values()) - 0.75) < 0.02


def test_poisson_tables(spark):
    """Against the distribution itself, at rates far beyond what a sum from zero could hold."""
    rates = [0.0, 0.3, 5.0, 150.0, 1e3, 1e6]
    rows = mixing._poisson(spark.createDataFrame([(str(r), r) for r in rates], "source string, rate double")).collect()
    assert sorted(r.rate for r in rows) == rates
    for r in rows:
        if r.rate == 0:
            assert min(r.cdf) >= 1
            continue
        k = r.first + np.arange(len(r.cdf))
        want = np.cumsum(np.exp(k * math.log(r.rate) - r.rate - np.array([math.lgamma(x + 1) for x in k])))
        assert np.abs(np.array(r.cdf) - want).max() < 1e-7 and abs(r.cdf[-1] - 1) < 1e-7
        assert len(r.cdf) <= 24 * math.sqrt(r.rate) + 64


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["² ½ Ⅷ 7 _", "a", "\u0301"])], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_id.language_id(docs).collect()} == {0: "und", 1: "en", 2: "und"}


# --- every operator on awkward and empty tables -------------------------------------------------

def everything(docs, labels, bench):
    import public_tokenizers

    return {
        "exact": exact_dedup.exact_groups(docs), "lines": line_dedup.line_dedup(docs), "leaks": decontamination.benchmark_overlap(docs, bench),
        "spans": suffix_dedup.repeated_spans(docs), "near": simhash.near_duplicates(docs),
        "tokens": token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")),
        "quality": quality.quality_scores(docs, labels), "licences": license_scan.license_scan(docs), "language": language_id.language_id(docs)}


def test_every_row_returns(awkward, labels, bench):
    ids = sorted((r.doc_id for r in awkward.select("doc_id").collect()), key=repr)
    for name, df in everything(awkward, labels, bench).items():
        assert sorted((r.doc_id for r in df.collect()), key=repr) == ids, name


def test_empty_tables(empty, labels, bench):
    for name, df in everything(empty, labels.limit(0), bench.limit(0)).items():
        assert df.count() == 0, name
    assert mixing.mix_sources(empty).count() == 0


def test_awkward_mixture(awkward):
    rows = mixing.mix_sources(awkward).collect()
    copies = Counter((r.doc_id, r.text) for r in rows)
    assert all(len({r.mix_copies for r in rows if (r.doc_id, r.text) == k}) == 1 for k in copies)
    assert {r.mix_rate for r in rows} >= {r.mix_rate for r in rows if r.source is None} != set()
