"""The trie against plain dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from wattlane.llm.conversation_trie import bits, conversation_trie, ordered_turns, prefix_trie, spliced

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos int, key string, node string, `a.b` int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def said(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(ts)] for c, ts in turns.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, of in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(of) - 1) * size
    return sorted((
        (min(of), len(path), min(members[path[:-1]]) if path else None, len(of), len(kids[path]), leaves[path], saved[path],
         hashlib.sha256(",".join(str(c) for c in sorted(c for c in of if len(convs[c]) == len(path))).encode()).hexdigest())
        for path, of in list(members.items())), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    texts = ["", None, "hello", "ünï", "a:b", "x" * 5_000]
    rows = []
    for c in [0, 1, 2, 3, 4, 7, 8, 13, 20, 21, 22, 23, 24, 105, 106, 10 ** 12]:
        for t in range(rng.choice([1, 2, 3, 9, 40])):
            rows.append((c, rng.choice([t, t, None, 0]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(200 + i, t, "user", "same") for i in range(40) for t in range(6)]  # copies
    rows += [(None, 1, "user", "nobody"), rows[0], rows[0]]
    rows = [(*r, "clash", 1, "clash", "clash", 2) for r in rows]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("shard", [20_000, 30, 1])
def test_rebuilt_conversations(odd, shard):
    rows, df = odd
    got = prefix_trie(spliced(ordered_turns(df)), shard)
    assert rows_of(got) == brute(rebuilt(said(rows)))


def test_conversations_as_they_stand(odd):
    rows, df = odd
    got = conversation_trie(df, shard_turns=50)
    assert rows_of(got) == brute(said(rows))
    names = {r.node: (r.parent, r.depth) for r in got.collect()}
    assert len(names) == got.count() and all(d == 0 or names[p][1] == d - 1 for p, d in names.values())


def test_conversations_without_turns(spark):
    """A conversation whose first turns come from one that is absent may have none left."""
    c = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 3)
    rows = [(c, t, "user", "x") for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(prefix_trie(spliced(ordered_turns(df)))) == brute(rebuilt(said(rows))) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(entry.queries()["op12_conversation_trie"](spark, sf)) == brute(rebuilt(said(rows)))


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spliced(ordered_turns(spark.createDataFrame([], SCHEMA)))).columns[:8] == NAMES


def test_bits():
    assert bits(0) == [] and bits(1 << 70 | 5) == [0, 2, 70]
