"""Tables and brute-force versions shared by the tests of the training-data operators."""

import random
import re

import xxhash

WORDS = "the of and ein der die que los las ène èau mi to cat dog sun ran far hot old new".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, text_sha256 int, `a.b` int"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward_texts():
    rng = random.Random(3)
    long = sentence(rng, 30_000)
    shared = sentence(rng, 60)
    return [None, "", " ", "\n\n", "x", "7", long, long, shared, shared + " tail", "head " + shared, shared, "ab" * 900,
            "licensed under the MIT License\nSPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0)",
            "GNU General Public License, the Apache License and CC BY-NC", "日本語 текст ελληνικά <|endoftext|> a b c\x1cd",
            "a <|endoftext|><|endoftext|>'s 12½", None, "x"]


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def small(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def answers(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def brute_print(text, wide=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + wide]) for i in range(max(1, len(words) - wide + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    root = {f: f for f in set(prints.values())}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = sorted(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in known}
