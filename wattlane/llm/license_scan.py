"""Licence scan: an Aho-Corasick automaton over the words of each text finds notice
phrases and identifier tags; the expression behind a tag is parsed by a shunting yard
and evaluated for the least restrictive terms a user may choose.

It is one map over the documents without a shuffle; the automaton is built once per task.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattlane.llm.common import col, documents, query

# Base phrases with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices the scan labels by itself, names first, then the words licences are quoted by.
OTHER_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "server side public license": "sspl",
    "business source license": "busl",
    "boost software license": "bsl",
    "sil open font license": "ofl",
    "artistic license": "artistic",
    "isc license": "isc",
    "zlib license": "zlib",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under the apache license version 2 0": "apache-2.0",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "either version 2 of the license or at your option any later version": "gpl-2.0-or-later",
    "either version 3 of the license or at your option any later version": "gpl-3.0-or-later",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
# Licence identifiers in lower case by how far they restrict their user, and exceptions.
PERMISSIVE, WEAK, STRONG, UNKNOWN = range(4)
IDENTIFIERS = {
    PERMISSIVE: ["0bsd", "afl-3.0", "apache-1.1", "apache-2.0", "bsd-1-clause", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause",
                 "bsl-1.0", "cc-by-3.0", "cc-by-4.0", "cc0-1.0", "isc", "mit", "mit-0", "ncsa", "postgresql", "psf-2.0",
                 "python-2.0", "unicode-3.0", "unlicense", "wtfpl", "x11", "zlib"],
    WEAK: ["artistic-2.0", "cddl-1.0", "cddl-1.1", "epl-1.0", "epl-2.0", "lgpl-2.0", "lgpl-2.0-only", "lgpl-2.0-or-later", "lgpl-2.1",
           "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later", "mpl-1.1", "mpl-2.0", "ms-pl", "ofl-1.1"],
    STRONG: ["agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later", "busl-1.1", "cc-by-nc-3.0", "cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0",
             "cc-by-nd-4.0", "cc-by-sa-3.0", "cc-by-sa-4.0", "eupl-1.1", "eupl-1.2", "gpl-1.0", "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later",
             "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "osl-3.0", "sspl-1.0"],
}
EXCEPTIONS = ["autoconf-exception-2.0", "autoconf-exception-3.0", "bison-exception-2.2", "bootloader-exception", "classpath-exception-2.0",
              "font-exception-2.0", "gcc-exception-2.0", "gcc-exception-3.1", "gpl-cc-1.0", "linux-syscall-note", "llvm-exception",
              "openssl-exception", "qt-gpl-exception-1.0", "u-boot-exception-2.0", "wxwindows-exception-3.1"]
LEVELS = {name: level for level, names in IDENTIFIERS.items() for name in names}
OWN = ("licenseref-", "documentref-")
LEVEL_LABELS = ("terms-permissive", "terms-weak", "terms-strong", "terms-unknown")
INVALID, FOREIGN = "invalid-expression", "unknown-identifier"

WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
EXPRESSION = re.compile(r"spdx[^0-9a-z\n]+license[^0-9a-z\n]+identifier[^0-9a-z(\n]*([^\n]*)")
PIECE = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*|\S")
BINDS = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str] | None:
    """The expression's tokens in postfix order; ``with`` binds tighter than ``and``, that
    tighter than ``or``. None when operands, operators or brackets don't fit. Trailing
    comment marks are ignored."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for piece in PIECE.findall(re.sub(r"(\*/|-->|#+)\s*$", "", expression.lower().strip())):
        if piece == "(":
            if not operand_next:
                return None
            stack.append(piece)
        elif piece == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif piece in BINDS:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[piece]:
                out.append(stack.pop())
            stack.append(piece)
            operand_next = True
            continue
        else:
            if not operand_next or not piece[0].isalnum():
                return None
            out.append(piece)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def level(identifier: str) -> int:
    return LEVELS.get(identifier.removesuffix("+"), UNKNOWN)


def is_known(name: str) -> bool:
    """Is it an identifier of the list, with ``+`` or without, an exception, or a reference of the text's own?"""
    return name.removesuffix("+") in LEVELS or name in EXCEPTIONS or name.startswith(OWN)


def evaluate(expression: str) -> tuple[set[str], int] | None:
    """Its identifiers, and the level of the best choice: all of ``and`` bind (the maximum),
    ``or`` leaves the choice (the minimum), a known exception after ``with`` softens strong terms
    to weak ones. None for a malformed expression."""
    order = postfix(expression)
    if order is None:
        return None
    names: set[str] = set()
    stack: list[tuple[int, str | None]] = []
    for piece in order:
        if piece not in BINDS:
            stack.append((level(piece), piece))
            continue
        (right, exception), (left, name) = stack.pop(), stack.pop()
        if piece == "with":
            if exception is None or name is None:
                return None
            names |= {name, exception}
            stack.append((WEAK if left == STRONG and exception in EXCEPTIONS else left, None))
        else:
            names |= {x for x in (name, exception) if x}
            stack.append((max(left, right) if piece == "and" else min(left, right), None))
    value, name = stack.pop()
    return names | ({name} if name else set()), value


def build_automaton(base: dict[str, str], other: dict[str, str]):
    """Phrases between single blanks, so a match is a run of whole words."""
    found = ahocorasick.Automaton()
    for phrase, label in {**other, **base}.items():
        found.add_word(f" {phrase} ", (phrase, label, phrase in base))
    found.add_word(f" {TAG} ", (TAG, None, False))
    found.make_automaton()
    return found


def scan(text: bytes, automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
    words = text.translate(WORD_BYTES).split()
    line = " " + b" ".join(words).decode() + " "
    base, labels, starts, tagged = set(), set(), [], False
    at, seen = 0, 0
    for end, (phrase, label, is_base) in automaton.iter(line):
        start = end - len(phrase) - 1
        if label is None:
            tagged = True
            continue
        labels.add(label)
        if is_base:
            base.add(label)
            if start >= at:
                seen += line.count(" ", at, start)
                at = start
                starts.append(seen)
            else:  # a longer phrase that began before the last one counted
                starts.append(line.count(" ", 0, start))
    score = 0.9 if base else 0.6 if labels else 0.0
    if tagged:
        for found in EXPRESSION.findall(text.decode().lower()):
            value = evaluate(found)
            if value is None:
                labels.add(INVALID)
            else:
                names = {x for x in value[0] if is_known(x)}
                labels |= names | {LEVEL_LABELS[value[1]]}
                if names == value[0]:
                    score = 1.0
                else:  # words that are no licence say nothing, but a tag stands there
                    labels.add(FOREIGN)
        score = max(score, 0.3)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


RESULT = (("n_words", T.LongType(), pa.int64()), ("n_base", T.LongType(), pa.int64()),
          ("first_word", T.LongType(), pa.int64()), ("last_word", T.LongType(), pa.int64()),
          ("base_labels", T.StringType(), pa.string()), ("labels", T.StringType(), pa.string()),
          ("score", T.DoubleType(), pa.float64()))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 base: dict[str, str] = BASE_PHRASES, other: dict[str, str] = OTHER_PHRASES) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_base`` (places of base phrases),
    ``first_word``, ``last_word`` (where the first and last of them start, words from 0),
    ``base_labels``, ``labels`` and ``score``: 1 behind a tag whose expression is well formed and
    names known identifiers only, 0.9 with a base phrase, 0.6 with another notice, 0.3 with only some
    other tag, else 0.

    Null text counts as empty: no words, empty labels, null positions, score 0. Ids may be
    null or repeated; each row is scanned by itself. Other columns are ignored.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(n, t) for n, t, _ in RESULT])

    def run(batches):
        automaton = build_automaton(base, other)
        for batch in batches:
            rows = [scan(t or b"", automaton) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = zip(*rows) if rows else [[] for _ in RESULT]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(list(c), a) for c, (_, _, a) in zip(columns, RESULT)],
                [id_col] + [n for n, _, _ in RESULT])

    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


@query("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    return license_scan(documents(spark, sf_dir))
