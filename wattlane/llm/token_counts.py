"""Token counts: pieces are counted once per distinct pre-token and joined to the
pre-token frequencies of each document; no id list is ever built.

A map splits every text into pre-tokens. The most common pre-tokens, a head of bounded
size found in a bounded sample, are counted up front and travel to the tasks with the
function, so most of a document is summed in the map. Which pre-tokens are in the head
only decides where they are counted, never the result. The rest, the long tail, is kept
as frequencies per document in one staged table: its distinct pre-tokens are counted once
each, and a shuffled join on the pre-token brings the counts back. A pre-token that is hot
although the sample missed it is split by adaptive skew handling, as both sides of the
join are read from files.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.llm.common import col, documents, query
from wattlane.session import settle

#: Bounds of the head: documents sampled, and pre-tokens kept.
SAMPLE_DOCS = 4_000
HEAD_SIZE = 100_000
#: Longest pre-token of the head, in characters.
HEAD_CHARS = 64
#: Documents split, and pre-tokens encoded, at a time: what a worker holds besides its batch.
SLICE = 256
ENCODED = 1_000

SPACE = "\t-\r \x85\xa0"
WIDE_SPACE = SPACE + "  -     　"


def _pattern(letters: str, numbers: str, space: str) -> str:
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+")


class PreTokens:
    """Splits as the byte-level pre-tokeniser does. Texts below U+0250 take a pattern with
    explicit classes, which the standard module matches several times faster."""

    def __init__(self, specials: list[str]):
        self.low = re.compile(_pattern("a-zA-ZªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", SPACE))
        self.any = regex.compile(_pattern(r"\p{L}", r"\p{N}", WIDE_SPACE))
        self.beyond = re.compile("[^\x00-ɏ]")
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings."""
        find = (self.any if self.beyond.search(text) else self.low).findall
        if self.specials is None:
            return find(text), 0
        parts = self.specials.split(text)
        return find(text) if len(parts) == 1 else [x for p in parts for x in find(p)], len(parts) - 1


def specials_of(tokenizer_json: str) -> list[str]:
    """The special strings of a byte-level tokeniser file; other kinds are refused."""
    spec = json.loads(tokenizer_json)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or not pre.get("use_regex", True):
        raise ValueError("token counts need a byte-level tokeniser without normaliser or prefix blank")
    added = spec.get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take in neighbouring text are not supported")
    return [t["content"] for t in added]


def count_pieces(tokenizer, pre_tokens: list[str]) -> list[int]:
    return [len(e) for i in range(0, len(pre_tokens), ENCODED)
            for e in tokenizer.encode_batch(pre_tokens[i:i + ENCODED], add_special_tokens=False)]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    (more than ``limit`` tokens), as the tokeniser file gives them without begin or end
    tokens; its special strings inside a text count one each.

    Null text counts as empty with 0 tokens. Ids may be null or repeated; every row is
    counted by itself. An empty table gives an empty result; other columns are ignored.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    specials = specials_of(spec)
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(spec)  # one vocabulary file, of fixed size
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))

    n = docs.count()
    sample = texts.select("text").sample(fraction=min(1.0, SAMPLE_DOCS / max(n, 1)), seed=1)

    def distinct(batches):
        split = PreTokens(specials)
        here = Counter()
        for batch in batches:
            for t in batch.column(0):
                t = t.as_py()
                here.update(x for x in set(split.split(t or "")[0]) if len(x) <= HEAD_CHARS)
        common = here.most_common(HEAD_SIZE)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in common], pa.string()),
                                          pa.array([c for _, c in common], pa.int64())], ["t", "c"])

    head_rows = (sample.mapInArrow(distinct, "t string, c long").groupBy("t").agg(F.sum("c").alias("c"))
                 .where("c > 1").orderBy(F.desc("c"), "t").limit(HEAD_SIZE).select("t"))
    head = [r.t for r in head_rows.toLocalIterator()]
    known = spark.sparkContext.broadcast(dict(zip(head, count_pieces(Tokenizer.from_str(spec), head))))

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("n_bytes", T.LongType()),
        T.StructField("pieces", T.LongType()), T.StructField("tail", T.ArrayType(T.StringType())),
        T.StructField("times", T.ArrayType(T.IntegerType()))])

    def split_texts(batches):
        pieces, split = known.value, PreTokens(specials)
        row = TaskContext.get().partitionId() << 36
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            sizes, sums, tails, times = [], [], [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                found, special = split.split(t)
                tail, often, total = [], [], special
                for x, f in Counter(found).items():
                    p = pieces.get(x)
                    if p is None:
                        tail.append(x)
                        often.append(f)
                    else:
                        total += p * f
                sizes.append(len(t.encode()))
                sums.append(total)
                tails.append(tail)
                times.append(often)
            rows = pa.array(range(row, row + len(sizes)), pa.int64())
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(tails, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))],
                ["row", "id", "n_bytes", "pieces", "tail", "times"])

    # Written once: row numbers stay the same whatever is recomputed later.
    staged = settle(texts.mapInArrow(split_texts, schema), "pretokens")

    def count_distinct(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shipped.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count_pieces(tokenizer, batch.column(0).to_pylist()), pa.int64())], ["t", "p"])

    counted = settle(staged.select(F.explode("tail").alias("t")).distinct().mapInArrow(count_distinct, "t string, p long"),
                     "pieces")
    frequencies = staged.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select(
        "row", F.col("x.tail").alias("t"), F.col("x.times").alias("f"))
    rest = frequencies.join(counted, "t").groupBy("row").agg(F.sum(F.col("p") * F.col("f")).alias("rest"))
    total = F.col("pieces") + F.coalesce("rest", F.lit(0))
    return staged.select("row", "id", "n_bytes", "pieces").join(rest, "row", "left").select(
        F.col("id").alias(id_col), "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
