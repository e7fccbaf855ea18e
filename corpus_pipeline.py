"""A corpus through five stages: language, recurring lines, near duplicates, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and reads again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.common import col, fresh
from wattlane.llm.decontamination import drop_contaminated
from wattlane.llm.language_id import UNDETERMINED, tag_languages
from wattlane.llm.line_dedup import line_dedup
from wattlane.llm.mixing import mix_sources
from wattlane.llm.near_copies import drop_near_copies
from wattlane.llm.simhash import drop_near_duplicates
from wattlane.session import settle

#: Below this pooled probability the language is not certain enough to keep a document.
LEAST_CERTAINTY = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the given ``lang`` is only learnt from."""
    lang, score = fresh(docs, "found_lang", "found_score")
    tagged = tag_languages(docs, lang, score)
    return tagged.where((F.col(lang) != UNDETERMINED) & (F.col(score) >= LEAST_CERTAINTY)).select(*map(col, docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; a document that loses all its text goes with them."""
    cut = line_dedup(docs)
    left = cut.where((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*map(col, docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates. Fingerprints over five words link what is all but
    identical and fold the large groups; 64 bits cannot tell a similarity of 0.8, so what they
    leave is then compared by its five-word shingles and goes at a Jaccard similarity of 0.8."""
    return drop_near_copies(settle(drop_near_duplicates(docs, words=5), "folded"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with the same share of the bytes, in global random order."""
    return mix_sources(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", one_of_each_group),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: No SQL for a trained network and an iterated grouping; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
