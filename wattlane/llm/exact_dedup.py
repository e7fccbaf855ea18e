"""Exact deduplication by a 128-bit content hash, with a comparison of the bytes.

The first aggregation groups by (hash, text): its map side folds the copies in each
task, so a text that fills a third of the table sends one row per task, and two texts
that collide in the hash stay apart because Spark compares the grouping bytes. Only
hashes travel afterwards. The link from a row back to its group is salted by the row
id; a group lists the salts that really occur among its members in a 64-bit mask, so
salting creates no row without a partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import col, documents, query, whole_text

SALTS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are. ``keep`` names the member that stays, the one
    with the smallest (``min``) or largest (``max``) id.

    Null text counts as empty. A null id is passed over when the keeper is chosen; a
    group with only null ids has a null ``keep_id`` and all its rows are kept. Rows that
    repeat an id and its text carry the same answer and count in ``group_size``. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    pick = F.min if keep == "min" else F.max
    rows = docs.select(col(id_col).alias("id"), whole_text(text_col).alias("text")).select(
        "id", "text", F.unhex(F.md5("text")).alias("h"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    groups = (
        rows.groupBy("h", "text")
        .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
             F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"))
        .select("h", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n"), "keep_id", "group_size",
                F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> getbit(mask, i) = 1)")).alias("salt")))
    members = rows.select("id", "salt", "h", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n"))
    return members.join(groups, ["h", "sha", "n", "salt"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


@query("op2_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op2_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir), keep="max")
