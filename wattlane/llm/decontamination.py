"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become tokens; numbers, units after a number and names (capitals inside a sentence)
become typed placeholders. Windows of five template tokens are hashed and joined with the
windows of the benchmark, and so are the same windows of plain lower-cased words.

A place of an item is covered when its words stand in the document, in whatever case and
wherever; or when its template does, and its slots agree with the others of their diagonal
(same distance between document and item): there each value of the item stands for the value
of the document it most often meets, and the other way round. So a re-parameterised question
matches, a mere look-alike does not, and one altered number spoils only the windows it is
in. A window of nothing but placeholders says nothing and is matched by its words alone. A
document is contaminated when 0.8 of an item's places are covered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import col, documents, fresh, query, whole_text
from wattlane.session import settle

WORDS = 5
SIMILARITY = 0.8
# Units that become a placeholder behind a number.
UNITS = ["mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "sec", "seconds", "min", "minutes", "h",
         "hours", "days", "weeks", "months", "years", "miles", "feet", "inches", "pounds", "dollars", "euros", "cents",
         "percent", "usd", "eur", "w", "kw", "kwh", "v", "hz", "degrees"]
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+|[.!?]"
#: What stands for a slot of each type where other tokens have the hash of their word.
NUMBER, UNIT, NAME = 1, 2, 3
#: Between the slot values of a window; no token contains it.
GLUE = "|"


def _templates(df: DataFrame, text_col: str, keys: list[str]) -> DataFrame:
    """``keys`` and, token by token, ``w`` (hash of the lower-cased word) and, where a token is a slot, ``c``
    (its type) and ``raw`` (its value)."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    tokens = df.withColumn("t", F.expr(f"regexp_extract_all({text_col}, r'{TOKEN}', 0)"))
    typed = tokens.withColumn("s", F.expr(f"""
        filter(transform(t, (x, i) -> case
            when x in ('.', '!', '?') then null
            when x < ':' then named_struct('w', xxhash64(x), 'c', {NUMBER}L, 'raw', x)
            when i > 0 and get(t, i - 1) between '0' and '9:' and lower(x) in ({units})
                then named_struct('w', xxhash64(lower(x)), 'c', {UNIT}L, 'raw', lower(x))
            when i > 0 and get(t, i - 1) not in ('.', '!', '?') and left(x, 1) != lower(left(x, 1))
                then named_struct('w', xxhash64(lower(x)), 'c', {NAME}L, 'raw', x)
            else named_struct('w', xxhash64(lower(x)), 'c', cast(null as bigint), 'raw', cast(null as string)) end), x -> x is not null)"""))
    return typed.select(*keys, F.expr("s.w").alias("w"), F.expr("s.c").alias("c"), F.expr("s.raw").alias("raw"))


def _windows(templates: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """A row for the words of each window (``plain``), and one for its template if it has slots and more than
    slots. ``h`` is the hash, ``at`` the place, ``slots`` the values joined."""
    at = lambda a: ", ".join(a.format(k) for k in range(WORDS))
    last = f"size(w) - {WORDS}"
    # No filter on the size: it would be pushed below the templates and evaluate them once more.
    none = "cast(array() as array<int>)"
    words = f"""
        transform(if(size(w) >= {WORDS}, sequence(0, {last}), {none}),
                  i -> named_struct('at', i, 'h', xxhash64({at('w[i + {}]')}), 'slots', cast(null as string)))"""
    # Only windows around a slot have a template of their own.
    near = f"""
        array_distinct(flatten(transform(filter(transform(c, (x, i) -> if(x is null or size(c) < {WORDS}, null, i)), i -> i is not null),
                                         i -> sequence(greatest(i - {WORDS - 1}, 0), least(i, {last})))))"""
    typed = f"""
        transform(filter({near}, i -> exists(slice(c, i + 1, {WORDS}), x -> x is null)),
                  i -> named_struct('at', i, 'h', xxhash64({at('coalesce(c[i + {0}], w[i + {0}])')}), 'slots', concat_ws('{GLUE}', {at('raw[i + {}]')})))"""
    return templates.select(*keys, F.explode(F.expr(f"concat({words}, {typed})")).alias("x")).select(
        *keys, F.col("x.at").alias(f"{prefix}_at"), F.col("x.slots").isNull().alias("plain"), F.col("x.h").alias("h"),
        F.col("x.slots").alias(f"{prefix}_slots"))


#: Of the pairs (value of the item, value of the document) of a diagonal those that no pair with one
#: of the two values outnumbers; of equals the smaller pair counts.
AGREED = """
    filter(counted, x -> not exists(counted, z ->
        ((z.i = x.i) != (z.d = x.d)) and (z.n > x.n or (z.n = x.n and (z.i < x.i or (z.i = x.i and z.d < x.d))))))"""


def _overlaps(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
              similarity: float) -> tuple[DataFrame, DataFrame]:
    """The keys (id, hash of the text) of all rows, and ``overlap`` and ``items`` of those with any match."""
    keys = ["id", "th"]
    texts = docs.select(col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    asked = items.select(col(item_col).alias("item"), whole_text(item_text_col).alias("text"))
    wanted = settle(_windows(_templates(asked, "text", ["item"]), ["item"], "i"), "items")
    sizes = wanted.where("plain").groupBy("item").agg(F.countDistinct("i_at").alias("windows"))

    found = settle(_windows(_templates(texts, "text", keys), keys, "d").join(wanted, ["h", "plain"]).select(
        *keys, "item", "plain", "d_at", "i_at", "d_slots", "i_slots").distinct(), "found")
    # Documents and items agree on the template of a window, so their slots pair off in order.
    pairs = F.expr(f"""transform(arrays_zip(split(i_slots, '[{GLUE}]'), split(d_slots, '[{GLUE}]')),
                                 x -> named_struct('i', x['0'], 'd', x['1']))""")
    # A place of the item stands once on a diagonal, so what is gathered here is bounded by the item.
    diagonal = found.where("not plain").select(*keys, "item", "i_at", (F.col("d_at") - F.col("i_at")).alias("shift"), pairs.alias("pairs")) \
        .groupBy(*keys, "item", "shift").agg(F.collect_set(F.struct("i_at", "pairs")).alias("seen"))
    agreed = diagonal.withColumn("all", F.flatten("seen.pairs")) \
        .withColumn("counted", F.expr("transform(array_distinct(all), x -> named_struct('i', x.i, 'd', x.d, 'n', size(filter(all, z -> z = x))))")) \
        .withColumn("agreed", F.expr(f"transform({AGREED}, x -> named_struct('i', x.i, 'd', x.d))")) \
        .select(*keys, "item", F.explode(F.expr("filter(seen, s -> size(array_except(s.pairs, agreed)) = 0)")).alias("s")) \
        .select(*keys, "item", "s.i_at")
    covered = found.where("plain").select(*keys, "item", "i_at").union(agreed).distinct()
    hits = (covered.groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("n"))
            .join(sizes.withColumnRenamed("item", "of"), F.col("item").eqNullSafe(F.col("of")))
            .select(*keys, "item", (F.col("n") / F.col("windows")).alias("share")))
    per_doc = hits.groupBy(*keys).agg(
        F.max("share").alias("overlap"),
        F.array_sort(F.collect_set(F.when(F.col("share") >= similarity, F.struct("item")))).alias("items"))
    return texts.select(*keys), per_doc


def benchmark_overlap(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text",
                      similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: its id, ``contaminated``, ``n_items``, ``item_ids`` (comma-joined,
    ascending) and ``overlap``, the largest share of an item's places that are covered.

    Null and empty texts have no window and are clean; so is everything when the benchmark
    is empty. An item of fewer than five tokens has no window and matches nothing; items that
    repeat an id are one item with the windows of all; a null item id is named ``null``. Rows that repeat
    an id and its text each return, with the same answer. Other columns are ignored.
    """
    texts, per_doc = _overlaps(docs, items, id_col, text_col, item_col, item_text_col, similarity)
    joined = texts.join(
        per_doc.select(F.col("id").alias("pid"), F.col("th").alias("pth"), "overlap", "items"),
        F.col("id").eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")), "left")
    n = F.when(F.col("items").isNull(), 0).otherwise(F.size("items"))
    return joined.select(
        F.col("id").alias(id_col), (n > 0).alias("contaminated"), n.cast("long").alias("n_items"),
        F.coalesce(F.expr("array_join(transform(items, x -> coalesce(cast(x.item as string), 'null')), ',')"), F.lit("")).alias("item_ids"),
        F.coalesce("overlap", F.lit(0.0)).alias("overlap"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, whatever their names; see
    ``benchmark_overlap`` for null and empty texts, repeated rows and an empty benchmark."""
    _, per_doc = _overlaps(docs, items, id_col, text_col, item_col, item_text_col, similarity)
    of, th = fresh(docs, "of", "th")
    bad = settle(per_doc.where(F.size("items") > 0).select("id", "th"), "leaks").toDF(of, th)
    return docs.join(bad, col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(whole_text(text_col)) == F.col(th)), "left_anti")


def _sql_templates(table: str, key: str) -> str:
    units = ", ".join(f"'{u}'" for u in UNITS)
    return f"""
        SELECT {key} AS k, list_filter(list_transform(range(1, len(t) + 1), lambda i: CASE
            WHEN t[i] IN ('.', '!', '?') THEN NULL
            WHEN t[i] < ':' THEN {{'c': '<n>', 'raw': t[i]}}
            WHEN i > 1 AND t[i - 1] BETWEEN '0' AND '9:' AND lower(t[i]) IN ({units}) THEN {{'c': '<u>', 'raw': lower(t[i])}}
            WHEN i > 1 AND t[i - 1] NOT IN ('.', '!', '?') AND left(t[i], 1) != lower(left(t[i], 1)) THEN {{'c': '<p>', 'raw': t[i]}}
            ELSE {{'c': lower(t[i]), 'raw': NULL}} END), lambda x: x IS NOT NULL) AS s
        FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS t FROM {table})"""


def _sql_windows(table: str, key: str) -> str:
    return f"""
        SELECT k AS {key}, i, list_transform(s[i:i + {WORDS - 1}], lambda x: x.c) AS c,
               list_transform(s[i:i + {WORDS - 1}], lambda x: lower(coalesce(x.raw, x.c))) AS w,
               list_filter(list_transform(s[i:i + {WORDS - 1}], lambda x: x.raw), lambda x: x IS NOT NULL) AS slots
        FROM (SELECT k, s, unnest(range(1, len(s) - {WORDS - 2})) AS i FROM {table} WHERE len(s) >= {WORDS})"""


ORACLE = f"""
    WITH dt AS ({_sql_templates('documents', 'doc_id')}), it AS ({_sql_templates('benchmark', 'item_id')}),
    d AS ({_sql_windows('dt', 'doc_id')}), b AS ({_sql_windows('it', 'item')}),
    f AS (SELECT doc_id, item, b.i AS place, d.i - b.i AS shift, b.slots AS bs, d.slots AS ds
          FROM d JOIN b ON d.c = b.c WHERE len(b.slots) BETWEEN 1 AND {WORDS - 1}),
    pairs AS (SELECT doc_id, item, shift, place, bs[n] AS bv, ds[n] AS dv FROM (SELECT *, unnest(range(1, len(bs) + 1)) AS n FROM f)),
    counted AS (SELECT doc_id, item, shift, bv, dv, count(*) AS n FROM pairs GROUP BY ALL),
    beaten AS (SELECT DISTINCT x.doc_id, x.item, x.shift, x.bv, x.dv
               FROM counted x JOIN counted z ON x.doc_id = z.doc_id AND x.item = z.item AND x.shift = z.shift
               WHERE (z.bv = x.bv) != (z.dv = x.dv) AND (z.n > x.n OR z.n = x.n AND (z.bv < x.bv OR z.bv = x.bv AND z.dv < x.dv))),
    bad AS (SELECT DISTINCT doc_id, item, shift, place FROM pairs JOIN beaten USING (doc_id, item, shift, bv, dv)),
    covered AS (SELECT doc_id, item, b.i AS place FROM d JOIN b USING (w)
                UNION SELECT doc_id, item, place FROM f ANTI JOIN bad USING (doc_id, item, shift, place)),
    sizes AS (SELECT item, count(DISTINCT i) AS n FROM b GROUP BY item),
    hits AS (SELECT doc_id, item, count(DISTINCT place) * 1.0 / any_value(n) AS share
             FROM covered JOIN sizes USING (item) GROUP BY doc_id, item),
    per AS (SELECT doc_id, max(share) AS overlap, count(*) FILTER (share >= {SIMILARITY}) AS n_items,
                   string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) FILTER (share >= {SIMILARITY}) AS item_ids
            FROM hits GROUP BY doc_id)
    SELECT doc_id, coalesce(n_items, 0) > 0 AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           coalesce(item_ids, '') AS item_ids, round(coalesce(overlap, 0.0), 6) AS overlap
    FROM documents LEFT JOIN per USING (doc_id)"""


@query("op3_decontamination", ORACLE)
def op3_decontamination(spark, sf_dir):
    found = benchmark_overlap(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("overlap", F.round("overlap", 6))
