"""Line deduplication with a log-template tree.

The tree has a fixed depth: a line goes down by its token count and its leading tokens,
where tokens with digits are variable from the start. In the leaf it reaches, a token is a
constant if more than half of the leaf's lines have it at that position; the others
generalise to a variable field. This depends on shares only, so a field whose values each
recur many times in a large corpus still generalises. A line whose leaf leaves too few
constants keeps its own tokens as template. Besides its template every line has its exact
text as another, which is what finds lines that are mostly digits, very short or long.

A template that occurs in enough documents is a recurring one: its first occurrence stays,
all others are dropped.

Leaves are never gathered into a task: the support of (leaf, position, token) is a
counting aggregate with a map side, and so is the number of documents of a template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import col, documents, fresh, query, whole_text
from wattlane.session import settle

#: Documents from which a template recurs; identical lines of more than LONG_WORDS tokens do so
#: from LONG_DOCS on, identical lines of fewer than MIN_TOKENS from SHORT_DOCS on.
MIN_DOCS = 3
LONG_WORDS, LONG_DOCS = 50, 2
MIN_TOKENS, SHORT_DOCS = 3, 20
LEADING = 3
#: Most variable and least constant tokens of a template, and what makes a token of a leaf a constant.
VARIABLE_SHARE = 0.2
CONSTANT_SHARE = 0.5
LEAF_SHARE = 0.5
WILD = "<*>"
BLANKS = r"[ \x09\x0b-\x0d]+"
#: A token with a digit, found without going back over the token.
DIGIT_TOKEN = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _lines(texts: DataFrame) -> DataFrame:
    """``id, th, at, n`` of every line with a token (``at`` counts all lines from 0). Lines long enough
    for the tree have ``leaf``, ``masked`` (single blanks, digit tokens wild) and its name ``m``. Lines
    whose text says more than that, or without a leaf, have the name ``same`` of their text."""
    lines = texts.select("id", "th", F.posexplode(F.split("text", "\n")).alias("at", "line")) \
        .withColumn("plain", F.trim(F.regexp_replace("line", BLANKS, " "))).where("plain != ''") \
        .withColumn("n", F.length("plain") - F.length(F.translate("plain", " ", "")) + 1) \
        .withColumn("digits", F.col("plain").rlike("[0-9]")) \
        .withColumn("masked", F.when(F.col("digits"), F.regexp_replace("plain", DIGIT_TOKEN, WILD)).otherwise(F.col("plain")))
    deep = F.col("n") >= MIN_TOKENS
    return lines.select(
        "id", "th", "at", "n", F.when(deep, F.xxhash64("n", F.substring_index("masked", " ", LEADING))).alias("leaf"),
        F.when(deep, F.col("masked")).alias("masked"), F.when(deep, F.unhex(F.md5("masked"))).alias("m"),
        F.when(~deep | F.col("digits") | (F.col("n") > LONG_WORDS), F.unhex(F.md5(F.concat(F.lit("="), "line")))).alias("same"))


def _templates(tokens: DataFrame, constants: DataFrame) -> DataFrame:
    """``m, template`` of the masked lines ``m`` with few enough variable and enough constant tokens."""
    return (
        tokens.join(constants.hint("merge"), ["leaf", "j", "token"], "left")
        .groupBy("m").agg(
            F.array_sort(F.collect_list(F.struct("j", F.when(F.col("constant"), F.col("token")).otherwise(WILD).alias("token")))).alias("x"),
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.col("constant").isNull() & (F.col("token") != WILD)).alias("variable"),
            F.count_if(F.col("constant") & (F.col("token") != WILD)).alias("fixed"))
        .where((F.col("variable") <= VARIABLE_SHARE * F.col("size")) & (F.col("fixed") >= CONSTANT_SHARE * F.col("size")))
        .select("m", F.unhex(F.md5(F.array_join(F.expr("x.token"), " "))).alias("template")))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``id, th, drop``: per text with something to drop, the sorted numbers of its lines that
    go. ``th`` is the xxhash64 of the text; rows that repeat id and text count as one."""
    texts = docs.select(col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    parsed = settle(_lines(texts), "parsed")
    # A leaf with fewer lines has no recurring template, and its lines need not travel. Leaves and
    # templates grow with the corpus, so their joins are merge joins at every size.
    leaves = settle(parsed.where("leaf is not null").groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf"), "leaves")
    lines = settle(parsed.select("id", "th", "at", "leaf", "masked", "m").join(leaves.hint("merge"), "leaf"), "lines")
    docs_of = lines.select("id", "th", "m").distinct().groupBy("m").agg(F.count(F.lit(1)).alias("docs"))
    unique = settle(lines.select("leaf", "masked", "m").distinct().join(docs_of.hint("merge"), "m"), "unique")

    # A line alone in its leaf keeps its own tokens as template.
    shared = unique.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.sum("docs").alias("lines")).where("kinds > 1")
    shared = settle(shared.select("leaf", "lines"), "shared")
    tokens = settle(unique.join(shared.hint("merge"), "leaf").select(
        "leaf", "m", "docs", F.posexplode(F.split("masked", " ")).alias("j", "token")), "tokens")
    constants = settle(
        tokens.groupBy("leaf", "j", "token").agg(F.sum("docs").alias("n")).join(shared.hint("merge"), "leaf")
        .where(F.col("n") > LEAF_SHARE * F.col("lines")).select("leaf", "j", "token", F.lit(True).alias("constant")), "constants")
    general = settle(_templates(tokens.select("leaf", "m", "j", "token"), constants), "general")
    as_is = unique.where(F.col("docs") >= min_docs).where(
        F.expr(f"size(filter(split(masked, ' '), x -> x != '{WILD}')) >= {CONSTANT_SHARE} * size(split(masked, ' '))")
    ).select("m", F.col("m").alias("template")).join(general.select("m").hint("merge"), "m", "left_anti")
    template = settle(general.unionByName(as_is), "templates")
    placed = lines.select("id", "th", "at", "m").join(template.hint("merge"), "m").select(
        "template", "id", "th", "at", F.lit(min_docs).alias("need"))

    # Copies of a line share their template too, so the first of that is the first of them.
    same = parsed.where("same is not null").select(
        F.col("same").alias("template"), "id", "th", "at",
        F.when(F.col("n") > LONG_WORDS, LONG_DOCS).when(F.col("n") < MIN_TOKENS, SHORT_DOCS).otherwise(min_docs).alias("need"))
    again = settle(same.groupBy("template").count().where("count > 1").select("template"), "again")
    placed = settle(placed.unionByName(same.join(again.hint("merge"), "template")), "placed")
    recurring = settle(
        placed.groupBy("template", "need", "id", "th").agg(F.min("at").alias("at"))
        .groupBy("template", "need").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("id", "th", "at")).alias("first"))
        .where(F.col("docs") >= F.col("need")).select("template", "first"), "recurring")
    dropped = placed.join(recurring.hint("merge"), "template").where(~F.struct("id", "th", "at").eqNullSafe(F.col("first")))
    return settle(dropped.groupBy("id", "th").agg(F.array_sort(F.collect_set("at")).alias("drop")), "dropped")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns of ``docs`` with recurring lines taken out of the text, and ``n_lines`` and
    ``n_dropped`` (columns of these names in the input are replaced; other names may clash with nothing).

    Lines end at ``\\n``. A template of three tokens or more recurs from ``min_docs`` documents on, and
    so does the exact text of a line, whatever its digits; a text of more than 50 tokens from two
    documents on, one of fewer than three from 20 on. Lines without a token always stay. The first
    occurrence, by smallest id (null ids first), then text hash and line, stays.

    Null text counts as empty: it has one line and comes back as it was. Rows that repeat id and
    text count as one document and are cut alike. An empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    of, th, gone = fresh(docs, "of", "th", "gone")
    drop = recurring_lines(docs, id_col, text_col, min_docs).toDF(of, th, gone)
    text = whole_text(text_col)
    # Both sides are plain tables, so adaptive execution splits a text that many rows share.
    joined = docs.select(*map(col, names)).join(
        drop.hint("merge"), col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(th)), "left")
    pieces = F.split(text, "\n")
    kept = F.when(F.col(gone).isNull(), col(text_col)).otherwise(
        F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col(gone), i)), "\n"))
    return joined.select(
        *[kept.alias(c) if c == text_col else col(c) for c in names],
        F.size(pieces).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"))


ORACLE = rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
    p AS (SELECT doc_id, pos, line, w, len(w) AS n, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{WILD}' ELSE x END) AS t
          FROM (SELECT doc_id, pos, line, list_filter(regexp_split_to_array(line, '[ \t\x0b-\x0d]+'), lambda x: x != '') AS w FROM l)
          WHERE len(w) > 0),
    u AS (SELECT n, t[1:{LEADING}] AS lead, t, count(DISTINCT doc_id) AS docs FROM p WHERE n >= {MIN_TOKENS} GROUP BY ALL),
    leaf AS (SELECT n, lead, sum(docs) AS lines FROM u GROUP BY ALL),
    tok AS (SELECT n, lead, t, docs, unnest(t) AS token, generate_subscripts(t, 1) AS j FROM u),
    con AS (SELECT n, lead, j, token FROM tok JOIN leaf USING (n, lead) GROUP BY n, lead, j, token, lines HAVING sum(docs) > {LEAF_SHARE} * lines),
    gen AS (SELECT tok.t, string_agg(CASE WHEN con.token IS NULL THEN '{WILD}' ELSE tok.token END, ' ' ORDER BY tok.j) AS template,
                   count(*) FILTER (con.token IS NULL AND tok.token != '{WILD}') <= {VARIABLE_SHARE} * count(*)
                   AND count(*) FILTER (con.token IS NOT NULL AND tok.token != '{WILD}') >= {CONSTANT_SHARE} * count(*) AS good
            FROM tok LEFT JOIN con ON tok.n = con.n AND tok.lead = con.lead AND tok.j = con.j AND tok.token = con.token GROUP BY tok.t),
    tpl AS (SELECT t, CASE WHEN good THEN template ELSE array_to_string(t, ' ') END AS template FROM gen
            WHERE good OR len(list_filter(t, lambda x: x != '{WILD}')) >= {CONSTANT_SHARE} * len(t)),
    pl AS (SELECT doc_id, pos, 'T' || template AS template, {MIN_DOCS} AS need FROM p JOIN tpl USING (t)
           UNION ALL
           SELECT doc_id, pos, '=' || line, CASE WHEN n > {LONG_WORDS} THEN {LONG_DOCS} WHEN n < {MIN_TOKENS} THEN {SHORT_DOCS} ELSE {MIN_DOCS} END FROM p),
    rec AS (SELECT template, min(doc_id) AS first FROM pl GROUP BY template, need HAVING count(DISTINCT doc_id) >= need),
    keep AS (SELECT template, first AS doc_id, min(pos) AS pos FROM pl JOIN rec USING (template) WHERE doc_id = first GROUP BY ALL),
    gone AS (SELECT DISTINCT doc_id, pos FROM pl JOIN rec USING (template) ANTI JOIN keep USING (template, doc_id, pos))
    SELECT l.doc_id, count(*) AS n_lines, count(gone.pos) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL), '')) AS kept_sha256
    FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id"""


@query("op1_line_dedup", ORACLE)
def op1_line_dedup(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(whole_text("text"), 256).alias("kept_sha256"))
