"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate, its target share of the output over its size.
A document draws its count by inverting the Poisson distribution of that mean at a
uniform number hashed from seed and id, is exploded by the count, and the copies are
shuffled globally by a hash of their own, which spreads a hot source evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.llm.common import col, documents, fresh, query, whole_text
from wattlane.session import settle

#: Hex digits of the hash that make the uniform number: 52 bits are exact in a double.
DIGITS = 13


def _uniform(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") / float(16 ** DIGITS)


def source_rates(docs: DataFrame, targets: DataFrame | None = None, source_col: str = "source",
                 text_col: str = "text", amount: float = 1.0) -> DataFrame:
    """``source, bytes, rate``: mean repetitions that bring each source to its share of
    ``amount`` times the bytes of the input.

    ``targets`` has ``source, weight``; without it all sources weigh the same. A source
    without a target, or with a null or negative weight, has rate 0. A source without any
    byte cannot reach a share and has rate 1. Null is a source like any other.
    """
    sizes = docs.groupBy(col(source_col).alias("source")).agg(
        F.sum(F.octet_length(whole_text(text_col)).cast("long")).alias("bytes"))
    if targets is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        wanted = targets.groupBy(F.col("source").alias("wanted")).agg(F.max("weight").cast("double").alias("weight"))
        sizes = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").drop("wanted")
    sizes = sizes.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    sizes = settle(sizes, "sizes")
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    per_weight = float(amount) * (total.bytes or 0) / total.weight if total.weight else 0.0
    share = F.col("weight") * per_weight / F.col("bytes")
    return sizes.select(
        "source", "bytes",
        F.when(F.col("bytes") == 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("rate"))


def _poisson(rates: DataFrame) -> DataFrame:
    """``rates`` with ``cdf``, the Poisson distribution from count ``first`` on.

    Counts further than 12 deviations (and 30) from the mean have no mass a double could
    show, so a small source with a high rate gets a table of the square root of its rate.
    Logarithms of the masses are summed up from ``first``, where Stirling's formula gives them.
    """
    ends = rates.withColumns({
        "first": F.expr("greatest(0L, bigint(floor(rate - 12 * sqrt(rate) - 30)))"),
        "last": F.expr("bigint(ceil(rate + 12 * sqrt(rate) + 30))")})
    start = F.expr("""if(first = 0, -rate, first * ln(rate) - rate
        - (first * ln(first) - first + ln(2 * pi() * first) / 2 + 1 / (12 * first)))""")
    counts = ends.select("source", "rate", "first", start.alias("start"), F.explode(F.sequence("first", "last")).alias("k"))
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when((F.col("k") > F.col("first")) & (F.col("rate") > 0), F.log("rate") - F.log("k")).otherwise(0.0)
    summed = counts.withColumn("mass", F.exp(F.col("start") + F.sum(step).over(upto))).withColumn("c", F.sum("mass").over(upto))
    return summed.groupBy("source", "rate", "first").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("cdf"))


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text", amount: float = 1.0,
                seed: int = 42) -> DataFrame:
    """The columns of ``docs``, each row as often as its draw says, with ``mix_copy``
    (from 0), ``mix_copies``, ``mix_rate`` and ``mix_key``, the key of the global order.

    Rows are dealt to partitions by ``mix_key`` and sorted by it inside each, so every
    partition is a random sample of the mixture and every run gives the same one. Columns
    of these names in the input are replaced, others may have any name. Rows that repeat an id draw the same count; a
    null id draws like an id of its own; null and empty texts have size 0; an empty table
    gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("mix_copy", "mix_copies", "mix_rate", "mix_key")]
    source, first, cdf, draw = fresh(docs, "mix_source", "mix_first", "mix_cdf", "mix_draw")
    rates = settle(_poisson(source_rates(docs, targets, source_col, text_col, amount)).select(
        F.col("source").alias(source), F.col("rate").alias("mix_rate"), F.col("first").alias(first),
        F.col("cdf").alias(cdf)), "rates")
    key = F.coalesce(col(id_col).cast("string"), F.lit(""))
    # The table of rates is a file by now: Spark broadcasts it only if it is below the session's threshold.
    # The draw is zipped to the table: a lambda that captures a column of the other side would let the
    # optimiser move the filter on the count below the join.
    drawn = docs.select(*map(col, names)).join(rates, col(source_col).eqNullSafe(F.col(source))).withColumn(
        draw, _uniform(F.concat(F.lit(f"{seed}:"), key))).withColumn(
        "mix_copies", F.expr(
            f"int({first} + size(filter(arrays_zip({cdf}, array_repeat({draw}, size({cdf}))), x -> x.{cdf} <= x['1'])))"))
    copies = drawn.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.expr("sequence(0, mix_copies - 1)")))
    keyed = copies.withColumn("mix_key", F.md5(F.concat(F.lit(f"{seed}/"), key, F.lit("/"), F.col("mix_copy").cast("string"))))
    return (keyed.select(*map(col, names), "mix_copy", "mix_copies", "mix_rate", "mix_key")
            .repartition("mix_key").sortWithinPartitions("mix_key"))


@query("op4_mixing", """
    WITH sizes AS (
        SELECT source, sum(strlen(coalesce(text, ''))) AS b FROM documents GROUP BY source),
    rates AS (
        SELECT source, (SELECT sum(b) FROM sizes) * 1.0 / (SELECT count(*) FROM sizes) / b AS rate FROM sizes),
    cdf AS (
        SELECT source, rate, k,
               sum(exp(-rate + k * ln(rate) - CASE WHEN k < 2 THEN 0 ELSE lgamma(k + 1) END)) OVER (PARTITION BY source ORDER BY k) AS c
        FROM rates, generate_series(0, 300) AS g(k)),
    drawn AS (
        SELECT d.*, r.rate,
               (SELECT count(*) FROM cdf WHERE cdf.source = d.source AND cdf.c <=
                   CAST('0x' || substr(md5('42:' || d.doc_id), 1, 13) AS BIGINT) / 4503599627370496.0) AS n
        FROM documents d JOIN rates r ON d.source = r.source)
    SELECT doc_id, source, text, CAST(n AS INTEGER) AS copies, CAST(copy AS INTEGER) AS copy, round(rate, 6) AS rate,
           md5('42/' || doc_id || '/' || copy) AS order_key
    FROM (SELECT *, unnest(range(n)) AS copy FROM drawn WHERE n > 0)""")
def op4_mixing(spark, sf_dir):
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "text", F.col("mix_copies").alias("copies"), F.col("mix_copy").alias("copy"),
                        F.round("mix_rate", 6).alias("rate"), F.col("mix_key").alias("order_key"))
