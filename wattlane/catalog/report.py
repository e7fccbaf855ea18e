"""Profile, aggregate, correlation, distribution and check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlane.catalog.cleaning import calendar_sql
from wattlane.catalog.registry import EVENTS_K, events_with_k, query, rounded, table
from wattlane.functions import day_name, hour_of_day, in_range_or_null, ratio, slot_floor, z_score
from wattlane.functions.distributions import HART_ABOVE, HART_BELOW
from wattlane.operators.checks import anova_by, anova_f, check_report, jarque_bera, ks_normality
from wattlane.operators.dedupe import duplicate_row_share
from wattlane.operators.grid import calendar_columns
from wattlane.operators.profile import column_stats, profile_columns, rule_violations
from wattlane.operators.ranks import rank_average, spearman_matrix, strongest_partners
from wattlane.operators.summaries import (
    box_numbers, daily_sum, first_rows, group_mean, histogram, monthly_median_ratio, top_rows, value_counts,
)
from wattlane.plans.cleaning import qa_report
from wattlane.plans.eda import summary_lines

HOLED = f"""h AS (SELECT event_id, ts, event_type, user_id, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value,
    CASE WHEN k BETWEEN 5 AND 80 THEN k END AS k FROM ({EVENTS_K}))"""


def holed(spark, d):
    return events_with_k(spark, d).select(
        "event_id", "ts", "event_type", "user_id", in_range_or_null(F.col("value"), 1, 200).alias("value"),
        in_range_or_null(F.col("k"), 5, 80).alias("k"))


TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "event_type": "string", "user_id": "bigint",
         "value": "double", "k": "double"}


@query("profile_columns", f"WITH {HOLED} " + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{t}' AS dtype, count(*) AS n, count(*) - count({c}) AS missing,
       CAST(round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*), 3) AS DOUBLE) AS pct_missing,
       count(DISTINCT {c}) AS n_unique FROM h""" for c, t in TYPES.items()))
def profile(spark, d):
    return profile_columns(holed(spark, d))


@query("column_stats", " UNION ALL ".join(f"""
SELECT '{c}' AS metric, count({c}) AS n, min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS sd, round(var_samp({c}), 4) AS variance FROM lineitem"""
                                   for c in ("l_quantity", "l_discount", "l_tax")))
def stats(spark, d):
    out = column_stats(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return rounded(out).withColumn("variance", F.round("variance", 4))


@query("value_counts", """
WITH v AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer)
SELECT segment, count(*) AS n FROM v GROUP BY segment
""")
def counts(spark, d):
    v = table(spark, d, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    return value_counts(v, "segment")


@query("rule_violations", """
SELECT 'negative_balance' AS rule, count(*) FILTER (c_acctbal < 0) AS n FROM customer
UNION ALL SELECT 'no_segment', count(*) FILTER (c_mktsegment IS NULL OR c_mktsegment = '') FROM customer
""")
def violations(spark, d):
    return rule_violations(table(spark, d, "customer"), {
        "negative_balance": F.col("c_acctbal") < 0,
        "no_segment": F.col("c_mktsegment").isNull() | (F.col("c_mktsegment") == "")})


@query("qa_report", f"""
WITH e AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS ts, value, k, {calendar_sql('ts')} FROM ({EVENTS_K})),
b AS (SELECT min(ts) AS a, max(ts) AS z FROM e),
g AS (SELECT unnest(generate_series(a, z, INTERVAL '15 minutes')) AS ts FROM b),
r AS (SELECT k / value AS r FROM e WHERE k > 0 AND value > 0)
SELECT 'n_expected' AS metric, CAST(count(*) AS DOUBLE) AS value FROM g
UNION ALL SELECT 'n_missing', CAST(count(*) AS DOUBLE) FROM g WHERE ts NOT IN (SELECT ts FROM e)
UNION ALL SELECT 'value_negative', CAST(count(*) FILTER (value < 0) AS DOUBLE) FROM e
UNION ALL SELECT 'k_outside_percent', CAST(count(*) FILTER (k < 0 OR k > 100) AS DOUBLE) FROM e
UNION ALL SELECT 'nsm_outside_day', CAST(count(*) FILTER (nsm < 0 OR nsm >= 86400) AS DOUBLE) FROM e
UNION ALL SELECT 'nsm_not_multiple', CAST(count(*) FILTER (nsm % 900 <> 0) AS DOUBLE) FROM e
UNION ALL SELECT 'ratio_q10', round(quantile_cont(r, 0.1), 6) FROM r
UNION ALL SELECT 'ratio_q50', round(quantile_cont(r, 0.5), 6) FROM r
UNION ALL SELECT 'ratio_q90', round(quantile_cont(r, 0.9), 6) FROM r
""")
def qa(spark, d):
    e = calendar_columns(events_with_k(spark, d), "ts").withColumn("ts", slot_floor(F.col("ts")))
    return rounded(qa_report(e, "ts", ["value"], ["k"], "nsm", ("k", "value")))


@query("daily_sum_filled", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS s FROM orders GROUP BY 1),
b AS (SELECT min(day) AS a, max(day) AS z FROM d),
c AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL '1 day')) AS DATE) AS day FROM b)
SELECT day, round(coalesce(s, 0), 2) AS total FROM c LEFT JOIN d USING (day)
""")
def daily(spark, d):
    return rounded(daily_sum(table(spark, d, "orders"), "o_orderdate", "o_totalprice"), 2)


@query("mean_by_hour", "SELECT CAST(hour(ts) AS BIGINT) AS hour, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def mean_by_hour(spark, d):
    return rounded(group_mean(table(spark, d, "events"), hour_of_day(F.col("ts")), "hour", "value"))


@query("mean_by_dow", "SELECT dayname(ts) AS day_of_week, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def mean_by_dow(spark, d):
    return rounded(group_mean(table(spark, d, "events"), day_name(F.col("ts")), "day_of_week", "value"))


@query("mean_by_category", f"""
WITH {HOLED} SELECT event_type, round(avg(value), 6) AS mean FROM h WHERE event_type <> 'error' GROUP BY 1
""")
def mean_by_category(spark, d):
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    return rounded(group_mean(holed(spark, d), known, "event_type", "value"))


@query("peak_hours", """
SELECT CAST(hour(ts) AS BIGINT) AS hour, round(avg(value), 6) AS mean FROM events GROUP BY 1
ORDER BY avg(value) DESC, 1 LIMIT 5
""")
def peak_hours(spark, d):
    means = group_mean(table(spark, d, "events"), hour_of_day(F.col("ts")), "hour", "value")
    return rounded(top_rows(means, "mean", ["hour"], 5))


@query("first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def first(spark, d):
    return first_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 10)


@query("monthly_ratio_median", """
WITH r AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice / o_custkey AS r FROM orders
           WHERE o_totalprice > 0 AND o_custkey > 0)
SELECT month, round(median(r), 6) AS median_ratio FROM r GROUP BY month
""")
def monthly_ratio(spark, d):
    orders = table(spark, d, "orders").withColumn("o_custkey", F.col("o_custkey").cast("double"))
    return rounded(monthly_median_ratio(orders, "o_orderdate", "o_totalprice", "o_custkey"))


RANKED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_HOLES = """x AS (SELECT l_quantity, CASE WHEN l_quantity >= 10 THEN l_extendedprice END AS l_extendedprice, l_discount,
    CASE WHEN l_discount > 0.02 THEN l_tax END AS l_tax FROM lineitem)"""


def line_holes(spark, d):
    return table(spark, d, "lineitem").select(
        "l_quantity", F.when(F.col("l_quantity") >= 10, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", F.when(F.col("l_discount") > 0.02, F.col("l_tax")).alias("l_tax"))


def rank_sql(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


def pair_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 6) AS rho, count(*) AS n FROM (
        SELECT CAST({rank_sql('a')} AS DOUBLE) AS ra, CAST({rank_sql('b')} AS DOUBLE) AS rb FROM (
            SELECT {a} AS a, {b} AS b FROM x WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"""


@query("spearman_matrix", f"WITH {LINE_HOLES} " + " UNION ALL ".join(pair_sql(a, b) for a in RANKED for b in RANKED))
def spearman(spark, d):
    return rounded(spearman_matrix(line_holes(spark, d), RANKED))


@query("spearman_top", f"WITH {LINE_HOLES}, m AS (" + " UNION ALL ".join(pair_sql(a, "l_quantity") for a in RANKED) +
       ') SELECT col_a AS "column", rho FROM m ORDER BY rho DESC, col_a LIMIT 3')
def spearman_top(spark, d):
    return rounded(strongest_partners(spearman_matrix(line_holes(spark, d), RANKED), "l_quantity", 3))


@query("rank_average", f"""
WITH {HOLED} SELECT event_id, value, CASE WHEN value IS NOT NULL THEN
    CAST(rank() OVER (ORDER BY value NULLS LAST) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS DOUBLE) END AS rank
FROM h
""")
def ranks(spark, d):
    return rank_average(holed(spark, d).select("event_id", "value"), "value")


def histogram_sql(source: str, columns: list[str], bins: int) -> str:
    return " UNION ALL ".join(f"""
SELECT '{c}' AS metric, i AS bin, round(a + (b - a) / {bins} * (i - 1), 6) AS low, round(a + (b - a) / {bins} * i, 6) AS high,
       count(v) AS n
FROM (SELECT min({c}) AS a, max({c}) AS b FROM {source}) CROSS JOIN (SELECT unnest(range(1, {bins + 1})) AS i)
LEFT JOIN (SELECT {c} AS v, least(CAST(floor({bins} * ({c} - (SELECT min({c}) FROM {source}))
    / ((SELECT max({c}) FROM {source}) - (SELECT min({c}) FROM {source}))) AS BIGINT) + 1, {bins}) AS j
    FROM {source} WHERE {c} IS NOT NULL) ON i = j
GROUP BY i, a, b""" for c in columns)


@query("histogram_bins", f"WITH {HOLED} {histogram_sql('h', ['value', 'k'], 60)}")
def histogram_bins(spark, d):
    return rounded(histogram(holed(spark, d), ["value", "k"], 60))


@query("boxplot_numbers", """
WITH q AS (SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT q.event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM q JOIN events e ON e.event_type = q.event_type GROUP BY q.event_type, n, q1, median, q3
""")
def boxplot(spark, d):
    return rounded(box_numbers(table(spark, d, "events"), "value", "event_type"))


@query("z_scores", """
WITH s AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       round((l_quantity - m) / sd, 6) AS z FROM lineitem, s
""")
def z_scores(spark, d):
    line = table(spark, d, "lineitem")
    s = line.agg(F.struct(F.avg("l_quantity").alias("m"), F.stddev_samp("l_quantity").alias("sd"))).scalar()
    return rounded(line.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias(
        "l_linenumber"), z_score(F.col("l_quantity"), s.getField("m"), s.getField("sd")).alias("z")))


@query("positive_ratio", """
SELECT o_orderkey, CASE WHEN o_custkey > 0 AND o_totalprice > 0 THEN o_totalprice / o_custkey END AS ratio FROM orders
""")
def positive_ratio(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", ratio(F.col("o_totalprice"), F.col("o_custkey").cast("double")).alias("ratio"))


@query("duplicate_rows", """
WITH g AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
       round(sum(n - 1) * 100.0::DOUBLE / sum(n), 6) AS pct_duplicates FROM g
""")
def duplicate_rows(spark, d):
    return rounded(duplicate_row_share(table(spark, d, "events").select("event_type", "value")))


CHECKED = ["l_quantity", "l_discount", "l_tax"]
CHECK_TARGET = "l_extendedprice"


def checks_sql() -> str:
    def line(check, column, value, threshold, passed, source="lineitem"):
        return (f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", CAST({value} AS DOUBLE) AS value, "
                f"CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed FROM {source}")

    one = "(SELECT 1)"
    out = [line("target_present", CHECK_TARGET, 1, 1, "TRUE", one),
           line("target_numeric", CHECK_TARGET, 1, 1, "TRUE", one),
           line("enough_rows", "*", "count(*)", 100, "count(*) >= 100"),
           line("enough_features", "*", 3, 3, "TRUE", one),
           line("target_nonnegative", CHECK_TARGET, f"min({CHECK_TARGET})", 0, f"min({CHECK_TARGET}) >= 0"),
           line("duplicate_rows", "*", "round(p, 6)", 1, "p < 1",
                f"(SELECT sum(n - 1) * 100.0::DOUBLE / sum(n) AS p FROM (SELECT count(*) AS n FROM lineitem "
                f"GROUP BY {', '.join([*CHECKED, CHECK_TARGET])}))")]
    for c in [*CHECKED, CHECK_TARGET]:
        out.append(line("no_nulls", c, f"count(*) FILTER ({c} IS NULL)", 0, f"count(*) FILTER ({c} IS NULL) = 0"))
    for c in CHECKED:
        q1, q99 = f"quantile_cont({c}, 0.01)", f"quantile_cont({c}, 0.99)"
        top, bottom = f"{q99} + ({q99} - {q1}) * 0.5", f"{q1} - ({q99} - {q1}) * 1.0"
        z = f"(SELECT count(*) FILTER (abs(({c} - m) / sd) > 5) * 100.0::DOUBLE / count(*) AS p FROM lineitem, " \
            f"(SELECT avg({c}) AS m, stddev_samp({c}) AS sd FROM lineitem))"
        out += [line("numeric_type", c, 1, 1, "TRUE", one),
                line("no_infinities", c, f"count(*) FILTER (isinf({c}))", 0, f"count(*) FILTER (isinf({c})) = 0"),
                line("has_variance", c, f"round(var_samp({c}), 6)", 0, f"var_samp({c}) > 0"),
                line("range_high", c, f"max({c})", f"round({top}, 6)", f"max({c}) <= {top}"),
                line("range_low", c, f"min({c})", f"round({bottom}, 6)", f"min({c}) >= {bottom}"),
                line("few_outliers", c, "round(p, 6)", 0.1, "p < 0.1", z)]
    return " UNION ALL ".join(out)


@query("checks_report", checks_sql())
def checks(spark, d):
    return rounded(check_report(table(spark, d, "lineitem"), CHECK_TARGET, CHECKED))


def moments_sql(c: str) -> str:
    return f"""SELECT '{c}' AS metric, n, round(s, 6) AS skew, round(e, 6) AS excess,
        round(n / 6.0 * (s * s + e * e / 4.0), 3) AS statistic, round(exp(-(n / 6.0 * (s * s + e * e / 4.0)) / 2), 6) AS p_value
    FROM (SELECT count({c}) AS n, avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) AS s,
                 avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 AS e
          FROM lineitem, (SELECT avg({c}) AS m FROM lineitem))"""


@query("jarque_bera", " UNION ALL ".join(moments_sql(c) for c in CHECKED))
def jarque_bera_query(spark, d):
    out = jarque_bera(table(spark, d, "lineitem"), CHECKED)
    return rounded(out.withColumn("statistic", F.round("statistic", 3)))


def poly_sql(x: str, coefficients: list[float]) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def ks_sql(c: str) -> str:
    """Distance from the ranks of the distinct values; the tail by its series. No z here reaches 7."""
    return f"""
SELECT '{c}' AS metric, n, round(d, 6) AS statistic,
       round(CASE WHEN n * d * d < 0.04 THEN 1 ELSE greatest(least(list_sum(list_transform(range(1, 201), lambda j:
           (CASE WHEN j % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END) * exp(-2.0::DOUBLE * j * j * least(n * d * d, 1e4)))), 1), 0) END, 6) AS p_value
FROM (SELECT any_value(n) AS n, max(greatest(upto / n - normal, normal - (upto - same) / n)) AS d FROM (
    SELECT n, CAST(upto AS DOUBLE) AS upto, same, CASE WHEN z > 0 THEN 1 - tail ELSE tail END AS normal FROM (
        SELECT *, exp(-x * x / 2) * {poly_sql('x', HART_ABOVE)} / {poly_sql('x', HART_BELOW)} AS tail FROM (
            SELECT n, same, upto, z, abs(z) AS x FROM (
                SELECT n, same, sum(same) OVER (ORDER BY v) AS upto, (v - m) / sd AS z FROM (
                    SELECT {c} AS v, count(*) AS same FROM t WHERE {c} IS NOT NULL GROUP BY {c}),
                    (SELECT count({c}) AS n, avg({c}) AS m, stddev_samp({c}) AS sd FROM t))))))"""


KS_TABLE = "t AS (SELECT l_quantity, CASE WHEN l_discount > 0.03 THEN l_extendedprice END AS l_extendedprice FROM lineitem)"


@query("ks_normality", f"WITH {KS_TABLE}" + " UNION ALL ".join(ks_sql(c) for c in ("l_quantity", "l_extendedprice")))
def ks(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_quantity", F.when(F.col("l_discount") > 0.03, F.col("l_extendedprice")).alias("l_extendedprice"))
    return rounded(ks_normality(lines, ["l_quantity", "l_extendedprice"]))


@query("anova_by", """
WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS s FROM orders
           WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * m) / sum(n) AS gm, sum(n * s) AS w FROM g),
b AS (SELECT k, t.n, sum(g.n * pow(g.m - gm, 2)) AS ssb, w AS ssw FROM g, t GROUP BY k, t.n, w),
f AS (SELECT *, (ssb / (k - 1)) / (ssw / (n - k)) AS f, (n - k) / 2.0 AS a FROM b),
x AS (SELECT *, 1 / (1 + (k - 1) * f / (n - k)) AS x FROM f)
SELECT k AS n_groups, n, round(ssb / 1e6, 2) AS ss_between, round(ssw / 1e6, 2) AS ss_within, round(f, 4) AS f_value,
       round(pow(x, a) * (1 + a * (1 - x)), 6) AS p_value FROM x
""")
def anova_by_query(spark, d):
    """Total price between the five order priorities. With five groups the tail of F is a finite sum, which the
    SQL takes; the operator has the one form for any number."""
    out = anova_by(table(spark, d, "orders"), "o_totalprice", "o_orderpriority")
    return out.select("n_groups", "n", *[F.round(F.col(c) / 1e6, 2).alias(c) for c in ("ss_between", "ss_within")],
                      F.round("f_value", 4).alias("f_value"), F.round("p_value", 6).alias("p_value"))


@query("anova_f", f"""
WITH g AS (""" + " UNION ALL ".join(
    f"SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) AS s FROM lineitem" for c in CHECKED) + """),
t AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS gm, sum(n * s) AS w FROM g),
b AS (SELECT CAST(t.n AS BIGINT) AS n, sum(g.n * pow(g.m - gm, 2)) AS ssb, w AS ssw FROM g, t GROUP BY t.n, w),
f AS (SELECT *, (ssb / 2) / (ssw / (n - 3)) AS f FROM b)
SELECT CAST(3 AS BIGINT) AS n_groups, n, round(ssb, 3) AS ss_between, round(ssw, 3) AS ss_within, round(f, 3) AS f_value,
       round(pow(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 6) AS p_value FROM f
""")
def anova(spark, d):
    return rounded(rounded(anova_f(table(spark, d, "lineitem"), CHECKED), 6).withColumns({
        c: F.round(c, 3) for c in ("ss_between", "ss_within", "f_value")}))


@query("summary_lines", f"""
WITH e AS (SELECT event_id, ts, event_type, value, k, dayname(ts) AS day_of_week FROM ({EVENTS_K})),
x AS (SELECT event_id, value, k FROM e),
m AS ({' UNION ALL '.join(pair_sql(a, 'value') for a in ('event_id', 'value', 'k'))})
SELECT 'rows' AS section, 'n' AS item, CAST(count(*) AS DOUBLE) AS value FROM e
UNION ALL SELECT 'first', CAST(min(ts) AS VARCHAR), NULL FROM e
UNION ALL SELECT 'last', CAST(max(ts) AS VARCHAR), NULL FROM e
UNION ALL SELECT 'correlation', col_a, rho FROM m
UNION ALL SELECT 'peak_hour', CAST(h AS VARCHAR), round(v, 2) FROM (
    SELECT hour(ts) AS h, avg(value) AS v FROM e GROUP BY 1 ORDER BY v DESC, h LIMIT 5)
UNION ALL SELECT 'day_of_week', day_of_week, round(avg(value), 2) FROM e GROUP BY day_of_week
UNION ALL SELECT 'event_type', event_type, round(avg(value), 2) FROM e GROUP BY event_type
UNION ALL SELECT 'median_ratio', 'k/value', round(median(k / value), 6) FROM e WHERE k > 0 AND value > 0
""")
def summary(spark, d):
    e = events_with_k(spark, d).select("event_id", "ts", "event_type", "value", "k",
                                       day_name(F.col("ts")).alias("day_of_week"))
    matrix = spearman_matrix(e, ["event_id", "value", "k"])
    out = summary_lines(e, "ts", "value", "k", "event_type", matrix)
    return rounded(out)
