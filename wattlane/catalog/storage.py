"""Sources and sinks: given tables written, read back and compared with what they were."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattlane.catalog.modelling import CONFIG, DIRTY_SQL, dirty_orders
from wattlane.catalog.registry import EVENTS_K, events_with_k, query, rounded, table
from wattlane.functions import day_name
from wattlane.operators.checks import build_checks
from wattlane.operators.features import build_features
from wattlane.operators.names import unique_names
from wattlane.operators.splits import fit_three_way_split
from wattlane.plans.eda import eda_tables
from wattlane.session import job_folder, settle, shared_dir
from wattlane.sources.ledger import RunLedger, compare_runs, payload_lines
from wattlane.sources.tables import (
    read_report, read_split, read_table, read_untidy_csv, write_report, write_results, write_splits, write_table,
)


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", """
SELECT CAST(o_orderkey AS VARCHAR) AS x0, CAST(o_custkey AS VARCHAR) AS x1, o_orderpriority AS "note, long" FROM orders
""")
def csv_round_trip(spark, d):
    """Orders as CSV folders whose files order their columns differently, read as one table."""
    path = fresh(spark, "csv")
    texts = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("x0"), F.col("o_custkey").cast("string").alias("x1"),
        F.col("o_orderpriority").alias("note, long"), "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    write_table(texts.where(done).select("x0", "x1", "note, long"), f"{path}/done", "csv")
    write_table(texts.where(~done).select("note, long", "x0", "x1"), f"{path}/open", "csv")
    return read_untidy_csv(spark, f"{path}/*", ordinal=False)


@query("csv_many_files", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS n, CAST(c_nationkey AS VARCHAR) AS n_1,
       CAST(c_acctbal AS VARCHAR) AS "balance\nof account", CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment
FROM customer
""")
def csv_many_files(spark, d):
    """Customers as many CSV files, a folder per nation: some begin with a byte-order mark, some name two columns alike,
    all have a header with a line break, and the order of columns differs."""
    c = table(spark, d, "customer").select(F.pmod("c_nationkey", F.lit(3)).alias("kind"), F.col("c_nationkey").alias("folder"), F.struct(
        F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"), F.col("c_nationkey").cast("string").alias("c"),
        F.col("c_nationkey").cast("string").alias("d"), F.col("c_acctbal").cast("string").alias("e"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise("n/a").alias("f")).alias("r"))
    names = ["c_custkey", "c_name", "n", "n", '"balance\nof account"', "c_mktsegment"]
    turned = F.struct(*[F.col(f"r.{x}") for x in "fedcba"])
    line = F.when(F.col("kind") == 2, F.to_csv(turned)).otherwise(F.to_csv("r"))
    head = F.when(F.col("kind") == 2, ",".join(names[::-1])).when(F.col("kind") == 1, "\ufeff" + ",".join(names)).otherwise(",".join(names))
    lines = c.select("folder", F.lit(0).alias("at"), head.alias("line")).distinct().unionByName(c.select("folder", F.lit(1).alias("at"), line.alias("line")))
    path = fresh(spark, "customers")
    lines.repartition("folder").sortWithinPartitions("folder", "at").select("folder", "line").write.partitionBy("folder").text(path)
    out = read_untidy_csv(spark, f"{path}/*", null_tokens=["n/a"], ordinal=False)
    return out.toDF(*unique_names(out.columns))


@query("ledger_round_trip", """
WITH m AS (SELECT o_orderpriority AS name, count(*)::DOUBLE AS n, avg(o_totalprice) AS mean, max(o_totalprice) AS top FROM orders GROUP BY 1),
v AS (SELECT *, row_number() OVER (ORDER BY name) AS version FROM m)
SELECT name, 'metric mean' AS item, round(mean + 1, 4) AS value, true AS passed FROM m
UNION ALL SELECT name, 'metric n', n, true FROM m
UNION ALL SELECT name, 'metric top', CASE WHEN name >= '3' THEN top END, name >= '3' FROM m
UNION ALL SELECT name, 'param source', NULL, true FROM m
UNION ALL SELECT 'best', 'version ' || (2 * version - 1), NULL, true FROM v
UNION ALL SELECT 'best', 'version ' || (2 * version), NULL, true FROM v
""")
def ledger_round_trip(spark, d):
    """A run per order priority: started, logged, opened again to change a metric and add another, registered twice, and
    checked. A metric that is missing or no number fails its check."""
    rows = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(
        F.count("*").cast("double").alias("n"), F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("top")).orderBy("name").collect()
    path = fresh(spark, "ledger")
    ledger = RunLedger(spark, path)
    started = {r["name"]: ledger.start(r["name"]) for r in rows}
    ledger.log_many([(started[r["name"]], r["name"], {"source": "orders"}, {"n": r["n"], "mean": r["mean"]}) for r in rows])
    again = RunLedger(spark, path)
    again.log_many([(started[r["name"]], r["name"], {}, {"mean": r["mean"] + 1, "top": r["top"] if r["name"] >= "3" else "none"}) for r in rows])
    for r in rows:
        again.register("best", started[r["name"]], f"{r['name']}/first")
        again.register("best", started[r["name"]], f"{r['name']}/second")
    log = settle(again.read(), "ledger")
    values = compare_runs(log, ["n", "mean", "top"]).select("run_id", F.inline(F.array(*[
        F.struct(F.lit(f"metric {m}").alias("check"), F.col(m).alias("value")) for m in ("n", "mean", "top")])))
    checks = payload_lines(log, ["n", "mean", "top"], ["source"])
    return checks.join(values, ["run_id", "check"], "left").select(
        "name", F.col("check").alias("item"), F.round("value", 4).alias("value"), "passed")


@query("report_round_trip", """
SELECT o_orderpriority AS model, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(min(o_totalprice), 2) AS low,
       round(max(o_totalprice), 2) AS high, CASE WHEN o_orderpriority >= '3' THEN max(o_orderkey) END AS last_key,
       (SELECT round(avg(o_totalprice), 4) FROM orders) AS overall, (SELECT count(*) FROM orders) AS total
FROM orders GROUP BY o_orderpriority
""")
def report_round_trip(spark, d):
    """A nested report over the orders, written as one typed JSON row, read back and taken apart by Spark."""
    orders = table(spark, d, "orders")
    rows = orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        F.max("o_orderkey").alias("key")).collect()
    overall = orders.agg(F.avg("o_totalprice"), F.count("*")).first()
    report = {"overall": {"mean": overall[0], "rows": overall[1]}, "models": [
        {"model": r["o_orderpriority"], "n": r["n"], "scores": {"mean": r["mean"], "range": [r["low"], r["high"]]},
         **({"last_key": r["key"]} if r["o_orderpriority"] >= "3" else {})} for r in rows]}
    read = read_report(spark, write_report(spark, report, fresh(spark, "report")))
    return read.select("overall", F.inline("models")).select(
        "model", "n", F.round("scores.mean", 4).alias("mean"), F.round(F.col("scores.range")[0], 2).alias("low"),
        F.round(F.col("scores.range")[1], 2).alias("high"), "last_key",
        F.round("overall.mean", 4).alias("overall"), F.col("overall.rows").alias("total"))


@query("sorted_write", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, true AS in_order FROM orders
""")
def sorted_write(spark, d):
    """Orders written by date and key; ``in_order`` says that a row follows its predecessor in its file, and that
    the file shares no date and key with another file's range."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_orderdate").cast("date").alias("o_orderdate"))
    path = write_table(orders, fresh(spark, "sorted"), order_by=["o_orderdate", "o_orderkey"])
    read = read_table(spark, path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    place = F.struct("o_orderdate", "o_orderkey")
    ends = read.groupBy("file").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    apart = ends.select("file", (F.coalesce(F.lag("high").over(Window.orderBy("low")) < F.col("low"), F.lit(True))).alias("apart"))
    before = F.lag(place).over(Window.partitionBy("file").orderBy("at"))
    follows = F.coalesce(before <= place, F.lit(True))
    return read.withColumn("follows", follows).join(apart, "file").select(
        "o_orderkey", "o_orderdate", (F.col("follows") & F.col("apart")).alias("in_order"))


@query("splits_round_trip", """
WITH h AS (SELECT o_orderkey, o_custkey, md5(concat_ws('|', '42', o_orderkey)) AS a, md5(concat_ws('|', '43', o_orderkey)) AS b FROM orders),
t AS (SELECT *, row_number() OVER (ORDER BY a) <= ceil(0.12::DOUBLE * (SELECT count(*) FROM h)) AS is_test FROM h),
v AS (SELECT *, row_number() OVER (PARTITION BY is_test ORDER BY b) AS r, count(*) OVER (PARTITION BY is_test) AS m FROM t)
SELECT o_orderkey, o_custkey FROM v WHERE NOT is_test AND r <= ceil(0.2::DOUBLE / (1 - 0.12::DOUBLE) * m)
""")
def splits_round_trip(spark, d):
    """The validation part, read back from the split files."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    path = fresh(spark, "splits")
    write_splits(fit_three_way_split(orders.select("o_orderkey"), ["o_orderkey"]).transform(orders), path)
    return read_split(spark, path, "val")


@query("build_checks", f"""
WITH {DIRTY_SQL},
n AS (SELECT count(*)::DOUBLE AS rows_in, count(*) FILTER (o_custkey IS NULL)::DOUBLE AS nulls_in FROM d),
o AS (SELECT count(*)::DOUBLE AS rows_out FROM u)
SELECT 'rows_not_added' AS "check", '*' AS "column", rows_out AS value, rows_in AS threshold, rows_out <= rows_in AS passed FROM n, o
UNION ALL SELECT 'rows_left', '*', rows_out, 0, rows_out > 0 FROM o
UNION ALL SELECT 'nulls_not_added', '*', 0, nulls_in, true FROM n
UNION ALL SELECT 'date_removed', 'o_orderdate', 1, 1, true
""")
def build_checks_query(spark, d):
    before = settle(dirty_orders(spark, d), "dirty")
    return rounded(build_checks(before, build_features(before, CONFIG)[0], "o_orderdate"))


@query("report_bundle", f"""
WITH e AS (SELECT ts, event_type, value, k, dayname(ts) AS day_of_week FROM ({EVENTS_K})),
days AS (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY))::DATE AS day FROM e)
SELECT 'daily' AS "table", CAST(day AS VARCHAR) AS item, round(coalesce(sum(value), 0), 4) AS value
FROM days LEFT JOIN e ON CAST(ts AS DATE) = day GROUP BY day
UNION ALL SELECT 'mean_by_hour', CAST(hour(ts) AS VARCHAR), round(avg(value), 4) FROM e GROUP BY hour(ts)
UNION ALL SELECT 'mean_by_day_of_week', day_of_week, round(avg(value), 4) FROM e GROUP BY day_of_week
UNION ALL SELECT 'mean_by_category', event_type, round(avg(value), 4) FROM e WHERE event_type IS NOT NULL GROUP BY event_type
UNION ALL SELECT 'ratio_by_month', strftime(ts, '%Y-%m'), round(median(k / value), 4) FROM e WHERE k > 0 AND value > 0 GROUP BY 2
{' '.join(f"UNION ALL SELECT 'data_quality', '{c}', (count(*) - count({c}))::DOUBLE FROM e" for c in ('ts', 'event_type', 'value', 'k', 'day_of_week'))}
""")
def report_bundle(spark, d):
    """The exploratory tables, written in one go and read back from their folders."""
    events = events_with_k(spark, d).select("ts", "event_type", "value", "k", day_name(F.col("ts")).alias("day_of_week"))
    with job_folder(spark):
        paths = write_results(eda_tables(events, "ts", "value", "k", "event_type", ["value", "k"]), fresh(spark, "report"))

    def lines(name, item, value):
        return read_table(spark, paths[name]).select(
            F.lit(name).alias("table"), F.expr(item).cast("string").alias("item"),
            F.round(F.col(value).cast("double"), 4).alias("value"))

    out = lines("daily", "day", "total")
    for name, item, value in (("mean_by_hour", "hour", "mean"), ("mean_by_day_of_week", "day_of_week", "mean"),
                              ("mean_by_category", "event_type", "mean"),
                              ("ratio_by_month", "date_format(month, 'yyyy-MM')", "median_ratio"),
                              ("data_quality", "column", "missing")):
        out = out.unionByName(lines(name, item, value))
    return out
