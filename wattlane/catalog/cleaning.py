"""Cleaning, imputation, capping and grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlane import defaults as D
from wattlane.catalog.registry import EVENTS_K, events_with_k, query, rounded, table
from wattlane.functions import (
    category_rank, coerce_numeric, day_name, hour_of_day, in_range_or_null, mixed_label, month_start,
    nonnegative_or_null, normalise_category, seconds_since_midnight, sentinel_to_null, slot_ceil, slot_floor,
    to_timestamp_dayfirst, week_status, binary_code, in_domain_or_null,
)
from wattlane.operators.cap import cap_iqr
from wattlane.operators.dedupe import dedupe_by_time, duplicate_counts
from wattlane.operators.grid import complete_grid, fill_label, full_grid, missing_slots, slot_counts, time_grid
from wattlane.operators.impute import impute_by_hierarchy, impute_by_ratio, impute_mode_by_key
from wattlane.operators.quantiles import exact_quantiles
from wattlane.operators.summaries import group_mean
from wattlane.plans.cleaning import clean, cleaning_counts, typed_readings
from wattlane.session import choose_method, settle, unnest

SLOTS = """
slots AS (SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS ts, user_id, event_type, value, k FROM ev),
firsts AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ts ORDER BY event_id) AS rn FROM slots) WHERE rn = 1)
"""


def slotted(spark, d):
    return events_with_k(spark, d).drop("props").withColumn("ts", slot_floor(F.col("ts")))


def first_per_slot(spark, d):
    return dedupe_by_time(slotted(spark, d), "ts", ["event_id"], "first")


def medians_sql(source: str, keys: list[str], columns: list[str]) -> str:
    """Grouped medians, null keys left out."""
    wanted = ", ".join(f"median({c}) AS {c}" for c in columns)
    if not keys:
        return f"SELECT {wanted} FROM {source}"
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"SELECT {', '.join(keys)}, {wanted} FROM {source} WHERE {present} GROUP BY {', '.join(keys)}"


def impute_sql(source: str, levels: list[list[str]], columns: list[str]) -> str:
    """Left joins of the median tables; coalesce in level order."""
    joins, names = [], []
    for i, keys in enumerate(levels):
        names.append(f"m{i}")
        on = " AND ".join(f"s.{k} = m{i}.{k}" for k in keys) or "TRUE"
        joins.append(f"LEFT JOIN ({medians_sql(source, keys, columns)}) m{i} ON {on}")
    fills = ", ".join(f"coalesce(s.{c}, {', '.join(f'{n}.{c}' for n in names)}) AS {c}" for c in columns)
    return f"SELECT s.* REPLACE ({fills}) FROM {source} s {' '.join(joins)}"


def cap_sql(source: str, columns: list[str], k: float = 1.5) -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in columns)
    clips = ", ".join(
        f"CASE WHEN s.{c} IS NULL THEN NULL ELSE greatest(least(s.{c}, q.{c}_3 + {k} * (q.{c}_3 - q.{c}_1)), "
        f"q.{c}_1 - {k} * (q.{c}_3 - q.{c}_1)) END AS {c}" for c in columns)
    return f"SELECT s.* REPLACE ({clips}) FROM {source} s, (SELECT {q} FROM {source}) q"


@query("clean_flagship", f"""
WITH ev AS ({EVENTS_K}), {SLOTS},
ruled AS (SELECT event_type, dayname(ts) AS day_of_week,
                 CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value FROM firsts),
filled AS ({impute_sql('ruled', [['event_type', 'day_of_week'], ['day_of_week'], []], ['value'])}),
capped AS ({cap_sql('filled', ['value'])})
SELECT event_type, day_of_week, count(*) AS n, round(avg(value), 6) AS mean_value
FROM capped GROUP BY event_type, day_of_week
""")
def clean_flagship(spark, d):
    """Mean cleaned value per event type and day of week: slots, first reading per slot,
    range rule, three-level median, quartile fences, group mean."""
    events = table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    method = choose_method(events)
    first = dedupe_by_time(events.withColumn("ts", slot_floor(F.col("ts"))), "ts", ["event_id"])
    ruled = settle(first.select(
        "event_type", day_name(F.col("ts")).alias("day_of_week"),
        in_range_or_null(F.col("value"), 1, 200).alias("value")), "ruled")
    filled = unnest(impute_by_hierarchy(
        ruled, ["value"], [["event_type", "day_of_week"], ["day_of_week"], []], method), method, "filled")
    capped = cap_iqr(filled, ["value"], 1.5, method)
    return rounded(capped.groupBy("event_type", "day_of_week").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean_value")))


@query("dedupe_first", f"""
WITH ev AS ({EVENTS_K}), {SLOTS} SELECT * FROM firsts
""")
def dedupe_first(spark, d):
    return first_per_slot(spark, d)


@query("dedupe_aggregate", f"""
WITH ev AS ({EVENTS_K}), {SLOTS},
blank AS (SELECT event_id, ts, value, k, CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM slots)
SELECT ts, round(avg(value), 6) AS value, round(avg(k), 6) AS k,
       arg_min(event_type, event_id) FILTER (event_type IS NOT NULL) AS event_type
FROM blank GROUP BY ts
""")
def dedupe_aggregate(spark, d):
    blank = slotted(spark, d).drop("user_id").withColumn(
        "event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    return rounded(dedupe_by_time(blank, "ts", ["event_id"], "aggregate"))


@query("dup_counts", f"""
WITH ev AS ({EVENTS_K}), s AS (
    SELECT CASE WHEN user_id <> 7 THEN time_bucket(INTERVAL '15 minutes', ts) END AS ts FROM ev),
g AS (SELECT ts, count(*) AS n FROM s GROUP BY ts)
SELECT CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(n) FILTER (ts IS NULL), 0) AS BIGINT) AS n_no_key,
       CAST(coalesce(sum(n - 1) FILTER (ts IS NOT NULL), 0) AS BIGINT) AS n_surplus,
       CAST(coalesce(sum(n) FILTER (ts IS NOT NULL AND n > 1), 0) AS BIGINT) AS n_members
FROM g
""")
def dup_counts(spark, d):
    s = slotted(spark, d).select(F.when(F.col("user_id") != 7, F.col("ts")).alias("ts"))
    return duplicate_counts(s, ["ts"])


@query("calendar_features", """
SELECT event_id, dayname(ts) AS day_of_week,
       CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS week_status,
       CAST(CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS BIGINT) AS day_status_num,
       CAST(round_even((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 900.0, 0) AS BIGINT) * 900 AS nsm,
       CAST(hour(ts) AS BIGINT) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month,
       time_bucket(INTERVAL '15 minutes', ts) AS slot_start,
       CASE WHEN time_bucket(INTERVAL '15 minutes', ts) = ts THEN ts
            ELSE time_bucket(INTERVAL '15 minutes', ts) + INTERVAL '15 minutes' END AS slot_end
FROM events
""")
def calendar_features(spark, d):
    ts = F.col("ts")
    day = day_name(ts)
    return table(spark, d, "events").select(
        "event_id", day.alias("day_of_week"), week_status(day).alias("week_status"),
        binary_code(week_status(day)).cast("long").alias("day_status_num"), seconds_since_midnight(ts).alias("nsm"),
        hour_of_day(ts).alias("hour"), month_start(ts).alias("month"), slot_floor(ts).alias("slot_start"),
        slot_ceil(ts).alias("slot_end"))


PRIORITY_RULES = [("URGENT", "Urgent"), ("HIGH", "High"), ("MEDIUM", "Medium")]
PRIORITY_SQL = ("CASE WHEN o_orderpriority ILIKE '%urgent%' THEN 'Urgent' WHEN o_orderpriority ILIKE '%high%' THEN 'High' "
                "WHEN o_orderpriority ILIKE '%medium%' THEN 'Medium' END")


@query("normalize_category", f"SELECT o_orderkey, o_orderpriority AS priority_raw, {PRIORITY_SQL} AS priority FROM orders")
def normalize_category(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", p.alias("priority_raw"), normalise_category(p, PRIORITY_RULES).alias("priority"))


@query("category_order", f"""
WITH c AS (SELECT o_orderkey, {PRIORITY_SQL} AS p FROM orders),
m AS (SELECT o_orderkey, CASE WHEN p IN ('Medium', 'High') THEN p END AS category FROM c)
SELECT o_orderkey, category, CAST(CASE category WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS BIGINT) AS category_rank
FROM m
""")
def category_order(spark, d):
    domain = ["Medium", "High"]
    c = in_domain_or_null(normalise_category(F.col("o_orderpriority"), PRIORITY_RULES), domain)
    return table(spark, d, "orders").select("o_orderkey", c.alias("category")).withColumn(
        "category_rank", category_rank(F.col("category"), domain))


MIXED_PART = "CASE WHEN p_size % 2 = 0 THEN ' ' || p_size || ' ' WHEN p_size % 3 = 0 THEN p_size || 'd' " \
             "WHEN p_size % 5 = 0 THEN 'bad' ELSE p_brand END"


def mixed_part(spark, d):
    return table(spark, d, "part").select("p_partkey", F.expr(MIXED_PART).alias("raw"))


@query("coerce_numeric", f"""
SELECT p_partkey, {MIXED_PART} AS raw,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS number FROM part
""")
def coerce_numeric_query(spark, d):
    return mixed_part(spark, d).withColumn("number", coerce_numeric(F.col("raw")))


@query("split_mixed", f"""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS number,
       CASE WHEN p_size % 2 <> 0 THEN {MIXED_PART} END AS label FROM part
""")
def split_mixed_query(spark, d):
    number = coerce_numeric(F.col("raw"))
    return mixed_part(spark, d).select("p_partkey", number.alias("number"),
                                       mixed_label(F.col("raw"), number).alias("label"))


@query("sentinel_to_null", f"""
WITH m AS (SELECT p_partkey, {MIXED_PART} AS raw FROM part)
SELECT p_partkey, CASE WHEN raw NOT IN ({', '.join(repr(s) for s in D.SENTINELS)}) THEN raw END AS value FROM m
""")
def sentinel_query(spark, d):
    return mixed_part(spark, d).select("p_partkey", sentinel_to_null(F.col("raw")).alias("value"))


@query("parse_dayfirst", """
WITH t AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M')
    WHEN o_custkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE o_orderpriority END AS text FROM orders)
SELECT o_orderkey, text,
       coalesce(try_strptime(text, '%d/%m/%Y %H:%M'), try_strptime(text, '%Y-%m-%d %H:%M:%S')) AS parsed FROM t
""")
def parse_dayfirst(spark, d):
    text = (F.when(F.col("o_custkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
            .when(F.col("o_custkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.col("o_orderpriority")))
    return table(spark, d, "orders").select("o_orderkey", text.alias("text")).withColumn(
        "parsed", to_timestamp_dayfirst(F.col("text")))


@query("rule_nonnegative", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer
""")
def rule_nonnegative(spark, d):
    return table(spark, d, "customer").select("c_custkey", nonnegative_or_null(F.col("c_acctbal")).alias("balance"))


@query("rule_range", """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS quantity FROM lineitem
""")
def rule_range(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        in_range_or_null(F.col("l_quantity"), 5, 45).alias("quantity"))


HOLES_SQL = f"""ev AS ({EVENTS_K}),
holes AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type END AS event_type,
                 dayname(ts) AS day_of_week, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value,
                 CASE WHEN k BETWEEN 5 AND 80 THEN k END AS k FROM ev)"""


def with_holes(spark, d):
    """Events with nulls in both measures and in the category."""
    return events_with_k(spark, d).select(
        "event_id", F.when(F.col("event_type") != "signup", F.col("event_type")).alias("event_type"),
        day_name(F.col("ts")).alias("day_of_week"), in_range_or_null(F.col("value"), 1, 200).alias("value"),
        in_range_or_null(F.col("k"), 5, 80).alias("k"))


@query("impute_hierarchy", f"""
WITH {HOLES_SQL}, filled AS ({impute_sql('holes', [['event_type', 'day_of_week'], ['day_of_week'], []], ['value', 'k'])})
SELECT * REPLACE (round(value, 6) AS value, round(k, 6) AS k) FROM filled
""")
def impute_hierarchy(spark, d):
    return rounded(impute_by_hierarchy(
        with_holes(spark, d), ["value", "k"], [["event_type", "day_of_week"], ["day_of_week"], []]))


@query("impute_ratio", f"""
WITH {HOLES_SQL}, f AS (SELECT median(k / value) AS f FROM holes WHERE k > 0 AND value > 0)
SELECT event_id, value, round(coalesce(k, value * f), 6) AS k FROM holes, f
""")
def impute_ratio(spark, d):
    return rounded(impute_by_ratio(with_holes(spark, d).select("event_id", "value", "k"), "k", "value"))


@query("impute_mode_by_key", f"""
WITH {HOLES_SQL},
c AS (SELECT day_of_week, event_type, count(*) AS n FROM holes WHERE event_type IS NOT NULL GROUP BY ALL),
m AS (SELECT day_of_week, event_type AS mode FROM (SELECT *, row_number() OVER (PARTITION BY day_of_week ORDER BY n DESC,
      list_position(['view', 'purchase', 'error', 'click'], event_type)) AS rn FROM c) WHERE rn = 1)
SELECT event_id, h.day_of_week, coalesce(event_type, mode) AS event_type FROM holes h LEFT JOIN m USING (day_of_week)
""")
def impute_mode(spark, d):
    holes = with_holes(spark, d).select("event_id", "day_of_week", "event_type")
    return impute_mode_by_key(holes, "event_type", "day_of_week", ["view", "purchase", "error", "click"])


@query("cap_iqr", f"""
WITH {HOLES_SQL}, capped AS ({cap_sql('holes', ['value', 'k'])})
SELECT event_id, round(value, 6) AS value, round(k, 6) AS k FROM capped
""")
def cap_iqr_query(spark, d):
    return rounded(cap_iqr(with_holes(spark, d).select("event_id", "value", "k"), ["value", "k"]))


QUANTILE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
PROBABILITIES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query("quantiles", " UNION ALL ".join(f"""
SELECT l_returnflag, '{c}' AS metric, p, n, round(q, 6) AS q FROM (
    SELECT l_returnflag, count({c}) AS n, unnest([{', '.join(map(str, PROBABILITIES))}]::DOUBLE[]) AS p,
           unnest(quantile_cont({c}, [{', '.join(map(str, PROBABILITIES))}])) AS q FROM lineitem GROUP BY l_returnflag)
""" for c in QUANTILE_COLUMNS))
def quantiles(spark, d):
    q = exact_quantiles(table(spark, d, "lineitem"), QUANTILE_COLUMNS, PROBABILITIES, ["l_returnflag"])
    grid = F.array(*[F.lit(p) for p in PROBABILITIES])
    return rounded(q.select("l_returnflag", "metric", "n", F.inline(F.arrays_zip(grid.alias("p"), F.col("q").alias("q")))))


GRID_SQL = """
bounds AS (SELECT min(ts) AS a, max(ts) AS b FROM firsts),
grid AS (SELECT unnest(generate_series(a, b, INTERVAL '15 minutes')) AS ts FROM bounds)
"""


@query("time_grid", """
WITH b AS (SELECT time_bucket(INTERVAL '15 minutes', min(ts)) AS a, time_bucket(INTERVAL '15 minutes', max(ts)) AS z,
                  max(ts) AS m FROM events)
SELECT unnest(generate_series(a, CASE WHEN z = m THEN z ELSE z + INTERVAL '15 minutes' END, INTERVAL '15 minutes')) AS ts
FROM b
""")
def time_grid_query(spark, d):
    return time_grid(table(spark, d, "events"), "ts")


@query("grid_complete", f"""
WITH ev AS ({EVENTS_K}), {SLOTS}, {GRID_SQL}
SELECT ts, event_id, user_id, event_type, value, k FROM grid LEFT JOIN firsts USING (ts)
""")
def grid_complete(spark, d):
    return complete_grid(first_per_slot(spark, d), "ts")


@query("grid_missing_slots", f"""
WITH ev AS ({EVENTS_K}), {SLOTS}, {GRID_SQL} SELECT ts FROM grid EXCEPT SELECT ts FROM firsts
""")
def grid_missing(spark, d):
    return missing_slots(slotted(spark, d), "ts")


@query("grid_slot_counts", f"""
WITH ev AS ({EVENTS_K}), {SLOTS}, {GRID_SQL}
SELECT count(*) AS n_expected, count(event_id) AS n_filled, count(*) - count(event_id) AS n_missing
FROM grid LEFT JOIN firsts USING (ts)
""")
def grid_slot_counts(spark, d):
    return slot_counts(slotted(spark, d), "ts")


def fill_sql(source: str, label: str, ts: str = "ts") -> str:
    return f"""SELECT * EXCLUDE (ff) REPLACE (first_value(ff IGNORE NULLS) OVER (
        ORDER BY {ts} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {label}) FROM (
        SELECT *, last_value({label} IGNORE NULLS) OVER (PARTITION BY CAST({ts} AS DATE) ORDER BY {ts}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff FROM {source})"""


@query("grid_fill_labels", f"""
WITH ev AS ({EVENTS_K}), {SLOTS}, {GRID_SQL},
joined AS (SELECT ts, CASE WHEN event_type IN ('purchase', 'view') AND hour(ts) > 9 AND day(ts) % 4 <> 0
                           THEN event_type END AS event_type FROM grid LEFT JOIN firsts USING (ts))
{fill_sql('joined', 'event_type')}
""")
def grid_fill_labels(spark, d):
    grid = complete_grid(first_per_slot(spark, d).select("ts", "event_type"), "ts")
    seen = F.col("event_type").isin("purchase", "view") & (F.hour("ts") > 9) & (F.dayofmonth("ts") % 4 != 0)
    return fill_label(grid.withColumn("event_type", F.when(seen, F.col("event_type"))), "ts", "event_type")


def calendar_sql(ts: str = "ts") -> str:
    return f"""dayname({ts}) AS day_of_week,
        CASE WHEN dayname({ts}) IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS week_status,
        CAST(CASE WHEN dayname({ts}) IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS BIGINT) AS day_status_num,
        CAST(round_even((hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})) / 900.0, 0) AS BIGINT) * 900 AS nsm"""


@query("grid_full", f"""
WITH ev AS ({EVENTS_K}), {SLOTS}, {GRID_SQL},
joined AS (SELECT ts, event_type, value, k, {calendar_sql()} FROM grid LEFT JOIN firsts USING (ts)),
labelled AS ({fill_sql('joined', 'event_type')}),
filled AS ({impute_sql('labelled', [['event_type', 'day_of_week'], ['day_of_week'], []], ['value', 'k'])})
SELECT * REPLACE (round(value, 6) AS value, round(k, 6) AS k) FROM filled
""")
def grid_full(spark, d):
    first = first_per_slot(spark, d).select("ts", "event_type", "value", "k")
    out = full_grid(first, "ts", "event_type", ["value", "k"], method=choose_method(table(spark, d, "events")))
    return rounded(out.withColumn("day_status_num", F.col("day_status_num").cast("long")))


# Raw readings in the shape of an untidy file, derived from every event.
def raw_readings(spark, d):
    e = events_with_k(spark, d)
    v, k = F.col("value"), F.col("k")
    mixed = F.when(k < 10, "bad").when(k < 20, "unknown").otherwise(k.cast("string"))
    load = (F.when(F.col("event_type") == "click", "light load").when(F.col("event_type") == "view", "MEDIUM-LOAD")
            .when(F.col("event_type") == "purchase", " Max ").when(F.col("event_type") == "error", "weird"))
    return e.select(
        "event_id",
        F.when(F.col("user_id") == 7, "bad").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm")).alias("date"),
        (v - 5).cast("string").alias("Usage_kWh"),
        k.cast("string").alias("Lagging_Current_Reactive.Power_kVarh"),
        (v * 0.5 - 1).cast("string").alias("Leading_Current_Reactive_Power_kVarh"),
        F.when(F.col("event_type") != "error", v * 0.0005 + k * 0.00001).cast("string").alias("CO2(tCO2)"),
        (k * 1.2 - 5).cast("string").alias("Lagging_Current_Power_Factor"),
        F.when(k > 30, F.lit("n/a")).otherwise((100 - k).cast("string")).alias("Leading_Current_Power_Factor"),
        load.alias("Load_Type"), mixed.alias("mixed_type_col"))


LOAD_SQL = """CASE event_type WHEN 'click' THEN 'Light_Load' WHEN 'view' THEN 'Medium_Load'
    WHEN 'purchase' THEN 'Maximum_Load' END"""
CLEAN_LEVELS = [["load_type", "day_of_week"], ["day_of_week"], []]
CLEAN_SQL = f"""
ev AS ({EVENTS_K}),
typed AS (SELECT event_id, CASE WHEN user_id <> 7 THEN date_trunc('minute', ts) END AS date,
    value - 5 AS usage_kwh, k AS lagging_current_reactive_power_kvarh,
    value * 0.5::DOUBLE - 1 AS leading_current_reactive_power_kvarh,
    CASE WHEN event_type <> 'error' THEN value * 0.0005::DOUBLE + k * 0.00001::DOUBLE END AS co2_tco2,
    k * 1.2::DOUBLE - 5 AS lagging_current_power_factor,
    CASE WHEN k <= 30 THEN 100 - k END AS leading_current_power_factor,
    {LOAD_SQL} AS load_type,
    CASE event_type WHEN 'click' THEN 'light load' WHEN 'view' THEN 'MEDIUM-LOAD' WHEN 'purchase' THEN ' Max '
        WHEN 'error' THEN 'weird' END AS load_type_raw,
    CASE WHEN k < 10 THEN 'bad' WHEN k < 20 THEN 'unknown' ELSE CAST(k AS VARCHAR) END AS mixed_type_col FROM ev),
uniq AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY event_id) AS rn
    FROM typed WHERE date IS NOT NULL) WHERE rn = 1),
ruled AS (SELECT *, {calendar_sql('date')} FROM (SELECT * REPLACE (
    CASE WHEN usage_kwh >= 0 THEN usage_kwh END AS usage_kwh,
    CASE WHEN leading_current_reactive_power_kvarh >= 0 THEN leading_current_reactive_power_kvarh END
        AS leading_current_reactive_power_kvarh,
    CASE WHEN lagging_current_power_factor BETWEEN 0 AND 100 THEN lagging_current_power_factor END
        AS lagging_current_power_factor) FROM uniq)),
factor AS (SELECT median(co2_tco2 / usage_kwh) AS f FROM ruled WHERE co2_tco2 > 0 AND usage_kwh > 0),
ratioed AS (SELECT r.* REPLACE (coalesce(co2_tco2, usage_kwh * f) AS co2_tco2) FROM ruled r, factor),
filled AS ({impute_sql('ratioed', CLEAN_LEVELS, D.MEASURES)}),
capped AS ({cap_sql('filled', D.ENERGY_COLUMNS)}),
modes AS (SELECT day_of_week, load_type AS mode FROM (SELECT day_of_week, load_type, row_number() OVER (
    PARTITION BY day_of_week ORDER BY count(*) DESC, list_position(['Light_Load', 'Medium_Load', 'Maximum_Load'], load_type))
    AS rn FROM capped WHERE load_type IS NOT NULL GROUP BY day_of_week, load_type) WHERE rn = 1),
done AS (SELECT date, week_status, day_status_num, c.day_of_week, coalesce(load_type, mode) AS load_type,
    {', '.join(D.MEASURES)}, nsm, mixed_type_col, CAST(NULL AS VARCHAR) AS day_of_week_raw,
    CAST(NULL AS VARCHAR) AS week_status_raw, load_type_raw, TRY_CAST(mixed_type_col AS DOUBLE) AS mixed_type_col_num,
    CASE WHEN TRY_CAST(mixed_type_col AS DOUBLE) IS NULL THEN mixed_type_col END AS mixed_type_col_label
    FROM capped c LEFT JOIN modes USING (day_of_week))
"""
ROUND_MEASURES = ", ".join(f"round({c}, 6) AS {c}" for c in D.MEASURES)


@query("clean_readings", f"WITH {CLEAN_SQL} SELECT * REPLACE ({ROUND_MEASURES}) FROM done")
def clean_readings(spark, d):
    """The whole cleaning, from raw text to final columns."""
    out = clean(raw_readings(spark, d), ordinal=["event_id"], method=choose_method(table(spark, d, "events"))).clean
    return rounded(out.withColumn("day_status_num", F.col("day_status_num").cast("long")))


@query("clean_readings_grid", f"""
WITH {CLEAN_SQL},
b AS (SELECT time_bucket(INTERVAL '15 minutes', min(date)) AS a, time_bucket(INTERVAL '15 minutes', max(date)) AS z,
             max(date) AS m FROM done),
grid AS (SELECT unnest(generate_series(a, CASE WHEN z = m THEN z ELSE z + INTERVAL '15 minutes' END,
                                       INTERVAL '15 minutes')) AS date FROM b),
joined AS (SELECT date, x.* EXCLUDE (date), {calendar_sql('date')} FROM grid LEFT JOIN
    (SELECT * EXCLUDE (day_of_week, week_status, day_status_num, nsm) FROM done) AS x USING (date)),
labelled AS ({fill_sql('joined', 'load_type', 'date')}),
gridded AS ({impute_sql('labelled', CLEAN_LEVELS, D.MEASURES)})
SELECT * REPLACE ({ROUND_MEASURES}) FROM gridded
""")
def clean_readings_grid(spark, d):
    out = clean(raw_readings(spark, d), ordinal=["event_id"], with_grid=True,
                method=choose_method(table(spark, d, "events"))).grid
    return rounded(out.withColumn("day_status_num", F.col("day_status_num").cast("long")))


@query("cleaning_counts", f"""
WITH {CLEAN_SQL}
SELECT count(*) AS n_original, count(*) - count(date) AS n_na_date, count(date) - count(DISTINCT date) AS n_duplicates,
       count(DISTINCT date) AS n_final FROM typed
""")
def cleaning_counts_query(spark, d):
    return cleaning_counts(typed_readings(raw_readings(spark, d)), "date")


@query("mean_by_load_type", f"""
WITH {CLEAN_SQL} SELECT load_type, round(avg(usage_kwh), 6) AS mean FROM done WHERE load_type IS NOT NULL GROUP BY load_type
""")
def mean_by_load_type(spark, d):
    out = clean(raw_readings(spark, d), ordinal=["event_id"], method=choose_method(table(spark, d, "events"))).clean
    return rounded(group_mean(out, F.col("load_type"), "load_type", "usage_kwh"))
