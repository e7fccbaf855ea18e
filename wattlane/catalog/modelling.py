"""Feature, split, metric, model, training and scoring queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattlane.catalog.registry import query, rounded, table
from wattlane.functions import nonzero_entries
from wattlane.operators.checks import quality_gate
from wattlane.operators.features import (
    FeatureConfig, align_to_schema, build_features, drop_empty_columns, fit_features, fit_statistics, level_counts,
    standard_scale,
)
from wattlane.operators.metrics import cv_summary, regression_metrics, select_best, selection_table
from wattlane.operators.neighbours import knn_predict
from wattlane.operators.splits import fit_repeated_folds, fit_three_way_split
from wattlane.plans.evaluation import actual_vs_predicted, residual_histogram
from wattlane.plans.models import DEFAULT_CONFIG, ModelSpec, assemble, build_estimator
from wattlane.plans.scoring import Scorer
from wattlane.plans.training import cross_validate, evaluate_fit, train
from wattlane.catalog.report import histogram_sql
from wattlane.session import settle, shared_dir, spread
from wattlane.sources.ledger import compare_runs

# ---- features over orders -------------------------------------------------

CONFIG = FeatureConfig(target="o_totalprice", drop=("o_orderdate",), keep=("o_orderkey",))
DIRTY_SQL = """d AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS o_custkey,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS price_text,
    o_totalprice, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'unknown' ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderstatus = 'F' THEN 'error' WHEN o_orderstatus = 'O' THEN '7' ELSE 'text' END AS code,
    CASE WHEN o_orderstatus = 'F' THEN 'bad' ELSE 'missing' END AS label FROM orders),
u AS (SELECT * FROM d WHERE price_text <> 'bad')"""
PRIORITIES = ["1-URGENT", "2-HIGH", "4-NOT SPECIFIED"]


def dirty_orders(spark, d):
    """Orders with a text target, sentinels, a text column holding some numbers, and a column of sentinels only."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(status != "P", F.col("o_custkey").cast("double")).alias("o_custkey"),
        F.when(priority == "5-LOW", "bad").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(priority == "3-MEDIUM", "unknown").otherwise(priority).alias("o_orderpriority"),
        F.when(status == "F", "error").when(status == "O", "7").otherwise("text").alias("code"),
        F.when(status == "F", "bad").otherwise("missing").alias("label"))


@query("feature_fit_stats", f"""
WITH {DIRTY_SQL}
SELECT 'o_custkey' AS "column", (SELECT count(o_custkey) FROM d) AS n_numeric, count(o_custkey) AS n_number,
       count(o_custkey) AS n_text, round(avg(o_custkey), 6) AS mean FROM u
UNION ALL SELECT 'o_orderpriority', 0, 0, count(*) FILTER (o_orderpriority <> 'unknown'), NULL FROM u
UNION ALL SELECT 'code', (SELECT count(*) FILTER (code = '7') FROM d), count(*) FILTER (code = '7'),
    count(*) FILTER (code <> 'error'), avg(CASE WHEN code = '7' THEN 7.0::DOUBLE END) FROM u
UNION ALL SELECT 'label', 0, 0, 0, NULL FROM u LIMIT 4
""")
def feature_fit_stats(spark, d):
    return rounded(fit_statistics(dirty_orders(spark, d), CONFIG)[0])


@query("feature_level_counts", f"""
WITH {DIRTY_SQL} SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM u
WHERE o_orderpriority <> 'unknown' GROUP BY o_orderpriority
""")
def feature_level_counts(spark, d):
    return level_counts(dirty_orders(spark, d), ["o_orderpriority"], CONFIG)


@query("impute_mean", f"""
WITH {DIRTY_SQL} SELECT o_orderkey, round(coalesce(o_custkey, (SELECT avg(o_custkey) FROM u)), 6) AS o_custkey FROM u
""")
def impute_mean(spark, d):
    built, _ = build_features(dirty_orders(spark, d), CONFIG)
    return rounded(built.select("o_orderkey", "o_custkey"))


TOP_PRIORITY = """(SELECT o_orderpriority FROM u WHERE o_orderpriority <> 'unknown' GROUP BY 1
    ORDER BY count(*) DESC, o_orderpriority LIMIT 1)"""
FILLED_PRIORITY = f"CASE WHEN o_orderpriority = 'unknown' THEN {TOP_PRIORITY} ELSE o_orderpriority END"


@query("impute_most_frequent", f"WITH {DIRTY_SQL} SELECT o_orderkey, {FILLED_PRIORITY} AS o_orderpriority FROM u")
def impute_most_frequent(spark, d):
    config = FeatureConfig(target="o_totalprice", drop=("o_orderdate",), keep=("o_orderkey",), one_hot=False)
    built, _ = build_features(dirty_orders(spark, d), config)
    return built.select("o_orderkey", "o_orderpriority")


ONE_HOT = ", ".join(f"CAST({FILLED_PRIORITY} = '{p}' AS INT)::DOUBLE AS \"o_orderpriority_{p}\"" for p in PRIORITIES)


@query("one_hot", f"WITH {DIRTY_SQL} SELECT o_orderkey, {ONE_HOT} FROM u")
def one_hot(spark, d):
    built, _ = build_features(dirty_orders(spark, d), CONFIG)
    return built.select("o_orderkey", *[f"o_orderpriority_{p}" for p in PRIORITIES])


FEATURES_SQL = f"""SELECT round(coalesce(o_custkey, (SELECT avg(o_custkey) FROM u)), 6) AS o_custkey, 7.0::DOUBLE AS code,
    {ONE_HOT}, o_totalprice, o_orderkey FROM u"""


@query("feature_build", f"WITH {DIRTY_SQL} {FEATURES_SQL}")
def feature_build(spark, d):
    return rounded(build_features(dirty_orders(spark, d), CONFIG)[0])


@query("align_schema", f"""
WITH {DIRTY_SQL}, f AS ({FEATURES_SQL})
SELECT "o_orderpriority_2-HIGH", 0.0::DOUBLE AS day_status_num, o_custkey, o_orderkey FROM f
""")
def align_schema(spark, d):
    built, _ = build_features(dirty_orders(spark, d), CONFIG)
    return rounded(align_to_schema(built, ["o_orderpriority_2-HIGH", "day_status_num", "o_custkey"], ["o_orderkey"])[0])


@query("nonzero_features", f"""
WITH {DIRTY_SQL}, f AS ({FEATURES_SQL})
SELECT o_orderkey, feature, value FROM ({' UNION ALL '.join(
    f"""SELECT o_orderkey, '{c}' AS feature, "{c}" AS value FROM f"""
    for c in ['o_custkey', 'code', *['o_orderpriority_' + p for p in PRIORITIES]])}) WHERE value <> 0
""")
def nonzero_features(spark, d):
    built, model = build_features(dirty_orders(spark, d), CONFIG)
    entries = nonzero_entries(model.feature_names())
    return rounded(built.select("o_orderkey", F.explode(entries).alias("feature", "value")))


@query("drop_empty", """SELECT c_custkey, c_acctbal FROM customer""")
def drop_empty(spark, d):
    c = table(spark, d, "customer")
    return drop_empty_columns(c.select("c_custkey", F.when(F.col("c_acctbal") > 1e12, 1).alias("none"), "c_acctbal"))


@query("standard_scale", """
SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer))
    / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS c_acctbal FROM customer
""")
def scale(spark, d):
    return rounded(standard_scale(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]))


# ---- splits and folds -----------------------------------------------------

@query("split_three_way", """
WITH h AS (SELECT o_orderkey, md5(concat_ws('|', '42', o_orderkey)) AS a, md5(concat_ws('|', '43', o_orderkey)) AS b FROM orders),
t AS (SELECT o_orderkey, b, row_number() OVER (ORDER BY a) <= ceil(0.12::DOUBLE * (SELECT count(*) FROM h)) AS is_test FROM h),
v AS (SELECT *, row_number() OVER (PARTITION BY is_test ORDER BY b) AS r, count(*) OVER (PARTITION BY is_test) AS m FROM t)
SELECT o_orderkey, CASE WHEN is_test THEN 'test' WHEN r <= ceil(0.2::DOUBLE / (1 - 0.12::DOUBLE) * m) THEN 'val'
    ELSE 'train' END AS split FROM v
""")
def split_three_way(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return fit_three_way_split(orders, ["o_orderkey"]).transform(orders)


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def fold_sql(rank: str, n: str, k: int = 5) -> str:
    """Consecutive ranges of the rank; the first n % k folds hold one row more."""
    return (f"CASE WHEN {rank} - 1 < ({n} % {k}) * ({n} // {k} + 1) THEN ({rank} - 1) // ({n} // {k} + 1) "
            f"ELSE ({n} % {k}) + ({rank} - 1 - ({n} % {k}) * ({n} // {k} + 1)) // ({n} // {k}) END")


FOLDS_SQL = f"""r AS (SELECT *, count(*) OVER () AS n, """ + ", ".join(
    f"row_number() OVER (ORDER BY md5(concat_ws('|', '7', '{r}', {', '.join(LINE_KEYS)}))) AS r{r}" for r in range(3)
) + " FROM lineitem), f AS (SELECT *, " + ", ".join(
    f"CAST({fold_sql(f'r{r}', 'n')} AS BIGINT) AS fold_{r}" for r in range(3)) + " FROM r)"


def folded_lines(spark, d):
    line = table(spark, d, "lineitem")
    return fit_repeated_folds(spread(line.select(*LINE_KEYS)), LINE_KEYS).transform(line)


@query("folds_repeated", f"""
WITH {FOLDS_SQL} SELECT {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in LINE_KEYS)}, fold_0, fold_1, fold_2 FROM f
""")
def folds_repeated(spark, d):
    return folded_lines(spark, d).select(*[F.col(k).cast("long").alias(k) for k in LINE_KEYS],
                                         *[F.col(f"fold_{r}").cast("long").alias(f"fold_{r}") for r in range(3)])


# ---- metrics and selection, with fixed formulas as predictions --------------

def metrics_sql(source: str, label: str, prediction: str, by: list[str]) -> str:
    g = ", ".join(by)
    return f"""SELECT {g}, count(*) AS n, sqrt(avg(pow({label} - {prediction}, 2))) AS rmse,
        avg(abs({label} - {prediction})) AS mae, CASE WHEN var_pop({label}) = 0 THEN 0
        ELSE 1 - avg(pow({label} - {prediction}, 2)) / var_pop({label}) END AS r2 FROM {source} GROUP BY {g}"""


FORMULAS = {"flat": 1500.0, "steep": 1600.0}


def predicted_lines(df):
    """Two fixed formulas as models, as rows ``(model, label, prediction)``."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), (F.col("l_quantity") * s).alias("prediction"))
                     for m, s in FORMULAS.items()])
    return df.select("*", F.inline(rows)).withColumn("label", F.col("l_extendedprice"))


PREDICTED_SQL = "p AS (" + " UNION ALL ".join(
    f"SELECT *, '{m}' AS model, l_quantity * {s}::DOUBLE AS prediction, l_extendedprice AS label FROM {{source}}"
    for m, s in FORMULAS.items()) + ")"


@query("regression_metrics", f"""
WITH {PREDICTED_SQL.format(source='lineitem')}, m AS ({metrics_sql('p', 'label', 'prediction', ['model', 'l_returnflag'])})
SELECT model, l_returnflag, n, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2 FROM m
""")
def metrics(spark, d):
    m = regression_metrics(predicted_lines(table(spark, d, "lineitem")), "label", "prediction", ["model", "l_returnflag"])
    return rounded(m).withColumns({"rmse": F.round("rmse", 4), "mae": F.round("mae", 4)})


@query("quality_gate", f"""
WITH {PREDICTED_SQL.format(source='lineitem')}, m AS ({metrics_sql('p', 'label', 'prediction', ['model'])})
SELECT 'r2' AS "check", model AS "column", round(r2, 4) AS value, 0.5::DOUBLE AS threshold, r2 > 0.5 AS passed FROM m
UNION ALL SELECT 'rmse', model, round(rmse, 4), 1000.0::DOUBLE, rmse < 1000 FROM m
""")
def gate(spark, d):
    m = regression_metrics(predicted_lines(table(spark, d, "lineitem")), "label", "prediction", ["model"])
    return rounded(quality_gate(m), 4)


@query("cv_summary", f"""
WITH {FOLDS_SQL}, {PREDICTED_SQL.format(source='f')},
long AS (""" + " UNION ALL ".join(
    f"SELECT model, {r} AS repeat, fold_{r} AS fold, label, prediction FROM p" for r in range(3)) + f"""),
m AS ({metrics_sql('long', 'label', 'prediction', ['model', 'repeat', 'fold'])})
SELECT model, """ + ", ".join(f"list(round({m}, 7) ORDER BY repeat, fold) AS cv_{m}_scores" for m in ("rmse", "mae", "r2")) +
       ", " + ", ".join(f"round(avg({m}), 7) AS cv_{m}_mean, round(stddev_samp({m}), 7) AS cv_{m}_std"
                        for m in ("rmse", "mae", "r2")) + " FROM m GROUP BY model")
def cv_summary_query(spark, d):
    p = predicted_lines(folded_lines(spark, d))
    long = p.select("model", "label", "prediction", F.inline(F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.col(f"fold_{r}").alias("fold")) for r in range(3)])))
    scores = regression_metrics(long, "label", "prediction", ["model", "repeat", "fold"])
    out = rounded(cv_summary(scores), 7)
    return out.withColumns({f"cv_{m}_scores": F.transform(f"cv_{m}_scores", lambda x: F.round(x, 7))
                            for m in ("rmse", "mae", "r2")})


SPLIT_LINES = "CASE WHEN l_linenumber = 1 THEN 'test' WHEN l_linenumber <= 3 THEN 'val' ELSE 'train' END"


@query("model_comparison", f"""
WITH s AS (SELECT *, {SPLIT_LINES} AS split FROM lineitem), {PREDICTED_SQL.format(source='s')},
m AS ({metrics_sql('p', 'label', 'prediction', ['model', 'split'])})
SELECT model, {', '.join(f"round(max({m}) FILTER (split = '{s}'), 4) AS {s}_{m}" for s in ('train', 'val', 'test')
                         for m in ('rmse', 'mae', 'r2'))},
       round((max(r2) FILTER (split = 'val') + max(r2) FILTER (split = 'test')) / 2, 4) AS avg_r2
FROM m GROUP BY model
""")
def model_comparison(spark, d):
    p = predicted_lines(table(spark, d, "lineitem").withColumn("split", F.expr(SPLIT_LINES)))
    return rounded(selection_table(regression_metrics(p, "label", "prediction", ["model", "split"])), 4)


@query("select_best", f"""
WITH s AS (SELECT *, {SPLIT_LINES} AS split FROM lineitem), {PREDICTED_SQL.format(source='s')},
m AS ({metrics_sql('p', 'label', 'prediction', ['model', 'split'])}),
t AS (SELECT model, (max(r2) FILTER (split = 'val') + max(r2) FILTER (split = 'test')) / 2 AS a FROM m GROUP BY model)
SELECT model, round(a, 4) AS avg_r2 FROM t ORDER BY a DESC, CASE model WHEN 'flat' THEN 0 ELSE 1 END LIMIT 1
""")
def select_best_query(spark, d):
    p = predicted_lines(table(spark, d, "lineitem").withColumn("split", F.expr(SPLIT_LINES)))
    t = selection_table(regression_metrics(p, "label", "prediction", ["model", "split"]))
    position = F.when(F.col("model") == "flat", 0).otherwise(1)
    return rounded(select_best(t.withColumn("position", position)).select("model", "avg_r2"), 4)


@query("runs_compare", f"""
WITH {PREDICTED_SQL.format(source='lineitem')}, m AS ({metrics_sql('p', 'label', 'prediction', ['model', 'l_returnflag'])})
SELECT model || '-' || l_returnflag AS run_id, model AS name, round(rmse, 4) AS rmse, round(r2, 6) AS r2 FROM m
""")
def runs_compare(spark, d):
    m = regression_metrics(predicted_lines(table(spark, d, "lineitem")), "label", "prediction", ["model", "l_returnflag"])
    ledger = m.select(F.concat_ws("-", "model", "l_returnflag").alias("run_id"), F.col("model").alias("name"),
                      F.lit("metric").alias("kind"), F.inline(F.array(*[
                          F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in ("rmse", "r2")])))
    # Every metric was logged twice in one tick of the clock, first with a value that no longer holds.
    first = ledger.withColumn("value", F.lit("1e9")).withColumns({"logged_at": F.lit(1.0), "seq": F.lit(0)})
    ledger = first.unionByName(ledger.withColumns({"logged_at": F.lit(1.0), "seq": F.lit(1)}))
    out = compare_runs(ledger, ["rmse", "r2"], "r2")
    return rounded(out).withColumn("rmse", F.round("rmse", 4))


@query("residual_histogram", "WITH r AS (SELECT l_extendedprice - l_quantity * 1500.0::DOUBLE AS residual FROM lineitem) "
       + histogram_sql("r", ["residual"], 30))
def residuals(spark, d):
    p = table(spark, d, "lineitem").withColumn("prediction", F.col("l_quantity") * 1500.0)
    return rounded(residual_histogram(p, "l_extendedprice", "prediction"))


@query("actual_vs_predicted", """
WITH p AS (SELECT l_extendedprice AS actual, l_quantity * 1500.0::DOUBLE AS predicted FROM lineitem)
SELECT *, (SELECT least(min(actual), min(predicted)) FROM p) AS axis_low,
       (SELECT greatest(max(actual), max(predicted)) FROM p) AS axis_high FROM p
""")
def points(spark, d):
    p = table(spark, d, "lineitem").withColumn("prediction", F.col("l_quantity") * 1500.0)
    return actual_vs_predicted(p, "l_extendedprice", "prediction")


# ---- models ---------------------------------------------------------------

LABEL_SQL = "l_quantity * 1000.0::DOUBLE * (1 - l_discount) + 0.1::DOUBLE * l_extendedprice"
MODEL_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def labelled_lines(spark, d):
    """Line items with a label that depends on the features."""
    y = F.col("l_quantity") * 1000.0 * (1 - F.col("l_discount")) + 0.1 * F.col("l_extendedprice")
    return table(spark, d, "lineitem").withColumn("y", y)


def one_feature_fit(spark, d, spec):
    data = assemble(labelled_lines(spark, d).select(*LINE_KEYS, "l_quantity", "y"), ["l_quantity"], "y")
    out = build_estimator(spec).fit(data).transform(data)
    return rounded(out.select(*[F.col(k).cast("long").alias(k) for k in LINE_KEYS], "prediction"), 3)


def one_feature_sql(alpha: float) -> str:
    return f"""WITH l AS (SELECT *, {LABEL_SQL} AS y FROM lineitem),
    s AS (SELECT avg(l_quantity) AS mx, avg(y) AS my, covar_pop(y, l_quantity) * count(*)
          / (var_pop(l_quantity) * count(*) + {alpha}) AS slope FROM l)
    SELECT {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in LINE_KEYS)},
           round(my + slope * (l_quantity - mx), 3) AS prediction FROM l, s"""


@query("ols_one_feature", one_feature_sql(0.0))
def ols_one_feature(spark, d):
    return one_feature_fit(spark, d, ModelSpec("ols", "linear_regression"))


@query("ridge_one_feature", one_feature_sql(500.0))
def ridge_one_feature(spark, d):
    return one_feature_fit(spark, d, ModelSpec("ridge", "ridge", {"alpha": 500.0}))


@query("cross_validate", f"""
WITH {FOLDS_SQL}, l AS (SELECT *, {LABEL_SQL} AS y FROM f),
long AS (""" + " UNION ALL ".join(
    f"SELECT {r} AS repeat, fold_{r} AS fold, l_quantity AS x, y FROM l" for r in range(3)) + f"""),
part AS (SELECT repeat, fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy
         FROM long GROUP BY repeat, fold),
rest AS (SELECT a.repeat, a.fold, sum(b.n) AS n, sum(b.sx) AS sx, sum(b.sy) AS sy, sum(b.sxx) AS sxx, sum(b.sxy) AS sxy
         FROM part a JOIN part b ON a.repeat = b.repeat AND a.fold <> b.fold GROUP BY a.repeat, a.fold),
fit AS (SELECT repeat, fold, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS slope, sy / n AS my, sx / n AS mx FROM rest),
p AS (SELECT long.repeat, long.fold, y AS label, my + slope * (x - mx) AS prediction
      FROM long JOIN fit ON long.repeat = fit.repeat AND long.fold = fit.fold),
m AS ({metrics_sql('p', 'label', 'prediction', ['repeat', 'fold'])})
SELECT CAST(repeat AS BIGINT) AS repeat, fold, n, round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(r2, 6) AS r2,
       'ols' AS model FROM m
""")
def cross_validate_query(spark, d):
    """Fifteen fits of a one-feature regression, scored in one aggregate."""
    lines = labelled_lines(spark, d).select(*LINE_KEYS, "l_quantity", "y")
    folds = fit_repeated_folds(spread(lines.select(*LINE_KEYS)), LINE_KEYS).transform(lines)
    data = spread(assemble(folds.drop(*LINE_KEYS), ["l_quantity"], "y")).persist()
    scores = settle(cross_validate(data, ModelSpec("ols", "linear_regression"), 3, 5), "cv")
    data.unpersist()
    return rounded(scores.select(F.col("repeat").cast("long").alias("repeat"), F.col("fold").cast("long").alias("fold"),
                                 "n", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"), "r2", "model"))


@query("knn_exact", """
WITH s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS DOUBLE) AS y,
                  md5(concat_ws('|', '42', vec_id)) AS h FROM embeddings),
t AS (SELECT * FROM s QUALIFY row_number() OVER (ORDER BY h) > ceil(0.12::DOUBLE * (SELECT count(*) FROM s))),
d AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.y, sqrt(list_sum(list_transform(list_zip(q.v, t.v),
          lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist FROM s q CROSS JOIN t),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM d)
SELECT qid, round(CASE WHEN min(dist) = 0 THEN avg(y) FILTER (dist = 0) ELSE sum(y / dist) / sum(1 / dist) END, 5) AS prediction
FROM k WHERE r <= 50 GROUP BY qid
""")
def knn_exact(spark, d):
    """Every embedding scored by its 50 nearest embeddings outside the test part."""
    emb = table(spark, d, "embeddings")
    split = fit_three_way_split(emb.select("vec_id"), ["vec_id"])
    known = split.transform(emb).where(F.col("split") != "test")
    return rounded(knn_predict(known, emb, "embedding", "label", "vec_id", "vec_id", 50, "distance"), 5)


def fitted(spark, d, spec):
    """Train on the training part, score every split."""
    lines = labelled_lines(spark, d).select(*LINE_KEYS, *MODEL_FEATURES, "y")
    lines = fit_three_way_split(lines.select(*LINE_KEYS), LINE_KEYS).transform(lines)
    data = spread(assemble(lines.drop(*LINE_KEYS), MODEL_FEATURES, "y")).persist()
    model = build_estimator(spec).fit(data.where("split = 'train'"))
    out = settle(evaluate_fit(model, data, spec.name), "fit")
    data.unpersist()
    return rounded(out, 4)


@query("train_linear")
def train_linear(spark, d):
    return fitted(spark, d, ModelSpec("LinearRegression", "linear_regression"))


@query("train_ridge")
def train_ridge(spark, d):
    return fitted(spark, d, ModelSpec("Ridge", "ridge", {"alpha": 1.0}))


@query("train_tree")
def train_tree(spark, d):
    return fitted(spark, d, ModelSpec("RegressionTree", "decision_tree", {"max_depth": 10, "random_state": 42}))


@query("train_forest")
def train_forest(spark, d):
    return fitted(spark, d, ModelSpec("Forest", "random_forest", {"n_estimators": 15, "max_depth": 4}))


@query("train_gbt")
def train_gbt(spark, d):
    return fitted(spark, d, ModelSpec("Boosting", "gradient_boosting", {"n_estimators": 100, "max_depth": 3}))


def order_features(spark, d):
    """Orders with their customer: features, an informative target, and the order key."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 400.0).otherwise(0.0)
    y = F.col("o_totalprice") / 1000 + F.col("c_acctbal") / 50 + urgent
    return rows.select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderstatus", "o_orderpriority", "c_mktsegment",
                       y.alias("y"))


ORDER_CONFIG = FeatureConfig(target="y", drop=(), keep=("o_orderkey",))
TRAINING = {**DEFAULT_CONFIG, "target": "y"}


@query("train_compare")
def train_compare(spark, d):
    """Split, cross-validate, fit and compare the default models on the joined order table."""
    built, features = build_features(settle(order_features(spark, d), "orders"), ORDER_CONFIG)
    result = train(built, TRAINING, features.feature_names(), ["o_orderkey"],
                   f"{shared_dir(spark)}/train-{uuid.uuid4().hex}")
    scores = {c: F.transform(c, lambda x: F.round(x, 4)) for c in ("cv_rmse_scores", "cv_mae_scores", "cv_r2_scores")}
    return rounded(result.comparison, 4).withColumns(scores)


@query("batch_score")
def batch_score(spark, d):
    """Fit on the training part, then score the whole table through the serving path."""
    raw = settle(order_features(spark, d), "orders")
    features = fit_features(raw, ORDER_CONFIG)
    built = features.transform(raw)
    split = fit_three_way_split(raw.select("o_orderkey"), ["o_orderkey"])
    known = assemble(split.transform(built).where("split = 'train'").drop("split"), features.feature_names(), "y", "o_orderkey")
    model = build_estimator(ModelSpec("Ridge", "ridge", {"alpha": 1.0})).fit(known)
    scored = Scorer(features, features.feature_names(), model, "o_orderkey").score(raw.drop("y"))
    return rounded(scored.select("o_orderkey", "prediction", F.size("input_features").alias("n_nonzero")), 4)
