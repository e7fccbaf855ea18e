"""Model, scoring and encoding queries whose fit SQL can solve: normal equations of three features, and trees
of two levels by trying every split."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlane.catalog.modelling import LABEL_SQL, LINE_KEYS, MODEL_FEATURES, labelled_lines, metrics_sql
from wattlane.catalog.registry import EVENTS_K, ORACLES, events_with_k, query, rounded, table
from wattlane.catalog.stream import event_stream
from wattlane.operators.features import FeatureConfig, fit_features, sparse_features
from wattlane.operators.splits import fit_three_way_split
from wattlane.plans.models import ModelSpec, assemble, build_estimator
from wattlane.plans.scoring import Scorer
from wattlane.plans.training import evaluate_fit
from wattlane.session import settle, spread
from wattlane.streaming import run_available, score_stream

KEYS_SQL = ", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in LINE_KEYS)
LINES_SQL = f"l AS (SELECT *, {LABEL_SQL} AS y FROM lineitem)"


def keys():
    return [F.col(k).cast("long").alias(k) for k in LINE_KEYS]


def solve_sql(source: str, features: list[str], alpha: float) -> str:
    """CTEs ``s`` (moments) and ``w`` (one row: w1, w2, w3 and intercept w0) of least squares on three
    features with the penalty ``alpha``, by Cramer's rule on the centred normal equations."""
    x = dict(zip("123", features))
    pairs = ["11", "12", "13", "22", "23", "33"]
    sums = ", ".join(f"covar_pop({x[p[0]]}, {x[p[1]]}) * count(*){f' + {alpha}' if p[0] == p[1] else ''} AS a{p}" for p in pairs)
    means = ", ".join(f"covar_pop(y, {c}) * count(*) AS b{i}, avg({c}) AS m{i}" for i, c in x.items())
    det = "(a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13))"
    return f"""s AS (SELECT {sums}, {means}, avg(y) AS my FROM {source}),
    e AS (SELECT *,
        (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / {det} AS w1,
        (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / {det} AS w2,
        (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / {det} AS w3 FROM s),
    w AS (SELECT w1, w2, w3, my - w1 * m1 - w2 * m2 - w3 * m3 AS w0 FROM e)"""


def predicted_sql(features: list[str]) -> str:
    return " + ".join(["w0", *[f"w{i} * {c}" for i, c in enumerate(features, 1)]])


# ---- linear models on three features ----------------------------------------

def linear_fit(spark, d, spec, digits):
    data = assemble(labelled_lines(spark, d).select(*LINE_KEYS, *MODEL_FEATURES, "y"), MODEL_FEATURES, "y")
    out = build_estimator(spec).fit(data).transform(data)
    return out.select(*keys(), F.round("prediction", digits).alias("prediction"))


def linear_sql(alpha: float, digits: int) -> str:
    return f"""WITH {LINES_SQL}, {solve_sql('l', MODEL_FEATURES, alpha)}
    SELECT {KEYS_SQL}, round({predicted_sql(MODEL_FEATURES)}, {digits}) AS prediction FROM l, w"""


@query("ols_three_features", linear_sql(0.0, 0))
def ols_three_features(spark, d):
    return linear_fit(spark, d, ModelSpec("ols", "linear_regression"), 0)


@query("ridge_three_features", linear_sql(25.0, 1))
def ridge_three_features(spark, d):
    return linear_fit(spark, d, ModelSpec("ridge", "ridge", {"alpha": 25.0}), 1)


SPLIT_CUTS = f"""h AS (SELECT *, md5(concat_ws('|', '42', {', '.join(LINE_KEYS)})) AS a,
    md5(concat_ws('|', '43', {', '.join(LINE_KEYS)})) AS b FROM l),
t AS (SELECT *, row_number() OVER (ORDER BY a) <= ceil(0.12::DOUBLE * (SELECT count(*) FROM h)) AS is_test FROM h),
v AS (SELECT *, row_number() OVER (PARTITION BY is_test ORDER BY b) AS r, count(*) OVER (PARTITION BY is_test) AS m FROM t),
parts AS (SELECT *, CASE WHEN is_test THEN 'test' WHEN r <= ceil(0.2::DOUBLE / (1 - 0.12::DOUBLE) * m) THEN 'val'
    ELSE 'train' END AS split FROM v)"""


@query("evaluate_linear", f"""
WITH {LINES_SQL}, {SPLIT_CUTS}, known AS (SELECT * FROM parts WHERE split = 'train'),
{solve_sql('known', MODEL_FEATURES, 1.0)},
p AS (SELECT split, y AS label, {predicted_sql(MODEL_FEATURES)} AS prediction FROM parts, w),
q AS ({metrics_sql('p', 'label', 'prediction', ['split'])})
SELECT split, n, round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(r2, 6) AS r2, 'Ridge' AS model FROM q
""")
def evaluate_linear(spark, d):
    """Fitted on the training part, measured on every part."""
    lines = labelled_lines(spark, d).select(*LINE_KEYS, *MODEL_FEATURES, "y")
    lines = fit_three_way_split(lines.select(*LINE_KEYS), LINE_KEYS).transform(lines)
    data = spread(assemble(lines.drop(*LINE_KEYS), MODEL_FEATURES, "y"))
    model = build_estimator(ModelSpec("Ridge", "ridge", {"alpha": 1.0})).fit(data.where("split = 'train'"))
    out = rounded(evaluate_fit(model, data, "Ridge"))
    return out.withColumns({"rmse": F.round("rmse", 3), "mae": F.round("mae", 3)})


def trained_sql(name: str, alpha: float) -> str:
    """Metrics on every part of the model fitted on the training part."""
    return f"""
WITH {LINES_SQL}, {SPLIT_CUTS}, known AS (SELECT * FROM parts WHERE split = 'train'),
{solve_sql('known', MODEL_FEATURES, alpha)},
p AS (SELECT split, y AS label, {predicted_sql(MODEL_FEATURES)} AS prediction FROM parts, w),
q AS ({metrics_sql('p', 'label', 'prediction', ['split'])})
SELECT split, n, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2, '{name}' AS model FROM q"""


ORACLES["train_linear"] = trained_sql("LinearRegression", 0.0)
ORACLES["train_ridge"] = trained_sql("Ridge", 1.0)


# ---- trees, by trying every split ---------------------------------------------

TREE_FEATURES = ["l_discount", "l_tax", "l_linenumber"]


def split_sql(source: str, label: str, node: str, out: str) -> str:
    """CTE ``out``: per node the feature and the largest value on the left of its best split."""
    tall = " UNION ALL ".join(
        f"SELECT {node} AS node, '{c}' AS feature, {c}::DOUBLE AS x, count(*) AS n, sum({label}) AS s FROM {source} GROUP BY ALL"
        for c in TREE_FEATURES)
    return f"""{out} AS (SELECT node, arg_max(feature, gain) AS feature, arg_max(x, gain) AS cut FROM (
        SELECT node, feature, x, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) AS gain FROM (
            SELECT node, feature, x, sum(n) OVER up AS ln, sum(s) OVER up AS ls,
                   sum(n) OVER whole AS tn, sum(s) OVER whole AS ts FROM ({tall})
            WINDOW up AS (PARTITION BY node, feature ORDER BY x), whole AS (PARTITION BY node, feature))
        WHERE ln < tn) GROUP BY node)"""


def side_sql(best: str) -> str:
    chosen = " ".join(f"WHEN '{c}' THEN {c}::DOUBLE" for c in TREE_FEATURES)
    return f"CASE WHEN CASE {best}.feature {chosen} END <= {best}.cut THEN 1 ELSE 2 END"


TREE_SQL = f"""WITH {LINES_SQL}, {split_sql('l', 'y', '0', 'top')},
a AS (SELECT l.*, {side_sql('top')} AS side FROM l, top),
{split_sql('a', 'y', 'side', 'low')},
b AS (SELECT a.*, side * 10 + {side_sql('low')} AS leaf FROM a JOIN low ON a.side = low.node)
SELECT {KEYS_SQL}, round(avg(y) OVER (PARTITION BY leaf), 3) AS prediction FROM b"""


def tree_fit(spark, d, spec):
    lines = labelled_lines(spark, d).select(*LINE_KEYS, *TREE_FEATURES, "y").withColumns(
        {f"key_{i}": F.col(k).cast("long") for i, k in enumerate(LINE_KEYS)})
    data = assemble(lines.select(*TREE_FEATURES, "y", *[f"key_{i}" for i in range(len(LINE_KEYS))]), TREE_FEATURES, "y")
    out = build_estimator(spec).fit(data).transform(data)
    return out.select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(LINE_KEYS)],
                      F.round("prediction", 3).alias("prediction"))


@query("tree_two_levels", TREE_SQL)
def tree_two_levels(spark, d):
    return tree_fit(spark, d, ModelSpec("tree", "decision_tree", {"max_depth": 2}))


@query("forest_without_bootstrap", TREE_SQL)
def forest_without_bootstrap(spark, d):
    """Without resampling every tree of the forest is the tree."""
    return tree_fit(spark, d, ModelSpec("forest", "random_forest", {"n_estimators": 3, "max_depth": 2, "bootstrap": False}))


@query("boosting_two_rounds", f"""WITH {LINES_SQL}, {split_sql('l', 'y', '0', 'top')},
a AS (SELECT l.*, {side_sql('top')} AS side FROM l, top),
f AS (SELECT *, avg(y) OVER (PARTITION BY side) AS first, 2 * (y - avg(y) OVER (PARTITION BY side)) AS rest FROM a),
{split_sql('f', 'rest', '0', 'again')},
g AS (SELECT f.*, {side_sql('again')} AS other FROM f, again)
SELECT {KEYS_SQL}, round(first + 0.1::DOUBLE * avg(rest) OVER (PARTITION BY other), 3) AS prediction FROM g""")
def boosting_two_rounds(spark, d):
    """The second stump learns what the first one left."""
    return tree_fit(spark, d, ModelSpec("boosting", "gradient_boosting",
                                        {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 1}))


# ---- scoring ---------------------------------------------------------------------

ORDER_FEATURES = ["o_totalprice", "c_acctbal", "o_custkey"]
PRICED_SQL = """l AS (SELECT o_orderkey, o_totalprice::DOUBLE AS o_totalprice, c_acctbal::DOUBLE AS c_acctbal,
    o_custkey::DOUBLE AS o_custkey, o_orderstatus, o_orderpriority,
    o_totalprice / 1000 + c_acctbal / 50 + CASE WHEN o_orderpriority = '1-URGENT' THEN 400.0::DOUBLE ELSE 0 END AS y
    FROM orders JOIN customer ON o_custkey = c_custkey)"""


def priced_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    rows = orders.join(table(spark, d, "customer").select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 400.0).otherwise(0.0)
    return rows.drop("c_custkey").withColumn("y", F.col("o_totalprice") / 1000 + F.col("c_acctbal") / 50 + urgent)


def fitted_scorer(raw, features, target, key):
    learnt = fit_features(raw.select(key, *features, target), FeatureConfig(target=target, drop=(), keep=(key,)))
    data = assemble(learnt.transform(raw.select(key, *features, target)), learnt.feature_names(), target, key)
    model = build_estimator(ModelSpec("ridge", "ridge", {"alpha": 10.0})).fit(data)
    return Scorer(learnt, learnt.feature_names(), model, key)


@query("score_contract", f"""
WITH {PRICED_SQL}, {solve_sql('l', ORDER_FEATURES, 10.0)},
p AS (SELECT *, {predicted_sql(ORDER_FEATURES)} AS whole, w0 + w1 * o_totalprice + w3 * o_custkey AS partly FROM l, w)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, 'scored' AS outcome, round(whole, 3) AS prediction, '' AS detail FROM p
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
UNION ALL SELECT CAST(o_orderkey AS BIGINT), 'rejected', NULL, concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'o_totalprice' END,
    CASE WHEN o_orderstatus = 'P' THEN 'c_acctbal' END) FROM p WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'
UNION ALL SELECT CAST(o_orderkey AS BIGINT), 'column missing', round(partly, 3), 'c_acctbal' FROM p
""")
def score_contract(spark, d):
    """The whole table three ways: rows that satisfy the input contract with their score, rows that do not with
    the offending fields, and all rows once more without a column, which is then 0 and reported."""
    raw = settle(priced_orders(spark, d), "orders")
    scorer = fitted_scorer(raw, ORDER_FEATURES, "y", "o_orderkey")
    asked = raw.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "bad").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_acctbal")).alias("c_acctbal"), "o_custkey")
    good, rejected = scorer.score_checked(asked)
    partly = scorer.score(raw.select("o_orderkey", "o_totalprice", "o_custkey"))
    missing = ",".join(scorer.zero_filled)

    def lines(df, outcome, prediction, detail):
        return df.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.lit(outcome).alias("outcome"),
                         F.round(prediction.cast("double"), 3).alias("prediction"), detail.alias("detail"))

    return (lines(good, "scored", F.col("prediction"), F.lit(""))
            .unionByName(lines(rejected, "rejected", F.lit(None), F.concat_ws(",", "problems")))
            .unionByName(lines(partly, "column missing", F.col("prediction"), F.lit(missing))))


EVENT_FEATURES = ["user_id", "k", "minute"]


def timed(events):
    return events.select("event_id", F.col("user_id").cast("double").alias("user_id"), "k",
                         F.minute("ts").cast("double").alias("minute"), "value")


@query("stream_score_solved", f"""
WITH k AS ({EVENTS_K}), r AS (SELECT event_id, user_id::DOUBLE AS user_id, k, minute(ts)::DOUBLE AS minute, value FROM k
    WHERE value IS NOT NULL),
l AS (SELECT event_id, coalesce(user_id, (SELECT avg(user_id) FROM r)) AS user_id, coalesce(k, (SELECT avg(k) FROM r)) AS k,
             minute, value AS y FROM r), {solve_sql('l', EVENT_FEATURES, 10.0)},
a AS (SELECT event_id, coalesce(user_id::DOUBLE, (SELECT avg(user_id) FROM r)) AS user_id,
             coalesce(k, (SELECT avg(k) FROM r)) AS k, minute(ts)::DOUBLE AS minute FROM k)
SELECT CAST(event_id AS BIGINT) AS event_id, round({predicted_sql(EVENT_FEATURES)}, 4) AS prediction FROM a, w
""")
def stream_score_solved(spark, d):
    """A stream of events scored by a ridge regression fitted on the stored table."""
    scorer = fitted_scorer(timed(events_with_k(spark, d)), EVENT_FEATURES, "value", "event_id")
    stream = event_stream(spark, d)
    stream = timed(stream.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))).drop("value")
    out = run_available(score_stream(stream, scorer).select("event_id", "prediction"), "solved")
    return out.select(F.col("event_id").cast("long").alias("event_id"), F.round("prediction", 4).alias("prediction"))


# ---- one-hot vectors of many levels --------------------------------------------------

MANY = "concat_ws('/', o_custkey, o_orderpriority, o_orderstatus)"
SPARSE_CONFIG = FeatureConfig(target="y", drop=(), keep=("o_orderkey",))


def coded_orders(spark, d, code):
    return table(spark, d, "orders").select(
        "o_orderkey", F.expr(code).alias("code"), (F.col("o_totalprice") / 1000.0).cast("double").alias("y"))


@query("one_hot_sparse", f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, {MANY} AS code, CAST(dense_rank() OVER (ORDER BY {MANY}) - 1 AS BIGINT) AS place FROM orders
""")
def one_hot_sparse(spark, d):
    """Levels by the thousand: where the one stands in each row's vector."""
    vectors, _ = sparse_features(coded_orders(spark, d, MANY), SPARSE_CONFIG)
    return vectors.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "code",
                          F.col("code_index").cast("long").alias("place"))


@query("ridge_levels", """
WITH l AS (SELECT o_orderkey, o_custkey AS g, o_totalprice::DOUBLE / 1000 AS y FROM orders),
s AS (SELECT g, count(*) AS n, avg(y) AS m FROM l GROUP BY g),
b AS (SELECT sum(n * 2.0::DOUBLE / (n + 2) * m) / sum(n * 2.0::DOUBLE / (n + 2)) AS b FROM s)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, round(b + n * (m - b) / (n + 2), 4) AS prediction FROM l JOIN s USING (g), b
""")
def ridge_levels(spark, d):
    """Ridge regression on one level per customer."""
    vectors, _ = sparse_features(coded_orders(spark, d, "concat('c', o_custkey)"), SPARSE_CONFIG)
    data = vectors.select("o_orderkey", "features", F.col("y").alias("label"))
    out = build_estimator(ModelSpec("ridge", "ridge", {"alpha": 2.0})).fit(data).transform(data)
    return out.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.round("prediction", 4).alias("prediction"))
