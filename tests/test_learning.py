import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.catalog import QUERIES
from wattlane.operators.checks import build_checks, check_report, jarque_bera
from wattlane.operators.features import FeatureConfig, FeatureModel, align_to_schema, build_features, fit_features
from wattlane.operators.metrics import regression_metrics, select_best
from wattlane.plans.evaluation import evaluate
from wattlane.plans.models import (
    DEFAULT_CONFIG, ModelSpec, assemble, build_estimator, load_model, load_specs, register_model, save_model,
    validate_config,
)
from wattlane.plans.scoring import Scorer, check_input
from wattlane.plans.training import load_result, payload_checks, train
from wattlane.sources import RunLedger
from wattlane.streaming import run_available, score_stream

SCHEMA = "date string, Usage_KWH string, a double, mixed string, cat string, gone string, cat_raw string, id long"
ROWS = [
    ("x", "1.5", 1.0, "7", "u", "bad", "r", 1), ("x", "bad", 100.0, "t", "w", "unknown", "r", 2),
    ("x", "2", None, "t", None, None, "r", 3), ("x", "3", 3.0, None, "v", "bad", "r", 4),
    ("x", "4", 5.0, "9", "v", "bad", "r", 5), ("x", "5", 3.0, None, "u", "bad", "r", 6),
]


def test_feature_build(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    config = FeatureConfig(target="usage_kwh", keep=("id",))
    built, model = build_features(df, config)
    assert model.dropped == ["gone"]                              # a column of sentinels vanishes
    assert built.columns == ["a", "mixed", "cat_u", "cat_v", "usage_kwh", "id"]
    rows = {r["id"]: r for r in built.collect()}
    assert set(rows) == {1, 3, 4, 5, 6}                           # target 'bad' is dropped
    assert rows[3]["a"] == 3.0 and rows[3]["mixed"] == 8.0        # means; text in a numeric column is null
    assert rows[3]["cat_u"] == 1.0                                # u and v tie; the smaller value wins
    assert FeatureModel.from_json(model.to_json()) == model
    assert build_checks(df, built).where("not passed").count() == 0
    raw = fit_features(df, FeatureConfig(target="usage_kwh", keep=("id",), drop_raw=False))
    assert raw.levels["cat_raw"] == ["r"]


def test_align_reports_zero_filled(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out, report = align_to_schema(df, ["b", "z"])
    assert out.first() == (2.0, 0.0) and report == {"zero_filled": ["z"], "dropped": ["a"]}


def test_too_many_levels_is_an_error(spark, monkeypatch):
    from wattlane.operators import features

    monkeypatch.setattr(features, "MAX_LEVELS", 1)
    with pytest.raises(ValueError, match="levels"):
        fit_features(spark.createDataFrame(ROWS, SCHEMA), FeatureConfig(target="usage_kwh", keep=("id",)))


def test_checks_flag_bad_columns(spark):
    df = spark.createDataFrame([(float(i % 5), 1.0, float(i)) for i in range(200)] + [(1.0, None, -1.0)],
                               "a double, flat double, y double")
    bad = {(r["check"], r["column"]) for r in check_report(df, "y").where("not passed").collect()}
    assert bad == {("no_nulls", "flat"), ("has_variance", "flat"), ("target_nonnegative", "y"), ("enough_features", "*")}
    inf = df.withColumn("a", F.when(F.col("y") == 3, float("inf")).otherwise(F.col("a")))
    assert check_report(inf, "y").where("check = 'no_infinities' and column = 'a' and not passed").count() == 1


def test_jarque_bera_tells_normal_from_uniform(spark):
    df = spark.range(4000).select(F.randn(1).alias("n"), F.rand(2).alias("u"))
    p = {r["metric"]: r["p_value"] for r in jarque_bera(df, ["n", "u"]).collect()}
    assert p["n"] > 0.01 and p["u"] < 1e-6


def test_metrics_with_constant_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    assert (r["rmse"], r["mae"], r["r2"]) == (1.0, 1.0, 0.0)


def test_selection_prefers_the_first_of_equals(spark):
    df = spark.createDataFrame([("b", 0.5, 1), ("a", 0.5, 0), ("c", 0.4, 2)], "model string, avg_r2 double, position int")
    assert select_best(df).first()["model"] == "a"


def points(spark, n=300):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (n, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, y double")
    return df, x, y


def test_ridge_equals_closed_form(spark):
    df, x, y = points(spark)
    model = build_estimator(ModelSpec("r", "ridge", {"alpha": 25.0})).fit(assemble(df, ["a", "b", "c"], "y"))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), want, rtol=1e-7)


def test_least_squares_with_redundant_columns(spark):
    df, x, y = points(spark)
    df = df.withColumns({"u": (F.col("a") > 0).cast("double"), "v": (F.col("a") <= 0).cast("double")})
    features = ["a", "b", "c", "u", "v"]
    model = build_estimator(ModelSpec("l", "linear_regression")).fit(assemble(df, features, "y"))
    got = np.array([r["prediction"] for r in model.transform(assemble(df, features, "y", "id")).orderBy("row_key").collect()])
    full = np.column_stack([np.ones(len(y)), x, x[:, 0] > 0])
    want = full @ np.linalg.lstsq(full, y, rcond=None)[0]
    assert np.allclose(got, want, atol=1e-5)


def test_specs_and_config():
    assert [s.name for s in load_specs(DEFAULT_CONFIG)] == [
        "Ridge", "LinearRegression", "kNN", "RegressionTree", "RandomForestRegressor"]
    assert [s.name for s in load_specs({"models": [{"type": " Ridge "}, {"name": "t", "type": "decision_tree"}]})] == ["model_0", "t"]
    assert validate_config(DEFAULT_CONFIG) == []
    for broken, word in [({"models": {}}, "at least one"), ({"models": {"m": {}}}, "type"),
                         ({"models": {"m": {"type": "zzz"}}}, "not supported"), ({"models": 3}, "mapping"),
                         ({**DEFAULT_CONFIG, "test_size": 0.9}, "sum to less"), ({**DEFAULT_CONFIG, "target": ""}, "target"),
                         ({**DEFAULT_CONFIG, "cv_n_splits": 1}, "cv_n_splits"), ({**DEFAULT_CONFIG, "paths": {}}, "paths.train"),
                         ({**DEFAULT_CONFIG, "models": {"f": {"type": "random_forest", "params": {"n_estimators": 5}}}}, "n_estimators")]:
        assert any(word in p for p in validate_config(broken)), word
    with pytest.raises(ValueError, match="single-machine"):
        build_estimator(ModelSpec("s", "svm"))
    register_model("plain", lambda: build_estimator(ModelSpec("l", "linear_regression")))
    assert load_specs({"models": {"p": {"type": "plain"}}})[0].model_type == "plain"


CONFIG = {
    "target": "y", "test_size": 0.12, "val_size": 0.2, "cv_n_splits": 2, "cv_n_repeats": 1,
    "models": {"Ridge": {"type": "ridge"}, "kNN": {"type": "knn", "params": {"n_neighbors": 5, "weights": "distance"}},
               "Tree": {"type": "decision_tree", "params": {"max_depth": 3}}},
}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    df, _, _ = points(spark)
    out = str(tmp_path_factory.mktemp("train"))
    ledger = RunLedger(spark, f"{out}/ledger")
    return df, train(df, CONFIG, ["a", "b", "c"], ["id"], out, ledger), ledger, out


def test_training_and_evaluation(spark, trained):
    df, result, ledger, out = trained
    assert result.best_model == "Ridge" and payload_checks(result) == []
    assert result.scores.count() == 3 * 2
    report = json.loads(spark.read.text(f"{out}/metrics").first()["value"])
    assert report["test_metrics"]["r2"] > 0.99 and len(report["validation_results"][0]["cv_rmse_scores"]) == 2
    knn = {r["split"]: r for r in result.metrics.where("model = 'kNN'").collect()}
    assert knn["train"]["rmse"] < 1e-9 and knn["test"]["r2"] > 0.5    # its own rows are exact matches
    stored = load_result(spark, out)                              # as another process finds it
    assert (stored.best_model, stored.run_id, set(stored.models)) == (result.best_model, result.run_id, set(result.models))
    again = evaluate(spark, stored, f"{out}/eval", ledger)
    assert abs(again["test_metrics"]["rmse"] - report["test_metrics"]["rmse"]) < 1e-9
    assert spark.read.parquet(f"{out}/eval/figures/val_residuals").count() == 30
    logged = {(r["kind"], r["key"]) for r in ledger.read().where(F.col("run_id") == result.run_id).collect()}
    assert {("param", "best_model_name"), ("metric", "best_avg_r2"), ("metric", "eval_val_mae"), ("version", "1")} <= logged
    assert ledger.read().where("parent_id is not null and kind = 'run'").count() == 3


def test_models_round_trip(spark, trained, tmp_path):
    df, result, _, _ = trained
    data = assemble(df, ["a", "b", "c"], "y", "id")
    for name in ("Ridge", "kNN"):
        path = save_model(result.models[name], str(tmp_path / name), spark)
        a, b = (m.transform(data).agg(F.sum("prediction")).first()[0] for m in (result.models[name], load_model(path, spark)))
        assert abs(a - b) < 1e-9


def test_scoring_rejects_and_streams(spark, tmp_path):
    rows = [(i, float(i % 7), ["u", "v"][i % 2], 2.0 * (i % 7) + (i % 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, cat string, y double")
    features = fit_features(df, FeatureConfig(target="y", drop=(), keep=("id",)))
    model = build_estimator(ModelSpec("r", "ridge", {"alpha": 0.1})).fit(
        assemble(features.transform(df), features.feature_names(), "y", "id"))
    scorer = Scorer(features, ["a", "cat_u", "cat_v", "missing"], build_estimator(ModelSpec("r", "ridge")).fit(
        assemble(features.transform(df).withColumn("missing", F.lit(0.0)), ["a", "cat_u", "cat_v", "missing"], "y", "id")), "id")
    path = scorer.save(str(tmp_path / "scorer"), spark)
    batch = Scorer.load(path, spark)
    scored = {r["id"]: r for r in batch.score(df.drop("y")).collect()}
    assert batch.zero_filled == ["missing"]
    assert scored[0]["input_features"] == {"cat_u": 1.0} and abs(scored[3]["prediction"] - 7.0) < 0.5
    assert model is not None

    df.drop("y").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.drop("y").schema).parquet(str(tmp_path / "in"))
    streamed = {r["id"]: r["prediction"] for r in run_available(score_stream(stream, batch), "t").collect()}
    assert streamed == {k: v["prediction"] for k, v in scored.items()}

    mixed = spark.createDataFrame([(1, "1.5", "u"), (2, "x", "u"), (3, None, None)], "id long, a string, cat string")
    good, bad = check_input(mixed, ["a"], ["cat"])
    assert [r["a"] for r in good.collect()] == [1.5]
    assert {r["id"]: r["problems"] for r in bad.collect()} == {2: ["a"], 3: ["a", "cat"]}
    with pytest.raises(ValueError, match="missing"):
        check_input(mixed, ["zz"], [])


def test_sparse_features_have_no_level_bound(spark, monkeypatch):
    from wattlane.operators import features

    monkeypatch.setattr(features, "MAX_LEVELS", 1)
    df = spark.createDataFrame(ROWS, SCHEMA)
    config = FeatureConfig(target="usage_kwh", keep=("id",))
    vectors, _ = features.sparse_features(df, config)
    rows = {r["id"]: r["features"].toArray().tolist() for r in vectors.collect()}
    dense, _ = build_features(df, FeatureConfig(target="usage_kwh", keep=("id",), one_hot=False))
    assert set(rows) == {r["id"] for r in dense.collect()}
    assert rows[3][2:] == [1.0, 0.0] and rows[4][2:] == [0.0, 1.0]      # u, v; a null took the mode
    new = spark.createDataFrame([("x", "1", 1.0, "7", "other", None, "r", 9)], SCHEMA)
    unseen = features.sparse_features(new, config, fit_on=df)[0].first()
    assert unseen["features"].toArray().tolist()[2:] == [0.0, 0.0]      # a level not learnt


def coded(spark, n=240):
    rows = [(i, f"s{i * 7 % 23}", ["a", "b", None, "Z"][i % 4], float(i % 5) - 1, float(i * 13 % 37)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s string, t string, x double, y double")


def test_levels_stay_off_the_driver(spark):
    """They are numbered and looked up as a table; the vectors' metadata has their number, not their names."""
    from wattlane.operators.features import sparse_features

    df = coded(spark)
    vectors, fitted = sparse_features(df, FeatureConfig(target="y", drop=(), keep=("id",)))
    assert vectors.schema["features"].metadata == {"ml_attr": {"num_attrs": 27}}
    assert fitted.sizes == [23, 3] and fitted.levels.count() == 26
    order = {v: i for i, v in enumerate(sorted({f"s{i}" for i in range(23)}))}
    for r in vectors.collect():
        one = [1 + order[r["s"]], 24 + ["Z", "a", "b"].index(r["t"])]
        want = dict.fromkeys(one, 1.0) | ({0: float(r["id"] % 5) - 1} if r["id"] % 5 != 1 else {})
        assert dict(zip(r["features"].indices.tolist(), r["features"].values.tolist())) == want and r["features"].size == 27
        assert (r["s_index"], r["t_index"]) == (one[0] - 1, one[1] - 24)


def test_wide_ridge_equals_closed_form(spark, monkeypatch, tmp_path):
    from wattlane.operators.features import sparse_features
    from wattlane.plans import models

    monkeypatch.setattr(models, "MAX_DIRECT", 10)
    vectors, _ = sparse_features(coded(spark), FeatureConfig(target="y", drop=(), keep=("id",)))
    data = vectors.select("id", "features", F.col("y").alias("label"))
    model = build_estimator(ModelSpec("r", "ridge", {"alpha": 2.0})).fit(data)
    assert isinstance(model, models.WideLinearModel)
    rows = data.orderBy("id").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])
    mx, my = x.mean(axis=0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + 2.0 * np.eye(27), (x - mx).T @ (y - my))
    want = my + (x - mx) @ w
    stored = load_model(save_model(model, str(tmp_path / "m"), spark), spark)
    for m in (model, stored):
        assert np.allclose([r["prediction"] for r in m.transform(data).orderBy("id").collect()], want, atol=1e-8)
    alone, _ = sparse_features(coded(spark).drop("t", "x"), FeatureConfig(target="y", drop=(), keep=("id",)))  # one entry a row
    data = alone.select("id", "features", F.col("y").alias("label"))
    rows = build_estimator(ModelSpec("r", "ridge", {"alpha": 2.0})).fit(data).transform(data).collect()
    small = ridge_by_hand(data, 2.0)
    assert max(abs(r["prediction"] - small[r["id"]]) for r in rows) < 1e-8


def ridge_by_hand(data, alpha):
    rows = data.collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["label"] for r in rows])
    xc = x - x.mean(axis=0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    return dict(zip([r["id"] for r in rows], y.mean() + xc @ w))


def test_training_and_scoring_jobs(spark, tmp_path):
    from wattlane.plans.jobs import run_evaluation, run_scoring, run_training

    df, _, _ = points(spark)
    df.write.parquet(str(tmp_path / "in"))
    config = {**CONFIG, "models": {"Ridge": {"type": "ridge"}}}
    result = run_training(spark, str(tmp_path / "in"), str(tmp_path / "t"), ["a", "b", "c"], config, ["id"])
    assert result.best_model == "Ridge" and result.comparison.count() == 1
    report = run_evaluation(spark, str(tmp_path / "t"), str(tmp_path / "e"))
    assert report["test_metrics"]["r2"] > 0.99 and report["val_metrics"]["r2"] > 0.99

    features = fit_features(df, FeatureConfig(target="y", drop=(), keep=("id",)))
    Scorer(features, ["a", "b", "c"], result.models["Ridge"], "id").save(str(tmp_path / "s"), spark)
    df.select("id", "a", F.when(F.col("id") > 0, F.col("b")).alias("b"), "c").write.parquet(str(tmp_path / "asked"))
    paths = run_scoring(spark, str(tmp_path / "s"), str(tmp_path / "asked"), str(tmp_path / "o"))
    assert spark.read.parquet(paths["scored"]).count() == 299
    assert spark.read.parquet(paths["rejected"]).first()["problems"] == ["b"]


def test_train_compare_is_the_default_training(spark, sf):
    rows = {r.model: r for r in QUERIES["train_compare"](spark, sf).collect()}
    assert set(rows) == set(DEFAULT_CONFIG["models"])
    folds = DEFAULT_CONFIG["cv_n_splits"] * DEFAULT_CONFIG["cv_n_repeats"]
    for r in rows.values():
        assert len(r.cv_rmse_scores) == len(r.cv_mae_scores) == len(r.cv_r2_scores) == folds
        assert abs(sum(r.cv_rmse_scores) / folds - r.cv_rmse_mean) < 1e-3
