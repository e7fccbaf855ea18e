"""Model specifications and estimators."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.neighbours import knn_predict
from wattlane.operators.wide import entry_rows, predict_linear, products, solve_ridge
from wattlane.sources.tables import write_document

FEATURES, LABEL, KEY = "features", "label", "row_key"
MAX_DIRECT = 4_096  # widest vectors that Spark's direct solver takes
SPARSE = 64         # vectors with more entries than this, in the mean of squares, count as dense


@dataclass
class ModelSpec:
    name: str
    model_type: str
    params: dict[str, Any] = field(default_factory=dict)


class RidgeRegression(Estimator):
    """Squared error plus ``alpha`` times the squared coefficients, intercept not penalised.

    Spark divides the loss by n and by the label's deviation, hence the factor. Sparse vectors too wide for its
    direct solver are solved by ``operators.wide``, whose coefficients are a table."""

    def __init__(self, alpha: float = 1.0, fit_intercept: bool = True):
        super().__init__()
        self.alpha, self.fit_intercept = float(alpha), fit_intercept

    def _fit(self, dataset: DataFrame):
        if width(dataset) > MAX_DIRECT:
            rows = entry_rows(dataset, FEATURES, LABEL)
            if products(rows) <= SPARSE ** 2:
                return WideLinearModel(*solve_ridge(rows, self.alpha, self.fit_intercept))
        s = dataset.agg(F.count(LABEL).alias("n"), F.stddev_pop(LABEL).alias("sd")).first()
        reg = self.alpha * (s["sd"] or 0.0) / max(s["n"], 1)
        return LinearRegression(featuresCol=FEATURES, labelCol=LABEL, regParam=reg, elasticNetParam=0.0,
                                standardization=False, solver="auto", fitIntercept=self.fit_intercept).fit(dataset)


class WideLinearModel(Model):
    """Coefficients as a table ``(j, w)``; a feature that is not in it counts nothing."""

    def __init__(self, coefficients: DataFrame, intercept: float):
        super().__init__()
        self.coefficients, self.intercept = coefficients, intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return predict_linear(dataset, FEATURES, self.coefficients, self.intercept)


def width(dataset: DataFrame) -> int:
    """Of the feature vectors, from their metadata or else the first row."""
    known = dataset.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
    if known is None:
        first = dataset.select(FEATURES).first()
        known = 0 if first is None or first[0] is None else first[0].size
    return known


class KnnRegressor(Estimator):
    """k nearest neighbours; see ``operators.neighbours``. Rows need a unique integer key."""

    def __init__(self, k: int = 50, weights: str = "distance", p: float = 2):
        super().__init__()
        self.k, self.weights, self.p = int(k), weights, p

    def _fit(self, dataset: DataFrame):
        train = dataset.select(F.col(KEY), vector_to_array(FEATURES).alias("vec"), F.col(LABEL))
        return KnnModel(train, self.k, self.weights, self.p)


class KnnModel(Model):
    def __init__(self, train: DataFrame, k: int, weights: str, p: float = 2):
        super().__init__()
        self.train, self.k, self.weights, self.p = train, k, weights, p

    def _transform(self, dataset: DataFrame) -> DataFrame:
        queries = dataset.select(F.col(KEY), vector_to_array(FEATURES).alias("vec"))
        found = knn_predict(self.train, queries, "vec", LABEL, KEY, KEY, self.k, self.weights, self.p)
        return dataset.join(found.withColumnRenamed("qid", KEY), KEY, "left")


# With every one-hot level kept the normal equations are singular. A trace of
# regularisation keeps the direct solver, at no visible change of the predictions. Beyond the width
# that solver takes, Spark iterates instead.
SINGULAR_GUARD = 1e-9


def _linear(fit_intercept: bool = True, copy_X: bool = True, n_jobs: int | None = None):
    return LinearRegression(featuresCol=FEATURES, labelCol=LABEL, solver="auto", fitIntercept=fit_intercept,
                            regParam=SINGULAR_GUARD)


def _ridge(alpha: float = 1.0, fit_intercept: bool = True, random_state: int | None = None):
    return RidgeRegression(alpha, fit_intercept)


def _knn(n_neighbors: int = 5, weights: str = "uniform", metric: str = "minkowski", p: int = 2):
    order = {"euclidean": 2, "manhattan": 1, "minkowski": p}
    if metric not in order:
        raise ValueError(f"unknown metric {metric!r}")
    return KnnRegressor(n_neighbors, weights, order[metric])


# Spark's deepest tree.
DEEPEST = 30


def _depth(max_depth: int | None) -> int:
    if max_depth is None:
        warnings.warn(f"trees end at depth {DEEPEST}; max_depth=None asks for none", stacklevel=3)
        return DEEPEST
    return int(max_depth)


def _tree(max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1, random_state: int = 42,
          max_bins: int = 32):
    """Features with more than ``max_bins`` values are binned."""
    if min_samples_split > 2 * min_samples_leaf:
        warnings.warn(f"min_samples_split={min_samples_split} has no counterpart here; only min_samples_leaf="
                      f"{min_samples_leaf} limits the nodes", stacklevel=2)
    return DecisionTreeRegressor(featuresCol=FEATURES, labelCol=LABEL, maxDepth=_depth(max_depth), seed=random_state,
                                 minInstancesPerNode=min_samples_leaf, maxBins=max_bins)


def _forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1, random_state: int = 42,
            bootstrap: bool = True, max_bins: int = 32):
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL, numTrees=n_estimators, seed=random_state,
                                 maxDepth=_depth(max_depth), minInstancesPerNode=min_samples_leaf,
                                 featureSubsetStrategy="all", bootstrap=bootstrap, maxBins=max_bins)


def _boosting(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3, random_state: int = 42,
              max_bins: int = 32):
    return GBTRegressor(featuresCol=FEATURES, labelCol=LABEL, maxIter=n_estimators, stepSize=learning_rate,
                        maxDepth=max_depth, seed=random_state, maxBins=max_bins)


def _svm(**_: Any):
    raise ValueError("'svm' (kernel SVR) is a single-machine solver and is not available here")


REGISTRY: dict[str, Callable[..., Estimator]] = {
    "linear_regression": _linear, "ridge": _ridge, "knn": _knn, "decision_tree": _tree,
    "random_forest": _forest, "gradient_boosting": _boosting, "svm": _svm,
}


def register_model(name: str, factory: Callable[..., Estimator]) -> None:
    """Add a model type; the factory's estimator reads 'features' and 'label'."""
    REGISTRY[name.strip().lower()] = factory


def model_type(raw: str | None) -> str:
    if not raw:
        raise ValueError("every model needs a 'type'")
    key = raw.strip().lower()
    if key not in REGISTRY:
        raise ValueError(f"model type {raw!r} is not supported; use one of {sorted(REGISTRY)}")
    return key


def load_specs(config: Mapping[str, Any]) -> list[ModelSpec]:
    """Specs from a mapping name -> spec, or from a list whose entries may carry a name."""
    models = config.get("models")
    if not models:
        raise ValueError("define at least one model under 'models'")
    if isinstance(models, Mapping):
        named = list(models.items())
    elif isinstance(models, list):
        if not all(isinstance(m, Mapping) for m in models):
            raise ValueError("every entry of 'models' must be a mapping")
        named = [(m.get("name") or f"model_{i}", m) for i, m in enumerate(models)]
    else:
        raise ValueError("'models' must be a mapping or a list of mappings")
    return [ModelSpec(name, model_type(spec.get("type")), dict(spec.get("params") or {})) for name, spec in named]


# The default training configuration.
DEFAULT_CONFIG: dict[str, Any] = {
    "target": "usage_kwh",
    "models": {
        "Ridge": {"type": "ridge", "params": {"alpha": 1.0, "fit_intercept": True, "random_state": 42}},
        "LinearRegression": {"type": "linear_regression", "params": {"fit_intercept": True}},
        "kNN": {"type": "knn", "params": {"n_neighbors": 50, "weights": "distance", "metric": "minkowski", "p": 2}},
        "RegressionTree": {"type": "decision_tree", "params": {
            "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1, "random_state": 42}},
        "RandomForestRegressor": {"type": "random_forest", "params": {
            "n_estimators": 15, "max_depth": 4, "random_state": 42}},
    },
    "test_size": 0.12, "val_size": 0.2, "random_state": 42, "val_random_state": 43,
    "cv_n_splits": 5, "cv_n_repeats": 3, "cv_random_state": 7,
}

# Accepted hyper-parameters per model type (a pair is an inclusive integer range).
ALLOWED_PARAMS: dict[str, dict[str, Any]] = {
    "ridge": {"alpha": [0.1, 0.5, 1.0, 10.0], "fit_intercept": [True, False]},
    "linear_regression": {"fit_intercept": [True, False], "n_jobs": [-1, 1, 2, 4]},
    "knn": {"n_neighbors": (3, 100), "weights": ["uniform", "distance"],
            "metric": ["euclidean", "manhattan", "minkowski"]},
    "decision_tree": {"max_depth": [None, 3, 5, 10, 15, 20], "min_samples_split": (2, 20),
                      "min_samples_leaf": (1, 10)},
    "random_forest": {"n_estimators": (10, 200), "max_depth": [None, 3, 4, 5, 10, 15, 20]},
    "gradient_boosting": {"n_estimators": (10, 200), "learning_rate": [0.001, 0.01, 0.05, 0.1, 0.2],
                          "max_depth": (2, 10)},
}


def validate_config(config: Mapping[str, Any]) -> list[str]:
    """Problems found in a training configuration; an empty list means it is valid."""
    problems = []
    try:
        specs = load_specs(config)
    except ValueError as e:
        return [str(e)]
    for spec in specs:
        for name, allowed in ALLOWED_PARAMS.get(spec.model_type, {}).items():
            if name not in spec.params:
                continue
            value = spec.params[name]
            ok = value in allowed if isinstance(allowed, list) else (
                isinstance(value, int) and allowed[0] <= value <= allowed[1])
            if not ok:
                problems.append(f"{spec.name}: {name}={value!r} is not in {allowed}")
    if not isinstance(config.get("target"), str) or not config["target"]:
        problems.append("target must be a non-empty string")
    test, val = config.get("test_size", 0.12), config.get("val_size", 0.2)
    if not (0 < test < 1 and 0 < val < 1 and test + val < 1):
        problems.append("test_size and val_size must be fractions that sum to less than 1")
    if not 2 <= config.get("cv_n_splits", 5) <= 10:
        problems.append("cv_n_splits must be between 2 and 10")
    if not 1 <= config.get("cv_n_repeats", 3) <= 10:
        problems.append("cv_n_repeats must be between 1 and 10")
    if "paths" in config and "train" not in config["paths"]:
        problems.append("paths.train is missing")
    return problems


def build_estimator(spec: ModelSpec) -> Estimator:
    return REGISTRY[spec.model_type](**spec.params)


def assemble(df: DataFrame, features: list[str], target: str, key: str | None = None) -> DataFrame:
    """Feature vector and label in one row, with the row key and any fold or split columns kept."""
    keep = [c for c in df.columns if c not in features and c not in (target, key)]
    vectors = VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="keep").transform(df)
    columns = [F.col(FEATURES)]
    if target in df.columns:
        columns.append(F.col(f"`{target}`").cast("double").alias(LABEL))
    if key:
        columns.append(F.col(f"`{key}`").cast("long").alias(KEY))
    return vectors.select(*columns, *[F.col(f"`{c}`") for c in keep])


def save_model(model: Model, path: str, spark: SparkSession) -> str:
    if isinstance(model, KnnModel):
        model.train.write.mode("overwrite").parquet(f"{path}/train")
        write_document(spark, {"kind": "knn", "k": model.k, "weights": model.weights, "p": model.p}, f"{path}/kind")
    elif isinstance(model, WideLinearModel):
        model.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        write_document(spark, {"kind": "wide", "intercept": model.intercept}, f"{path}/kind")
    else:
        PipelineModel([model]).write().overwrite().save(f"{path}/pipeline")
        write_document(spark, {"kind": "spark"}, f"{path}/kind")
    return path


def load_model(path: str, spark: SparkSession) -> Model:
    kind = json.loads(spark.read.text(f"{path}/kind").first()["value"])
    if kind["kind"] == "knn":
        return KnnModel(spark.read.parquet(f"{path}/train"), kind["k"], kind["weights"], kind["p"])
    if kind["kind"] == "wide":
        return WideLinearModel(spark.read.parquet(f"{path}/coefficients"), kind["intercept"])
    return PipelineModel.load(f"{path}/pipeline")
