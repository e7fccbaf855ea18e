"""Evaluation of a trained model from its stored splits."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions import residual
from wattlane.operators.metrics import regression_metrics
from wattlane.operators.summaries import histogram
from wattlane.plans.models import LABEL, assemble, load_model
from wattlane.plans.training import TrainingResult
from wattlane.session import settle
from wattlane.sources.ledger import RunLedger
from wattlane.sources.tables import write_report, write_results


def actual_vs_predicted(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """The points of the figure with the common axis bounds on every row."""
    low = F.least(F.min(label), F.min(prediction)).alias("low")
    high = F.greatest(F.max(label), F.max(prediction)).alias("high")
    bounds = predictions.agg(F.struct(low, high).alias("b")).scalar()
    return predictions.select(F.col(label).alias("actual"), F.col(prediction).alias("predicted"),
                              bounds.getField("low").alias("axis_low"), bounds.getField("high").alias("axis_high"))


def residual_histogram(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       bins: int = 30) -> DataFrame:
    errors = predictions.select(residual(F.col(label), F.col(prediction)).alias("residual"))
    return histogram(errors, ["residual"], bins)


def evaluate(spark: SparkSession, result: TrainingResult, out: str, ledger: RunLedger | None = None) -> dict[str, Any]:
    """Reload the stored splits and the best model, recompute val and test metrics,
    write the tables behind the figures and the report, and add to the training run."""
    key = None
    if "knn" in {str(m.get("type")) for m in _specs(result.config)}:
        key = next(c for c in spark.read.parquet(result.split_path).columns
                   if c not in result.features and c not in (result.config["target"].lower(), "split"))
    model = load_model(result.model_paths[result.best_model], spark)
    held = spark.read.parquet(result.split_path).where(F.col("split").isin("val", "test"))
    predictions = settle(
        model.transform(assemble(held, result.features, result.config["target"].lower(), key))
        .select("split", LABEL, "prediction"), "predictions")

    tables = {}
    for name in ("val", "test"):
        part = predictions.where(F.col("split") == name)
        tables[f"{name}_actual_vs_predicted"] = actual_vs_predicted(part)
        tables[f"{name}_residuals"] = residual_histogram(part)
    write_results(tables, f"{out}/figures")

    now = {r["split"]: {m: r[m] for m in ("rmse", "mae", "r2")}
           for r in regression_metrics(predictions, LABEL, "prediction", ["split"]).collect()}
    every: dict[str, dict] = {}
    for r in result.metrics.collect():
        if r["split"] in ("train", "test"):
            every.setdefault(r["model"], {})[r["split"]] = {m: r[m] for m in ("rmse", "mae", "r2")}
    report = {"best_model": result.best_model, "train_metrics": every[result.best_model]["train"],
              "test_metrics": now.get("test"), "val_metrics": now.get("val"), "all_models_metrics": every,
              "split_paths": {s: f"{result.split_path}/split={s}" for s in ("train", "val", "test")}}
    write_report(spark, report, f"{out}/metrics")
    if ledger and result.run_id:
        ledger.log(result.run_id, "training", metrics={
            f"eval_{s}_{m}": v for s, values in now.items() for m, v in values.items()})
    return report


def _specs(config) -> list:
    models = config["models"]
    return list(models.values()) if isinstance(models, dict) else list(models)
