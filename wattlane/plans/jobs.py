"""The stages as single calls: raw file to clean table, clean table to features, features to models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.features import FeatureConfig, FeatureModel, build_features
from wattlane.plans.cleaning import Cleaned, clean
from wattlane.plans.eda import eda_tables
from wattlane.plans.evaluation import evaluate
from wattlane.plans.models import DEFAULT_CONFIG
from wattlane.plans.scoring import Scorer
from wattlane.plans.training import TrainingResult, load_result, train
from wattlane.session import job_folder
from wattlane.sources.ledger import RunLedger
from wattlane.sources.tables import read_table, read_untidy_csv, write_document, write_results, write_table

ROW_KEY = "row_key"


def run_cleaning(spark: SparkSession, source: str, out: str, strategy: str = "first", with_grid: bool = False,
                 fmt: str = "parquet") -> Cleaned:
    """Clean a raw CSV; writes ``out/clean``, ``out/counts`` and, when asked, ``out/grid``."""
    with job_folder(spark):
        result = clean(read_untidy_csv(spark, source), strategy=strategy, with_grid=with_grid)
        tables = {"clean": result.clean, "counts": result.counts, "grid": result.grid}
        paths = {name: write_table(df, f"{out}/{name}", fmt) for name, df in tables.items() if df is not None}
    return Cleaned(**{name: read_table(spark, path, fmt) for name, path in paths.items()})


def with_row_key(df: DataFrame, ts: str = "date") -> DataFrame:
    """An integer key from the timestamp (microseconds), unique once duplicates are gone.
    Taken from the calendar fields, so no time zone can fold two hours into one."""
    t = F.col(ts)
    seconds = F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return df.withColumn(ROW_KEY, seconds * 1_000_000 + (F.extract(F.lit("second"), t) * 1_000_000).cast("long"))


def run_features(spark: SparkSession, source: str, out: str, config: FeatureConfig | None = None,
                 ts: str = "date") -> tuple[DataFrame, FeatureModel]:
    """Feature table of a cleaned table; writes ``out/table`` and the fitted model as JSON."""
    df = read_table(spark, source)
    if config is None:
        df, config = with_row_key(df, ts), FeatureConfig(drop=(ts,), keep=(ROW_KEY,))
    with job_folder(spark):
        built, model = build_features(df, config)
        path = write_table(built, f"{out}/table")
    write_document(spark, {"features": model.to_json()}, f"{out}/model")
    return read_table(spark, path), model


def run_training(spark: SparkSession, source: str, out: str, features: Sequence[str],
                 config: Mapping[str, Any] = DEFAULT_CONFIG, keys: Sequence[str] = (ROW_KEY,)) -> TrainingResult:
    """Train on a feature table; models, splits, metrics and the run ledger go under ``out``."""
    with job_folder(spark):
        train(read_table(spark, source), config, features, keys, out, RunLedger(spark, f"{out}/ledger"))
    return load_result(spark, out)


def run_evaluation(spark: SparkSession, trained: str, out: str) -> dict[str, Any]:
    """Evaluate what ``run_training`` left under ``trained``, in any process; writes figures' tables and report."""
    with job_folder(spark):
        return evaluate(spark, load_result(spark, trained), out, RunLedger(spark, f"{trained}/ledger"))


def run_report(spark: SparkSession, source: str, out: str, **columns: Any) -> dict[str, str]:
    """The exploratory tables of a cleaned table, one folder each under ``out``."""
    with job_folder(spark):
        return write_results(eda_tables(read_table(spark, source), **columns), out)


def run_scoring(spark: SparkSession, scorer: str, source: str, out: str) -> dict[str, str]:
    """Score a table with a saved scorer; writes ``out/scored`` and ``out/rejected``."""
    with job_folder(spark):
        good, rejected = Scorer.load(scorer, spark).score_checked(read_table(spark, source))
        return write_results({"scored": good, "rejected": rejected}, out)
