"""Scoring whole tables with a saved model: check, build features, align, predict."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.defaults import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from wattlane.functions import coerce_numeric, nonzero_entries
from wattlane.operators.features import FeatureModel, align_to_schema
from wattlane.plans.models import KnnModel, assemble, load_model, save_model
from wattlane.sources.tables import write_document


def check_input(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
                text: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with typed fields, and rejected rows with the offending fields in ``problems``.
    Every field is required. A missing column is an error."""
    missing = [c for c in [*numeric, *text] if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = {c: coerce_numeric(F.col(c), types[c]) for c in numeric}
    bad = [F.when(typed[c].isNull(), F.lit(c)) for c in numeric]
    for c in text:
        is_text = isinstance(types[c], T.StringType)
        bad.append(F.when(F.col(c).isNull(), F.lit(c)) if is_text else F.lit(c))
    marked = df.withColumn("problems", F.array_compact(F.array(*bad)))
    good = marked.where(F.size("problems") == 0).drop("problems").withColumns(typed)
    return good, marked.where(F.size("problems") > 0)


@dataclass
class Scorer:
    """A feature model, the feature order the regressor was trained with, and the regressor."""

    features: FeatureModel
    expected: list[str]
    model: Model
    key: str | None = None
    zero_filled: list[str] = field(default_factory=list)

    def score(self, df: DataFrame) -> DataFrame:
        """Input columns kept by the feature model, ``prediction`` and the non-zero features.
        Features of an absent input column are 0 and named in ``zero_filled``. Every step is a
        projection, on batch and streaming DataFrames alike, unless the model is a
        nearest-neighbour one, which needs a batch."""
        if df.isStreaming and isinstance(self.model, KnnModel):
            raise ValueError("a nearest-neighbour model runs jobs of its own; use streaming.score_batches")
        built = self.features.transform(df, present_only=True)
        keep = [k for k in self.features.keep if k in built.columns]
        aligned, report = align_to_schema(built, self.expected, keep)
        self.zero_filled = report["zero_filled"]
        shown = aligned.withColumn("input_features", nonzero_entries(self.expected))
        out = self.model.transform(assemble(shown, self.expected, "", self.key))
        names = [k for k in keep if k != self.key]
        kept = [F.col("row_key").alias(self.key)] if self.key else []
        return out.select(*kept, *names, "prediction", "input_features")

    def score_checked(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Scores of the rows that satisfy the input contract, and the rejected rows with their problems."""
        kinds = self.features.columns
        good, rejected = check_input(df, [c for c, k in kinds.items() if k == "numeric"],
                                     [c for c, k in kinds.items() if k == "text"])
        return self.score(good), rejected

    def save(self, path: str, spark: SparkSession) -> str:
        save_model(self.model, f"{path}/model", spark)
        write_document(spark, {"features": json.loads(self.features.to_json()), "expected": self.expected,
                             "key": self.key}, f"{path}/features")
        return path

    @staticmethod
    def load(path: str, spark: SparkSession) -> Scorer:
        meta = json.loads(spark.read.text(f"{path}/features").first()["value"])
        return Scorer(FeatureModel(**meta["features"]), meta["expected"], load_model(f"{path}/model", spark), meta["key"])
