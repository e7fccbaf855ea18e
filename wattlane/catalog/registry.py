"""Registration of queries, and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Engines add floating numbers in different orders; compare to fixed decimals."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number inside the JSON text as a second measure."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("k", F.get_json_object("props", "$.k").try_cast("double"))


EVENTS_K = "SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"
