"""The batch expressions on Structured Streaming. State is bounded by a watermark."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.cap import clip_at
from wattlane.plans.scoring import Scorer
from wattlane.session import shared_dir


def score_stream(stream: DataFrame, scorer: Scorer) -> DataFrame:
    return scorer.score(stream)


def clean_stream(stream: DataFrame, rules: Mapping[str, Column], medians: DataFrame, by: Sequence[str],
                 bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Stateless cleaning: rules, then medians from a static table, then stored bounds.
    ``medians`` has the key columns and one column per measure."""
    measures = [c for c in medians.columns if c not in by]
    ruled = stream.withColumns(dict(rules))
    static = medians.select(*by, *[F.col(c).alias(f"_m_{c}") for c in measures])
    filled = ruled.join(static, list(by), "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in measures})
    return clip_at(filled.drop(*[f"_m_{c}" for c in measures]), dict(bounds)).select(*stream.columns)


def dedupe_stream(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """One row per key; a key is remembered until the watermark passes it."""
    zoned = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return zoned.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def window_mean(stream: DataFrame, ts: str, value: str, width: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    zoned = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    means = zoned.groupBy(F.window(ts, width)).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return means.select(F.col("window.start").cast("timestamp_ntz").alias("slot"), "n", "mean")


def run_available(stream: DataFrame, name: str, out: str | None = None, state: str | None = None) -> DataFrame:
    """Process everything available now in append mode, and return what the sink holds.

    Who passes ``out`` and ``state`` (a checkpoint folder) can run it again: the next run goes on
    where the last one ended, with its watermark, its windows and its keys.
    """
    spark: SparkSession = stream.sparkSession
    base = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    sink = out or f"{base}/out"
    writer = stream.writeStream.option("checkpointLocation", state or f"{base}/state").trigger(availableNow=True)
    writer.outputMode("append").format("parquet").option("path", sink).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


def batch_sink(process: Callable[[DataFrame], DataFrame], out: str) -> Callable[[DataFrame, int], None]:
    """Writes what ``process`` makes of a batch to the folder of its number. A batch that runs again after a
    failure overwrites its own folder and no other, so each counts once."""
    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return write


def run_batches(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, state: str) -> None:
    """Process everything available now, batch by batch, with any batch code: jobs, joins, models that need a
    whole table. Run again with the same folders it goes on where it ended, or repeats the batch that failed."""
    query = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
    query.foreachBatch(batch_sink(process, out)).start().awaitTermination()


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def score_batches(stream: DataFrame, scorer: Scorer, out: str, state: str) -> None:
    """Scores of a stream by any model; a nearest-neighbour one runs its passes in each batch."""
    run_batches(stream, scorer.score, out, state)
