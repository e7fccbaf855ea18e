"""Streaming queries over the events file; each must equal the batch result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattlane.catalog.modelling import ModelSpec, assemble, build_estimator
from wattlane.catalog.registry import query, rounded, table
from wattlane.functions import in_range_or_null
from wattlane.operators.cap import iqr_fences
from wattlane.operators.features import FeatureConfig, fit_features
from wattlane.operators.quantiles import group_quantile
from wattlane.plans.scoring import Scorer
from wattlane.session import settle, shared_dir
from wattlane.operators.neighbours import knn_predict
from wattlane.operators.splits import fit_three_way_split
from wattlane.streaming import (
    clean_stream, dedupe_stream, read_batches, run_available, run_batches, score_stream, window_mean,
)


def event_stream(spark, d):
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query("stream_window_mean", """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS slot, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1
HAVING slot + INTERVAL '15 minutes' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)
""")
def stream_window_mean(spark, d):
    """Windows the watermark has closed; their state is gone by then."""
    return rounded(run_available(window_mean(event_stream(spark, d), "ts", "value"), "window"))


@query("stream_window_restart", """
WITH s AS (SELECT *, ts <= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AND event_id % 7 <> 0 AS first FROM events),
e AS (SELECT *, time_bucket(INTERVAL '15 minutes', ts) AS slot FROM s),
k AS (SELECT * FROM e WHERE first OR slot + INTERVAL '15 minutes' > (SELECT max(ts) - INTERVAL '1 hour' FROM s WHERE first))
SELECT slot, count(*) AS n, round(avg(value), 6) AS mean FROM k GROUP BY slot
HAVING slot + INTERVAL '15 minutes' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)
""")
def stream_window_restart(spark, d):
    """Window means of a stream that ends halfway and is started again from its checkpoint. A seventh of the first half
    comes with the second: too late, but for windows that were open still."""
    events = table(spark, d, "events")
    ends = events.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("a"), F.unix_micros(F.max("ts").cast("timestamp")).alias("b")).first()
    middle = F.timestamp_micros(F.lit((ends["a"] + ends["b"]) // 2)).cast("timestamp_ntz")
    first = (F.col("ts") <= middle) & (F.col("event_id") % 7 != 0)
    base = f"{shared_dir(spark)}/restart-{uuid.uuid4().hex}"
    for part in (first, ~first):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        means = run_available(window_mean(stream, "ts", "value"), "restart", f"{base}/out", f"{base}/state")
    return rounded(means)


@query("stream_knn_batches", """
WITH s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS DOUBLE) AS y,
                  md5(concat_ws('|', '42', vec_id)) AS h FROM embeddings),
t AS (SELECT * FROM s QUALIFY row_number() OVER (ORDER BY h) > ceil(0.12::DOUBLE * (SELECT count(*) FROM s))),
d AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.y, sqrt(list_sum(list_transform(list_zip(q.v, t.v),
          lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist FROM s q CROSS JOIN t),
k AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM d)
SELECT qid, round(avg(y), 5) AS prediction FROM k WHERE r <= 9 GROUP BY qid
""")
def stream_knn_batches(spark, d):
    """A stream of embeddings, stopped halfway and started again, each batch scored by its nearest neighbours in a stored table."""
    emb = table(spark, d, "embeddings")
    known = fit_three_way_split(emb.select("vec_id"), ["vec_id"]).transform(emb).where(F.col("split") != "test").drop("split")
    known = settle(known, "known")
    base = f"{shared_dir(spark)}/knn-{uuid.uuid4().hex}"
    for part in (0, 1):
        emb.where(F.col("vec_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        run_batches(spark.readStream.schema(emb.schema).parquet(f"{base}/in"),
                    lambda batch: knn_predict(known, batch, "embedding", "label", "vec_id", "vec_id", 9, "uniform"), f"{base}/out", f"{base}/state")
    return rounded(read_batches(spark, f"{base}/out"), 5)


@query("stream_dedupe", "SELECT DISTINCT date_trunc('minute', ts) AS minute FROM events")
def stream_dedupe(spark, d):
    minutes = event_stream(spark, d).withColumn(
        "minute", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    return run_available(dedupe_stream(minutes, "ts", ["minute"]).select("minute"), "dedupe")


@query("stream_clean", """
WITH r AS (SELECT event_id, event_type, CASE WHEN value BETWEEN 1 AND 200 THEN value END AS value FROM events),
m AS (SELECT event_type, median(value) AS m FROM r GROUP BY event_type),
q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM r)
SELECT event_id, r.event_type, round(greatest(least(coalesce(value, m), b + 1.5 * (b - a)), a - 1.5 * (b - a)), 6) AS value
FROM r JOIN m ON r.event_type = m.event_type, q
""")
def stream_clean(spark, d):
    """Medians and fences come from a batch pass over the same table and stay fixed for the stream."""
    rule = {"value": in_range_or_null(F.col("value"), 1, 200)}
    batch = table(spark, d, "events").withColumns(rule)
    medians = settle(group_quantile(batch, ["value"], 0.5, ["event_type"]), "medians")
    fences = {r["metric"]: (r["low"], r["high"]) for r in iqr_fences(batch, ["value"]).collect()}
    stream = event_stream(spark, d).select("event_id", "event_type", "value")
    return rounded(run_available(clean_stream(stream, rule, medians, ["event_type"], fences), "clean"))


@query("stream_score")
def stream_score(spark, d):
    """A stream of events scored by a model fitted on the stored table."""
    raw = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    features = fit_features(raw, FeatureConfig(target="value", drop=(), keep=("event_id",)))
    data = assemble(features.transform(raw), features.feature_names(), "value", "event_id")
    model = build_estimator(ModelSpec("ridge", "ridge", {"alpha": 1.0})).fit(data)
    scorer = Scorer(features, features.feature_names(), model, "event_id")
    stream = event_stream(spark, d).select("event_id", "user_id", "event_type")
    return rounded(run_available(score_stream(stream, scorer).select("event_id", "prediction"), "score"))
