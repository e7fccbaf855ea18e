import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattlane.operators import neighbours, splits
from wattlane.operators.cap import cap_iqr
from wattlane.operators.dedupe import dedupe_by_time, duplicate_counts
from wattlane.operators.grid import fill_label, full_grid, time_grid
from wattlane.operators.impute import impute_by_hierarchy, impute_by_ratio, impute_mode_by_key
from wattlane.operators.quantiles import exact_quantiles
from wattlane.operators.ranks import spearman_matrix
from wattlane.operators.summaries import daily_sum, histogram

METHODS = ["direct", "bracket"]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one group, and half of those one value."""
    rng = np.random.default_rng(5)
    n = 6000
    key = np.where(np.arange(n) % 3 == 0, "hot", np.char.add("k", (np.arange(n) % 40).astype(str)))
    a = np.where(np.arange(n) % 6 == 0, 7.0, rng.lognormal(2, 2, n))
    b = np.where(rng.random(n) < 0.2, np.nan, np.round(rng.normal(0, 1, n), 2))
    pdf = pd.DataFrame({"key": key, "a": a, "b": b, "c": np.full(n, 3.0)})
    pdf.loc[pdf.index % 50 == 1, "key"] = None
    df = spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    return pdf, df.repartition(7)


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("by", [[], ["key"]])
def test_quantiles_match_pandas(skewed, method, by):
    pdf, df = skewed
    probs = [0.5, 0.0, 0.01, 0.25, 0.75, 0.99, 1.0]
    got = {(r["key"] if by else None, r["metric"]): (r["n"], r["q"])
           for r in exact_quantiles(df, ["a", "b", "c"], probs, by, method).collect()}
    groups = pdf.groupby("key") if by else [(None, pdf)]
    want = {(k, c): (g[c].count(), g[c].quantile(probs).tolist()) for k, g in groups for c in "abc"}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert np.allclose(got[k][1], want[k][1], rtol=1e-12)


def test_bracket_widens_when_it_misses(skewed, monkeypatch):
    from wattlane.operators import quantiles as q

    pdf, df = skewed
    sketch = q._sketch

    def wrong(source, columns, probabilities, by, margin):
        out = sketch(source, columns, probabilities, by, margin)
        if margin > 0.1:
            return out
        return out.withColumn("lo", F.transform("lo", lambda x: x * 1.5)).withColumn("hi", F.transform("hi", lambda x: x * 1.5))

    monkeypatch.setattr(q, "_sketch", wrong)
    got = exact_quantiles(df, ["a"], [0.9], [], "bracket").first()
    assert np.isclose(got["q"][0], pdf["a"].quantile(0.9))


def test_bracket_handles_infinities(spark):
    values = [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("inf")]
    df = frame(spark, [(v,) for v in values], "v double")
    got = exact_quantiles(df, ["v"], [0.2, 0.4, 1.0], [], "bracket").first()["q"]
    assert got == [1.0, 2.0, float("inf")]


ROWS = [(1, "2018-01-01 00:00:00", None, 1.0), (2, "2018-01-01 00:00:00", "b", 3.0), (3, "2018-01-01 00:15:00", "c", 5.0),
        (4, None, "d", 7.0)]


def readings(spark):
    return frame(spark, ROWS, "id int, t string, c string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))


def test_dedupe_first_and_aggregate(spark):
    first = {r["t"].minute: (r["id"], r["c"]) for r in dedupe_by_time(readings(spark), "t", ["id"]).collect()}
    assert first == {0: (1, None), 15: (3, "c")}
    merged = {r["t"].minute: (r["v"], r["c"]) for r in dedupe_by_time(readings(spark), "t", ["id"], "aggregate").collect()}
    assert merged == {0: (2.0, "b"), 15: (5.0, "c")}
    assert duplicate_counts(readings(spark), ["t"]).first() == (4, 1, 1, 2)


def test_dedupe_limits_groups_before_the_shuffle(spark):
    plan = dedupe_by_time(readings(spark), "t", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("method", METHODS)
def test_imputation_levels_and_null_keys(spark, method):
    df = frame(spark, [("a", "Mon", 1.0), ("a", "Mon", 3.0), ("a", "Mon", None), (None, "Mon", None), (None, "Mon", 90.0),
                       ("b", "Tue", None), ("b", None, 8.0)], "g string, d string, v double")
    out = impute_by_hierarchy(df, ["v"], [["g", "d"], ["d"], []], method)
    filled = {(r["g"], r["d"]): r["v"] for r in out.where("v not in (1, 3, 90, 8)").collect()}
    # (a, Mon) -> 2; a null key uses the day median of 1, 3, 90; Tue has no value, so the global median of 1, 3, 8, 90
    assert filled == {("a", "Mon"): 2.0, ("b", "Tue"): 5.5}
    assert out.where("g is null and v = 3").count() == 1 and out.where("v is null").count() == 0


@pytest.mark.parametrize("method", METHODS)
def test_ratio_fill(spark, method):
    df = frame(spark, [(1.0, 10.0), (3.0, 10.0), (None, 10.0), (None, None), (-1.0, 5.0)], "c double, u double")
    assert [r["c"] for r in impute_by_ratio(df, "c", "u", method).collect()] == [1.0, 3.0, 2.0, None, -1.0]
    none = frame(spark, [(None, 2.0)], "c double, u double")
    assert impute_by_ratio(none, "c", "u", "direct").first()["c"] is None


def test_mode_tie_follows_the_domain(spark):
    df = frame(spark, [("Maximum_Load", "Mon"), ("Medium_Load", "Mon"), (None, "Mon"), (None, "Tue")], "l string, d string")
    out = impute_mode_by_key(df, "l", "d", ["Light_Load", "Medium_Load", "Maximum_Load"])
    assert sorted((r["d"], r["l"]) for r in out.where("l is null or l = 'Medium_Load'").collect()) == [
        ("Mon", "Medium_Load"), ("Mon", "Medium_Load"), ("Tue", None)] or out.where("d = 'Tue' and l is null").count() == 1
    assert out.where("d = 'Mon' and l = 'Medium_Load'").count() == 2


@pytest.mark.parametrize("method", METHODS)
def test_cap_keeps_null_and_clips(spark, method):
    df = frame(spark, [(float(i),) for i in range(1, 9)] + [(1000.0,), (None,)], "v double")
    got = [r["v"] for r in cap_iqr(df, ["v"], 1.5, method).collect()]
    assert got[-1] is None and max(v for v in got if v is not None) == 7 + 1.5 * 4


def test_grid_and_global_backward_fill(spark):
    rows = [("2018-01-01 00:07:00", "off"), ("2018-01-01 12:00:00", None), ("2018-01-02 06:00:00", "x"),
            ("2018-01-03 00:00:00", None)]
    df = frame(spark, rows, "t string, l string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    grid = time_grid(df, "t")
    assert grid.count() == 2 * 96 + 1
    full = full_grid(df.withColumn("v", F.lit(1.0)), "t", "l", ["v"])
    got = {r["t"]: r["l"] for r in full.collect()}
    assert got[dt.datetime(2018, 1, 1)] == "x"      # backward across midnight; the off-grid label is gone
    assert got[dt.datetime(2018, 1, 2, 23, 45)] == "x"
    assert got[dt.datetime(2018, 1, 3)] is None      # nothing follows the last day
    assert full.where("v is null").count() == 0


def test_fill_label_equals_pandas(spark):
    rng = np.random.default_rng(1)
    t = pd.date_range("2020-01-01", periods=1000, freq="15min")
    s = pd.Series(np.where(rng.random(1000) < 0.02, rng.choice(["a", "b"], 1000), None), index=t)
    want = s.groupby(pd.Grouper(freq="D")).ffill().bfill()
    df = frame(spark, [(x.to_pydatetime(), v) for x, v in s.items()], "t timestamp_ntz, l string")
    got = {r["t"]: r["l"] for r in fill_label(df, "t", "l").collect()}
    assert [got[x.to_pydatetime()] for x in t] == [None if pd.isna(v) else v for v in want]


@pytest.mark.parametrize("method", METHODS)
def test_spearman_equals_pandas(skewed, method):
    pdf, df = skewed
    pdf = pdf.assign(e=pdf.a.where(pdf.index % 7 != 0).round(1))
    sp = df.sparkSession.createDataFrame(pdf[["a", "b", "c", "e"]])
    sp = sp.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in sp.columns]).withColumn("none", F.lit(None).cast("double"))
    want = pdf[["a", "b", "c", "e"]].corr(method="spearman")
    got = spearman_matrix(sp, ["a", "b", "c", "e", "none"]).collect()
    assert len(got) == 25
    for r in got:
        if "none" in (r["col_a"], r["col_b"]) or "c" in (r["col_a"], r["col_b"]):
            assert r["rho"] is None
        else:
            assert abs(want.loc[r["col_a"], r["col_b"]] - r["rho"]) < 1e-12


def test_histogram_maximum_empty_bins_and_constant(spark):
    df = frame(spark, [(0.0, 2.0), (0.1, 2.0), (10.0, None)], "v double, c double")
    got = {(r["metric"], r["bin"]): r["n"] for r in histogram(df, ["v", "c"], 5).collect()}
    assert [got["v", b] for b in range(1, 6)] == [2, 0, 0, 0, 1]
    assert sum(got["c", b] for b in range(1, 6)) == 2


def test_daily_sum_has_empty_days(spark):
    df = frame(spark, [("2018-01-01 01:00:00", 2.0), ("2018-01-03 01:00:00", 3.0)], "t string, v double").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    assert [r["total"] for r in daily_sum(df, "t", "v").orderBy("day").collect()] == [2.0, 0.0, 3.0]


def test_split_sizes_and_stability(spark):
    df = spark.range(2503).withColumnRenamed("id", "k")
    a = splits.fit_three_way_split(df, ["k"])
    b = splits.fit_three_way_split(df.repartition(13), ["k"])
    assert a == b
    n = {r["split"]: r["count"] for r in a.transform(df).groupBy("split").count().collect()}
    assert n == {"test": 301, "val": 501, "train": 1701}
    plan = a.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_folds_cover_and_have_kfold_sizes(spark, monkeypatch):
    df = spark.range(1003).withColumnRenamed("id", "k")
    fitted = splits.fit_repeated_folds(df, ["k"], 5, 3)
    for r in range(3):
        n = {x[f"fold_{r}"]: x["count"] for x in fitted.transform(df).groupBy(f"fold_{r}").count().collect()}
        assert n == {0: 201, 1: 201, 2: 201, 3: 200, 4: 200}
    monkeypatch.setattr(splits, "CELL_ROWS", 1)  # forces the deeper levels
    assert splits.fit_repeated_folds(df, ["k"], 5, 3).cuts == fitted.cuts


def test_split_keeps_copies_of_a_hot_key_together(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    out = splits.fit_three_way_split(df, ["k"]).transform(df)
    assert out.where("k = -1").select("split").distinct().count() == 1


@pytest.mark.parametrize("p", [1, 2, 3])
def test_knn_equals_brute_force(spark, monkeypatch, p):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 50)
    monkeypatch.setattr(neighbours, "TRAIN_BLOCK", 60)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 3, (400, 3)), 1)
    x[::3] = [1.0, 2.0, 3.0]                       # a third of the train rows are copies
    y = rng.normal(0, 1, 400)
    q = np.vstack([rng.normal(0, 3, (100, 3)), np.tile([1.0, 2.0, 3.0], (60, 1)), x[1:40]])
    train = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))],
                                  "tid long, v array<double>, y double")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "qid long, v array<double>")
    got = {r["qid"]: r["prediction"] for r in neighbours.knn_predict(
        train, queries, "v", "y", "tid", "qid", 7, "distance", p, 9).collect()}
    assert len(got) == len(q)
    for i, v in enumerate(q):
        d = (np.abs(x - v) ** p).sum(axis=1) ** (1 / p)
        best = sorted(range(400), key=lambda j: (d[j], j))[:7]
        zero = [j for j in best if d[j] == 0]
        want = np.mean(y[zero]) if zero else np.sum(y[best] / d[best]) / np.sum(1 / d[best])
        assert abs(got[i] - want) < 1e-9


def test_knn_uniform_and_fewer_rows_than_k(spark):
    train = spark.createDataFrame([(1, [0.0], 2.0), (2, [1.0], 4.0)], "tid long, v array<double>, y double")
    q = spark.createDataFrame([(1, [0.2])], "qid long, v array<double>")
    assert neighbours.knn_predict(train, q, "v", "y", "tid", "qid", 5, "uniform").first()["prediction"] == 3.0
