"""Paths made for large tables, forced on small ones: ranks over many partitions, two-pass neighbours, headers of many
files, versions claimed by several writers, streams that are started again."""

import glob
import json
import math
import os
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.functions.distributions import f_tail, incomplete_beta, kolmogorov_tail, log_gamma, normal_cdf
from wattlane.operators import neighbours, profile, ranks
from wattlane.operators.checks import anova_by, anova_f, ks_normality
from wattlane.operators.quantiles import exact_quantiles
from wattlane.session import gather
from wattlane.sources.ledger import RunLedger, payload_lines
from wattlane.sources.tables import first_record, read_report, read_untidy_csv, write_report
from wattlane.streaming import read_batches, run_batches


# --- ranks --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tied():
    rng = np.random.default_rng(1)
    n = 3_000
    hot = np.where(np.arange(n) % 3 == 0, 7.0, rng.integers(0, 40, n).astype(float))  # a third of the rows is one value
    smooth = rng.normal(0, 1, n)
    holes = np.where(rng.random(n) < 0.3, np.nan, np.round(smooth + rng.normal(0, 1, n), 1))
    return pd.DataFrame({"id": np.arange(n), "hot": hot, "smooth": smooth, "holes": holes, "flat": 2.0})


def to_spark(spark, pdf):
    return spark.createDataFrame(pdf).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("hot", "smooth", "holes")})


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_ranks_across_partitions(spark, tied, partitions):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = to_spark(spark, tied)
        for c in ("hot", "holes", "flat"):
            got = ranks.rank_average(df, c).select("id", "rank").toPandas().sort_values("id")["rank"].to_numpy()
            assert np.allclose(got, tied[c].rank().to_numpy(), equal_nan=True), c
        matrix = {(r.col_a, r.col_b): (r.rho, r.n) for r in ranks.spearman_matrix(df, ["hot", "smooth", "holes", "flat"]).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for a in ("hot", "smooth", "holes"):
        for b in ("hot", "smooth", "holes"):
            both = tied[[a, b]].dropna() if a != b else tied[[a]].dropna()
            want = both[a].rank().corr(both[b].rank())
            assert matrix[a, b][0] == pytest.approx(want, abs=1e-9) and matrix[a, b][1] == len(both)
    assert matrix["flat", "hot"] == (None, len(tied))


def test_long_runs_of_a_value_do_not_wait_in_a_task(spark, tied, monkeypatch):
    monkeypatch.setattr(ranks, "HOLD", 40)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    settle, kept = ranks.settle, {}
    monkeypatch.setattr(ranks, "settle", lambda df, name="stage": kept.setdefault(name, settle(df, name)))
    try:
        numbered, partial = ranks.numbered_rows(to_spark(spark, tied).select("hot", "holes"))
        got = ranks.row_ranks(numbered, ["hot", "holes"], partial).join(numbered, ranks.ROW).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert kept["ordered"].where("same0 is null").count() > 500
    for i, c in enumerate(("hot", "holes")):
        mine = got[got["metric"] == i]
        assert len(mine) == tied[c].notna().sum() and np.allclose(mine["r0"], mine[c].rank())
    both = got[(got["metric"] == 0) & got["holes"].notna()]
    assert np.allclose(both["r1"], both["hot"].rank())


def test_ranks_have_one_exchange_of_values(spark, tied):
    """The values travel once, by range; what follows is small or keyed by row."""
    numbered, _ = ranks.numbered_rows(to_spark(spark, tied).select("hot"))
    plans = []
    settle = ranks.settle
    ranks.settle = lambda df, name="stage": plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or settle(df, name)
    try:
        ranks.row_ranks(numbered, ["hot"])
    finally:
        ranks.settle = settle
    ordered = dict(plans)["ordered"]
    assert ordered.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in ordered


def test_ranks_of_nan_infinity_and_nothing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, -0.0), (4, 0.0), (5, None), (6, float("nan"))], "id long, v double")
    got = {r["id"]: r["rank"] for r in ranks.rank_average(df, "v").collect()}
    assert got == {1: 4.5, 2: 3.0, 3: 1.5, 4: 1.5, 5: None, 6: 4.5}
    assert ranks.rank_average(df.limit(0), "v").count() == 0


# --- quantiles, profile -------------------------------------------------------------------------

def test_gathered_statistics_and_written_ones_agree(spark, tied, monkeypatch):
    from wattlane.operators import quantiles

    df = to_spark(spark, tied).withColumn("g", F.col("id") % 7)
    few = sorted(map(tuple, exact_quantiles(df, ["smooth", "holes"], [0.0, 0.1, 0.5, 1.0], ["g"]).select("g", "metric", "n", "q").collect()))
    monkeypatch.setattr(quantiles, "gather", lambda table, most=0: (table, None))
    many = sorted(map(tuple, exact_quantiles(df, ["smooth", "holes"], [0.0, 0.1, 0.5, 1.0], ["g"]).select("g", "metric", "n", "q").collect()))
    assert few == many
    for g, metric, n, q in few:
        values = tied[tied["id"] % 7 == g][metric].dropna()
        assert n == len(values) and np.allclose(q, values.quantile([0.0, 0.1, 0.5, 1.0]))


def test_gather_leaves_large_tables_alone(spark):
    df = spark.range(30)
    assert gather(df, 29) == (df, None)
    small, rows = gather(df, 30)
    assert rows.num_rows == 30 and "LocalTableScan" in small._jdf.queryExecution().executedPlan().toString()


def test_profile_of_all_types(spark):
    df = spark.createDataFrame([(1, 0.0, "a", None, [1]), (2, -0.0, "a", None, [1]), (2, float("nan"), None, None, None), (None, float("nan"), "", None, [2])],
                               "i int, x double, s string, none string, `a.b` array<int>")
    got = {r["column"]: (r["dtype"], r["n"], r["missing"], r["n_unique"]) for r in profile.profile_columns(df).collect()}
    assert got == {"i": ("int", 4, 1, 2), "x": ("double", 4, 0, 2), "s": ("string", 4, 1, 2), "none": ("string", 4, 4, 0), "a.b": ("array<int>", 4, 1, 2)}
    plan = profile.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    approx = {r["column"]: r["n_unique"] for r in profile.profile_columns(df.drop("a.b"), exact_distinct=False).collect()}
    assert approx == {"i": 2, "x": 2, "s": 2, "none": 0}
    assert [r["n"] for r in profile.profile_columns(df.limit(0)).collect()] == [0] * 5


# --- nearest neighbours -------------------------------------------------------------------------

def test_copies_of_rows_are_bounded(spark):
    """In clusters a query meets few cells, and the second pass only those its radius reaches."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 50, (30, 2))
    x = centres[rng.integers(0, 30, 4_000)] + rng.normal(0, 1, (4_000, 2))
    train = spark.createDataFrame([(i, v.tolist(), 1.0) for i, v in enumerate(x)], "tid long, v array<double>, y double")
    wanted = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:500])], "qid long, v array<double>")
    stats = {}
    near = neighbours.nearest_neighbours(train, wanted, "v", "y", "tid", "qid", 5, stats=stats)
    got = {}
    for r in near.collect():
        got.setdefault(r["qid"], []).append((r["dist"], r["tid"]))
    for i in range(0, 500, 25):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = sorted(range(4_000), key=lambda j: (d[j], j))[:5]
        assert [t for _, t in sorted(got[i])] == want
    assert stats["cells"] <= math.isqrt(4_000) and stats["rows"] == 4_000
    assert stats["home_query_copies"] <= 2 * 500 and stats["reach_query_copies"] <= 6 * 500
    assert stats["home_train_copies"] <= 4_000 and stats["reach_train_copies"] <= 4_000


def test_queries_travel_once_per_block_where_nothing_can_be_pruned(spark):
    """In many dimensions every cell is in reach: then copies go by blocks, not by cells, and the result is whole."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1_500, 24))
    train = spark.createDataFrame([(i, v.tolist(), float(i)) for i, v in enumerate(x)], "tid long, v array<double>, y double")
    wanted = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:200])], "qid long, v array<double>")
    stats = {}
    got = {}
    for r in neighbours.nearest_neighbours(train, wanted, "v", "y", "tid", "qid", 5, stats=stats).collect():
        got.setdefault(r["qid"], []).append((r["dist"], r["tid"]))
    for i in range(200):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        assert [t for _, t in sorted(got[i])] == sorted(range(1_500), key=lambda j: (d[j], j))[:5]
    assert stats["cells"] > 10 and stats["home_query_copies"] + stats["reach_query_copies"] == 200


def test_pivots_lie_among_the_rows(spark):
    """The least vector of a bucket is one with a small first number: such pivots part nothing."""
    rows = spark.range(4_000).select(F.array((F.col("id") * 1000 + 0.5).cast("double"), F.lit(1.0)).alias("vec"))
    first = neighbours._pivots(rows, 20, 2).vectors[:, 0]
    assert len(first) == 20 and first.max() > 2e6 and 5e5 < np.median(first) < 3.5e6


def test_cells_share_blocks_and_large_ones_have_several():
    rng = np.random.default_rng(7)
    pivots = neighbours.Pivots(rng.normal(0, 1, (12, 2)), 2)
    sizes = np.array([3, 50, 7, 1, 9, 2, 25, 4, 4, 4, 8, 1])
    cells = neighbours.Cells(pivots, np.arange(12), sizes, np.full(12, 0.5), 10)
    assert sorted(cells.ids) == list(range(12)) and max(cells.rows) <= 10 and sum(cells.rows) >= sizes.sum()
    at = {c: (cells.first[i], cells.pieces[i]) for i, c in enumerate(cells.ids.tolist())}
    assert at[1][1] == 5 and at[6][1] == 3
    for c, (first, pieces) in at.items():     # nothing else stands in the blocks of a large cell
        assert pieces == 1 or not any(first <= f < first + pieces for o, (f, _) in at.items() if o != c)


def test_partial_selection_keeps_ties_in_order():
    d = np.array([[3.0, 1.0, 1.0, 1.0, 2.0], [5.0, 5.0, 5.0, 5.0, 5.0], [np.inf, 4.0, np.inf, np.inf, 0.0]])
    row, column = neighbours._best(d, 3)
    assert [column[row == i].tolist() for i in range(3)] == [[1, 2, 3], [0, 1, 2], [4, 1]]


# --- distributions ------------------------------------------------------------------------------

def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(float(v)).alias(k) for k, v in values.items()]).select(column.alias("p")).first()["p"]


def test_normal_and_gamma(spark):
    for z in (-40.0, -8.0, -7.08, -7.06, -2.5, 0.0, 0.7, 6.0, 9.0):
        assert one(spark, normal_cdf(F.col("z")), z=z) == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-7, abs=1e-15)
    for x in (0.01, 0.5, 1.0, 7.25, 1e5):
        assert one(spark, log_gamma(F.col("x")), x=x) == pytest.approx(math.lgamma(x), rel=1e-11, abs=1e-11)


@pytest.mark.parametrize("x, a, b", [(0.2, 1, 1), (0.3, 2, 5), (0.9, 5, 2), (0.5, 40, 60), (0.9999, 30_000, 4), (0.999, 3_000, 1)])
def test_incomplete_beta(spark, x, a, b):
    """For whole parameters it is the chance of at least a successes in a + b - 1 draws."""
    n = a + b - 1
    log_term = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(x) + (n - j) * math.log1p(-x)
    want = math.fsum(math.exp(log_term(j)) for j in range(a, n + 1))
    assert one(spark, incomplete_beta(F.col("x"), F.col("a"), F.col("b")), x=x, a=a, b=b) == pytest.approx(want, rel=1e-9)


def test_tails(spark):
    assert one(spark, f_tail(F.col("f"), F.col("a"), F.col("b")), f=3.0, a=2.0, b=30.0) == pytest.approx((1 + 2 * 3 / 30) ** -15)
    assert one(spark, f_tail(F.col("f"), F.col("a"), F.col("b")), f=0.0, a=2.0, b=30.0) == 1.0
    assert one(spark, kolmogorov_tail(F.col("d"), F.col("n")), d=0.136, n=100.0) == pytest.approx(0.04945, abs=2e-4)
    assert one(spark, kolmogorov_tail(F.col("d"), F.col("n")), d=0.0, n=100.0) == 1.0


def test_ks_statistic(spark, tied):
    df = to_spark(spark, tied)
    got = {r["metric"]: r for r in ks_normality(df, ["hot", "smooth", "holes", "flat"]).collect()}
    assert set(got) == {"hot", "smooth", "holes"}
    for c, r in got.items():
        v = np.sort(tied[c].dropna().to_numpy())
        cdf = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in (v - v.mean()) / v.std(ddof=1)])
        values, counts = np.unique(v, return_counts=True)
        at = cdf[np.searchsorted(v, values)]
        upto = np.cumsum(counts)
        want = max((upto / len(v) - at).max(), (at - (upto - counts) / len(v)).max())
        assert r["n"] == len(v) and r["statistic"] == pytest.approx(want, abs=1e-12)
    assert got["smooth"]["p_value"] > 0.1 and got["hot"]["p_value"] < 1e-9


def test_anova_of_any_number_of_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(f"g{i % 4}", float(v) + (i % 4 == 3) * 1.0) for i, v in enumerate(rng.normal(0, 1, 400))]
    line = anova_by(spark.createDataFrame([*rows, (None, 5.0), ("g1", None)], "g string, v double"), "v", "g").first()
    groups = [np.array([v for g, v in rows if g == f"g{k}"]) for k in range(4)]
    grand = np.mean([v for _, v in rows])
    between, within = sum(len(g) * (g.mean() - grand) ** 2 for g in groups), sum(((g - g.mean()) ** 2).sum() for g in groups)
    assert (line["n_groups"], line["n"]) == (4, 400)
    assert line["f_value"] == pytest.approx(between / 3 / (within / 396)) and 0 < line["p_value"] < 0.05
    wide = spark.createDataFrame(pd.DataFrame({f"c{k}": g for k, g in enumerate(groups)}))
    assert anova_f(wide, ["c0", "c1", "c2", "c3"]).first()["p_value"] == pytest.approx(line["p_value"])


# --- sources ------------------------------------------------------------------------------------

def test_headers_without_jobs(spark, tmp_path):
    long = "x" * 70_000
    for i in range(60):
        header = ('a,b,"c\nd"', '"c\nd",b,a')[i % 2]
        rows = (f'{i},"two\nlines",z', f'z,"two\nlines",{i}')[i % 2]
        (tmp_path / f"f{i:02d}.csv").write_bytes((b"\xef\xbb\xbf" if i % 3 == 0 else b"") + f"{header}\n{rows}\n".encode())
    started = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    df = read_untidy_csv(spark, str(tmp_path), ordinal=False)
    jobs = len(started.getJobIdsForGroup("headers"))
    assert df.columns == ["a", "b", "c\nd"] and jobs <= 3
    assert sorted((int(r[0]), r[1], r[2]) for r in df.collect()) == [(i, "two\nlines", "z") for i in range(60)]
    (tmp_path / "wide").mkdir()
    (tmp_path / "wide" / "w.csv").write_text(f'p,"{long}\n{long}",q\n1,2,3\n')
    assert first_record(spark, str(tmp_path / "wide" / "w.csv")) == ("p", f"{long}\n{long}", "q")
    (tmp_path / "wide" / "e.csv").write_text("")
    assert first_record(spark, str(tmp_path / "wide" / "e.csv")) == ()


def test_writers_never_share_a_version(spark, tmp_path):
    path = str(tmp_path / "ledger")
    runs = [RunLedger(spark, path).start(f"run{i}") for i in range(4)]
    drawn, barrier = [], threading.Barrier(4)

    def write(run):
        ledger = RunLedger(spark, path)
        barrier.wait()
        for k in range(3):
            drawn.append(ledger.register("best/of all", run, f"{run}/{k}"))

    threads = [threading.Thread(target=write, args=(r,)) for r in runs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(drawn) == 12 and len(set(drawn)) == 12
    log = RunLedger(spark, path).read()
    assert sorted(int(r["key"]) for r in log.where("kind = 'version'").collect()) == sorted(drawn)
    assert RunLedger(spark, path).register("other", runs[0], "x") == 1


def test_payload_lines(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    a, b = ledger.start("a"), ledger.start("b")
    ledger.log(a, "a", {"p": 1}, {"r2": 0.5, "rmse": 2.0})
    ledger.log(b, "b", {}, {"r2": float("nan"), "rmse": "inf"})
    ledger.log(b, "b", {"p": None}, {"rmse": 3})
    ledger.register("m", "nobody", "u")
    got = {(r["name"], r["check"]): r["passed"] for r in payload_lines(ledger.read(), ["r2", "rmse"], ["p"]).collect()}
    assert got == {("a", "metric r2"): True, ("a", "metric rmse"): True, ("a", "param p"): True,
                   ("b", "metric r2"): False, ("b", "metric rmse"): True, ("b", "param p"): False, ("m", "version 1"): False}


def test_typed_report(spark, tmp_path):
    report = {"best": "x", "ok": True, "none": None, "avg": 1, "scores": [1, 2.5, None],
              "models": [{"name": "a", "test": {"r2": 1}}, {"name": "b", "test": {"r2": 0.5, "mae": 2}, "tags": ["u", "v"]}], "empty": []}
    path = write_report(spark, report, str(tmp_path / "r"))
    line = json.loads(open(glob.glob(f"{path}/part-*")[0]).read())
    assert line["scores"] == [1.0, 2.5, None] and line["none"] is None and line["models"][0]["tags"] is None
    read = read_report(spark, path)
    assert isinstance(read.schema["scores"].dataType, T.ArrayType) and read.schema["scores"].dataType.elementType == T.DoubleType()
    rows = read.select(F.inline("models")).select("name", "test.r2", "test.mae", "tags").collect()
    assert [tuple(r) for r in rows] == [("a", 1.0, None, None), ("b", 0.5, 2, ["u", "v"])]


# --- streams ------------------------------------------------------------------------------------

def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    """The last batch loses its commit, as after a failure between its output and the commit."""
    inbox, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "id long"
    seen = []

    def double(batch):
        seen.append(sorted(r["id"] for r in batch.collect()))
        return batch.select((F.col("id") * 2).alias("twice"))

    for part in (range(0, 10), range(10, 20)):
        spark.createDataFrame([(i,) for i in part], schema).write.mode("append").parquet(inbox)
        run_batches(spark.readStream.schema(schema).parquet(inbox), double, out, state)
    last = max((f for f in os.listdir(f"{state}/commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{state}/commits/{name}"):
            os.remove(f"{state}/commits/{name}")
    run_batches(spark.readStream.schema(schema).parquet(inbox), double, out, state)
    assert seen[0] == list(range(10)) and seen[1:] == [list(range(10, 20))] * 2
    assert sorted(r["twice"] for r in read_batches(spark, out).collect()) == [2 * i for i in range(20)]
