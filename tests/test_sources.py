import datetime as dt
import os
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from wattlane.operators.names import normalise_names, snake_name, unique_names, without_time_names
from wattlane.plans.cleaning import clean
from wattlane.plans.eda import eda_tables
from wattlane.session import shared_dir
from wattlane.sources import RunLedger, read_split, read_table, read_untidy_csv, write_results, write_splits, write_table
from wattlane.sources.ledger import compare_runs, latest_values
from wattlane.sources.tables import ORDINAL

HEADER = "date,Usage_kWh,Lagging_Current_Reactive.Power_kVarh,Leading_Current_Reactive_Power_kVarh,CO2(tCO2)," \
         "Lagging_Current_Power_Factor,Leading_Current_Power_Factor,NSM,WeekStatus,Day_of_week,Load_Type,mixed_type_col"

# 2018-01-01 is a Monday. Each line exercises one rule of the cleaning.
LINES = [
    "01/01/2018 00:00,10,1,1,0.01,50,100,0,Weekday,Monday,light load,12",
    "1/1/2018 0:00,99,1,1,0.01,50,100,0,Weekday,Monday,MEDIUM-LOAD,bad",      # duplicate timestamp
    "01/01/2018 00:15,20,1,1,,120,-3,0,Weekday,Monday,MEDIUM-LOAD,unknown",   # co2 by ratio; factors out of range
    "01/01/2018 00:30,-1,1,1,0.03,50,0,0,Weekday,Monday, Max ,",              # negative usage
    "01/01/2018 00:45,1e3,n/a,<NA>,0.02,60,90,0,Weekday,Monday,light load,5", # outlier; null tokens
    "01/01/2018 01:00, 12 ,1,1,0.02,60,90,0,Weekday,Monday,weird,bad",        # unknown load type
    "2018-01-13 00:30:00,30,2,2,0.03,60,90,0,Weekend,Saturday,light load,7",  # ISO date
    "bad,30,2,2,0.03,60,90,0,Weekend,Saturday,light load,7",
    ",30,2,2,0.03,60,90,0,Weekend,Saturday,light load,7",
    "02/01/2018 00:07,11,1,1,0.011,55,95,0,Weekday,Tuesday,light load,3",     # off the grid
]


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "readings.csv"
    path.write_text("﻿" + "\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_names():
    assert [snake_name(n) for n in ("Usage_kWh", "Usage_KWh", "CO2(tCO2)", "Energía.Activa", "WeekStatus", " a  b ")] == [
        "usage_k_wh", "usage_kwh", "co2_t_co2", "energia_activa", "week_status", "a_b"]
    assert unique_names(["a", "a", "b", "a"]) == ["a", "a_1", "b", "a_2"]
    assert unique_names(["x", "x", "x_1"]) == ["x", "x_2", "x_1"]
    assert without_time_names(["Date", "usage", "Hour_of_day"]) == ["usage"]


def test_csv_bom_tokens_and_repeated_headers(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("﻿Energía.Activa,v,v\n1,N/A, \nNone,x,nan\n", encoding="utf-8")
    df = normalise_names(read_untidy_csv(spark, str(path), ordinal=False))
    assert df.columns == ["energia_activa", "v", "v_1"]
    assert [tuple(r) for r in df.collect()] == [("1", None, None), (None, "x", None)]


@pytest.mark.parametrize("method", ["direct", "bracket"])
def test_cleaning_of_the_dirty_file(spark, raw_path, method):
    out = clean(read_untidy_csv(spark, raw_path), with_grid=True, method=method)
    rows = {r["date"]: r.asDict() for r in out.clean.collect()}
    assert out.clean.columns[:5] == ["date", "week_status", "day_status_num", "day_of_week", "load_type"]
    assert ORDINAL not in out.clean.columns
    assert len(rows) == 7
    at = lambda h, m, d=1: rows[dt.datetime(2018, 1, d, h, m)]
    first = at(0, 0)
    assert first["usage_kwh"] == 10 and first["load_type"] == "Light_Load" and first["load_type_raw"] == "light load"
    assert first["day_of_week"] == "Monday" and first["week_status"] == "Weekday" and first["day_status_num"] == 0
    assert first["mixed_type_col_num"] == 12 and first["mixed_type_col_label"] is None
    # valid pairs: 0.001, 0.00002, 0.02/12, 0.001, 0.001 -> median 0.001
    assert abs(at(0, 15)["co2_tco2"] - 0.02) < 1e-12
    assert at(0, 15)["mixed_type_col_label"] == "unknown"
    # Monday usages are 10, 20, 1000, 12 and no other Maximum_Load reading exists on that day
    assert at(0, 30)["usage_kwh"] == 16.0 and at(0, 30)["load_type"] == "Maximum_Load"
    assert at(0, 30)["leading_current_power_factor"] == 0
    assert at(0, 15)["lagging_current_power_factor"] == 55.0 and at(0, 15)["leading_current_power_factor"] == 90.0
    assert at(0, 45)["usage_kwh"] < 100                           # capped
    assert at(1, 0)["load_type"] == "Light_Load"                  # most frequent on Monday
    assert at(0, 30, 13)["week_status"] == "Weekend" and at(0, 30, 13)["day_status_num"] == 1
    assert at(0, 45)["nsm"] == 2700
    assert out.counts.first().asDict() == {"n_original": 10, "n_na_date": 2, "n_duplicates": 1, "n_final": 7}
    measures = ["usage_kwh", "co2_tco2", "lagging_current_power_factor"]
    assert out.clean.where(" or ".join(f"{c} is null" for c in measures)).count() == 0

    grid = out.grid
    assert grid.count() == 12 * 96 + 3
    assert grid.where("date = timestamp_ntz'2018-01-02 00:07:00'").count() == 0
    assert grid.where(" or ".join(f"{c} is null" for c in measures)).count() == 0
    assert grid.where("date = timestamp_ntz'2018-01-05 10:00:00' and load_type = 'Light_Load'").count() == 1


def test_aggregate_strategy(spark, raw_path):
    out = clean(read_untidy_csv(spark, raw_path), strategy="aggregate", method="direct")
    row = out.clean.where("date = timestamp_ntz'2018-01-01 00:00:00'").first()
    assert row["load_type"] == "Light_Load"
    assert out.counts.first()["n_duplicates"] == 2


def test_eda_tables_are_written(spark, raw_path, tmp_path):
    cleaned = clean(read_untidy_csv(spark, raw_path), method="direct").clean
    tables = eda_tables(cleaned.select(
        "date", "day_of_week", "load_type", "usage_kwh", "co2_tco2", "lagging_current_power_factor"),
        measures=["usage_kwh", "co2_tco2"], bins=4)
    paths = write_results(tables, str(tmp_path))
    assert len(paths) == 10
    assert read_table(spark, paths["daily"]).count() == 13
    assert read_table(spark, paths["summary"]).where("section = 'rows' and value = 7").count() == 1


def test_tables_and_splits_round_trip(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").when(F.col("id") < 9, "val").otherwise("test"))
    write_splits(df, str(tmp_path / "s"))
    val = read_split(spark, str(tmp_path / "s"), "val")
    assert sorted(r["id"] for r in val.collect()) == [7, 8] and val.columns == ["id"]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    write_table(df, str(tmp_path / "t.csv"), "csv")
    back = read_table(spark, str(tmp_path / "t.csv"))
    assert back.count() == 10 and dict(back.dtypes)["id"] == "int"


def test_ledger(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"))
    a, b = ledger.start("a"), ledger.start("b")
    ledger.log(a, "a", {"alpha": 1}, {"rmse": 2.0, "r2": 0.5})
    ledger.log(b, "b", metrics={"rmse": 1.0, "r2": 0.9})
    ledger.log(a, "a", metrics={"eval_rmse": 3.0})            # a run reopened
    assert [ledger.register("best", a, "x"), ledger.register("best", b, "y"), ledger.register("other", b, "z")] == [1, 2, 1]
    table = compare_runs(ledger.read(), ["rmse", "r2"], "r2").collect()
    assert [(r["name"], r["rmse"], r["r2"]) for r in table] == [("b", 1.0, 0.9), ("a", 2.0, 0.5)]
    assert latest_values(ledger.read()).count() == 5


def test_stages_as_jobs(spark, raw_path, tmp_path):
    from wattlane.plans.jobs import run_cleaning, run_features

    before = set(os.listdir(unquote(urlparse(shared_dir(spark)).path)))
    cleaned = run_cleaning(spark, raw_path, str(tmp_path / "c"))
    assert cleaned.counts.first()["n_final"] == 7 and cleaned.grid is None
    built, model = run_features(spark, str(tmp_path / "c" / "clean"), str(tmp_path / "f"))
    assert built.count() == 7 and "date" not in built.columns and "row_key" in built.columns
    assert "load_type_Light_Load" in model.feature_names()
    assert all(t in ("double", "bigint") for _, t in built.dtypes)
    assert set(os.listdir(unquote(urlparse(shared_dir(spark)).path))) == before     # intermediate tables are gone


@pytest.mark.parametrize("header", ["x0,x1,x2", "sensor0,sensor1,x", "a,a,a", "a0,a,a"])
def test_csv_headers_are_the_files_own(spark, tmp_path, header):
    path = tmp_path / "h.csv"
    path.write_text(header + "\n1,2,3\n", encoding="utf-8")
    df = read_untidy_csv(spark, str(path), ordinal=False)
    assert df.columns == header.split(",") and tuple(df.first()) == ("1", "2", "3")


def test_csv_files_are_aligned_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n3,4\n")
    rows = {tuple(r) for r in read_untidy_csv(spark, str(tmp_path), ordinal=False).collect()}
    assert rows == {("1", "2"), ("4", "3")}
    (tmp_path / "c.csv").write_text("a,c\n3,4\n")
    with pytest.raises(ValueError, match="c.csv"):
        read_untidy_csv(spark, str(tmp_path))


def test_compare_takes_the_value_logged_last(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "l"))
    run = ledger.start("m")
    for value in (5.0, 3.0, 4.0):
        ledger.log(run, "m", metrics={"rmse": value})
    assert compare_runs(ledger.read(), ["rmse"]).first()["rmse"] == 4.0


def test_sorted_write(spark, tmp_path):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    back = read_table(spark, write_table(df, str(tmp_path / "s"), order_by=["v"]))
    parts = sorted((r.file, r.v) for r in back.select(F.input_file_name().alias("file"), "v").collect())
    assert [v for _, v in parts] == sorted(v for _, v in parts)
