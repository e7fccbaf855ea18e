"""Data checks as one long table ``(check, column, value, threshold, passed)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.functions import clean_nan, is_infinite, z_score
from wattlane.functions.distributions import f_tail, kolmogorov_tail, normal_cdf
from wattlane.operators.dedupe import duplicate_row_share
from wattlane.operators.profile import column_stats, numeric_columns
from wattlane.operators.quantiles import exact_quantiles
from wattlane.operators.ranks import numbered_rows, row_counts
from wattlane.session import choose_method, gather, settle, stage


def _line(check: str, column: Column | str, value: Column, threshold: Column | float, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), (F.lit(column) if isinstance(column, str) else column).alias("column"),
        value.cast("double").alias("value"),
        (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).cast("double").alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"))


def check_report(df: DataFrame, target: str, features: Sequence[str] | None = None, min_rows: int = 100,
                 min_features: int = 3, max_duplicate_pct: float = 1.0, max_outlier_pct: float = 0.1,
                 outlier_sd: float = 5.0, method: str = "auto") -> DataFrame:
    """All column and table checks. Nulls, infinities, extremes and spread come from
    one aggregate; ranges from one quantile pass; outliers and duplicates take one each."""
    method = choose_method(df, method)
    columns = [c for c in (features or df.columns) if c != target]
    everything = [*columns, target] if target in df.columns else columns
    numeric = [c for c in numeric_columns(df) if c in columns]
    parts = [_schema_checks(df, target, columns), _one_pass(df, target, everything, numeric, min_rows,
                                                            min_features, len(columns))]
    if numeric:
        parts += [_ranges(df, numeric, method), _outliers(df, numeric, outlier_sd, max_outlier_pct, method)]
    share = duplicate_row_share(df.select(*everything))
    parts.append(share.select(F.inline(F.array(_line(
        "duplicate_rows", "*", F.col("pct_duplicates"), max_duplicate_pct,
        F.col("pct_duplicates") < max_duplicate_pct)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _schema_checks(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = isinstance(types.get(target), T.NumericType)
    lines = [_line("target_present", target, F.lit(float(target in types)), 1.0, F.lit(target in types)),
             _line("target_numeric", target, F.lit(float(numeric)), 1.0, F.lit(numeric))]
    for c in columns:
        ok = isinstance(types[c], T.NumericType)
        lines.append(_line("numeric_type", c, F.lit(float(ok)), 1.0, F.lit(ok)))
    return df.sparkSession.range(1).select(F.inline(F.array(*lines)))


def _one_pass(df, target, everything, numeric, min_rows, min_features, n_features) -> DataFrame:
    aggs, lines = [F.count("*").alias("_rows")], []
    for i, c in enumerate(everything):
        aggs.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null{i}"))
        lines.append(_line("no_nulls", c, F.col(f"_null{i}"), 0, F.col(f"_null{i}") == 0))
    for i, c in enumerate(numeric):
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.count_if(is_infinite(v)).alias(f"_inf{i}"), 
                 F.when(F.min(v) == F.max(v), 0.0).otherwise(F.var_samp(v)).alias(f"_var{i}")]
        lines += [_line("no_infinities", c, F.col(f"_inf{i}"), 0, F.col(f"_inf{i}") == 0),
                  _line("has_variance", c, F.col(f"_var{i}"), 0, F.col(f"_var{i}") > 0)]
    if target in everything:
        aggs.append(F.min(F.col(target)).cast("double").alias("_tmin"))
        lines.append(_line("target_nonnegative", target, F.col("_tmin"), 0, F.col("_tmin") >= 0))
    lines += [_line("enough_rows", "*", F.col("_rows"), min_rows, F.col("_rows") >= min_rows),
              _line("enough_features", "*", F.lit(n_features), min_features, F.lit(n_features >= min_features))]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def _ranges(df, numeric, method) -> DataFrame:
    """The maximum may exceed q99 by half the q01..q99 spread, the minimum may fall one spread below q01."""
    q = exact_quantiles(df, numeric, [0.0, 0.01, 0.99, 1.0], (), method)
    low, q01, q99, high = (F.col("q")[i] for i in range(4))
    top, bottom = q99 + (q99 - q01) * 0.5, q01 - (q99 - q01) * 1.0
    return q.select(F.inline(F.array(
        _line("range_high", F.col("metric"), high, top, high <= top),
        _line("range_low", F.col("metric"), low, bottom, low >= bottom))))


def _outliers(df, numeric, sd, limit, method) -> DataFrame:
    stats = stage(column_stats(df, numeric), method, "stats")
    packed = stats.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("mean", "sd"))))).scalar()
    far = [F.count_if(F.abs(z_score(F.col(f"`{c}`").cast("double"), packed[c]["mean"], packed[c]["sd"])) > sd)
           .alias(f"_o{i}") for i, c in enumerate(numeric)]
    wide = df.agg(F.count("*").alias("_rows"), *far)
    lines = []
    for i, c in enumerate(numeric):
        pct = F.try_divide(F.col(f"_o{i}") * 100.0, F.col("_rows"))
        lines.append(_line("few_outliers", c, pct, limit, pct < limit))
    return wide.select(F.inline(F.array(*lines)))


def build_checks(before: DataFrame, after: DataFrame, ts: str = "date") -> DataFrame:
    """Checks on a feature build: rows and nulls do not grow, something is left, the date is gone."""
    def totals(df, tag):
        nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns[1:]),
                    F.count_if(F.col(f"`{df.columns[0]}`").isNull()))
        return df.agg(F.count("*").alias(f"rows_{tag}"), nulls.alias(f"nulls_{tag}"))

    both = totals(before, "in").crossJoin(totals(after, "out"))  # one row each
    gone = ts not in after.columns
    return both.select(F.inline(F.array(
        _line("rows_not_added", "*", F.col("rows_out"), F.col("rows_in"), F.col("rows_out") <= F.col("rows_in")),
        _line("rows_left", "*", F.col("rows_out"), 0, F.col("rows_out") > 0),
        _line("nulls_not_added", "*", F.col("nulls_out"), F.col("nulls_in"), F.col("nulls_out") <= F.col("nulls_in")),
        _line("date_removed", ts, F.lit(float(gone)), 1.0, F.lit(gone)))))


def jarque_bera(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Normality per column from central moments: ``(metric, n, skew, excess, statistic, p_value)``.
    The chi-square tail with two degrees of freedom is exp(-x / 2)."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        varies = F.min(v) < F.max(v)
        aggs.append(F.struct(F.lit(c).alias("metric"), F.count(v).alias("n"),
                             F.when(varies, F.skewness(v)).alias("skew"),
                             F.when(varies, F.kurtosis(v)).alias("excess")).alias(f"_j{i}"))
    rows = df.agg(*aggs).select(F.inline(F.array(*[f"_j{i}" for i in range(len(columns))])))
    statistic = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("excess") ** 2 / 4.0)
    return rows.withColumn("statistic", statistic).withColumn("p_value", F.exp(-F.col("statistic") / 2))


def ks_normality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kolmogorov-Smirnov distance to a normal with the column's own mean and deviation:
    ``(metric, n, statistic, p_value)``, p by the limiting distribution.

    The empirical distribution at each value comes from the counts of smaller and of equal values
    that the ranks are made of, so the distance is exact and no column is sorted as a whole.
    Nulls and NaN are passed over; a constant column has no line.
    """
    columns = list(columns)
    values = df.select(*[clean_nan(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])
    numbered, _ = numbered_rows(values)
    stats = column_stats(numbered, columns).select("metric", "n", "mean", "sd")
    number = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)]), F.col("metric"))
    stats = gather(stats.select(number.alias("i"), "metric", "n", "mean", "sd"))[0]
    rows = row_counts(numbered, columns).withColumnRenamed("metric", "i").join(stats.where("sd > 0"), "i")
    normal = normal_cdf((F.col("v") - F.col("mean")) / F.col("sd"))
    gap = F.greatest((F.col("below0") + F.col("equal0")) / F.col("n") - normal, normal - F.col("below0") / F.col("n"))
    return rows.groupBy("metric", "n").agg(F.max(gap).alias("statistic")).withColumn(
        "p_value", kolmogorov_tail(F.col("statistic"), F.col("n")))


def _anova_line(groups: DataFrame) -> DataFrame:
    """``n_groups, n, ss_between, ss_within, f_value, p_value`` from ``(n, m, s)``: size, mean and population variance."""
    groups = settle(groups.where("n > 0"), "groups")  # read twice: the grand mean comes first
    grand = groups.agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n"))).scalar()
    rows = groups.agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("m") - grand, F.lit(2.0))).alias("ss_between"),
        F.sum(F.col("n") * F.col("s")).alias("ss_within"))
    between, within = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    rows = rows.withColumn("f_value", F.try_divide(F.try_divide("ss_between", between), F.try_divide("ss_within", within)))
    return rows.withColumn("p_value", f_tail(F.col("f_value"), between.cast("double"), within.cast("double")))


def anova_f(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-way ANOVA with each column as a group: sums of squares in one aggregate, the tail of F from the
    incomplete beta function. ``(n_groups, n, ss_between, ss_within, f_value, p_value)``."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`").cast("double")
        aggs.append(F.struct(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("s")).alias(f"_g{i}"))
    return _anova_line(df.agg(*aggs).select(F.inline(F.array(*[f"_g{i}" for i in range(len(columns))]))))


def anova_by(df: DataFrame, value: str, by: str) -> DataFrame:
    """One-way ANOVA of ``value`` between the groups of ``by``, however many; rows with a null on either
    side are passed over."""
    v = F.col(value).cast("double")
    known = df.where(F.col(by).isNotNull() & v.isNotNull())
    return _anova_line(known.groupBy(by).agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("s")))


def quality_gate(metrics: DataFrame, min_r2: float = 0.5, max_rmse: float = 1000.0) -> DataFrame:
    return metrics.select(F.inline(F.array(
        _line("r2", F.col("model"), F.col("r2"), min_r2, F.col("r2") > min_r2),
        _line("rmse", F.col("model"), F.col("rmse"), max_rmse, F.col("rmse") < max_rmse))))
