"""Feature table as fit and transform.

Fitting takes two aggregates over the table: one decides which columns are
numeric, which are empty, and their means; the other counts the values of the
text columns, for the most frequent value and the one-hot levels. Transforming is
a projection.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlane.defaults import SENTINELS, TARGET, TIMESTAMP
from wattlane.functions import clean_nan, coerce_numeric, sentinel_to_null
from wattlane.operators.names import lower_names
from wattlane.operators.wide import fill_places, number_levels, sparse_vector
from wattlane.session import settle

MAX_LEVELS = 5_000


@dataclass
class FeatureConfig:
    target: str | None = TARGET
    drop: Sequence[str] = (TIMESTAMP,)
    keep: Sequence[str] = ()          # carried through unchanged, e.g. the row key
    one_hot: bool = True
    sentinels: Sequence[str] = tuple(SENTINELS)
    drop_raw: bool = True             # leave out the *_raw text columns


@dataclass
class FeatureModel:
    """What fitting learned. ``columns`` maps each kept feature to 'numeric' or 'text'."""

    target: str | None
    keep: list[str]
    one_hot: bool
    sentinels: list[str]
    columns: dict[str, str] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)

    def feature_names(self) -> list[str]:
        numeric = [c for c, kind in self.columns.items() if kind == "numeric"]
        text = [c for c, kind in self.columns.items() if kind == "text"]
        if not self.one_hot:
            return numeric + text
        return numeric + [f"{c}_{v}" for c in text for v in self.levels[c]]

    def transform(self, df: DataFrame, present_only: bool = False) -> DataFrame:
        """Features (all double), then the target when present, then the kept columns.
        Rows whose target is not numeric are dropped. With ``present_only`` an input column that
        is absent gives no feature, else it is imputed like a null."""
        df = lower_names(df)
        types = {f.name: f.dataType for f in df.schema.fields}
        out: list[Column] = []
        columns = {c: k for c, k in self.columns.items() if c in types or not present_only}
        for c, kind in columns.items():
            if kind == "numeric":
                value = _number(c, types.get(c), self.sentinels)
                out.append(F.coalesce(value, F.lit(self.means[c])).alias(c))
        for c, kind in columns.items():
            if kind != "text":
                continue
            value = F.coalesce(_text(c, types.get(c), self.sentinels), F.lit(self.modes[c]))
            if not self.one_hot:
                out.append(value.alias(c))
                continue
            out += [F.when(value == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in self.levels[c]]
        kept = [F.col(k) for k in self.keep if k in types]
        if self.target is None or self.target not in types:
            return df.select(*out, *kept)
        target = _number(self.target, types[self.target], self.sentinels)
        rows = df.withColumn("_target", target).where(F.col("_target").isNotNull())
        return rows.select(*out, F.col("_target").alias(self.target), *kept)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureModel:
        return FeatureModel(**json.loads(text))


def _text(name: str, dtype: T.DataType | None, sentinels: Sequence[str]) -> Column:
    if dtype is None:
        return F.lit(None).cast("string")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return clean_nan(F.col(f"`{name}`")).cast("string")
    text = F.col(f"`{name}`").cast("string")
    return sentinel_to_null(text, sentinels) if isinstance(dtype, T.StringType) else text


def _number(name: str, dtype: T.DataType | None, sentinels: Sequence[str]) -> Column:
    if dtype is None:
        return F.lit(None).cast("double")
    if isinstance(dtype, T.StringType):
        return coerce_numeric(_text(name, dtype, sentinels))
    return coerce_numeric(F.col(f"`{name}`"), dtype)


def fit_statistics(df: DataFrame, config: FeatureConfig) -> tuple[DataFrame, list[str]]:
    """One row per candidate column: n_numeric (all rows), and over rows with a numeric
    target n_number, n_text and the mean. This is the first fit aggregate."""
    df = lower_names(df)
    target = config.target.lower() if config.target else None
    skip = {c.lower() for c in [*config.drop, *config.keep]} | ({target} if target else set())
    types = {f.name: f.dataType for f in df.schema.fields}
    candidates = [c for c in types if c not in skip and not (config.drop_raw and c.endswith("_raw"))]
    usable = F.lit(True)
    if target in types:
        usable = _number(target, types[target], config.sentinels).isNotNull()
    rows = df.select(usable.alias("_ok"), *[
        F.struct(_number(c, types[c], config.sentinels).alias("x"),
                 _text(c, types[c], config.sentinels).alias("s")).alias(f"_c{i}")
        for i, c in enumerate(candidates)])
    aggs = [F.struct(
        F.lit(c).alias("column"), F.count(f"_c{i}.x").alias("n_numeric"),
        F.count(F.when(F.col("_ok"), F.col(f"_c{i}.x"))).alias("n_number"),
        F.count(F.when(F.col("_ok"), F.col(f"_c{i}.s"))).alias("n_text"),
        F.avg(F.when(F.col("_ok"), F.col(f"_c{i}.x"))).alias("mean")).alias(f"_a{i}")
        for i, c in enumerate(candidates)]
    return rows.agg(*aggs).select(F.inline(F.array(*[f"_a{i}" for i in range(len(candidates))]))), candidates


def level_counts(df: DataFrame, columns: Sequence[str], config: FeatureConfig) -> DataFrame:
    """``(column, value, n)`` for text columns, over rows with a numeric target. The second fit aggregate."""
    df = lower_names(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    target = config.target.lower() if config.target else None
    rows = df
    if target in types:
        rows = df.where(_number(target, types[target], config.sentinels).isNotNull())
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), _text(c, types[c], config.sentinels).alias("value")) for c in columns])))
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def fit_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> FeatureModel:
    """Learn the feature schema from ``df`` (all rows for parity, or the training rows).

    A column is numeric when any of its values is a number; a column with no value
    left is dropped. Both decisions are aggregates; what reaches the driver is one
    row per column, and at most MAX_LEVELS one-hot levels in all (more is an error;
    ``sparse_features`` has no such bound).
    """
    stats, candidates = fit_statistics(df, config)
    model = FeatureModel(config.target.lower() if config.target else None, [k.lower() for k in config.keep],
                         config.one_hot, list(config.sentinels))
    rows = {r["column"]: r for r in stats.collect()}
    for c in candidates:
        r = rows[c]
        numeric = r["n_numeric"] > 0
        if (r["n_number"] if numeric else r["n_text"]) == 0:
            model.dropped.append(c)
            continue
        model.columns[c] = "numeric" if numeric else "text"
        if numeric:
            model.means[c] = r["mean"]
    text = [c for c, kind in model.columns.items() if kind == "text"]
    if not text:
        return model
    counts = level_counts(df, text, config)
    if not model.one_hot:
        order = F.struct(-F.col("n"), F.col("value"))
        for r in counts.groupBy("column").agg(F.min_by("value", order).alias("mode")).collect():
            model.modes[r["column"]] = r["mode"]
        return model
    found = counts.limit(MAX_LEVELS + 1).collect()  # one more than allowed, so excess is an error and never cut off
    if len(found) > MAX_LEVELS:
        raise ValueError(f"the text columns {text} have more than {MAX_LEVELS} levels; use sparse_features")
    for r in sorted(found, key=lambda r: (-r["n"], r["value"])):
        model.modes.setdefault(r["column"], r["value"])
        model.levels.setdefault(r["column"], []).append(r["value"])
    for levels in model.levels.values():
        levels.sort()
    return model


def build_features(df: DataFrame, config: FeatureConfig = FeatureConfig(),
                   fit_on: DataFrame | None = None) -> tuple[DataFrame, FeatureModel]:
    model = fit_features(df if fit_on is None else fit_on, config)
    return model.transform(df), model


@dataclass
class SparseFeatureModel:
    """What ``sparse_features`` learned; the levels are a table ``(column, value, place)``."""

    model: FeatureModel
    numeric: list[str]
    text: list[str]
    sizes: list[int]
    levels: DataFrame | None

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        kept = out.columns
        if self.text:
            out = fill_places(out, self.levels, self.text)
        starts = [len(self.numeric) + sum(self.sizes[:i]) for i in range(len(self.text))]
        values = [F.struct(F.lit(i).alias("j"), F.col(f"`{c}`").alias("x")) for i, c in enumerate(self.numeric)]
        values += [F.struct((F.col(f"_place_{i}") + start).cast("int").alias("j"),
                            F.when(F.col(f"_place_{i}").isNotNull(), 1.0).otherwise(0.0).alias("x")) for i, start in enumerate(starts)]
        entries = F.filter(F.array(*values), lambda e: e["x"] != 0)
        width = len(self.numeric) + sum(self.sizes)
        features = sparse_vector(width, entries["j"], entries["x"])
        index = {f"{c}_index": F.coalesce(F.col(f"_place_{i}"), F.lit(self.sizes[i])).cast("double") for i, c in enumerate(self.text)}
        return out.select(*[F.col(f"`{c}`") for c in kept if c not in self.numeric], *[v.alias(k) for k, v in index.items()],
                          features.alias("features", metadata={"ml_attr": {"num_attrs": width}}))


def sparse_features(df: DataFrame, config: FeatureConfig = FeatureConfig(),
                    fit_on: DataFrame | None = None) -> tuple[DataFrame, SparseFeatureModel]:
    """Text columns of any number of levels: one sparse vector ``features`` per row, the numeric columns first,
    then a one for each text column's level (levels in alphabetical order). A level not seen in fitting
    has no one. Beside it ``<column>_index``, the filled text columns, the target and the kept columns.

    The caller chooses this form; ``build_features`` gives one column per level. The levels are numbered
    and looked up as a table; the driver holds their number only.
    """
    source = df if fit_on is None else fit_on
    model = fit_features(source, replace(config, one_hot=False))
    numeric = [c for c, kind in model.columns.items() if kind == "numeric"]
    text = [c for c, kind in model.columns.items() if kind == "text"]
    sizes, levels = [], None
    if text:
        counted = level_counts(source, text, config)
        places = F.create_map(*[x for i, c in enumerate(text) for x in (F.lit(c), F.lit(i))])
        levels = settle(number_levels(counted.select(places[F.col("column")].alias("column"), "value")), "places")
        found = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count("*").alias("n")).collect()}
        sizes = [found.get(i, 0) for i in range(len(text))]
    fitted = SparseFeatureModel(model, numeric, text, sizes, levels)
    return fitted.transform(df), fitted


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that hold no value at all; one aggregate decides."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if counts[f"_n{i}"] > 0 or c in keep])


def align_to_schema(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Exactly the expected columns in order: missing ones are 0, extra ones dropped.
    The second value reports both lists, so silent zero-filling is visible."""
    out = [F.col(f"`{c}`").cast("double").alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected]
    report = {"zero_filled": [c for c in expected if c not in df.columns],
              "dropped": [c for c in df.columns if c not in expected and c not in keep]}
    return df.select(*out, *[F.col(k) for k in keep]), report


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Optional (x - mean) / sd; a constant column becomes 0."""
    from wattlane.operators.profile import column_stats

    stats = {r["metric"]: r for r in column_stats(df, columns).collect()}
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[c]["mean"])) / F.lit(stats[c]["sd"]) if stats[c]["sd"] else F.lit(0.0)
        for c in columns})
