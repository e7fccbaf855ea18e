"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with the SQL that must agree with it."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def col(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each made different from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(col(name), F.lit(""))


def buckets(total: int, each: int) -> int:
    """How many groups of about ``each`` units hold ``total`` units."""
    return max(1, math.ceil(total / each))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Is crc32 of the id, as text, in the remainder class set aside for testing?"""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % modulus == remainder, F.lit(False))
