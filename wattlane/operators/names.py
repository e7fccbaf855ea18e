"""Column names and column sets. Metadata only: no job runs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.defaults import HEADER_FIXES, KEY_COLUMNS, TIME_KEYWORDS


#: A word of a header: capitals with what follows them in lower case, or lower case alone.
WORD = re.compile("[A-Z]+[a-z0-9]*|[a-z0-9]+")


def snake_name(name: str) -> str:
    """ASCII snake case: accents removed, camel case split, other signs to one underscore."""
    folded = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode()
    return "_".join(word.lower() for word in WORD.findall(folded))


def unique_names(names: Sequence[str]) -> list[str]:
    """Number repeated names _1, _2, ... and never reuse a name already taken."""
    taken, out = set(names), []
    seen: dict[str, int] = {}
    for name in names:
        if name not in seen:
            seen[name] = 0
            out.append(name)
            continue
        candidate = name
        while candidate in taken:
            seen[name] += 1
            candidate = f"{name}_{seen[name]}"
        taken.add(candidate)
        out.append(candidate)
    return out


def normalise_names(df: DataFrame, fixes: Mapping[str, str] = HEADER_FIXES) -> DataFrame:
    df = df.toDF(*unique_names([snake_name(c) for c in df.columns]))
    return df.withColumnsRenamed({k: v for k, v in fixes.items() if v not in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def keys_first(df: DataFrame, keys: Sequence[str] = tuple(KEY_COLUMNS)) -> DataFrame:
    head = [k for k in keys if k in df.columns]
    return df.select(*head, *[F.col(f"`{c}`") for c in df.columns if c not in head])


def column_or_null(df: DataFrame, name: str, dtype: str = "string"):
    """The column, or an all-null one of the given type when it is absent."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def without_time_names(names: Sequence[str], keywords: Sequence[str] = tuple(TIME_KEYWORDS)) -> list[str]:
    return [n.lower() for n in names if not any(k in n.lower() for k in keywords)]
