"""Category and text column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlane.defaults import LOAD_TYPE_RULES, SENTINELS, WEEK_STATUS


def normalise_category(c: Column, rules: Sequence[tuple[str, str]] = tuple(LOAD_TYPE_RULES)) -> Column:
    """Map spelling variants to the category of the first fragment they hold, whatever the
    case and blanks between letters; else null."""
    key = F.replace(F.upper(c.cast("string")), F.lit(" "), F.lit(""))
    out = None
    for fragment, category in rules:
        hit = key.contains(fragment)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out


def in_domain_or_null(c: Column, domain: Sequence[str]) -> Column:
    return F.when(c.isin(list(domain)), c)


def category_rank(c: Column, domain: Sequence[str]) -> Column:
    """1-based position in the domain; null when outside it."""
    position = F.array_position(F.array(*[F.lit(v) for v in domain]), c)
    return F.when(position > 0, position)


def sentinel_to_null(c: Column, sentinels: Sequence[str] = tuple(SENTINELS)) -> Column:
    return F.when(~c.isin(list(sentinels)), c)


def binary_code(c: Column, zero: str = WEEK_STATUS[0], one: str = WEEK_STATUS[1]) -> Column:
    return F.when(c == zero, 0).when(c == one, 1).cast("byte")


def nonzero_entries(names: Sequence[str]) -> Column:
    """Feature row as a map that holds only its non-zero entries."""
    pairs = [x for n in names for x in (F.lit(n), F.col(f"`{n}`").cast("double"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v != 0)
