"""Time expressions on zone-free timestamps (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlane.defaults import DAYS, STEP_SECONDS


def to_timestamp_dayfirst(c: Column) -> Column:
    """Day-first text, or ISO text, to TIMESTAMP_NTZ; anything else is null.

    The formats are tried on text of the right shape only, so ISO input with a
    day above 12 is read and not lost.
    """
    text = F.trim(c.cast("string"))
    dayfirst = F.try_to_timestamp(text, F.lit("d/M/yyyy H:mm"))
    iso = F.when(text.rlike(r"^\d{4}-"), text.try_cast("timestamp_ntz"))
    return F.coalesce(dayfirst.cast("timestamp_ntz"), iso)


def day_name(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.weekday(ts) + 1)


def week_status(day: Column) -> Column:
    return F.when(day.isin("Saturday", "Sunday"), "Weekend").when(day.isNotNull(), "Weekday")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def seconds_since_midnight(ts: Column, step: int = STEP_SECONDS) -> Column:
    """Whole seconds since midnight, rounded half-to-even to a multiple of step.
    Late in the day this yields 86400; it does not wrap."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (F.bround(seconds / F.lit(float(step)), 0) * step).cast("long")


def slot_floor(ts: Column, step: int = STEP_SECONDS) -> Column:
    """Start of the slot; stays zone-free and keeps null rows (``window`` drops them)."""
    if 86400 % step:
        raise ValueError("the step must divide a day")
    minutes = F.hour(ts) * 60 + F.minute(ts)
    if step % 60 == 0:
        into_day = F.make_dt_interval(mins=minutes - minutes % (step // 60))
    else:
        seconds = minutes * 60 + F.second(ts)
        into_day = F.make_dt_interval(secs=(seconds - seconds % step).cast("decimal(18,6)"))
    return ts.cast("date").cast("timestamp_ntz") + into_day


def slot_ceil(ts: Column, step: int = STEP_SECONDS) -> Column:
    floor = slot_floor(ts, step)
    return F.when(floor == ts, ts).otherwise(floor + F.make_dt_interval(secs=F.lit(step)))
