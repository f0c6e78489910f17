"""Calendar steps of the four frequencies.

``D``, ``W`` and ``M`` work on dates (``M`` on month ends), ``H`` on timestamps
without a time zone, cut to the hour. Every column here is one step apart from
the next in its own unit, so windows over time turn into integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ds_type(freq: str) -> str:
    return "timestamp_ntz" if freq == "H" else "date"


def to_step(value: Column, freq: str) -> Column:
    """The step a date or timestamp belongs to."""
    if freq == "H":
        ts = value.cast("timestamp_ntz")
        return ts - F.make_dt_interval(
            F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
        )
    day = value.cast("date")
    return F.last_day(day) if freq == "M" else day


def add_steps(ds: Column, n: Column | int, freq: str) -> Column:
    """``ds`` moved by ``n`` steps, forward or back."""
    n = (F.lit(n) if isinstance(n, int) else n).cast("int")
    if freq == "D":
        return F.date_add(ds, n)
    if freq == "W":
        return F.date_add(ds, n * 7)
    if freq == "H":
        return ds + F.make_dt_interval(F.lit(0), n)
    # A date inside a month reaches its own month end with the first step forward.
    inside = (n > 0) & (ds != F.last_day(ds))
    return F.last_day(F.add_months(ds, n - inside.cast("int")))


def step_number(ds: Column, freq: str) -> Column:
    """Steps since 1970, as a whole number that grows by one per step."""
    if freq == "M":
        return F.year(ds) * 12 + F.month(ds)
    if freq == "H":
        return F.unix_date(ds.cast("date")).cast("bigint") * 24 + F.hour(ds)
    days = F.unix_date(ds)
    return F.floor(days / 7).cast("int") if freq == "W" else days


def clock(ds: Column, freq: str) -> Column:
    """Days (``H``: hours) since 1970: the numeric form sent to Python workers."""
    return step_number(ds, "H") if freq == "H" else F.unix_date(ds)


def from_clock(value: Column, freq: str) -> Column:
    if freq == "H":
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return epoch + F.make_dt_interval(F.lit(0), value.cast("int"))
    return F.date_from_unix_date(value.cast("int"))


def elapsed(ds: Column, anchor: Column, freq: str) -> Column:
    """Days (``H``: hours) from ``anchor`` to ``ds``."""
    return clock(ds, freq) - clock(anchor, freq)


def step_index(ds: Column, anchor: Column, freq: str) -> Column:
    """Whole steps from ``anchor`` to ``ds``, rounded down."""
    if freq == "W":
        return F.floor(elapsed(ds, anchor, freq) / 7).cast("int")
    return step_number(ds, freq) - step_number(anchor, freq)
