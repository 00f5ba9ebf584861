"""Expressions the operators share, all built from Spark's own expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeflow.schemas import PRICE


def hour_of(ts: str) -> str:
    """SQL for the hour the column ``ts`` falls in, as TIMESTAMP_NTZ.

    ``date_trunc`` turns NTZ into a zoned timestamp and so depends on the
    session's zone; subtracting the minutes and seconds does not.
    """
    return f"{ts} - make_dt_interval(0, 0, minute({ts}), extract(SECOND FROM {ts}))"


def exact_mean(total: Column, n: Column) -> Column:
    """``total / n`` rounded half up to a PRICE; NULL when nothing was counted.

    Kept as a quotient of two sums rather than ``avg`` so that a mean over
    merged partial sums has exactly the digits of a mean over the rows.
    """
    # decimal(24,4) / decimal(13,0) is a decimal(38,18): wide enough that rounding
    # the quotient first does not change how it rounds to a PRICE.
    return F.try_divide(total.cast("decimal(24,4)"), n.cast("decimal(13,0)")).cast(PRICE)


def before(as_of: datetime | Column | None, *, days: int = 0, hours: int = 0) -> Column:
    """``as_of`` (by default now) minus the given days and hours."""
    if as_of is None:
        at = F.current_timestamp()
    elif isinstance(as_of, Column):
        at = as_of
    elif as_of.tzinfo is None:
        at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        at = F.lit(as_of)
    return at - F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))
