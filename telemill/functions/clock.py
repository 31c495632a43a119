"""Time arithmetic. Every function takes the clock as an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock(as_of: datetime | str | Column | None = None) -> Column:
    """The reference instant as a column; the current time when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def shift(ts: Column, amount: int, unit: str) -> Column:
    """``ts`` moved by a whole number of seconds, minutes, hours or days."""
    return ts + F.expr(f"INTERVAL '{int(amount)}' {unit}")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, not whole minutes elapsed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def recent(ts: str, as_of: Column, amount: int, unit: str, partition: str | None = "event_date") -> Column:
    """Rows of the last ``amount`` units.

    With a partition column the implied date condition is added, which is what
    lets the scan skip whole dates.
    """
    start = shift(as_of, -amount, unit)
    kept = F.col(ts) >= start
    if partition:
        kept = kept & (F.col(partition) >= F.to_date(start))
    return kept


def event_key(machine: Column, ts: Column) -> Column:
    """Event id made of the machine and the epoch milliseconds."""
    return F.concat_ws("_", machine, F.unix_millis(ts.cast("timestamp")).cast("string"))
