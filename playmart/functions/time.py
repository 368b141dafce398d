"""Windows over time and local days."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = date(1970, 1, 1)
FLOOR = date(1900, 1, 1)


def ts(value: datetime | str) -> Column:
    """A timestamp without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


@dataclass(frozen=True)
class Window:
    """A span of time; `closed` names the ends that belong to it: both, left, right or neither."""

    start: datetime | str | None = None
    end: datetime | str | None = None
    closed: str = "left"

    def holds(self, column: str | Column) -> Column:
        c = F.col(column) if isinstance(column, str) else column
        out = F.lit(True)
        if self.start is not None:
            out &= c >= ts(self.start) if self.closed in ("left", "both") else c > ts(self.start)
        if self.end is not None:
            out &= c <= ts(self.end) if self.closed in ("right", "both") else c < ts(self.end)
        return out


def local_day(column: str | Column, offset_hours: int = -3) -> Column:
    """Day of a timestamp at a fixed offset from it."""
    c = F.col(column) if isinstance(column, str) else column
    return F.to_date(c + hours(offset_hours))


def local_time(column: str | Column, tz: str) -> Column:
    """A UTC timestamp without zone as the wall time of a named zone."""
    c = F.col(column) if isinstance(column, str) else column
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def null_if_epoch(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != day(EPOCH), c)
