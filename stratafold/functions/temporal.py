"""Date and time expressions that give NULL, not an error, on bad text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the landed feeds.
DATE_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(_col(c), fmt)


def compose_timestamp(date: Column | str, time: Column | str, fmt: str = MINUTE_FORMAT) -> Column:
    """Join a date text and a time text; a missing or empty part gives NULL."""
    return F.try_to_timestamp(F.concat_ws(" ", _col(date), _col(time)), F.lit(fmt))


def logical_timestamp(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """The timestamp a logical date stands for (start of that day)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def stamp(as_of: dt.datetime | Column | None) -> Column:
    """The clock of a run: a given instant, or the start of the query."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def ntz(value: dt.datetime) -> Column:
    """A literal without time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of(c: Column | str) -> Column:
    """Partition value: the day."""
    return F.to_date(_col(c))


def month_of(c: Column | str) -> Column:
    """Partition value: the first day of the month."""
    return F.trunc(_col(c), "month")
