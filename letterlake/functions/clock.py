"""Event times and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_MILLIS = r"\A-?[0-9]+\z"
# A timestamp counts microseconds in 64 bits.
_MOST_MILLIS = (2**63 - 1) // 1000
_CALENDAR = r"\A[0-9]{4}-"

# Unit letters of a retention text such as 7d.
_SECONDS = {"d": 86_400, "h": 3_600, "m": 60, "s": 1}


def event_timestamp(column: Column) -> Column:
    """TIMESTAMP from epoch-millisecond digits or ISO text; what no timestamp holds is NULL, never an error."""
    millis = F.when(column.rlike(_EPOCH_MILLIS), column).try_cast("bigint")
    calendar = F.when(column.rlike(_CALENDAR), column)
    held = F.when(millis.between(-_MOST_MILLIS, _MOST_MILLIS), millis)
    return F.coalesce(F.timestamp_millis(held), F.try_to_timestamp(calendar))


def ntz(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def epoch_millis(column: Column) -> Column:
    return F.unix_millis(column.cast("timestamp"))


def iso_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_millis_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def duration(text: str) -> dt.timedelta:
    """``7d``, ``12h``, ``30m`` or ``45s``."""
    *digits, unit = text.strip() or " "
    count = "".join(digits)
    if not (count.isascii() and count.isdigit() and unit in _SECONDS):
        raise ValueError(f"no number of days, hours, minutes or seconds: {text!r}")
    return dt.timedelta(seconds=int(count) * _SECONDS[unit])


def instant(moment: dt.datetime | str) -> Column:
    """A constant UTC wall-clock time; clocks are always passed in, so that reruns agree."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")
