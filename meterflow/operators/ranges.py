"""Half-open time ranges that reach the partitions of a table."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from meterflow.functions.columns import calendar_parts, utc_day
from meterflow.schema import CALENDAR

WIDTH = {"year": 4}
# Ways a table's partitions hold its time: one ``date`` column, or the calendar columns.
BY_DATE, BY_MINUTE = "date", "minute"


def as_datetime(value):
    """A datetime, or ISO text of one; anything else is a ValueError."""
    if isinstance(value, datetime):
        return value
    try:
        return datetime.fromisoformat(value)
    except TypeError as error:
        raise ValueError(f"not a date and time: {value!r}") from error


def range_of(start, end=None, minutes=None):
    """Checked (start, end) of a range given by its end or its length in minutes. Either both
    bounds have a UTC offset or none has."""
    start = as_datetime(start)
    end = start + timedelta(minutes=minutes) if end is None else as_datetime(end)
    if (start.tzinfo is None) != (end.tzinfo is None):
        raise ValueError(f"one bound has an offset, the other has none: {start}, {end}")
    if start >= end:
        raise ValueError(f"empty time range: {start} to {end}")
    return start, end


def between(table, low=None, high=None, ts="timestamp", partitions=None, strict=False):
    """Rows with ``low <= ts < high`` for column bounds, either of which may be left out;
    ``strict`` leaves out ``low`` itself too.

    ``partitions`` tells how the table is partitioned by ``ts``, in UTC as the writers do:
    ``BY_DATE``, ``BY_MINUTE`` or not at all. Such a table is also filtered on those columns,
    because Spark does not derive a partition filter from a timestamp filter. A column that is
    merely called ``date`` has no meaning here.
    """
    kind = table.schema[ts].dataType
    if partitions == BY_DATE:
        part = F.col("date")

        def of(bound):
            return utc_day(bound, kind)
    elif partitions == BY_MINUTE:
        part = F.concat(
            *[F.lpad(F.col(p).cast("string"), WIDTH.get(p, 2), "0") for p in CALENDAR]
        )

        def of(bound):
            return F.concat(*calendar_parts(bound, kind))
    elif partitions is None:
        part = None
    else:
        raise ValueError(f"unknown partitions: {partitions!r}")

    rows = table
    if low is not None:
        rows = rows.filter(F.col(ts) > low if strict else F.col(ts) >= low)
        rows = rows if part is None else rows.filter(part >= of(low))
    if high is not None:
        rows = rows.filter(F.col(ts) < high)
        rows = rows if part is None else rows.filter(part <= of(high))
    return rows


def time_literal(table, value, ts="timestamp"):
    """A literal of the type of ``ts``. A value with an offset is that instant, which is a UTC
    time for a column without zone; one without is read in the session time zone."""
    value, kind = as_datetime(value), table.schema[ts].dataType
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
        if isinstance(kind, TimestampType):
            micros = (value - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
            return F.timestamp_micros(F.lit(micros))
        value = value.replace(tzinfo=None)
    return F.lit(value.isoformat(" ")).cast(kind)


def time_range(table, start, end, ts="timestamp", partitions=None):
    """Rows with ``start <= ts < end``."""
    return between(
        table, time_literal(table, start, ts), time_literal(table, end, ts), ts, partitions
    )
