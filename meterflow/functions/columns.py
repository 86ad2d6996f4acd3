from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from meterflow.schema import CALENDAR, NA_TEXT

# Ends of text that the cast to double takes and that are no numbers: 1.5d, 2f, nan.
NOT_A_MEASURE = r"(?:[dD]|[0-9.][fF]|[nN])\s*$"


def event_time(epoch_ms):
    """Instant of an epoch-millisecond column, milliseconds kept."""
    return F.timestamp_millis(epoch_ms)


def utc_time(ts, kind):
    """The time in UTC, as a timestamp without zone: the same whatever the session's zone."""
    if not isinstance(kind, TimestampType):
        return ts
    seconds = (F.unix_micros(ts) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def utc_day(ts, kind):
    """The day in UTC."""
    return F.to_date(utc_time(ts, kind))


def calendar_parts(ts, kind=None):
    """Zero-padded year, month, day, hour and minute text of a timestamp, in UTC."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    time = ts if kind is None else utc_time(ts, kind)
    return [F.date_format(time, fmt).alias(name) for name, fmt in CALENDAR.items()]


def clamp(value, low, high):
    """Value held within [low, high]; null and NaN stay as they are."""
    return (
        F.when(value < low, F.lit(low))
        .when((value > high) & ~F.isnan(value), F.lit(high))
        .otherwise(value)
    )


def rectify(value):
    """Zero for negative values; null stays null."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def power_factor(active, reactive):
    """Active power over apparent power; null where there is no power at all."""
    return F.try_divide(active, F.sqrt(active * active + reactive * reactive))


def measure_from_text(text):
    """Number in a text column, null where the text is not a number.

    The cast alone would also take Java's type suffixes ("1.5d", "2f") and keep NaN, which
    counts as missing here; "inf" stays a number. The expression is kept small, because the
    null check of an import repeats it in the same generated method.
    """
    return F.when(~text.rlike(NOT_A_MEASURE), text.try_cast("double"))


def text_or_null(text):
    """Text with the markers for "no value" turned into null."""
    return F.when(~text.isin(NA_TEXT), text)


def timestamp_from_text(date, time, fmt, strict=False):
    """Timestamp of a date and a time text; unparseable text is null, or fails if strict."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    joined = F.concat_ws(" ", date, time)
    return parse(joined, fmt) if strict else parse(joined, F.lit(fmt))
