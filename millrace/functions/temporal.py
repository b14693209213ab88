"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col

LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"


def parse_date(c: Column | str, *formats: str) -> Column:
    """Date under the first pattern that fits, null if none does."""
    return F.coalesce(*[F.try_to_date(col(c), f) for f in (formats or ("yyyy-MM-dd",))])


def parse_log_time(c: Column | str) -> Column:
    """Access-log time as zone-less UTC; null when unreadable."""
    return F.try_to_timestamp(col(c), F.lit(LOG_TIME)).cast("timestamp_ntz")


def log_time_text(c: Column | str) -> Column:
    return F.concat(F.date_format(col(c), "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp, zone-less ones read as UTC."""
    return F.unix_micros(col(c).cast("timestamp"))


def micros_of_day(hour, minute, second, micro) -> Column:
    """Time of day as a number; the engine has no time type by default."""
    h, m, s, u = (x if isinstance(x, Column) else F.lit(x) for x in (hour, minute, second, micro))
    return ((h * 60 + m) * 60 + s).cast("long") * 1_000_000 + u


def time_text(c: Column | str) -> Column:
    """ISO text HH:mm:ss.ffffff of a time of day in microseconds."""
    t = col(c).cast("long")
    sec = F.floor(t / 1_000_000)
    return F.format_string(
        "%02d:%02d:%02d.%06d", F.floor(sec / 3600), F.floor(sec / 60) % 60, sec % 60, t % 1_000_000
    )


def calendar_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Year to second, quarter, weekday (Monday 0), ISO weekday, day name, ISO week and month key."""
    c = F.col(ts)
    return df.withColumns({
        prefix + "year": F.year(c),
        prefix + "quarter": F.quarter(c),
        prefix + "month": F.month(c),
        prefix + "day": F.dayofmonth(c),
        prefix + "hour": F.hour(c),
        prefix + "minute": F.minute(c),
        prefix + "second": F.second(c),
        prefix + "weekday": F.weekday(c),
        prefix + "iso_weekday": F.weekday(c) + 1,
        prefix + "day_name": F.date_format(c, "EEEE"),
        prefix + "iso_week": F.weekofyear(c),
        prefix + "month_key": F.date_format(c, "yyyy-MM"),
    })


def to_zone(c: Column | str, zone: str) -> Column:
    """UTC wall time shown in another zone."""
    return F.from_utc_timestamp(col(c).cast("timestamp"), zone).cast("timestamp_ntz")


def replace_year(c: Column | str, year: int, strict: bool = True) -> Column:
    """Same day in another year. A day that does not exist raises, or gives null if not strict."""
    d = col(c)
    if strict:
        return F.make_date(F.lit(year), F.month(d), F.dayofmonth(d))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", F.lit(year), F.month(d), F.dayofmonth(d)), "yyyy-MM-dd")


def shift(c: Column | str, days: int = 0, hours: int = 0, minutes: int = 0, seconds: float = 0) -> Column:
    return col(c) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(seconds))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Whole days of a duration (floor), not the difference of calendar days."""
    return F.floor((micros(end) - micros(start)) / F.lit(86_400_000_000.0)).cast("long")


def duration_days(start: Column | str, end: Column | str) -> Column:
    """Duration in days with its fraction."""
    return seconds_between(start, end) / F.lit(86400.0)


def floor_minutes(c: Column | str, minutes: int) -> Column:
    """Start of the fixed-length slot the time falls in."""
    step = minutes * 60_000_000
    return F.timestamp_micros(micros(c) - F.pmod(micros(c), F.lit(step))).cast("timestamp_ntz")


def month_end(c: Column | str) -> Column:
    return F.last_day(col(c).cast("date"))


def quarter_end(c: Column | str) -> Column:
    return F.last_day(F.add_months(F.trunc(col(c).cast("date"), "quarter"), 2))


def with_audit_time(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
