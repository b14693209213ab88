"""Calendar spines, resampling, filling and interpolation of time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.functions.temporal import floor_minutes, micros, month_end, quarter_end
from millrace.operators.missing import nan_to_null
from millrace.operators.relational import agg_spec
from millrace.operators.split import PIECE_ROWS, join_on, neighbours

MINUTES = {"30min": 30, "h": 60}


def period_label(c: Column | str, freq: str) -> Column:
    """Label of the period a time falls in: start for minutes, hours and days, end for W, ME and QE."""
    if freq in MINUTES:
        return floor_minutes(c, MINUTES[freq])
    d = col(c).cast("date")
    if freq == "D":
        return d
    if freq == "W":
        return F.date_add(d, 6 - F.weekday(d))
    if freq == "ME":
        return month_end(c)
    if freq == "QE":
        return quarter_end(c)
    raise ValueError(f"unknown frequency {freq}")


def _steps(lo: Column, hi: Column, freq: str) -> Column:
    """Array of all labels from the first to the last one."""
    if freq in MINUTES:
        return F.sequence(lo, hi, F.expr(f"interval {MINUTES[freq]} minutes"))
    if freq == "D":
        return F.sequence(lo, hi, F.expr("interval 1 day"))
    if freq == "W":
        return F.sequence(lo, hi, F.expr("interval 7 days"))
    step = "interval 1 month" if freq == "ME" else "interval 3 months"
    return F.transform(F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr(step)), F.last_day)


def spine(spark: SparkSession, start: str, end: str, freq: str, out: str = "label") -> DataFrame:
    """All labels whose period touches [start, end]."""
    kind = "timestamp_ntz" if freq in MINUTES else "date"
    one = spark.range(1).select(
        period_label(F.lit(start).cast(kind), freq).alias("lo"),
        period_label(F.lit(end).cast(kind), freq).alias("hi"),
    )
    return one.select(F.explode(_steps(F.col("lo"), F.col("hi"), freq)).alias(out))


def resample(
    df: DataFrame, ts: str, freq: str, spec: Mapping[str, str], keys: Sequence[str] = (), out: str = "label"
) -> DataFrame:
    """Aggregate per period. Empty periods between the first and the last one appear, with sums of 0
    and other aggregates null."""
    grouped = agg_spec(df, [*keys, period_label(ts, freq).alias(out)], spec)
    labels = spine_of(grouped, keys, out, freq)
    full = join_on(labels, grouped, [*keys, out])
    return full.fillna(0, subset=[c for c, fn in spec.items() if fn == "sum"])


def spine_of(df: DataFrame, keys: Sequence[str], label: str, freq: str) -> DataFrame:
    """Labels from the first to the last one present, per key; as long as the calendar, not the data."""
    ends = df.groupBy(*keys).agg(F.min(label).alias("__lo"), F.max(label).alias("__hi"))
    return ends.select(*keys, F.explode(_steps(F.col("__lo"), F.col("__hi"), freq)).alias(label))


def upsample(df: DataFrame, label: str, freq: str, keys: Sequence[str] = ()) -> DataFrame:
    """Put a sparse series on a finer grid; new labels have null values."""
    return join_on(spine_of(df, keys, label, freq), df, [*keys, label])


def ffill(
    df: DataFrame, order: str, value: str, out: str, keys: Sequence[str] = (), piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Last known value at or before each row; NaN counts as unknown, a null order value comes first."""
    df = nan_to_null(df, [value])
    filled = neighbours(df, list(keys), order, value, micros(order), forward=False, piece_rows=piece_rows)
    return filled.withColumn(out, F.col("__prev")["v"]).drop("__prev")


def interpolate(
    df: DataFrame,
    order: str,
    value: str,
    out: str,
    keys: Sequence[str] = (),
    edges: str = "both",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Linear interpolation weighted by time (on a regular grid that is the position).

    ``edges="forward"`` leaves a leading gap empty; ``"both"`` fills it with the first known value. A
    trailing gap takes the last known value either way. NaN is a gap.
    """
    df = nan_to_null(df, [value])
    near = neighbours(df, list(keys), order, value, micros(order), piece_rows=piece_rows)
    t, prev, nxt = micros(order), F.col("__prev"), F.col("__next")
    span = micros(nxt["t"]) - micros(prev["t"])
    share = F.try_divide((t - micros(prev["t"])).cast("double"), span.cast("double"))
    between = prev["v"] + (nxt["v"] - prev["v"]) * share
    tail = F.when(nxt.isNull(), prev["v"])
    head = F.when(prev.isNull(), nxt["v"]) if edges == "both" else F.lit(None)
    return near.withColumn(out, F.coalesce(F.col(value), between, tail, head)).drop("__prev", "__next")
