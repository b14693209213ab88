"""Data mart, summary statistics, histogram, range counts and exact order statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from millrace.functions.columns import cents, exact_sum, mean
from millrace.operators.split import join_on


def mart_monthly(df: DataFrame, key: str, date_col: str, amount: str, digits: int | None = None) -> DataFrame:
    """Average amount per key, year and month, rounded half up to a whole number.

    ``digits``: decimal places of an amount of fixed places, for exact sums.
    """
    return (
        df.groupBy(
            F.col(key).alias("area_name"),
            F.year(date_col).alias("sale_year"),
            F.month(date_col).alias("sale_month"),
        )
        .agg(F.round(mean(amount, digits)).cast("long").alias("avg_price"))
    )


def summary_stats(df: DataFrame, c: str, digits: int | None = None) -> DataFrame:
    return df.agg(
        F.count(c).alias("total"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        mean(c, digits).alias("avg_value"),
    )


def histogram(df: DataFrame, c: str, bins: int = 20) -> DataFrame:
    """Counts of equal-width bins over [min, max], closed on the right; empty bins are listed with 0.

    A column with a single value has no width: all rows fall into the middle bin, as with bins built
    around that value.
    """
    known = df.select(F.col(c).cast("double").alias("x")).filter(F.col("x").isNotNull())
    ends = known.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).scalar()
    width = (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    raw = F.ceil(F.try_divide(F.col("x") - ends["lo"], width))
    middle = (bins + 1) // 2
    which = F.when(width == 0, F.lit(middle)).otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(bins)))
    counts = known.groupBy(which.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


SMALL_PRIMES = [p for p in range(2, 1000) if all(p % q for q in range(2, int(p**0.5) + 1))]


def _strong(n: int) -> bool:
    twos = (n - 1 & 1 - n).bit_length() - 1
    for base in SMALL_PRIMES[:12]:
        x = pow(base, n - 1 >> twos, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


@F.pandas_udf(BooleanType())
def is_prime(numbers: pd.Series) -> pd.Series:
    """Primality of whole numbers: the small primes divide the whole batch, what is left is tested by the strong test to
    twelve bases, which has no false answer below 2^64."""
    n = numbers.fillna(0).to_numpy(dtype=np.int64)
    prime = n >= 2
    for d in SMALL_PRIMES:
        prime &= (n % d != 0) | (n == d)
    for at in np.flatnonzero(prime & (n > SMALL_PRIMES[-1] ** 2)):
        prime[at] = _strong(int(n[at]))
    return pd.Series(prime)


def count_in_ranges(
    df: DataFrame, id_col: str, width: int, predicate: Callable[[Column], Column]
) -> DataFrame:
    """Numbers satisfying a predicate, counted per fixed-width range; ranges without any show 0."""
    start = (F.floor(F.col(id_col) / width) * width).cast("long")
    return df.groupBy(start.alias("range_start")).agg(
        F.count_if(predicate(F.col(id_col))).alias("n")
    )


def mode_of(df: DataFrame, c: str) -> DataFrame:
    """Most frequent value as a one-row table; of several the smallest."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
    most = counts.groupBy("__n").agg(F.min(c).alias("__v"))
    return most.agg(F.max_by("__v", "__n").alias(c))


#: Accuracy of the sketches: a rank is bounded to a few shares of 1 / ACCURACY of a group.
ACCURACY = 10_000


def quantiles(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), q: float = 0.5, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantile, with linear interpolation, of several columns per group: keys, column_name, n, value.

    One pass over the table makes mergeable sketches that bound the wanted ranks of all columns and groups at once; a second counts
    what lies below the bounds and the values between them, some 26 / ``accuracy`` of a group, of which the ranks are picked. Only these
    few values of a group are ever sorted. Null and NaN are left out; a column without any value in a group has no row.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*").filter(F.col("x").isNotNull() & ~F.isnan("x"))
    slack = 13 / accuracy
    ends = F.percentile_approx("x", [max(0.0, q - slack), min(1.0, q + slack)], accuracy)
    by = [*keys, "column_name"]
    bounds = long.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), ends.alias("ends")).select(
        # In a small group one place is more than the slack; there all values count as between.
        *by, "n", *[F.when(F.col("n") < accuracy / 5, F.col(small)).otherwise(F.get("ends", F.lit(i))).alias(name)
                    for i, (small, name) in enumerate((("least", "low"), ("most", "high")))])
    place = F.lit(q) * (F.col("n") - 1)
    near = join_on(long, bounds, by, "inner").filter(F.col("x") <= F.col("high"))
    counted = near.groupBy(*by, F.when(F.col("x") >= F.col("low"), F.col("x")).alias("x")).agg(
        F.count(F.lit(1)).alias("m"), F.first("n").alias("n"))
    upto = F.sum("m").over(Window.partitionBy(*by).orderBy(F.col("x").asc_nulls_first()))
    picked = counted.withColumn("upto", upto).groupBy(*by).agg(
        F.first("n").alias("n"), F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("n") - 1)), F.col("x"))).alias("lower"),
        F.min(F.when(F.col("upto") > F.ceil(F.lit(q) * (F.col("n") - 1)), F.col("x"))).alias("upper"))
    return picked.select(*by, "n", (F.col("lower") + (F.col("upper") - F.col("lower")) * (place - F.floor(place))).alias("value"))


def exact_quantile(df: DataFrame, c: str, q: float = 0.5, accuracy: int = ACCURACY) -> float | None:
    """The exact quantile of one column, as a number; None without values."""
    row = quantiles(df, [c], q=q, accuracy=accuracy).first()
    return row["value"] if row else None


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Running sum with the default frame (rows equal in order count together).

    For summary tables, whose groups are bounded by the calendar; long groups use ``split.running_total``.
    """
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order)))


def moving_avg(
    df: DataFrame, keys: list[str], order: list[str], value: str, rows_back: int, out: str
) -> DataFrame:
    """Average of the current and the ``rows_back`` rows before it, over a summary table."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-rows_back, 0)
    total = F.sum(F.col(value)).over(frame).cast("double")
    return df.withColumn(out, total / F.count(F.col(value)).over(frame))


def lag_diff(df: DataFrame, keys: list[str], order: list[str], value: str, prefix: str) -> DataFrame:
    """Previous value (0 for the first row) and the difference to it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    kind = dict(df.dtypes)[value]
    prev = F.coalesce(F.lag(value).over(w), F.when(F.row_number().over(w) == 1, F.lit(0).cast(kind)))
    return df.withColumn(f"previous_{prefix}", prev).withColumn(
        f"{prefix}_difference", F.col(value) - F.col(f"previous_{prefix}")
    )


def days_since_previous(df: DataFrame, keys: list[str], date: str, out: str) -> DataFrame:
    """Days since the previous row of the group, 0 for the first."""
    w = Window.partitionBy(*keys).orderBy(date)
    return df.withColumn(out, F.datediff(F.col(date), F.coalesce(F.lag(date).over(w), F.col(date))))


def monthly_sales(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Sales per year and month; lines are added up per order before the join."""
    totals = lines.groupBy("l_orderkey").agg(
        exact_sum(cents("l_quantity") * cents("l_extendedprice"), 4).alias("amount")
    )
    joined = orders.join(totals, orders["o_orderkey"] == totals["l_orderkey"])
    return joined.groupBy(
        F.year("o_orderdate").alias("sale_year"), F.month("o_orderdate").alias("sale_month")
    ).agg(F.sum("amount").alias("monthly_sales"))
