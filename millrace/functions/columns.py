"""Derived columns, banding, clipping, coercion and predicates."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Exact two-digit decimal, so that sums do not depend on the order of rows."""
    return col(c).cast("decimal(15,2)")


def cents(c: Column | str) -> Column:
    """Value in hundredths as a whole number."""
    return F.rint(col(c) * 100).cast("long")


def exact_sum(whole: Column, digits: int) -> Column:
    """Sum of whole numbers that stand for decimals with ``digits`` places, as an exact decimal.

    The upper and the lower 20 bits are added up apart, as plain long sums: several times faster than adding
    decimals, and neither can overflow before some 10^12 rows (an overflow would raise, not wrap).
    """
    upper = F.sum(F.shiftright(whole, 20)).cast("decimal(20,0)")
    lower = F.sum(whole.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    unit = F.expr(f"{10.0**-digits:.{digits}f}BD")
    return (upper * F.lit(1 << 20).cast("decimal(7,0)") + lower) * unit


def exact_avg(c: Column | str) -> Column:
    """Average of a money column (two places): exact sum, one division at the end; null for an empty group."""
    return F.try_divide(exact_sum(cents(c), 2).cast("double"), F.count(col(c)))


def mean(c: Column | str, digits: int | None = None) -> Column:
    """Average of any number as a double; null for an empty group.

    ``digits`` says that the values have so many decimal places: then the sum is exact and does not depend on the order
    of rows. Nothing is rounded otherwise.
    """
    if digits is None:
        return F.avg(col(c).cast("double"))
    whole = F.rint(col(c) * 10**digits).cast("long")
    return F.try_divide(exact_sum(whole, digits).cast("double"), F.count(col(c)))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even, as data-frame libraries do (``round`` rounds half up)."""
    scale = 10.0**digits
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def percent_of(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    return half_even(F.try_divide(col(num), col(den)) * 100, digits)


def with_ratio(df: DataFrame, num: str, den: str, out: str, digits: int = 1) -> DataFrame:
    """Add ``num`` as a percentage of ``den``."""
    return df.withColumn(out, percent_of(num, den, digits))


def either(cond: Column, yes, no) -> Column:
    """Two-way choice; an unknown condition takes the second branch."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def to_whole(c: Column | str) -> Column:
    """Round half to even into a nullable integer."""
    return F.rint(col(c)).cast("long")


def divide_or_zero(num: Column | str, den: Column | str) -> Column:
    """Quotient as float32; zero unless the denominator is positive."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0)).cast("float")


def number_or_zero(c: Column | str, keep_fraction: bool = False) -> Column:
    """Number in a text column, 0 where there is none; fractions are cut unless asked to keep them."""
    value = F.coalesce(col(c).try_cast("double"), F.lit(0.0))
    value = F.when(F.isnan(value), F.lit(0.0)).otherwise(value)
    return value if keep_fraction else value.cast("int")


def coerce_types(df: DataFrame, spec: Mapping[str, str], keep_fraction: bool = False) -> DataFrame:
    """Apply one of ``number``, ``whole``, ``yyyymmdd`` or a Spark type name to each named column."""
    def one(name: str, kind: str) -> Column:
        if kind == "number":
            return number_or_zero(name, keep_fraction)
        if kind == "whole":
            return to_whole(F.col(name).try_cast("double"))
        if kind == "yyyymmdd":
            return F.try_to_date(F.col(name), "yyyyMMdd")
        return F.col(name).try_cast(kind)

    return df.withColumns({name: one(name, kind) for name, kind in spec.items() if name in df.columns})


def clip(c: Column | str, lo=None, hi=None) -> Column:
    """Limit to [lo, hi]; null stays null (``least``/``greatest`` alone would turn it into a bound)."""
    bounded = col(c)
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(lo))
    if hi is not None:
        bounded = F.least(bounded, F.lit(hi))
    return F.when(col(c).isNotNull(), bounded)


def band(c: Column | str, thresholds: Sequence[tuple[float, str]]) -> Column:
    """Label of the highest threshold reached, null below all of them."""
    out: Column | None = None
    for limit, label in sorted(thresholds, reverse=True):
        cond = col(c) >= F.lit(limit)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    if out is None:
        raise ValueError("band needs at least one threshold")
    return out


def lookup(c: Column | str, table: Mapping[str, int], default: int = 0) -> Column:
    """Value of a word in a small constant table."""
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(F.try_element_at(pairs, col(c)), F.lit(default))


def or_text(c: Column | str, default: str = "N/A") -> Column:
    return F.coalesce(col(c), F.lit(default))


def two_digits(c: Column | str) -> Column:
    """Fixed two-digit text, for display only."""
    return F.format_string("%.2f", col(c).cast("double"))


def public_path(c: Column | str, root: str, data: str = "data/") -> Column:
    """Site path of a stored file: strip the root, keep a data path, otherwise put it below data."""
    p = col(c)
    return (
        F.when(p.startswith(root + data), F.concat(F.lit("/"), F.substr(p, F.lit(len(root) + 1))))
        .when(p.startswith(data), F.concat(F.lit("/"), p))
        .otherwise(F.concat(F.lit("/" + data), p))
    )


def contains(c: Column | str, text: str) -> Column:
    """Substring test; a missing field counts as empty text."""
    return F.coalesce(col(c), F.lit("")).contains(text)


def is_missing(c: Column | str, is_float: bool = False) -> Column:
    """Null, or NaN for a floating-point column."""
    return (col(c).isNull() | F.isnan(col(c))) if is_float else col(c).isNull()


def untrue(cond: Column) -> Column:
    """Negation in which an unknown condition counts as false."""
    return ~F.coalesce(cond, F.lit(False))


def in_period(c: Column | str, start: str, end: str) -> Column:
    """Half-open range on a timestamp column; reaches the file scan as a pushed filter."""
    return (col(c) >= F.lit(start).cast("timestamp_ntz")) & (col(c) < F.lit(end).cast("timestamp_ntz"))


def in_month(c: Column | str, year: int, month: int) -> Column:
    """All rows of one calendar month, as a half-open range."""
    nxt = (year + 1, 1) if month == 12 else (year, month + 1)
    return in_period(c, f"{year:04d}-{month:02d}-01", f"{nxt[0]:04d}-{nxt[1]:02d}-01")


def on_days(c: Column | str, first: str, last: str) -> Column:
    """Inclusive range of calendar days, as a half-open range that reaches the file scan."""
    end = datetime.date.fromisoformat(last) + datetime.timedelta(days=1)
    return in_period(c, first, end.isoformat())


def all_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for cond in conditions:
        out = out & cond
    return out
