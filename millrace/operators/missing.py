"""Profiles of missing values, dropping, and filling with one statistic per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import mode_of, quantiles


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One kind of missing: NaN becomes null, in the named columns or in all."""
    floats = [c for c, t in df.dtypes if t in ("float", "double") and (cols is None or c in cols)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def is_missing(df: DataFrame, c: str) -> Column:
    """Null or, in a column of floats, NaN."""
    gap = F.col(c).isNull()
    return gap | F.isnan(c) if dict(df.dtypes)[c] in ("float", "double") else gap


def missing_mask(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One flag per column and the number of gaps per row."""
    flags = {f"{c}_missing": is_missing(df, c) for c in cols}
    per_row = sum((is_missing(df, c).cast("int") for c in cols), F.lit(0))
    return df.withColumns({**flags, "row_missing": per_row})


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Gaps per column, one row per column, from a single pass."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    return one.unpivot("n_rows", list(cols), "column_name", "n_missing").select(
        "column_name", "n_missing", "n_rows"
    )


def nullity_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of the gaps of each pair of columns, one row per pair.

    Pairs with a column that is never or always missing have no correlation and are left out. Only counts
    are aggregated, so the result is exact.
    """
    gap = {c: is_missing(df, c) for c in cols}
    pairs = list(combinations(cols, 2))
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count_if(gap[c]).alias(f"g{i}") for i, c in enumerate(cols)]
    counts += [F.count_if(gap[a] & gap[b]).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    row = df.agg(*counts)
    at = {c: i for i, c in enumerate(cols)}
    entries = [
        F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
            F.col(f"g{at[a]}").alias("ga"), F.col(f"g{at[b]}").alias("gb"), F.col(f"p{i}").alias("gab"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    n, ga, gb, gab = (F.col(x).cast("double") for x in ("n", "ga", "gb", "gab"))
    spread = F.sqrt(ga * (n - ga)) * F.sqrt(gb * (n - gb))
    return (
        row.select("n", F.explode(F.array(*entries)).alias("e")).select("n", "e.*")
        .filter(spread > 0)
        .select("column_a", "column_b", ((n * gab - ga * gb) / spread).alias("corr"))
    )


def drop_rows(df: DataFrame, cols: Sequence[str], min_missing_share: float | None = None) -> DataFrame:
    """Drop rows with any gap, or those with at least the given share of missing columns."""
    if min_missing_share is None:
        return df.dropna("any", subset=list(cols))
    gaps = sum((is_missing(df, c).cast("int") for c in cols), F.lit(0))
    return df.filter(gaps < F.lit(min_missing_share * len(cols)))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Keep the columns without a gap (one aggregate decides which)."""
    gaps = df.agg(*[F.max(is_missing(df, c).cast("int")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if not gaps[c]])


def statistic(df: DataFrame, c: str, how: str) -> Column:
    """Mean, exact median or mode of a column, as a value that can be used inside expressions; NaN is a gap."""
    df = nan_to_null(df, [c])
    if how == "mean":
        return df.agg(F.avg(c)).scalar()
    if how == "median":
        return quantiles(df, [c]).agg(F.first("value")).scalar()
    if how == "mode":
        return mode_of(df, c).scalar()
    raise ValueError(f"unknown statistic {how}")


def impute(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Fill each named column with its mean, median or mode; NaN is a gap too."""
    df = nan_to_null(df, list(spec))
    return df.withColumns({c: F.coalesce(F.col(c), statistic(df, c, how)) for c, how in spec.items()})


def fill_constant(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    return nan_to_null(df, list(spec)).fillna(dict(spec))


def replace_where(df: DataFrame, c: str, cond: Column, value) -> DataFrame:
    """Replace values that satisfy a condition, and missing ones."""
    return df.withColumn(c, F.when(cond | is_missing(df, c), F.lit(value)).otherwise(F.col(c)))
