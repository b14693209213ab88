"""Ordered computations that stay balanced when one key, or no key at all, holds most rows.

A plain window sends a whole group to one task. Here the groups are counted first; only where one is too
long is the order axis cut into pieces. The window then runs inside (group, piece), and what crosses a border
(a count, a sum, a last value) is aggregated per piece, so that a second window sees one row per piece.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, PIECE = "__key", "__piece"
PIECE_ROWS = 2_000_000
MAX_PIECES = 4096
FAN = 64


def cut_points(df: DataFrame, axis: Column, pieces: int) -> list[float]:
    """Approximate quantiles of a numeric axis (one aggregate, bounded result)."""
    n = max(1, min(pieces, MAX_PIECES))
    if n == 1:
        return []
    shares = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(axis.cast("double"), shares, 20_000).alias("cuts")).first()
    return sorted({c for c in row["cuts"] or [] if math.isfinite(c)})


def sampled_cuts(values: DataFrame, c: str, pieces: int) -> list:
    """Cut points for distinct values of any sortable type, from a bounded hash sample.

    The cuts only decide how evenly the work is spread: every value still lands in exactly one piece.
    """
    rows = values.select(c).orderBy(F.xxhash64(F.col(c))).limit(MAX_PIECES).collect()
    known = sorted({r[0] for r in rows if r[0] is not None})
    step = max(1, len(known) // max(1, pieces))
    return known[::step][1:]


def _points(cuts: Sequence) -> Column:
    if all(isinstance(c, float) for c in cuts):
        return F.expr(f"array({', '.join(f'{c!r}D' for c in cuts)})")
    return F.array(*[F.lit(c) for c in cuts])


def bucket_of(axis: Column, cuts: Sequence) -> Column:
    """Number of cut points at or below the value: monotone in the axis. A null comes first, as in ascending order.

    Many cut points are searched in two steps, first among every 64th one.
    """
    if not cuts:
        return F.lit(0)
    if len(cuts) <= FAN:
        return F.when(axis.isNotNull(), F.size(F.filter(_points(cuts), lambda p: p <= axis))).otherwise(0)
    groups = [cuts[i:i + FAN] for i in range(0, len(cuts), FAN)]
    coarse = F.size(F.filter(_points([g[0] for g in groups]), lambda p: p <= axis))
    group = F.greatest(coarse - 1, F.lit(0))
    inside = F.get(F.array(*[_points(g) for g in groups]), group)
    return F.when(axis.isNotNull(), group * FAN + F.size(F.filter(inside, lambda p: p <= axis))).otherwise(0)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps the left key columns.

    The right side gets its own exchange even if it comes from an aggregate on the same keys, which is what
    lets adaptive execution split a hot key of the left side.
    """
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def cut(
    df: DataFrame, keys: Sequence[str], axis: Column, piece_rows: int = PIECE_ROWS
) -> tuple[DataFrame, bool]:
    """Add the group key and the piece number; the flag says whether any group had to be cut.

    Groups longer than ``piece_rows``, and than a 4096th of the table, are cut: there are at most 4096 of them,
    so their list may be broadcast.
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    keyed = df.withColumn(KEY, key)
    sizes = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    # One aggregate gives the total and the candidates: at most MAX_PIECES groups can be longer than a share of the table.
    row = sizes.agg(F.sum("n").alias("total"), F.max("n").alias("longest")).first()
    limit = max(piece_rows, (row["total"] or 0) // MAX_PIECES)
    long = sizes.filter(F.col("n") > limit).collect() if (row["longest"] or 0) > limit else []
    if not long:
        return keyed.withColumn(PIECE, F.lit(0)), False
    spark = df.sparkSession
    hot = spark.createDataFrame([(r[KEY], True) for r in long], _hot_type(keyed))
    marked = join_on(keyed, F.broadcast(hot), [KEY])
    cuts = cut_points(marked.filter("__hot"), axis, -(-sum(r["n"] for r in long) // limit))
    piece = F.when(F.col("__hot"), bucket_of(axis.cast("double"), cuts)).otherwise(0)
    return marked.withColumn(PIECE, piece).drop("__hot"), True


def _hot_type(keyed: DataFrame):
    from pyspark.sql.types import BooleanType, StructField, StructType

    return StructType([StructField(KEY, keyed.schema[KEY].dataType), StructField("__hot", BooleanType())])


def _number(pieces: DataFrame, many: bool, order: Sequence[Column], out: str) -> DataFrame:
    inside = pieces.withColumn(out, F.row_number().over(Window.partitionBy(KEY, PIECE).orderBy(*order)))
    if not many:
        return inside.drop(KEY, PIECE)
    before = Window.partitionBy(KEY).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy(KEY, PIECE).agg(F.count(F.lit(1)).alias("__n")).select(
        KEY, PIECE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    return join_on(inside, offsets, [KEY, PIECE]).withColumn(out, F.col(out) + F.col("__offset")).drop(
        "__offset", KEY, PIECE
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, axis: Column,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Row number per group. ``axis`` is numeric and monotone in the first order column."""
    pieces, many = cut(df, keys, axis, piece_rows)
    return _number(pieces, many, order, out)


def numbered_values(values: DataFrame, c: str, out: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Number the distinct values of a column of any sortable type."""
    n = values.count()
    cuts = sampled_cuts(values, c, -(-n // piece_rows)) if n > piece_rows else []
    pieces = values.withColumn(KEY, F.lit(0)).withColumn(PIECE, bucket_of(F.col(c), cuts))
    return _number(pieces, bool(cuts), [F.col(c)], out)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str, axis: Column,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Running sum per group (rows in a total order)."""
    pieces, many = cut(df, keys, axis, piece_rows)
    frame = Window.partitionBy(KEY, PIECE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = pieces.withColumn(out, F.sum(value).over(frame))
    if not many:
        return inside.drop(KEY, PIECE)
    before = Window.partitionBy(KEY).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy(KEY, PIECE).agg(F.sum(value).alias("__s")).select(
        KEY, PIECE, F.sum("__s").over(before).alias("__offset")
    )
    total = F.when(
        F.col(out).isNotNull() | F.col("__offset").isNotNull(),
        F.coalesce(F.col(out), F.lit(0)) + F.coalesce(F.col("__offset"), F.lit(0)),
    )
    return join_on(inside, offsets, [KEY, PIECE]).withColumn(out, total).drop("__offset", KEY, PIECE)


def neighbours(
    df: DataFrame, keys: Sequence[str], order: str, value: str, axis: Column, forward: bool = True,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add the nearest known (order, value) pair at or before each row, and at or after it if ``forward``.

    Columns ``__prev`` and ``__next`` are structs (t, v); null where there is none.
    """
    pieces, many = cut(df, keys, axis, piece_rows)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("t"), F.col(value).alias("v")))
    inside = Window.partitionBy(KEY, PIECE).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = pieces.withColumn("__prev", F.last(known, ignorenulls=True).over(upto))
    if forward:
        out = out.withColumn("__next", F.first(known, ignorenulls=True).over(onward))
    if not many:
        return out.drop(KEY, PIECE)
    by_piece = Window.partitionBy(KEY).orderBy(PIECE)
    carried = pieces.groupBy(KEY, PIECE).agg(F.max(known).alias("__hi"), F.min(known).alias("__lo")).select(
        KEY, PIECE,
        F.last("__hi", ignorenulls=True).over(by_piece.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.first("__lo", ignorenulls=True).over(by_piece.rowsBetween(1, Window.unboundedFollowing)).alias("__after"),
    )
    out = join_on(out, carried, [KEY, PIECE]).withColumn("__prev", F.coalesce("__prev", "__before"))
    if forward:
        out = out.withColumn("__next", F.coalesce("__next", "__after"))
    return out.drop("__before", "__after", KEY, PIECE)
