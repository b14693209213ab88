"""Query registry of this subpackage and small helpers on DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.split import join_on
from millrace.session import settle, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A table is broadcast only after its rows were counted and are at most so many (of a few numbers or short names each).
BROADCAST_ROWS = 100_000


def query(name: str, sql: str | None = None):
    """Register ``build(spark, folder) -> DataFrame`` under a name, with the SQL that gives the same rows."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(text: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def look_up(large: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe left join to a stored table: broadcast if its counted rows are few, else with an exchange on both
    sides, where adaptive execution splits a hot key."""
    return join_on(large, F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, keys)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Add a gapless number from 0 in the given order, per group or over the whole table.

    Sampled ranges of (group, order, row) go to the tasks, so that neither a large group nor a hot order value meets
    in one task; rows equal in group and order are numbered in any order. Each task numbers its own sorted rows, and one
    row per task and group carries the counts over.
    """
    tie, at, part, first, before = "__tie", "__at", "__part", "__first", "__before"
    keys = [F.col(g) for g in group]
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    spread = tied.repartitionByRange(*keys, *order, F.col(tie)).sortWithinPartitions(*keys, *order, F.col(tie))
    stored = settle(spread.drop(tie).withColumn(at, F.monotonically_increasing_id()), "numbered")
    placed = stored.withColumn(part, F.shiftright(at, 33))
    pieces = placed.groupBy(*group, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn(before, F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    return join_on(placed, offsets, [*group, part]).withColumn(
        out, F.col(at) - F.col(first) + F.col(before)
    ).drop(at, part, first, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, however often ``body`` (or a lambda in it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def coin(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts only."""
    key = F.concat_ws(":", F.lit(seed), *parts)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(16**13))
