"""Reconciliation between tables and catalogue reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import settle


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs between two tables, with both counts."""
    left = a.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_a"))
    right = b.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_b"))
    both = left.join(right, "key", "full_outer")
    return both.select(
        "key", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")
    ).filter(F.col("n_a") != F.col("n_b"))


#: Buckets of the two levels of digests.
COARSE, FINE = 256, 256


def reconcile_digests(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], coarse: int = COARSE, fine: int = FINE) -> tuple[DataFrame, DataFrame]:
    """Rows that two copies of a table do not share: key, only_a, only_b (numbers of rows), and beside it the rows that were compared.

    Both tables are reduced to a count and two sums of row hashes per bucket of the key. Only the rows of unequal buckets get
    finer digests, and only the rows of unequal fine buckets are shuffled and compared, so the cost of equal tables is one
    aggregate of at most ``coarse`` rows per task. Equal rows are counted, so repeated rows are compared too; nulls equal nulls.
    """
    names = [key, *[c for c in columns if c != key]]
    row = F.struct(*names)

    def hashed(df: DataFrame) -> DataFrame:
        h = F.xxhash64(F.lit(7), key)
        return df.select(*names, F.pmod(h, F.lit(coarse)).cast("int").alias("__coarse"),
                         F.pmod(F.shiftright(h, 20), F.lit(fine)).cast("int").alias("__fine"))

    def digest(df: DataFrame, *by: str) -> DataFrame:
        two = [F.xxhash64(row).cast("decimal(20,0)"), F.xxhash64(F.lit(1), row).cast("decimal(20,0)")]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(two)])

    def unequal(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
        """Buckets whose digests differ; at most coarse * fine short rows, so they may be broadcast."""
        both = digest(left, *by).withColumn("side", F.lit(1)).unionByName(digest(right, *by).withColumn("side", F.lit(-1)))
        sums = [F.sum(F.col(c) * F.col("side")) != 0 for c in ("n", "s0", "s1")]
        differs = sums[0] | sums[1] | sums[2]
        return settle(both.groupBy(*by).agg(differs.alias("differs")).filter("differs").select(*by), "unequal")

    left, right = hashed(a), hashed(b)
    some = F.broadcast(unequal(left, right, "__coarse"))
    left, right = (x.join(some, "__coarse", "left_semi") for x in (left, right))
    by = ["__coarse", "__fine"]
    few = F.broadcast(unequal(left, right, *by))
    read = [x.join(few, by, "left_semi").select(*names) for x in (left, right)]
    counted = read[0].withColumn("side", F.lit(1)).unionByName(read[1].withColumn("side", F.lit(-1)))
    odd = counted.groupBy(*names).agg(F.sum("side").cast("long").alias("more")).filter("more <> 0")
    found = odd.groupBy(F.col(key).alias("key")).agg(
        F.sum(F.greatest("more", F.lit(0))).alias("only_a"), F.sum(F.greatest(-F.col("more"), F.lit(0))).alias("only_b"))
    return found, counted


def reconcile_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Totals of two tables and the number of keys only one of them has."""
    left = a.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_a"))
    right = b.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_b"))
    return left.join(right, "key", "full_outer").agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum("n_b"), F.lit(0)).alias("rows_b"),
        F.count_if(F.col("n_b").isNull()).alias("only_a"),
        F.count_if(F.col("n_a").isNull()).alias("only_b"),
    )


def catalogue_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table and column with type and row count."""
    parts = []
    for name, df in tables.items():
        fields = [(name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
        described = spark.createDataFrame(
            fields, "table_name string, position int, column_name string, data_type string"
        )
        parts.append(described.withColumn("n_rows", df.agg(F.count(F.lit(1))).scalar()))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def user_databases(spark: SparkSession, system: tuple[str, ...] = ("default", "information_schema")) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases() if d.name not in system]


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are null, with their number of rows."""
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | empty)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows that refer to a parent which is not there; a null reference is allowed."""
    known = parent.select(F.col(parent_key).alias("__k"))
    return child.filter(F.col(child_key).isNotNull()).join(known, F.col(child_key) == F.col("__k"), "left_anti")
