"""JDBC tables: partitioned reads by key range, batched and typed writes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, table: str, partition: tuple[str, int, int, int] | None = None, fetch_size: int = 10_000, **options: str
) -> dict[str, str]:
    """Options of a read. ``partition`` is (column, lowest, highest, number of parts): rows outside the range
    are read too, by the first and the last part, so nothing is lost when the bounds are out of date."""
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if partition:
        column, low, high, parts = partition
        out |= {
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high + 1), "numPartitions": str(parts)
        }
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Whole table, in parallel key ranges if a partition is given. A failing part fails the read."""
    return spark.read.format("jdbc").options(**read_options(url, table, **kwargs)).load()


def key_range(spark: SparkSession, url: str, table: str, column: str, **options: str) -> tuple[int, int]:
    """Lowest and highest key, as bounds for a partitioned read (computed by the database)."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **options).load().first()
    return int(row[0]), int(row[1])


def write_options(
    url: str, table: str, batch_size: int = 10_000, column_types: Mapping[str, str] | None = None,
    truncate: bool = False, **options: str,
) -> dict[str, str]:
    out = {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": str(truncate).lower(), **options}
    if column_types:
        out["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in column_types.items())
    return out


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """Append in batches, or replace the table with explicit column types."""
    df.write.format("jdbc").options(**write_options(url, table, **kwargs)).mode(mode).save()
