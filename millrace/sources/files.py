"""File scans and sinks, SQL over files, size reports and seeded generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import settle


def read_table(
    spark: SparkSession, path: str | list[str], fmt: str, schema: str | StructType | None = None, **options
) -> DataFrame:
    """Scan files: ``csv`` (with header), ``jsonl``, ``json`` (array documents), ``text``, ``parquet`` or any
    other Spark format. Without a schema CSV columns are text unless ``inferSchema`` is given."""
    kind = {"jsonl": "json"}.get(fmt, fmt)
    defaults = {
        "csv": {"header": True, "escape": '"', "multiLine": False},
        "json": {"multiLine": fmt == "json"},
    }.get(kind, {})
    reader = spark.read.format(kind).options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(
    df: DataFrame, path: str, fmt: str, mode: str = "errorifexists",
    partition_by: Sequence[str] = (), compression: str | None = None, **options,
) -> None:
    """Write files; CSV gets a header, JSON lines keep null fields, text is UTF-8 throughout.

    CSV has one form for empty and missing text, which is read back as null.
    """
    kind = {"jsonl": "json"}.get(fmt, fmt)
    defaults = {
        "csv": {"header": True, "escape": '"'},
        "json": {"ignoreNullFields": False},
    }.get(kind, {})
    writer = df.write.format(kind).mode(mode).options(**{**defaults, **options})
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def with_first_upper(df: DataFrame) -> DataFrame:
    """First column in upper case, the rest unchanged; rows without any value dropped."""
    first = df.columns[0]
    return df.dropna("all").withColumn(first, F.upper(F.col(first)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the name of their file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


#: Counts per block of a text scan are broadcast only if there are at most so many blocks.
BLOCKS = 200_000


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the path of their file and their number in it, from 1: file, line, value.

    Files are read in blocks by many tasks. A first pass counts the lines of each block, prefix sums over the blocks of a file say how
    many lines came before, and a second pass numbers the lines inside their block; no task ever sees a whole file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).select(
        F.col("file").alias("__file"), F.col("start").alias("__start"), "n", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    stored = settle(blocks, "blocks")
    few = F.broadcast(stored) if stored.count() <= BLOCKS else stored
    inside = F.col("at") - F.col("first")
    # The same scan is cut into the same blocks; should it ever not be, the job ends instead of giving wrong numbers.
    checked = F.when(F.assert_true(inside.between(0, F.col("n") - 1), "blocks have changed between two scans").isNull(), inside)
    joined = lines.join(few, (F.col("file") == F.col("__file")) & (F.col("start") == F.col("__start")), "left")
    return joined.select("file", (F.col("before") + checked + 1).alias("line"), "value")


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give a scan of few splits one partition per core, for work that is heavy per row.

    A large table has more splits than cores and is returned as it is: no shuffle at scale.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted, *keys)


def year_bucket(c: Column | str, first: int, last: int) -> Column:
    """Range partition of a date: the first bucket takes everything older, the last one the tail."""
    year = F.year(c)
    return F.when(year.isNotNull(), F.least(F.greatest(year, F.lit(first)), F.lit(last)))


def write_year_partitions(df: DataFrame, path: str, date: str, first: int, last: int, mode: str = "overwrite") -> None:
    """Store a table in range partitions by year.

    Rows are brought together by year before the write (adaptive execution splits a large year over many files),
    so that the number of files follows the data and not tasks times years.
    """
    years = df.withColumn("part_year", year_bucket(date, first, last)).hint("rebalance", "part_year")
    years.write.mode(mode).partitionBy("part_year").parquet(path)


def read_year_partition(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One range partition; the other folders are never listed for reading."""
    return spark.read.parquet(path).filter(F.col("part_year") == year)


def sql_over(spark: SparkSession, statement: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL over DataFrames by name (``{orders}``) with bound parameters (``:low``)."""
    return spark.sql(statement, args=args, **tables)


def create_table_as(df: DataFrame, name: str, path: str, replace: bool = True) -> None:
    """Named table from a query, stored at an explicit path."""
    spark = df.sparkSession
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    elif spark.catalog.tableExists(name):
        return
    df.write.mode("errorifexists").option("path", path).format("parquet").saveAsTable(name)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file below a folder, with the size in the unit that fits.

    Only the listing is used; the content column is pruned and never read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    n = F.col("length")
    return files.select("path", "length").withColumns({
        "kilobytes": n / 1024, "megabytes": n / 1024**2, "gigabytes": n / 1024**3, "display": shown_size("length")})


def shown_size(c: str) -> Column:
    """A number of bytes in the unit that fits."""
    n = F.col(c)
    return (
        F.when(n >= 1024**3, F.format_string("%.2f GB", n / 1024**3))
        .when(n >= 1024**2, F.format_string("%.2f MB", n / 1024**2))
        .when(n >= 1024, F.format_string("%.2f KB", n / 1024))
        .otherwise(F.format_string("%d bytes", n))
    )


def total_size(spark: SparkSession, path: str) -> int | None:
    """Bytes below a folder, null for a path that does not exist."""
    from pyspark.errors import AnalysisException

    try:
        return file_sizes(spark, path).agg(F.sum("length")).first()[0]
    except AnalysisException:
        return None


def compression_saving(spark: SparkSession, plain: str, packed: str) -> float | None:
    """Percentage saved by the packed copy, null if the plain one is absent or empty."""
    a, b = total_size(spark, plain), total_size(spark, packed)
    return None if not a or b is None else (1 - b / a) * 100


def read_images(spark: SparkSession, path: str, wanted: DataFrame | None = None, stem: str = "stem") -> DataFrame:
    """Image files as rows (stem, path, content); files that are not asked for are skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    out = files.select(name.alias(stem), "path", "content")
    return out if wanted is None else out.join(wanted.select(stem).distinct(), stem, "left_semi")


def _uniform(id_col: Column, seed: int, salt: int) -> Column:
    """Pseudo-random number in [0, 1) that depends on the row id only, not on the partitioning."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def pick(id_col: Column, seed: int, salt: int, choices: Sequence) -> Column:
    at = F.floor(_uniform(id_col, seed, salt) * len(choices)).cast("int")
    return F.get(F.array(*[F.lit(c) for c in choices]), at)


def normal(id_col: Column, seed: int, salt: int, mean: float, spread: float) -> Column:
    """Normal deviate from two uniform ones."""
    radius = F.sqrt(-2 * F.log(1 - _uniform(id_col, seed, salt)))
    return mean + spread * radius * F.cos(2 * F.pi() * _uniform(id_col, seed, salt + 1))


def wide_rows(spark: SparkSession, n: int, columns: int = 10, seed: int = 42) -> DataFrame:
    """Wide test table: even columns text ``value_row_column``, odd columns whole numbers 1..1,000,000."""
    row = F.col("id")

    def one(c: int) -> Column:
        if c % 2 == 0:
            return F.concat(F.lit("value_"), row.cast("string"), F.lit(f"_{c}"))
        return (1 + F.floor(_uniform(row, seed, c) * 1_000_000)).cast("int")

    return spark.range(n).select(*[one(c).alias(f"col_{c}") for c in range(columns)])


def hourly_sales(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Hourly shop sales from 2024-01-01 on, with weather and temperature."""
    i = F.col("id")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return spark.range(n).select(
        (i + 1).cast("int").alias("id"),
        (start + F.make_dt_interval(F.lit(0), i.cast("int"))).alias("sale_datetime"),
        pick(i, seed, 1, ["north", "south", "east", "west"]).alias("store_name"),
        pick(i, seed, 2, ["americano", "latte", "espresso", "tea"]).alias("product_type"),
        pick(i, seed, 3, ["sunny", "cloudy", "rain", "snow"]).alias("weather"),
        normal(i, seed, 4, 15.0, 10.0).cast("decimal(5,2)").alias("temperature"),
        (1 + F.floor(_uniform(i, seed, 6) * 50)).cast("int").alias("sales_quantity"),
    )
