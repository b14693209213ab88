"""Windowed aggregation, log tailing, keyed loads and alerts over streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import band
from millrace.operators.logs import parse_access_logs, split_rejects


def stream_files(spark: SparkSession, folder: str, like: DataFrame, fmt: str = "parquet", **options) -> DataFrame:
    """Stream of the files of a folder, with the schema of a batch table."""
    return spark.readStream.format(fmt).schema(like.schema).options(**options).load(folder)


def hourly(
    df: DataFrame, ts: str, aggregates: Mapping[str, Column], keys: Sequence[str] = (),
    watermark: str = "10 minutes", window: str = "1 hour",
) -> DataFrame:
    """Tumbling aggregate over event time; as a stream, a window is final once the watermark has passed it.

    Works on batch and stream input. Partial results are combined before the shuffle, so a busy hour does
    not gather in one task.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark(ts, watermark)
    grouped = timed.groupBy(F.window(ts, window).alias("w"), *keys).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, *aggregates)


def to_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over everything that is there now into a parquet folder (exactly once)."""
    return (
        df.writeStream.outputMode(mode).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def tail_logs(lines: DataFrame, good_path: str, bad_path: str, checkpoint: str) -> StreamingQuery:
    """Parse arriving log lines: good rows to one table, the others to a quarantine.

    Each batch writes its own folder, replacing what an interrupted attempt may have left there.
    """

    def store(batch: DataFrame, number: int) -> None:
        parsed = parse_access_logs(batch).persist()
        try:
            good, bad = split_rejects(parsed)
            good.write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            bad.write.mode("overwrite").text(f"{bad_path}/batch={number}")
        finally:
            parsed.unpersist()

    return (
        lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def first_seen(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The state of a keyed load: per key the first row by ``order`` so far, and the times of its first and its last batch.

    The rows of a batch are combined before they are shuffled; of all earlier batches only one row per key is kept, as state, so
    a batch costs the batch. The time is the batch's own, which a repeated batch keeps.
    """
    rest = [c for c in stream.columns if c != key]
    first = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("at"))
    timed = stream.filter(F.col(key).isNotNull()).withColumn("__now", F.current_timestamp())
    return timed.groupBy(key).agg(F.min_by(F.struct(*rest), first).alias("__row"), F.min("__now").alias("__first"), F.max("__now").alias("__last"))


def keyed_load(
    stream: DataFrame, tables: Mapping[str, tuple[str, Sequence[str]]], key: str, order: str, checkpoint: str
) -> StreamingQuery:
    """Load a stream into several keyed tables: ``{name: (path, columns)}``.

    A key is loaded with the batch that first holds it, with its first row there by ``order``; later rows of the key are skipped,
    as the stream's state knows its keys. Nothing that is stored is read again. A repeated batch writes its folder anew. A
    row without a key is left out: it could not be recognised later.
    """
    def store(batch: DataFrame, number: int) -> None:
        fresh = batch.filter("__first = __last").select(key, "__row.*").persist()
        try:
            for path, columns in tables.values():
                fresh.select(*columns).write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            fresh.unpersist()

    return (
        first_seen(stream, key, order).writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def alerts(df: DataFrame, c: str, thresholds: Sequence[tuple[float, str]], out: str = "level") -> DataFrame:
    """Rows that reach a threshold, with its label; stateless, for batch and stream."""
    return df.withColumn(out, band(c, thresholds)).filter(F.col(out).isNotNull())
