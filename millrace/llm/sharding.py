"""Shards by jump consistent hashing: the key and the number of shards decide; a further shard only takes rows in."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import numbered, query, table, text_or_empty

#: Bytes that a stored document takes besides its text.
ROW_BYTES = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: a key jumps ahead at each number of shards with falling probability, so that going from
    n to n + 1 shards moves a share of 1 / (n + 1) of the keys, all of them into the new one."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard, ahead = np.full(len(state), -1, dtype=np.int64), np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    while going.size:
        shard[going] = ahead[going]
        with np.errstate(over="ignore"):
            state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = ((shard[going] + 1) * (2147483648.0 / draw)).astype(np.int64)
        going = going[ahead[going] < shards]
    return shard


def stable_key(*columns: Column) -> Column:
    """60 bits of the digest of the columns' text; equal values have equal keys on every run and machine."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("\0")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key column (see ``stable_key``)."""

    @F.pandas_udf("int")
    def placed(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards).astype("int32"))

    return placed(key)


def assign(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with size, text_crc32, shard, and grown_shard (the shard if there were one more).

    A null text has no bytes. A null id is a key like any other. Rows with equal ids share a shard, as the law asks.
    Columns of the same names as the added ones are replaced.
    """
    body, key = text_or_empty(text), stable_key(F.col(doc_id))
    return docs.withColumns({
        "size": (F.octet_length(body) + ROW_BYTES).cast("long"), "text_crc32": F.crc32(body.cast("binary")),
        "shard": shard_of(key, shards), "grown_shard": shard_of(key, shards + 1),
    })


def with_slots(assigned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add slot: gapless from 0 in each shard, by id, size and checksum. A large shard is numbered by many tasks.

    The rows are dealt anew, so give only the columns that are needed.
    """
    return numbered(assigned, ["shard"], [F.col(doc_id), F.col("size"), F.col("text_crc32")], "slot")


def write_shards(docs: DataFrame, shards: int, path: str, doc_id: str = "doc_id", files: int = 1) -> None:
    """Write the documents as one folder per shard, each in about ``files`` parts (raise it with the size of a shard).

    A column ``shard`` of the documents that ``assign`` has not made would be lost to the folder's name: then it raises.
    """
    given = set(docs.columns)
    if "shard" in given and "grown_shard" not in given:
        raise ValueError("the documents have a column shard; rename it first")
    dealt = docs.withColumn("shard", shard_of(stable_key(F.col(doc_id)), shards)).withColumn(
        "__file", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
    dealt.repartition(shards * files, "shard", "__file").drop("__file").write.partitionBy("shard").parquet(path)


@query("op8_jump_shards")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    assigned = assign(table(spark, folder, "documents").select("doc_id", "text"), 40).drop("text")
    return with_slots(assigned).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
