"""JSON, arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col


def parse_payload(df: DataFrame, c: str, schema: str, out: str = "payload") -> DataFrame:
    """Parse a JSON body; an unreadable body gives null."""
    return df.withColumn(out, F.from_json(F.col(c), schema, {"mode": "PERMISSIVE"}))


def explode_records(df: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """One row per record of the array at ``path``; bodies without the array yield nothing."""
    rows = df.select(*(keep or []), F.explode(F.col(path)).alias("__rec"))
    return rows.select(*(keep or []), "__rec.*")


def field_or(c: Column | str, default) -> Column:
    """Nested field with a default for an absent key."""
    return F.coalesce(col(c), F.lit(default))


def json_field(c: Column | str, path: str, kind: str) -> Column:
    """Typed field of a JSON text, null when absent or of another kind."""
    return F.try_variant_get(F.try_parse_json(col(c)), path, kind)


def first_of(c: Column | str) -> Column:
    return F.get(col(c), F.lit(0))


def pairs_to_map(keys: Column | str, values: Column | str) -> Column:
    """Text map from two parallel arrays; of repeated keys the last wins, as in a dictionary. The pairs are numbered and sorted by
    key, the last of each key stays, and these go back to their order."""
    def pair(p: Column, i: Column) -> Column:
        return F.struct(p["k"].cast("string").alias("k"), i.alias("i"), p["v"].cast("string").alias("v"))

    def last(pairs: Column) -> Column:
        return F.filter(pairs, lambda p, i: ~F.coalesce(F.get(pairs, i + 1)["k"] == p["k"], F.lit(False)))

    numbered = F.array_sort(F.transform(F.arrays_zip(col(keys).alias("k"), col(values).alias("v")), pair))
    kept = F.get(F.transform(F.array(numbered), last), F.lit(0))
    ordered = F.array_sort(F.transform(kept, lambda p: F.struct(p["i"].alias("i"), p["k"].alias("k"), p["v"].alias("v"))))
    return F.map_from_entries(F.transform(ordered, lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v"))))


def record_id(*columns: str) -> Column:
    """Stable document id from the content."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
