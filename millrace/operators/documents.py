"""Queries on schemaless documents kept as one superset of columns, and snapshot mutations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import all_of, untrue
from millrace.functions.payload import record_id
from millrace.operators.relational import semi
from millrace.operators.split import numbered
from millrace.session import settle

#: Ids of repeated documents are broadcast only if their counted rows are at most so many.
FEW_IDS = 200_000


def _number_bound(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def condition(df: DataFrame, query: Mapping[str, object]) -> Column:
    """Condition of a document query: ``{field: value}`` or ``{field: {"$gt": bound, …}}``.

    A numeric bound never matches text, a missing field never matches: text columns are read as numbers
    first, and what is not a number stays out.
    """
    kinds = dict(df.dtypes)

    def compare(name: str, op: str, bound) -> Column:
        c = F.col(name)
        if _number_bound(bound) and kinds[name] == "string":
            c = c.try_cast("double")
        tests = {
            "$gt": lambda: c > F.lit(bound), "$gte": lambda: c >= F.lit(bound),
            "$lt": lambda: c < F.lit(bound), "$lte": lambda: c <= F.lit(bound),
            "$ne": lambda: ~c.eqNullSafe(F.lit(bound)), "$in": lambda: c.isin(*bound),
            "$eq": lambda: c == F.lit(bound),
        }
        return tests[op]()

    conds = []
    for name, want in query.items():
        if isinstance(want, Mapping):
            conds += [compare(name, op, bound) for op, bound in want.items()]
        elif want is None:
            conds.append(F.col(name).isNull())
        else:
            conds.append(F.col(name) == F.lit(want))
    return all_of(conds)


def find(
    df: DataFrame, query: Mapping[str, object], limit: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    out = df.filter(condition(df, query))
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def with_ids(df: DataFrame, out: str = "_id") -> DataFrame:
    """Generated document id, a digest of the content; of equal documents the second and further ones digest their number too.

    Only documents that occur more than once are numbered; which of them is the second makes no difference.
    """
    keyed = df.withColumn(out, record_id(*df.columns))
    again = settle(keyed.groupBy(out).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(out).alias("__again")), "repeats")
    repeats = again.count()
    if not repeats:
        return keyed
    few = F.broadcast(again) if repeats <= FEW_IDS else again
    single = keyed.join(few, F.col(out) == F.col("__again"), "left_anti")
    copies = settle(keyed.join(few, F.col(out) == F.col("__again"), "left_semi").withColumn("__at", F.monotonically_increasing_id()), "copies")
    at = F.col("__at")
    counted = numbered(copies, [out], [at], "__n", at)
    own = F.when(F.col("__n") == 1, F.col(out)).otherwise(F.sha2(F.concat_ws(":", out, F.col("__n").cast("string")), 256))
    return single.unionByName(counted.withColumn(out, own).drop("__at", "__n"))


def derive_revision(
    df: DataFrame, id_col: str, overrides: Mapping[str, Column], ref_col: str
) -> DataFrame:
    """Copies of documents with changed or added fields, a fresh id and a reference to the original."""
    out = df.withColumn(ref_col, F.col(id_col)).withColumns(dict(overrides)).drop(id_col)
    return with_ids(out, id_col)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows left after a delete; rows for which the condition is unknown survive."""
    return df.filter(untrue(cond))


def delete_report(df: DataFrame, cond: Column) -> DataFrame:
    hit = F.coalesce(cond, F.lit(False))
    return df.agg(F.count_if(hit).alias("deleted"), F.count_if(~hit).alias("remaining"))


def update_where(df: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(cond, F.lit(False))
    known = set(df.columns)
    return df.withColumns({
        c: F.when(hit, v).otherwise(F.col(c)) if c in known else F.when(hit, v)
        for c, v in assignments.items()
    })


def update_one(
    df: DataFrame, cond: Column, id_col: str, assignments: Mapping[str, Column]
) -> DataFrame:
    """Set fields on the first matching document (lowest id) only."""
    target = df.filter(cond).agg(F.min(id_col)).scalar()
    return update_where(df, F.col(id_col) == target, assignments)


def insert_numbered(df: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Append rows with generated keys that continue after the highest one, by a numeric order column."""
    keyed = numbered(new, [], [F.col(order)], key, F.col(order))
    top = F.coalesce(df.agg(F.max(key)).scalar(), F.lit(0))
    return df.unionByName(keyed.withColumn(key, (F.col(key) + top).cast(dict(df.dtypes)[key])))


def last_change(changes: DataFrame, key: str, sequence: str) -> DataFrame:
    """One change per key: the one with the highest sequence (nulls first, then any fixed choice)."""
    rest = [c for c in changes.columns if c != key]
    picked = changes.groupBy(key).agg(F.max(F.struct(
        F.col(sequence).isNotNull().alias("__known"), F.col(sequence).alias("__at"), F.struct(*rest).alias("__row"))).alias("__last"))
    return picked.select(key, "__last.__row.*").select(*changes.columns)


def apply_changes(
    snapshot: DataFrame, changes: DataFrame, key: str, op_col: str, sequence: str | None = None
) -> DataFrame:
    """Next snapshot after a batch of inserts, updates (null = keep the field) and deletes.

    ``op_col`` holds ``insert``, ``update`` or ``delete``. With ``sequence`` the last change of a key counts; without it a
    key that occurs twice in the batch fails the job.
    An update or delete of an absent key, or an insert of a present one, changes nothing. The snapshot is only
    ever the probed side, so that a batch that fits a broadcast leaves it unshuffled.
    """
    fields = [c for c in snapshot.columns if c != key]
    if sequence is not None:
        changes = last_change(changes, key, sequence)
    else:
        rest = [c for c in changes.columns if c != key]
        grouped = changes.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row"))
        once = F.when(F.col("__n") == 1, F.col("__row")).otherwise(
            F.raise_error(F.concat(F.lit("two changes of key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
        changes = grouped.withColumn("__row", once).select(key, "__row.*").select(*changes.columns)
    edits = changes.filter(F.col(op_col).isin("update", "delete")).select(
        key, F.col(op_col).alias("__op"), F.struct(*fields).alias("__new")
    )
    kept = snapshot.join(edits, key, "left").filter(~F.col("__op").eqNullSafe("delete")).select(
        key, *[F.coalesce(F.col(f"__new.{c}"), F.col(c)).alias(c) for c in fields]
    )
    inserts = changes.filter(F.col(op_col) == "insert").select(key, *fields)
    return kept.unionByName(_absent(inserts, snapshot, key))


def _absent(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key is not stored; the stored keys are first reduced to those of the batch."""
    there = semi(stored.select(key), batch, key, key)
    return batch.join(there, key, "left_anti")


def affected(snapshot: DataFrame, changes: DataFrame, key: str, op_col: str) -> DataFrame:
    """Changes per operation, and how many of them found (or, for inserts, did not find) their key."""
    there = semi(snapshot.select(key), changes, key, key).select(key, F.lit(True).alias("__there"))
    seen = changes.join(there, key, "left")
    found = F.coalesce(F.col("__there"), F.lit(False))
    hit = F.when(F.col(op_col) == "insert", ~found).otherwise(found)
    return seen.groupBy(F.col(op_col).alias("op")).agg(
        F.count(F.lit(1)).alias("requested"), F.count_if(hit).alias("applied")
    )


def new_keys_only(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a batch that may be appended: one per key (the first by ``order``, a null order value last), none already
    stored. A row without a key is not appended: it could not be recognised by the next batch."""
    rest = [c for c in batch.columns if c != key]
    first = F.struct(F.col(order).isNull().alias("__none"), F.col(order).alias("__at"))
    one = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), first).alias("__row"))
    fresh = _absent(one, existing, key)
    return fresh.select(key, "__row.*").select(*batch.columns)


def keyed_append(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Existing rows and the new ones of a batch; a duplicate key costs that row, not the batch."""
    return existing.unionByName(new_keys_only(existing, batch, key, order))


def book_key(upc: str, slug: Column) -> Column:
    """Stored key of a record: its own code, or the slug of its title."""
    return F.coalesce(F.nullif(F.col(upc), F.lit("")), slug)


def drop_tables(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    if name.lower() == "default":
        raise ValueError("the default database is never dropped")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
