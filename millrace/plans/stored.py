"""Tables in versions, and collections of mixed documents that are stored and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import variants
from millrace.plans.registry import Tables, query
from millrace.session import scratch
from millrace.sources.versions import KeyedTable, key_bucket

BUCKETS = 32
BUCKET = f"cast('0x' || substr(md5(cast(c_custkey as varchar)), 1, 8) as bigint) % {BUCKETS}"
UPDATED, DELETED, INSERTED = (f"({BUCKET}) % 8 = 3 and c_custkey % 5 = 1", f"({BUCKET}) % 8 = 5 and c_custkey % 5 = 2",
                              f"({BUCKET}) % 16 = 7 and c_custkey % 5 = 0")


def versions(t: Tables) -> KeyedTable:
    """Customers but every fifth one, then a batch of updates, one of deletes and one of inserts, each of a few buckets."""
    rows, key, at = t.customer.select("c_custkey", "c_name", "c_acctbal"), F.col("c_custkey"), key_bucket("c_custkey", BUCKETS)
    table = KeyedTable(t.spark, scratch(t.spark, "customers"), "c_custkey", BUCKETS)
    table.create(rows.filter(key % 5 != 0))
    batches = (("update", (at % 8 == 3) & (key % 5 == 1)), ("delete", (at % 8 == 5) & (key % 5 == 2)), ("insert", (at % 16 == 7) & (key % 5 == 0)))
    for op, which in batches:
        name = F.when(F.lit(op) != "update", F.col("c_name"))
        table.apply(rows.filter(which).select("c_custkey", F.lit(op).alias("op"), name.alias("c_name"), (F.col("c_acctbal") + 100).alias("c_acctbal")))
    return table


@query("snapshot_versions", f"""
with v2 as (select c_custkey, c_name, case when {UPDATED} then c_acctbal + 100 else c_acctbal end as c_acctbal from customer where c_custkey % 5 <> 0)
select cast(2 as integer) as version, * from v2
union all select 4, * from v2 where not ({DELETED})
union all select 4, c_custkey, c_name, c_acctbal + 100 from customer where {INSERTED}""")
def snapshot_versions(t: Tables) -> DataFrame:
    """The second of four versions, read again after two more batches, beside the current one."""
    table = versions(t)
    return table.read(2).select(F.lit(2).alias("version"), "*").unionByName(table.read().select(F.lit(4).alias("version"), "*"))


@query("snapshot_rewrites", f"""
select cast(v as integer) as version, count(distinct {BUCKET}) as rewritten from customer, (values (2), (3), (4)) x(v)
where v = 2 and {UPDATED} or v = 3 and {DELETED} or v = 4 and {INSERTED} group by v""")
def snapshot_rewrites(t: Tables) -> DataFrame:
    """Buckets that each batch has written: those of its keys, and no other."""
    table = versions(t)
    return t.spark.createDataFrame([(v, table.rewritten(v)) for v in (2, 3, 4)], "version int, rewritten long").filter("rewritten > 0")


def documents(t: Tables) -> DataFrame:
    """A stored collection: events as documents of three shapes. ``amount`` is a number, a text or absent."""
    user = F.struct(F.col("user_id").alias("id"), F.when(F.col("user_id") % 3 == 0, "gold").alias("tier"))
    sold = F.to_json(F.struct("event_type", user.alias("user"), F.col("value").cast("decimal(15,2)").alias("amount"), F.array(
        F.concat(F.lit("sku"), (F.col("event_id") % 10).cast("string")), F.lit("gift")).alias("items")))
    failed = F.to_json(F.struct("event_type", user.alias("user"), F.col("value").cast("decimal(15,2)").cast("string").alias("amount"), (
        500 + F.col("event_id") % 5).alias("code")))
    other = F.concat(F.lit('{"event_type":"'), "event_type", F.lit('","props":'), "props", F.lit("}"))
    kind = F.col("event_type")
    text = F.when(kind == "purchase", sold).when(kind == "error", failed).otherwise(other)
    parsed, _ = variants.collection(t.events.select("event_id", text.alias("text")), "text", "event_id")
    path = scratch(t.spark, "collection")
    parsed.write.parquet(path)
    return t.spark.read.parquet(path)


@query("collection_find", """
select event_id, event_type, user_id, cast(cast(value as decimal(15,2)) as double) as amount from events
where event_type = 'purchase' and (user_id > 50 and cast(value as decimal(15,2)) >= 20 or event_id % 10 = 7)""")
def collection_find(t: Tables) -> DataFrame:
    """A numeric bound leaves texts out, a value finds the arrays that hold it."""
    found = variants.find(documents(t), {"$or": [{"user.id": {"$gt": 50}, "amount": {"$gte": 20}}, {"items": "sku7"}]})
    return found.select("event_id", F.try_variant_get("doc", "$.event_type", "string").alias("event_type"),
                        F.try_variant_get("doc", "$.user.id", "bigint").alias("user_id"), F.try_variant_get("doc", "$.amount", "double").alias("amount"))


@query("collection_update_one", """
select event_id, user_id, case when event_id = (select min(event_id) from events where event_type = 'error' and event_id % 5 = 2)
 then true end as seen, case when event_id = (select min(event_id) from events where event_type = 'error' and event_id % 5 = 2) then 'ops' end as by_whom
from events where event_type = 'error'""")
def collection_update_one(t: Tables) -> DataFrame:
    changed = variants.update_one(documents(t), {"code": 502}, {"user.seen": True, "review.by": "ops"}, "event_id")
    return variants.find(changed, {"event_type": "error"}).select(
        "event_id", F.try_variant_get("doc", "$.user.id", "bigint").alias("user_id"), F.try_variant_get("doc", "$.user.seen", "boolean").alias("seen"),
        F.try_variant_get("doc", "$.review.by", "string").alias("by_whom"))


@query("collection_kinds", """
select path, kind, sum(n)::bigint as n from (
 select unnest(['event_type', 'user', 'user.id', 'amount', 'items']) as path, unnest(['string', 'object', 'number', 'number', 'array']) as kind, 1 as n
  from events where event_type = 'purchase'
 union all select 'items[]', 'string', 2 from events where event_type = 'purchase'
 union all select unnest(['event_type', 'user', 'user.id', 'amount', 'code']), unnest(['string', 'object', 'number', 'string', 'number']), 1
  from events where event_type = 'error'
 union all select 'user.tier', 'string', 1 from events where event_type in ('purchase', 'error') and user_id % 3 = 0
 union all select unnest(['event_type', 'props', 'props.k']), unnest(['string', 'object', 'number']), 1
  from events where event_type not in ('purchase', 'error')) group by 1, 2""")
def collection_kinds(t: Tables) -> DataFrame:
    return variants.path_kinds(documents(t), levels=3)


@query("collection_revisions", """
select event_id as original_id, user_id % 3 <> 0 as user_tier_changed, true as amount_changed, false as code_changed
from events where event_type = 'error' and event_id % 5 = 3""")
def collection_revisions(t: Tables) -> DataFrame:
    """Revisions of some documents beside their originals: which paths differ."""
    stored = documents(t)
    revised = variants.revisions(stored, {"code": {"$in": [503]}}, {"user.tier": "gold", "amount": 0}, "event_id", "source_id")
    return variants.compare(stored, revised, "event_id", "source_id", ["user.tier", "amount", "code"]).drop("revision_id")
