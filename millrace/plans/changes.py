"""Snapshot mutations and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import slug
from millrace.operators import documents as docs
from millrace.operators import quality
from millrace.plans.registry import Tables, query

def changes(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    op = F.when(key % 10 == 0, "delete").when(key % 10 == 1, "update").otherwise("insert")
    moved = F.when(key % 10 == 2, key + 100_000_000).otherwise(key)
    return t.customer.filter(key % 10 < 3).select(
        moved.alias("c_custkey"), op.alias("op"),
        F.when(key % 10 == 2, F.concat(F.lit("NEW"), key.cast("string"))).alias("c_name"),
        (F.col("c_acctbal") + 100).alias("c_acctbal"),
    )


@query("apply_changes", """
select c_custkey, c_name, case when c_custkey % 10 = 1 then c_acctbal + 100 else c_acctbal end as c_acctbal
from customer where c_custkey % 10 <> 0
union all select c_custkey + 100000000, 'NEW' || c_custkey, c_acctbal + 100 from customer where c_custkey % 10 = 2""")
def apply_changes(t: Tables) -> DataFrame:
    snapshot = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return docs.apply_changes(snapshot, changes(t), "c_custkey", "op")


@query("changes_affected", """
select case c_custkey % 10 when 0 then 'delete' when 1 then 'update' else 'insert' end as op, count(*) as requested,
 count(*) as applied from customer where c_custkey % 10 < 3 group by 1""")
def changes_affected(t: Tables) -> DataFrame:
    return docs.affected(t.customer, changes(t), "c_custkey", "op")


@query("update_by_key", """
select c_custkey, case when c_custkey = 7 then 0.0 else c_acctbal end as c_acctbal from customer""")
def update_by_key(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal")
    return docs.update_where(rows, F.col("c_custkey") == 7, {"c_acctbal": F.lit(0.0)})


@query("delete_by_key", """
select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""")
def delete_by_key(t: Tables) -> DataFrame:
    gone = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(gone, "c_custkey", "left_anti")


@query("update_one", """
select c_custkey, c_mktsegment, case when c_custkey = (select min(c_custkey) from customer where c_mktsegment = 'BUILDING')
 then true end as is_modified from customer""")
def update_one(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_mktsegment")
    return docs.update_one(rows, F.col("c_mktsegment") == "BUILDING", "c_custkey", {"is_modified": F.lit(True)})


@query("delete_range", """
select o_orderkey, o_orderdate from orders where not (o_orderdate >= '1996-01-01' and o_orderdate < '1998-07-01')""")
def delete_range(t: Tables) -> DataFrame:
    from millrace.functions.columns import in_period

    rows = t.orders.select("o_orderkey", "o_orderdate")
    return docs.delete_where(rows, in_period("o_orderdate", "1996-01-01", "1998-07-01"))


@query("insert_numbered", """
select c_custkey, c_name from customer
union all select (select max(c_custkey) from customer) + row_number() over (order by s_suppkey), s_name from supplier""")
def insert_numbered(t: Tables) -> DataFrame:
    new = t.supplier.select(F.col("s_name").alias("c_name"), "s_suppkey")
    old = t.customer.select("c_custkey", "c_name").withColumn("s_suppkey", F.lit(None).cast("long"))
    return docs.insert_numbered(old, new, "c_custkey", "s_suppkey").drop("s_suppkey")


@query("keyed_append", """
with old as (select p_name as title, p_partkey as first_key from part where p_partkey < 20),
 stored as (select title, min(first_key) as first_key from old group by 1)
select title, first_key from stored union all
select p_name, min(p_partkey) from part where p_name not in (select title from stored) group by 1""")
def keyed_append(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("first_key"))
    old = docs.new_keys_only(rows.limit(0), rows.filter(F.col("first_key") < 20), "title", "first_key")
    return docs.keyed_append(old, rows, "title", "first_key")


@query("record_keys", r"""
select p_partkey, coalesce(nullif(case when p_partkey % 3 = 0 then '' else 'upc' || p_partkey end, ''),
 replace(p_name, ' ', '-')) as book_id from part""")
def record_keys(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    upc = F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("upc"), key.cast("string")))
    return t.part.withColumn("upc", upc).select("p_partkey", docs.book_key("upc", slug("p_name")).alias("book_id"))


@query("reconcile", """
select coalesce(a.k, b.k) as key, coalesce(n_a, 0) as n_a, coalesce(n_b, 0) as n_b from
 (select o_custkey as k, count(*) as n_a from orders group by 1) a full join
 (select c_custkey as k, count(*) as n_b from customer group by 1) b on a.k = b.k
where coalesce(n_a, 0) <> coalesce(n_b, 0)""")
def reconcile(t: Tables) -> DataFrame:
    return quality.reconcile(
        t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")), "k"
    )


@query("reconcile_digests", """
select o_orderkey as key, cast(1 as bigint) as only_a, cast(case when o_orderkey % 3001 = 8 then 0 else 1 end as bigint) as only_b
from orders where o_orderkey % 3001 in (7, 8)
union all select -o_orderkey, 0, 1 from orders where o_orderkey % 3001 = 9""")
def reconcile_digests(t: Tables) -> DataFrame:
    """A copy of the orders with changed, lost and added rows against the original."""
    names = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    rows, kind = t.orders.select(*names), F.col("o_orderkey") % 3001
    changed = rows.filter(kind != 8).withColumn("o_totalprice", F.when(kind == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    added = rows.filter(kind == 9).withColumn("o_orderkey", -F.col("o_orderkey"))
    return quality.reconcile_digests(rows, changed.unionByName(added), "o_orderkey", names)[0]


@query("reconcile_counts", """
select (select count(*) from documents) as rows_a, (select count(*) from labels) as rows_b,
 (select count(*) from documents where doc_id not in (select doc_id from labels)) as only_a,
 (select count(*) from labels where doc_id not in (select doc_id from documents)) as only_b""")
def reconcile_counts(t: Tables) -> DataFrame:
    return quality.reconcile_counts(t.documents, t.labels, "doc_id")


@query("catalogue_report", """
select table_name, cast(position as integer) as position, column_name, n_rows from (
 select 'nation' as table_name, unnest([0, 1, 2]) as position, unnest(['n_nationkey', 'n_name', 'n_regionkey']) as column_name,
  (select count(*) from nation) as n_rows
 union all select 'customer', unnest([0, 1, 2, 3, 4]),
  unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']), (select count(*) from customer)
 union all select 'labels', unnest([0, 1, 2]), unnest(['doc_id', 'quality', 'toxic']), (select count(*) from labels))""")
def catalogue_report(t: Tables) -> DataFrame:
    tables = {"nation": t.nation, "customer": t.customer, "labels": t.labels}
    return quality.catalogue_report(t.spark, tables).drop("data_type")


@query("repeated_keys", """
select o_custkey, cast(o_orderdate as date) as day, count(*) as n from orders group by all having count(*) > 1""")
def repeated_keys(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return quality.repeated_keys(rows, ["o_custkey", "day"])


@query("orphans", """
select l_orderkey, l_partkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')""")
def orphans(t: Tables) -> DataFrame:
    known = t.orders.filter(F.col("o_orderstatus") != "P")
    return quality.orphans(t.lineitem.select("l_orderkey", "l_partkey"), known, "l_orderkey", "o_orderkey")
