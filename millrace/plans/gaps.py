"""Missing-value queries; gaps are injected by a modulus on the keys, the same way on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import half_even
from millrace.operators import chained, missing, nearest_fill
from millrace.operators.aggregates import quantiles
from millrace.plans.registry import Tables, query

HOLES = """(select p_partkey, p_name, case when p_partkey % 7 = 0 then null else p_retailprice end as price,
 case when p_partkey % 3 = 0 then null else p_size end as size,
 case when p_partkey % 7 = 0 and p_partkey % 2 = 0 then null else p_type end as kind from part)"""
COLS = ["price", "size", "kind"]


def holes(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        "p_partkey", "p_name", F.when(key % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.when(key % 3 != 0, F.col("p_size")).alias("size"),
        F.when((key % 7 != 0) | (key % 2 != 0), F.col("p_type")).alias("kind"),
    )


@query("missing_mask", f"""
select p_partkey, price is null as price_missing, size is null as size_missing, kind is null as kind_missing,
 cast(price is null as integer) + cast(size is null as integer) + cast(kind is null as integer) as row_missing from {HOLES}""")
def missing_mask(t: Tables) -> DataFrame:
    return missing.missing_mask(holes(t), COLS).drop("p_name", *COLS)


@query("null_profile", f"""
select 'price' as column_name, count(*) filter (where price is null) as n_missing, count(*) as n_rows from {HOLES}
union all select 'size', count(*) filter (where size is null), count(*) from {HOLES}
union all select 'kind', count(*) filter (where kind is null), count(*) from {HOLES}
union all select 'p_name', count(*) filter (where p_name is null), count(*) from {HOLES}""")
def null_profile(t: Tables) -> DataFrame:
    return missing.null_profile(holes(t), [*COLS, "p_name"])


@query("nullity_corr", f"""
select column_a, column_b, round_even(r * 1e9, 0) / 1e9 as corr from (
 select 'price' as column_a, 'size' as column_b, corr(cast(price is null as integer), cast(size is null as integer)) as r from {HOLES}
 union all select 'price', 'kind', corr(cast(price is null as integer), cast(kind is null as integer)) from {HOLES}
 union all select 'size', 'kind', corr(cast(size is null as integer), cast(kind is null as integer)) from {HOLES})""")
def nullity_corr(t: Tables) -> DataFrame:
    return missing.nullity_corr(holes(t), [*COLS, "p_name"]).withColumn("corr", half_even("corr", 9))


@query("drop_rows_any", f"select * from {HOLES} where price is not null and size is not null and kind is not null")
def drop_rows_any(t: Tables) -> DataFrame:
    return missing.drop_rows(holes(t), COLS)


@query("drop_rows_half", f"""
select * from {HOLES} where cast(price is null as integer) + cast(size is null as integer) + cast(kind is null as integer) < 1.5""")
def drop_rows_half(t: Tables) -> DataFrame:
    return missing.drop_rows(holes(t), COLS, min_missing_share=0.5)


@query("drop_null_columns", f"select p_partkey, p_name from {HOLES}")
def drop_null_columns(t: Tables) -> DataFrame:
    return missing.drop_null_columns(holes(t))


@query("impute_mean", f"""
select p_partkey, round_even(coalesce(size, (select avg(size) from {HOLES})) * 1e9, 0) / 1e9 as size from {HOLES}""")
def impute_mean(t: Tables) -> DataFrame:
    return missing.impute(holes(t), {"size": "mean"}).select("p_partkey", half_even("size", 9).alias("size"))


@query("impute_median", f"""
select p_partkey, coalesce(price, (select median(price) from {HOLES})) as price from {HOLES}""")
def impute_median(t: Tables) -> DataFrame:
    return missing.impute(holes(t), {"price": "median"}).select("p_partkey", "price")


@query("impute_mode", f"""
select p_partkey, coalesce(kind, (select kind from {HOLES} where kind is not null group by 1 order by count(*) desc, 1 limit 1))
 as kind from {HOLES}""")
def impute_mode(t: Tables) -> DataFrame:
    return missing.impute(holes(t), {"kind": "mode"}).select("p_partkey", "kind")


@query("impute_const", f"select p_partkey, coalesce(price, 0) as price, coalesce(kind, 'none') as kind from {HOLES}")
def impute_const(t: Tables) -> DataFrame:
    return missing.fill_constant(holes(t), {"price": 0.0, "kind": "none"}).select("p_partkey", "price", "kind")


@query("impute_cond", f"select p_partkey, case when size >= 30 or size is null then 999 else size end as size from {HOLES}")
def impute_cond(t: Tables) -> DataFrame:
    return missing.replace_where(holes(t), "size", F.col("size") >= 30, 999).select("p_partkey", "size")


@query("median_price", "select median(o_totalprice) as median_price from orders")
def median_price(t: Tables) -> DataFrame:
    return quantiles(t.orders, ["o_totalprice"]).select(F.col("value").alias("median_price"))


@query("group_medians", """
select l_returnflag, l_linestatus, column_name, count(x) as n, round_even(median(x) * 1e6, 0) / 1e6 as value from (
 unpivot (select l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax, cast(l_suppkey as double) as l_suppkey from lineitem)
 on l_quantity, l_extendedprice, l_discount, l_tax, l_suppkey into name column_name value x) group by all""")
def group_medians(t: Tables) -> DataFrame:
    """Exact medians of five columns per group."""
    found = quantiles(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"], ["l_returnflag", "l_linestatus"])
    return found.withColumn("value", half_even("value", 6))


@query("group_deciles", """
select o_orderpriority, 'o_totalprice' as column_name, count(*) as n, round_even(quantile_cont(o_totalprice, 0.9) * 1e4, 0) / 1e4 as value
from orders group by 1""")
def group_deciles(t: Tables) -> DataFrame:
    return quantiles(t.orders, ["o_totalprice"], ["o_orderpriority"], 0.9).withColumn("value", half_even("value", 4))


def _measures(t: Tables) -> DataFrame:
    key = F.col("l_orderkey") + F.col("l_partkey")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(key % 9 != 0, F.col("l_quantity")).alias("quantity"),
        F.when(key % 8 != 1, F.col("l_discount")).alias("discount"),
        F.when(key % 10 != 2, F.col("l_tax")).alias("tax"),
    )


# Direct form: every incomplete tuple against every tuple that knows the value.
KNN = """
with m as (select l_orderkey, l_partkey, l_suppkey, l_linenumber,
  case when (l_orderkey + l_partkey) % 9 <> 0 then l_quantity end as q,
  case when (l_orderkey + l_partkey) % 8 <> 1 then l_discount end as d,
  case when (l_orderkey + l_partkey) % 10 <> 2 then l_tax end as x from lineitem),
 u as (select q, d, x, count(*) as n from m group by all),
 gap as (select q, d, x, 'q' as target from u where q is null union all select q, d, x, 'd' from u where d is null
  union all select q, d, x, 'x' from u where x is null),
 pairs as (select g.q, g.d, g.x, target, case target when 'q' then u.q when 'd' then u.d else u.x end as v, n,
  cast(g.q is not null and u.q is not null as integer) + cast(g.d is not null and u.d is not null as integer)
   + cast(g.x is not null and u.x is not null as integer) as shared,
  coalesce((g.q - u.q) * (g.q - u.q), 0) + coalesce((g.d - u.d) * (g.d - u.d), 0) + coalesce((g.x - u.x) * (g.x - u.x), 0) as ss
  from gap g, u),
 near as (select q, d, x, target, v, sqrt(ss * (3.0::double / shared)) as dist, sum(n) as n from pairs
  where shared > 0 and v is not null group by all),
 ranked as (select *, sum(n) over (partition by q, d, x, target order by dist, v rows unbounded preceding) - n as before from near),
 used as (select *, least(n, 5 - before)::double as take from ranked where before < 5),
 filled as (select q, d, x, target, case when min(dist) = 0
   then sum(case when dist = 0 then take * v end) / sum(case when dist = 0 then take end)
   else sum(take / nullif(dist, 0) * v) / sum(take / nullif(dist, 0)) end as f from used group by all),
 wide as (select q, d, x, max(f) filter (where target = 'q') as fq, max(f) filter (where target = 'd') as fd,
  max(f) filter (where target = 'x') as fx from filled group by all)
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
 round_even(coalesce(m.q, fq, (select avg(q) from m)) * 1e6, 0) / 1e6 as quantity,
 round_even(coalesce(m.d, fd, (select avg(d) from m)) * 1e6, 0) / 1e6 as discount,
 round_even(coalesce(m.x, fx, (select avg(x) from m)) * 1e6, 0) / 1e6 as tax
from m left join wide w on m.q is not distinct from w.q and m.d is not distinct from w.d and m.x is not distinct from w.x"""


@query("impute_knn", KNN)
def impute_knn(t: Tables) -> DataFrame:
    filled = nearest_fill.impute_knn(_measures(t), ["quantity", "discount", "tax"], k=5)
    return filled.withColumns({c: half_even(c, 6) for c in ("quantity", "discount", "tax")})


@query("impute_iterative")
def impute_iterative(t: Tables) -> DataFrame:
    return chained.impute_iterative(_measures(t), ["quantity", "discount", "tax"])
