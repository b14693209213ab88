"""Relational, window and data-mart queries over customers, orders and order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import cents, exact_avg, half_even, on_days
from millrace.operators import aggregates as agg
from millrace.operators import relational as rel
from millrace.plans.registry import Tables, query

AVG = "cast(sum(cast({0} as decimal(15,2))) as double) / count({0})"
LINE = "cast(l_quantity as decimal(15,2)) * cast(l_extendedprice as decimal(15,2))"
MONTHLY = f"""
select year(o_orderdate) as sale_year, month(o_orderdate) as sale_month, sum({LINE}) as monthly_sales
from orders join lineitem on o_orderkey = l_orderkey group by 1, 2"""
MART = f"""
select o_orderpriority as area_name, cast(year(o_orderdate) as integer) as sale_year,
 cast(month(o_orderdate) as integer) as sale_month,
 cast(round({AVG.format('o_totalprice')}) as bigint) as avg_price
from orders group by all"""


def line_amount() -> Column:
    """Quantity times price of an order line, in ten-thousandths."""
    return cents("l_quantity") * cents("l_extendedprice")


@query("mart_monthly_avg", MART)
def mart_monthly_avg(t: Tables) -> DataFrame:
    return agg.mart_monthly(t.orders, "o_orderpriority", "o_orderdate", "o_totalprice", digits=2)


@query("mart_spot_check", f"""
select sale_month, avg_price as average_price from ({MART}) where area_name = '1-URGENT' and sale_year = 1997
order by sale_month""")
def mart_spot_check(t: Tables) -> DataFrame:
    mart = mart_monthly_avg(t)
    return (
        mart.filter((F.col("area_name") == "1-URGENT") & (F.col("sale_year") == 1997))
        .select("sale_month", F.col("avg_price").alias("average_price")).orderBy("sale_month")
    )


@query("rep_avg_credit", f"""
select n_nationkey, n_name, (select {AVG.format('c_acctbal')} from customer where c_nationkey = n_nationkey)
 as avg_credit from nation""")
def rep_avg_credit(t: Tables) -> DataFrame:
    out = rel.with_correlated_avg(t.nation, t.customer, "n_nationkey", "c_nationkey", "c_acctbal", "avg_credit", digits=2)
    return out.select("n_nationkey", "n_name", "avg_credit")


@query("orders_above_year_avg", f"""
with totals as (select l_orderkey, sum({LINE}) as total from lineitem group by 1),
 yearly as (select cast(sum(total) as double) / count(*) as threshold from totals join orders
  on l_orderkey = o_orderkey where year(o_orderdate) = 1997)
select l_orderkey, cast(total as double) as total_amount from totals
where cast(total as double) > (select threshold from yearly)""")
def orders_above_year_avg(t: Tables) -> DataFrame:
    totals = rel.group_totals(t.lineitem, ["l_orderkey"], line_amount(), 4, "total")
    year = t.orders.filter(F.year("o_orderdate") == 1997)
    mean = rel.semi(totals, year, "l_orderkey", "o_orderkey").agg(
        F.try_divide(F.sum("total").cast("double"), F.count("total"))
    )
    return rel.above_scalar(totals, "total", mean).select(
        "l_orderkey", F.col("total").cast("double").alias("total_amount")
    )


@query("payments_nested_in", """
select o_custkey, o_orderkey, cast(o_orderdate as date) as paid_on, o_totalprice as amount from orders
where o_custkey in (select c_custkey from customer where c_nationkey in
 (select n_nationkey from nation where n_regionkey = 1))""")
def payments_nested_in(t: Tables) -> DataFrame:
    reps = t.nation.filter(F.col("n_regionkey") == 1)
    buyers = rel.semi(t.customer, reps, "c_nationkey", "n_nationkey")
    return rel.semi(t.orders, buyers, "o_custkey", "c_custkey").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("paid_on"), F.col("o_totalprice").alias("amount")
    )


@query("payments_of_buyers", """
select o_custkey, o_orderkey, cast(o_orderdate as date) as paid_on, o_totalprice as amount from orders
where o_custkey in (select distinct o_custkey from orders
 where cast(o_orderdate as date) between date '1997-01-01' and date '1997-01-31')""")
def payments_of_buyers(t: Tables) -> DataFrame:
    january = t.orders.filter(on_days("o_orderdate", "1997-01-01", "1997-01-31")).select("o_custkey").distinct()
    return rel.semi(t.orders, january, "o_custkey", "o_custkey").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("paid_on"), F.col("o_totalprice").alias("amount")
    )


@query("same_line_vendor", """
select p_partkey, p_name, p_type, p_brand from part
where (p_type, p_brand) in (select (p_type, p_brand) from part where p_partkey = 42)""")
def same_line_vendor(t: Tables) -> DataFrame:
    probe = t.part.filter(F.col("p_partkey") == 42)
    return rel.match_row_value(t.part, probe, ["p_type", "p_brand"]).select("p_partkey", "p_name", "p_type", "p_brand")


@query("peer_same_office", """
select c_custkey, c_name, c_nationkey, c_mktsegment from customer
where (c_nationkey, c_mktsegment) in (select (c_nationkey, c_mktsegment) from customer
 where c_name = 'Customer#000000042') and not (c_name = 'Customer#000000042')""")
def peer_same_office(t: Tables) -> DataFrame:
    me = F.col("c_name") == "Customer#000000042"
    peers = rel.match_row_value(t.customer, t.customer.filter(me), ["c_nationkey", "c_mktsegment"], exclude=me)
    return peers.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("top_rep_per_office", """
select office, employee, total_sales, ranking from (
 select n_regionkey as office, n_name as employee,
  cast(sum(cast(o_totalprice as decimal(15,2))) as double) as total_sales,
  cast(rank() over (partition by n_regionkey order by sum(cast(o_totalprice as decimal(15,2))) desc) as integer)
   as ranking
 from nation join customer on n_nationkey = c_nationkey join orders on c_custkey = o_custkey
 group by n_regionkey, n_name) where ranking <= 1""")
def top_rep_per_office(t: Tables) -> DataFrame:
    spent = rel.group_totals(t.orders, ["o_custkey"], cents("o_totalprice"), 2, "spent")
    by_rep = (
        t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey").agg(F.sum("spent").alias("sales"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("office"), F.col("n_name").alias("employee"))
        .agg(F.sum("sales").alias("sales"))
    )
    best = rel.top_n_per_group(by_rep, ["office"], [F.desc("sales")], 1, "ranking", ties=True)
    return best.select("office", "employee", F.col("sales").cast("double").alias("total_sales"), "ranking")


@query("recent3_lines", """
select o_custkey, o_orderkey, cast(o_orderdate as date) as ordered_on, recent_rank, p_name, l_quantity from (
 select *, cast(row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_quantity, l_extendedprice) as integer) as recent_rank
 from orders join lineitem on o_orderkey = l_orderkey)
join part on l_partkey = p_partkey where recent_rank <= 3""")
def recent3_lines(t: Tables) -> DataFrame:
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    order = [F.desc("o_orderdate"), *map(F.col, (
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    ))]
    last = rel.top_n_per_group(lines, ["o_custkey"], order, 3, "recent_rank")
    return last.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("ordered_on"), "recent_rank", "p_name", "l_quantity"
    )


@query("running_monthly_sales", f"""
select cast(sale_year as integer) as sale_year, cast(sale_month as integer) as sale_month,
 cast(monthly_sales as double) as monthly_sales,
 cast(sum(monthly_sales) over (partition by sale_year order by sale_month) as double) as cumulative_sales
from ({MONTHLY})""")
def running_monthly_sales(t: Tables) -> DataFrame:
    out = agg.running_sum(
        agg.monthly_sales(t.orders, t.lineitem), ["sale_year"], ["sale_month"], "monthly_sales", "cumulative_sales"
    )
    return out.withColumns({c: F.col(c).cast("double") for c in ("monthly_sales", "cumulative_sales")})


@query("moving_avg_3", f"""
select cast(sale_year as integer) as sale_year, cast(sale_month as integer) as sale_month,
 cast(monthly_sales as double) as monthly_sales,
 cast(sum(monthly_sales) over w as double) / count(*) over w as moving_avg
from ({MONTHLY}) window w as (order by sale_year, sale_month rows between 2 preceding and current row)""")
def moving_avg_3(t: Tables) -> DataFrame:
    out = agg.moving_avg(
        agg.monthly_sales(t.orders, t.lineitem), [], ["sale_year", "sale_month"], "monthly_sales", 2, "moving_avg"
    )
    return out.withColumn("monthly_sales", F.col("monthly_sales").cast("double"))


@query("payment_vs_avg", f"""
select o_custkey, o_orderkey, o_totalprice, avg_payment from orders join (
 select o_custkey as k, {AVG.format('o_totalprice')} as avg_payment from orders group by 1) on k = o_custkey""")
def payment_vs_avg(t: Tables) -> DataFrame:
    paid = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return rel.partition_mean(paid, ["o_custkey"], "o_totalprice", "avg_payment", digits=2)


@query("order_gap", f"""
with daily as (select o_custkey, cast(o_orderdate as date) as ordered_on, sum({LINE}) as total
 from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)
select o_custkey, ordered_on, cast(total as double) as total_amount,
 cast(lag(total, 1, 0) over w as double) as previous_amount,
 cast(total - lag(total, 1, 0) over w as double) as amount_difference,
 cast(datediff('day', lag(ordered_on, 1, ordered_on) over w, ordered_on) as integer) as days_since_last
from daily window w as (partition by o_custkey order by ordered_on)""")
def order_gap(t: Tables) -> DataFrame:
    totals = rel.group_totals(t.lineitem, ["l_orderkey"], line_amount(), 4, "total")
    daily = (
        t.orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("ordered_on")).agg(F.sum("total").alias("amount"))
    )
    out = agg.lag_diff(daily, ["o_custkey"], ["ordered_on"], "amount", "amount")
    out = agg.days_since_previous(out, ["o_custkey"], "ordered_on", "days_since_last")
    return out.select(
        "o_custkey", "ordered_on", F.col("amount").cast("double").alias("total_amount"),
        F.col("previous_amount").cast("double"), F.col("amount_difference").cast("double"), "days_since_last",
    )


@query("group_sum_expr", f"select l_returnflag, cast(sum({LINE}) as double) as total from lineitem group by 1")
def group_sum_expr(t: Tables) -> DataFrame:
    totals = rel.group_totals(t.lineitem, ["l_returnflag"], line_amount(), 4, "total")
    return totals.withColumn("total", F.col("total").cast("double"))


@query("group_avg", f"""
select l_returnflag, l_linestatus, {AVG.format('l_quantity')} as avg_quantity,
 {AVG.format('l_extendedprice')} as avg_price from lineitem group by all order by all""")
def group_avg(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(exact_avg("l_quantity").alias("avg_quantity"), exact_avg("l_extendedprice").alias("avg_price"))
        .orderBy("l_returnflag", "l_linestatus")
    )


@query("weekday_mean", f"""
select dayname(ts) as day_name, round_even({AVG.format('value')} * 100, 0) / 100 as mean_value
from events group by 1""")
def weekday_mean(t: Tables) -> DataFrame:
    day = F.date_format("ts", "EEEE").alias("day_name")
    return t.events.groupBy(day).agg(half_even(exact_avg("value"), 2).alias("mean_value"))


@query("distinct_buyers", "select distinct o_custkey from orders where o_orderstatus = 'F'")
def distinct_buyers(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey").distinct()


@query("price_stats", f"""
select count(p_retailprice) as total, min(p_retailprice) as min_value, max(p_retailprice) as max_value,
 {AVG.format('p_retailprice')} as avg_value from part""")
def price_stats(t: Tables) -> DataFrame:
    return agg.summary_stats(t.part, "p_retailprice", digits=2)


@query("price_histogram20", """
with e as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders),
 b as (select cast(least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / 20.0::double)), 1), 20) as integer) as bin
  from orders, e)
select cast(s.i as integer) as bin, count(b.bin) as n from generate_series(1, 20) s(i) left join b on b.bin = s.i
group by 1""")
def price_histogram20(t: Tables) -> DataFrame:
    return agg.histogram(t.orders, "o_totalprice", 20)


@query("price_page", """
select p_partkey, p_name, p_retailprice,
 (select cast(ceil(count(*) / 5.0) as bigint) from part where p_retailprice between 900 and 950) as total_pages
from part where p_retailprice between 900 and 950 order by p_retailprice, p_partkey limit 5 offset 10""")
def price_page(t: Tables) -> DataFrame:
    found = t.part.filter(F.col("p_retailprice").between(900, 950)).select("p_partkey", "p_name", "p_retailprice")
    pages = rel.page_count(found, 5).select("total_pages").scalar()
    return rel.page(found, [F.col("p_retailprice"), F.col("p_partkey")], 3, 5).withColumn("total_pages", pages)


@query("page_after_key", """
select p_partkey, p_name from part where p_partkey > 99 order by p_partkey limit 20""")
def page_after_key(t: Tables) -> DataFrame:
    return rel.page_after(t.part.select("p_partkey", "p_name"), "p_partkey", 99, 20)


@query("first_order", """
select o_orderkey, o_custkey from orders where o_orderpriority = '2-HIGH' order by o_orderkey limit 1""")
def first_order(t: Tables) -> DataFrame:
    found = rel.first_match(t.orders, F.col("o_orderpriority") == "2-HIGH", [F.col("o_orderkey")])
    return found.select("o_orderkey", "o_custkey")


@query("sample_rows", "select * from customer order by md5(c_custkey || ':42'), c_custkey limit 10")
def sample_rows(t: Tables) -> DataFrame:
    return rel.sample_exact(t.customer, "c_custkey", 10, 42)


@query("ordered_orders", """
select o_orderkey, o_custkey, o_totalprice from orders order by o_custkey, o_totalprice desc, o_orderkey""")
def ordered_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        "o_custkey", F.desc("o_totalprice"), "o_orderkey"
    )


@query("relative_to_baseline", f"""
with rates as (select o_orderpriority as task, o_orderpriority || '-' || o_orderstatus as method,
  {AVG.format('o_totalprice')} as rate from orders group by all)
select r.method, r.rate, r.rate / b.rate as relative from rates r
join rates b on r.task = b.task and b.method = b.task || '-O'""")
def relative_to_baseline(t: Tables) -> DataFrame:
    rates = t.orders.groupBy(
        F.col("o_orderpriority").alias("task"), F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("method")
    ).agg(exact_avg("o_totalprice").alias("rate"))
    out = rel.ratio_to_baseline(rates, "task", F.col("method").endswith("-O"), "rate", "method", "relative")
    return out.select("method", "rate", "relative")


@query("range_predicate_count", """
select cast(o_orderkey // 1000 * 1000 as bigint) as range_start, count(*) filter (where o_orderkey >= 2 and not exists (
  select 1 from generate_series(2, 1300) d(i) where i * i <= o_orderkey and o_orderkey % i = 0)) as n
from orders group by 1""")
def range_predicate_count(t: Tables) -> DataFrame:
    return agg.count_in_ranges(t.orders, "o_orderkey", 1000, agg.is_prime)


@query("append_results", """
select 'customer' as kind, c_custkey as id, c_acctbal as balance, null::varchar as note from customer
union all select 'supplier', s_suppkey, s_acctbal, s_name from supplier""")
def append_results(t: Tables) -> DataFrame:
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("note"),
    )
    return rel.append_all(a, b)


@query("optional_lookup", """
select p_partkey, p_name, s_name from part left join supplier on p_partkey = s_suppkey""")
def optional_lookup(t: Tables) -> DataFrame:
    return rel.find_with_optional(t.part, t.supplier, "p_partkey", "s_suppkey").select("p_partkey", "p_name", "s_name")


@query("sql_over_frames", f"""
select n_name, count(*) as n, {AVG.format('c_acctbal')} as avg_balance from customer join nation
on c_nationkey = n_nationkey where c_acctbal >= 500 group by 1""")
def sql_over_frames(t: Tables) -> DataFrame:
    from millrace.sources.files import sql_over

    return sql_over(
        t.spark,
        """select n_name, count(*) as n,
            cast(sum(cast(c_acctbal as decimal(15,2))) as double) / count(c_acctbal) as avg_balance
           from {customer} join {nation} on c_nationkey = n_nationkey where c_acctbal >= :low group by n_name""",
        args={"low": 500}, customer=t.customer, nation=t.nation,
    )
