"""Calendar, resampling and interpolation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import temporal as tm
from millrace.functions.columns import cents, exact_sum, half_even, money
from millrace.operators import relational, series
from millrace.plans.registry import Tables, query


@query("date_parts", """
select event_id, cast(year(ts) as integer) as year, cast(quarter(ts) as integer) as quarter,
 cast(month(ts) as integer) as month, cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour,
 cast(minute(ts) as integer) as minute, cast(second(ts) as integer) as second,
 cast(isodow(ts) - 1 as integer) as weekday, cast(isodow(ts) as integer) as iso_weekday, dayname(ts) as day_name,
 cast(week(ts) as integer) as iso_week, strftime(ts, '%Y-%m') as month_key from events""")
def date_parts(t: Tables) -> DataFrame:
    return tm.calendar_parts(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("date_diff", """
select o_orderkey, l_linenumber, cast(datediff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as integer)
 as days, cast(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) as bigint) as whole_days,
 (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 as seconds,
 (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 / 86400.0 as day_fraction,
 l_shipdate > o_orderdate as shipped_later
from orders join lineitem on o_orderkey = l_orderkey""")
def date_diff(t: Tables) -> DataFrame:
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    a, b = "o_orderdate", "l_shipdate"
    return rows.select(
        "o_orderkey", "l_linenumber", F.datediff(b, a).alias("days"), tm.whole_days(a, b).alias("whole_days"),
        tm.seconds_between(a, b).alias("seconds"), tm.duration_days(a, b).alias("day_fraction"),
        (F.col(b) > F.col(a)).alias("shipped_later"),
    )


@query("date_parse_tolerant", """
with r as (select event_id, case event_id % 4 when 0 then strftime(ts, '%Y-%m-%d') when 1 then strftime(ts, '%Y/%m/%d')
 when 2 then 'invalid-date' else strftime(ts, '%Y%m%d') end as s from events)
select event_id, cast(try_strptime(s, '%Y-%m-%d') as date) as strict_day,
 case when event_id % 4 <> 2 then cast(coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%Y/%m/%d'),
  try_strptime(s, '%Y%m%d')) as date) end as any_day from r""")
def date_parse_tolerant(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 4
    s = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd")).when(kind == 1, F.date_format("ts", "yyyy/MM/dd"))
        .when(kind == 2, "invalid-date").otherwise(F.date_format("ts", "yyyyMMdd"))
    )
    rows = t.events.select("event_id", s.alias("s"))
    return rows.select(
        "event_id", tm.parse_date("s").alias("strict_day"),
        tm.parse_date("s", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd").alias("any_day"),
    )


@query("tz_convert", "select event_id, ts + interval 9 hours as seoul_time from events")
def tz_convert(t: Tables) -> DataFrame:
    return t.events.select("event_id", tm.to_zone("ts", "Asia/Seoul").alias("seoul_time"))


@query("time_arith", """
select event_id, ts + interval '3 days 5 hours 10 minutes' as later, ts - interval 7 days as earlier,
 make_timestamp(epoch_us(ts) // 1800000000 * 1800000000) as half_hour,
 strftime(ts, '%H:%M:%S.%f') as clock, make_timestamp(epoch_us(ts) // 1000000 * 1000000) as from_epoch,
 cast(make_date(2026, cast(month(ts) as integer), cast(day(ts) as integer)) as date) as same_day_2026 from events""")
def time_arith(t: Tables) -> DataFrame:
    ts = F.col("ts")
    clock = tm.micros_of_day(F.hour(ts), F.minute(ts), F.second(ts), F.pmod(tm.micros(ts), F.lit(1_000_000)))
    return t.events.select(
        "event_id", tm.shift(ts, days=3, hours=5, minutes=10).alias("later"), tm.shift(ts, days=-7).alias("earlier"),
        tm.floor_minutes(ts, 30).alias("half_hour"), tm.time_text(clock).alias("clock"),
        F.timestamp_seconds(F.floor(tm.micros(ts) / 1_000_000)).cast("timestamp_ntz").alias("from_epoch"),
        tm.replace_year(ts, 2026).alias("same_day_2026"),
    )


@query("period_ends", """
select o_orderkey, last_day(o_orderdate) as month_end,
 last_day(cast(date_trunc('quarter', o_orderdate) + interval 2 months as date)) as quarter_end,
 cast(date_trunc('week', o_orderdate) as date) + 6 as week_end from orders""")
def period_ends(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", tm.month_end(d).alias("month_end"), tm.quarter_end(d).alias("quarter_end"),
        series.period_label(d, "W").alias("week_end"),
    )


@query("calendar_spine", """
with e as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders)
select cast(d as date) as label from e, unnest(generate_series(lo, hi, interval 1 day)) u(d)""")
def calendar_spine(t: Tables) -> DataFrame:
    days = t.orders.select(F.to_date("o_orderdate").alias("label"))
    return series.spine_of(days, [], "label", "D")


@query("resample_hour", """
with e as (select date_trunc('hour', ts) as label, cast(value as decimal(15,2)) as v from events),
s as (select unnest(generate_series(lo, hi, interval 1 hour)) as label from (select min(label) as lo, max(label) as hi from e))
select s.label, cast(coalesce(sum(v), 0) as double) as sum_value, cast(count(v) as bigint) as n, cast(max(v) as double) as highest,
 case when count(v) > 0 then cast(sum(v) as double) / count(v) end as avg_value
from s left join e using (label) group by 1""")
def resample_hour(t: Tables) -> DataFrame:
    rows = t.events.select("ts", money("value").alias("sum_value"), F.when(F.col("value").isNotNull(), 1).alias("n"),
                           F.col("value").alias("highest"))
    hours = series.resample(rows, "ts", "h", {"sum_value": "sum", "n": "sum", "highest": "max"})
    total = F.col("sum_value").cast("double")
    return hours.select("label", total.alias("sum_value"), "n", F.col("highest").cast("double").alias("highest"),
                        F.try_divide(total, F.col("n")).alias("avg_value"))


@query("agg_spec_means", """
select l_returnflag, round_even(avg(l_quantity), 6) as l_quantity, round_even(avg(l_discount), 6) as l_discount,
 round_even(avg(l_tax), 6) as l_tax, cast(sum(l_linenumber) as bigint) as l_linenumber from lineitem group by 1""")
def agg_spec_means(t: Tables) -> DataFrame:
    """One function per column: mean, mean, mean, sum."""
    spec = {"l_quantity": "mean", "l_discount": "mean", "l_tax": "mean", "l_linenumber": "sum"}
    found = relational.agg_spec(t.lineitem, ["l_returnflag"], spec)
    return found.withColumns({c: half_even(c, 6) for c in ("l_quantity", "l_discount", "l_tax")})


GAPPY = "select cast(o_orderdate as date) as day, o_totalprice from orders where month(o_orderdate) not in (2, 4, 5, 6)"


@query("resample_month", f"""
with g as ({GAPPY}), s as (select last_day(cast(d as date)) as label from
 (select min(day) as lo, max(day) as hi from g), unnest(generate_series(date_trunc('month', lo), hi, interval 1 month)) u(d))
select s.label, cast(coalesce(sum(cast(o_totalprice as decimal(15,2))), 0) as double) as total, max(o_totalprice) as highest
from s left join g on last_day(day) = s.label group by 1""")
def resample_month(t: Tables) -> DataFrame:
    return _gappy(t, "ME")


@query("resample_quarter", f"""
with g as ({GAPPY}), q as (select last_day(cast(date_trunc('quarter', day) + interval 2 months as date)) as label, * from g),
 s as (select last_day(cast(d as date)) as label from (select min(label) as lo, max(label) as hi from q),
  unnest(generate_series(date_trunc('month', lo), hi, interval 3 months)) u(d))
select s.label, cast(coalesce(sum(cast(o_totalprice as decimal(15,2))), 0) as double) as total, max(o_totalprice) as highest
from s left join q on q.label = s.label group by 1""")
def resample_quarter(t: Tables) -> DataFrame:
    return _gappy(t, "QE")


def _gappy(t: Tables, freq: str) -> DataFrame:
    rows = t.orders.filter(~F.month("o_orderdate").isin(2, 4, 5, 6)).select(
        F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("total"), F.col("o_totalprice").alias("highest")
    )
    out = series.resample(rows, "day", freq, {"total": "sum", "highest": "max"})
    return out.withColumn("total", F.col("total").cast("double"))


WEEKLY = """weekly as (select cast(date_trunc('week', o_orderdate) as date) + 6 as label,
 cast(sum(cast(o_totalprice as decimal(15,2))) as double) as total from orders where month(o_orderdate) <> 3 group by 1),
 daily as (select cast(d as date) as label, total from (select min(label) as lo, max(label) as hi from weekly),
  unnest(generate_series(lo, hi, interval 1 day)) u(d) left join weekly on weekly.label = cast(d as date))"""


def _weekly(t: Tables) -> DataFrame:
    rows = t.orders.filter(F.month("o_orderdate") != 3)
    weekly = rows.groupBy(series.period_label("o_orderdate", "W").alias("label")).agg(
        exact_sum(cents("o_totalprice"), 2).cast("double").alias("total")
    )
    return series.upsample(weekly, "label", "D")


@query("upsample_daily", f"with {WEEKLY} select label, total from daily")
def upsample_daily(t: Tables) -> DataFrame:
    return _weekly(t)


@query("upsample_ffill", f"""
with {WEEKLY} select label, last_value(total ignore nulls) over (order by label) as filled from daily""")
def upsample_ffill(t: Tables) -> DataFrame:
    return series.ffill(_weekly(t), "label", "total", "filled").select("label", "filled")


@query("interpolate_linear", f"""
with {WEEKLY}, n as (select *,
 last_value(total ignore nulls) over a as pv, last_value(case when total is not null then label end ignore nulls) over a as pt,
 first_value(total ignore nulls) over b as nv, first_value(case when total is not null then label end ignore nulls) over b as nt
 from daily window a as (order by label rows between unbounded preceding and current row),
  b as (order by label rows between current row and unbounded following))
select label, round_even(coalesce(total, pv + (nv - pv) * (cast(label - pt as double) / (nt - pt)), pv) * 10000, 0) / 10000 as filled from n""")
def interpolate_linear(t: Tables) -> DataFrame:
    out = series.interpolate(_weekly(t), "label", "total", "filled", edges="forward")
    return out.select("label", half_even("filled", 4).alias("filled"))


@query("interpolate_time", """
with s as (select event_id, user_id, ts, case when event_id % 4 in (1, 2) then null else value end as v from events),
n as (select *,
 last_value(v ignore nulls) over a as pv, last_value(case when v is not null then epoch_us(ts) end ignore nulls) over a as pt,
 first_value(v ignore nulls) over b as nv, first_value(case when v is not null then epoch_us(ts) end ignore nulls) over b as nt
 from s window a as (partition by user_id order by ts rows between unbounded preceding and current row),
  b as (partition by user_id order by ts rows between current row and unbounded following))
select event_id, round_even(coalesce(v, pv + (nv - pv) * (cast(epoch_us(ts) - pt as double) / cast(nt - pt as double)), pv, nv)
 * 10000, 0) / 10000 as filled from n""")
def interpolate_time(t: Tables) -> DataFrame:
    v = F.when(~(F.col("event_id") % 4).isin(1, 2), F.col("value"))
    rows = t.events.select("event_id", "user_id", "ts", v.alias("v"))
    out = series.interpolate(rows, "ts", "v", "filled", keys=["user_id"])
    return out.select("event_id", half_even("filled", 4).alias("filled"))


@query("ffill_by_user", """
with s as (select event_id, user_id, ts, case when event_id % 3 <> 0 then null else value end as v from events)
select event_id, last_value(v ignore nulls) over (partition by user_id order by ts rows between unbounded preceding
 and current row) as filled from s""")
def ffill_by_user(t: Tables) -> DataFrame:
    v = F.when(F.col("event_id") % 3 == 0, F.col("value"))
    rows = t.events.select("event_id", "user_id", "ts", v.alias("v"))
    out = series.ffill(rows, "ts", "v", "filled", keys=["user_id"])
    return out.select("event_id", "filled")
