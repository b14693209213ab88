"""Column expressions, filters, text and JSON queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.functions import payload as pl
from millrace.functions import text as tx
from millrace.operators import relational as rel
from millrace.plans.registry import Tables, query


@query("col_exprs", """
select l_orderkey, l_linenumber, round_even(l_tax / l_discount_or_one * 100 * 10, 0) / 10 as tax_pct,
 l_returnflag as flag, case when l_quantity >= 30 then 'Large' else 'Small' end as size_class,
 cast(round_even(l_quantity / 4, 0) as bigint) as quarter_qty
from (select *, case when l_discount = 0 then null else l_discount end as l_discount_or_one from lineitem)""")
def col_exprs(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_tax", "l_discount", "l_returnflag", "l_quantity")
    return (
        c.with_ratio(rows, "l_tax", "l_discount", "tax_pct", 1)
        .withColumnRenamed("l_returnflag", "flag")
        .withColumn("size_class", c.either(F.col("l_quantity") >= 30, "Large", "Small"))
        .withColumn("quarter_qty", c.to_whole(F.col("l_quantity") / 4))
        .drop("l_tax", "l_discount", "l_quantity")
    )


@query("guarded_division", """
select l_orderkey, l_linenumber,
 cast(case when l_quantity - 10 > 0 then l_extendedprice / (l_quantity - 10) else 0 end as float) as unit_price
from lineitem""")
def guarded_division(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        c.divide_or_zero("l_extendedprice", F.col("l_quantity") - 10).alias("unit_price"),
    )


@query("coerce_numeric", """
with raw as (select p_partkey, case when p_partkey % 5 = 0 then 'n/a' when p_partkey % 7 = 0 then null
 else cast(cast(p_retailprice as decimal(15,2)) as varchar) end as price_text, p_size from part)
select p_partkey, cast(trunc(coalesce(try_cast(price_text as double), 0)) as integer) as price,
 case when cast(trunc(p_size) as integer) > 0
  then cast(trunc(coalesce(try_cast(price_text as double), 0)) as double) / p_size else 0 end as per_size
from raw""")
def coerce_numeric(t: Tables) -> DataFrame:
    text = F.when(F.col("p_partkey") % 5 == 0, "n/a").when(F.col("p_partkey") % 7 == 0, F.lit(None)).otherwise(
        c.money("p_retailprice").cast("string")
    )
    raw = t.part.select("p_partkey", text.alias("price"), "p_size")
    typed = c.coerce_types(raw, {"price": "number"})
    share = F.when(F.col("p_size") > 0, F.col("price") / F.col("p_size")).otherwise(0.0)
    return typed.select("p_partkey", "price", share.alias("per_size"))


@query("category_codes", """
select p_partkey, p_brand, cast(case when p_brand is null then -1 else dense_rank() over (order by p_brand nulls last) - 1
 end as integer) as brand_code
from (select p_partkey, case when p_partkey % 9 = 0 then null else p_brand end as p_brand from part)""")
def category_codes(t: Tables) -> DataFrame:
    brand = F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand"))
    return rel.category_codes(t.part.select("p_partkey", brand.alias("p_brand")), "p_brand", "brand_code")


@query("bands", """
select event_id, value, case when value >= 30 then 'Rain Warning' when value >= 15 then 'Rain Advisory' end as level,
 value * 0.5 as amount from events""")
def bands(t: Tables) -> DataFrame:
    level = c.band("value", [(30.0, "Rain Warning"), (15.0, "Rain Advisory")])
    return t.events.select("event_id", "value", level.alias("level"), (F.col("value") * 0.5).alias("amount"))


@query("advisory_only", "select event_id, value from events where value >= 15 and not (value >= 30)")
def advisory_only(t: Tables) -> DataFrame:
    return t.events.select("event_id", "value").filter((F.col("value") >= 15) & c.untrue(F.col("value") >= 30))


@query("clip", """
select event_id, case when v is not null then least(greatest(v, 2.0::double), 20.0::double) end as clipped,
 case when v is not null then greatest(v, 5.0::double) end as floored
from (select event_id, case when event_id % 6 = 0 then null else value end as v from events)""")
def clip(t: Tables) -> DataFrame:
    value = F.when(F.col("event_id") % 6 != 0, F.col("value"))
    return t.events.select(
        "event_id", c.clip(value, 2.0, 20.0).alias("clipped"), c.clip(value, 5.0).alias("floored")
    )


@query("vector_arith", """
select l_orderkey, l_linenumber, round_even((l_quantity * l_discount + sin(l_tax)) * 1e9, 0) / 1e9 as d,
 case when l_discount > 0.05 then l_discount + l_tax else l_discount - l_tax end as e from lineitem""")
def vector_arith(t: Tables) -> DataFrame:
    d = F.col("l_quantity") * F.col("l_discount") + F.sin("l_tax")
    e = F.when(F.col("l_discount") > 0.05, F.col("l_discount") + F.col("l_tax")).otherwise(
        F.col("l_discount") - F.col("l_tax")
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", c.half_even(d, 9).alias("d"), e.alias("e"))


@query("masked_sum", """
select l_orderkey, l_linenumber, cast(l_discount > 0.05 as integer) * (l_discount + l_tax)
 + cast(l_discount <= 0.05 as integer) * (l_discount - l_tax) as e from lineitem""")
def masked_sum(t: Tables) -> DataFrame:
    e = F.expr("int(l_discount > 0.05) * (l_discount + l_tax) + int(l_discount <= 0.05) * (l_discount - l_tax)")
    return t.lineitem.select("l_orderkey", "l_linenumber", e.alias("e"))


@query("word_lookup", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 else 0 end
 as urgency from orders""")
def word_lookup(t: Tables) -> DataFrame:
    table = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return t.orders.select("o_orderkey", c.lookup("o_orderpriority", table).alias("urgency"))


@query("public_paths", """
with p as (select p_partkey, case p_partkey % 3 when 0 then 'site/data/' when 1 then 'data/' else 'img/' end
 || p_partkey || '.jpg' as path from part)
select p_partkey, case when starts_with(path, 'site/data/') then '/' || substr(path, 6)
 when starts_with(path, 'data/') then '/' || path else '/data/' || path end as public_path from p""")
def public_paths(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    folder = F.when(key % 3 == 0, "site/data/").when(key % 3 == 1, "data/").otherwise("img/")
    path = F.concat(folder, key.cast("string"), F.lit(".jpg"))
    return t.part.select("p_partkey", c.public_path(path, "site/").alias("public_path"))


@query("display_price", """
select p_partkey, coalesce(case when p_partkey % 4 = 0 then null else p_name end, 'N/A') as title,
 printf('%.2f', p_retailprice) as price_text from part""")
def display_price(t: Tables) -> DataFrame:
    title = F.when(F.col("p_partkey") % 4 != 0, F.col("p_name"))
    return t.part.select("p_partkey", c.or_text(title).alias("title"), c.two_digits("p_retailprice").alias("price_text"))


@query("text_filters", """
select p_partkey, p_name, p_type from part where contains(coalesce(p_name, ''), 'ring') and starts_with(p_brand, 'Brand#1')
 and not (p_type = 'ECONOMY' or p_size < 5) and p_retailprice is not null""")
def text_filters(t: Tables) -> DataFrame:
    cond = c.all_of([
        c.contains("p_name", "ring"), F.col("p_brand").startswith("Brand#1"),
        c.untrue((F.col("p_type") == "ECONOMY") | (F.col("p_size") < 5)), ~c.is_missing("p_retailprice", True),
    ])
    return t.part.filter(cond).select("p_partkey", "p_name", "p_type")


@query("in_list", "select c_custkey, c_name from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def in_list(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_name")


@query("month_slice", """
select event_id, ts, value from events where ts >= '2024-01-01' and ts < '2024-02-01' and event_type = 'purchase'""")
def month_slice(t: Tables) -> DataFrame:
    january = t.events.filter(c.in_month("ts", 2024, 1))
    return january.filter(F.col("event_type") == "purchase").select("event_id", "ts", "value")


@query("order_month_slice", """
select o_orderkey, o_totalprice from orders where o_orderdate >= '1997-02-01' and o_orderdate < '1997-03-01'""")
def order_month_slice(t: Tables) -> DataFrame:
    return t.orders.filter(c.in_month("o_orderdate", 1997, 2)).select("o_orderkey", "o_totalprice")


# ---- text ----


@query("string_ops", r"""
select p_partkey, regexp_replace('  ' || p_name || chr(9) || ' ', '^\s+|\s+$', '', 'g') as stripped,
 split_part(p_name, ' ', 1) as first_word, nullif(split_part(p_name, ' ', 2), '') as second_word,
 replace(p_brand, '#', ' ') as brand_text, regexp_replace(p_brand || '_' || p_partkey, '_\d+', '', 'g') as brand_only,
 upper(p_type) as type_upper, p_name || ' ' || p_type as full_name from part""")
def string_ops(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    padded = t.part.withColumn("padded", F.concat(F.lit("  "), "p_name", F.lit("\t ")))
    parts = tx.split_to_columns(padded, "p_name", " ", ["first_word", "second_word"])
    return parts.select(
        "p_partkey", tx.strip_ws("padded").alias("stripped"), "first_word", "second_word",
        F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("brand_text"),
        F.regexp_replace(F.concat("p_brand", F.lit("_"), key), r"_\d+", "").alias("brand_only"),
        F.upper("p_type").alias("type_upper"), F.concat("p_name", F.lit(" "), "p_type").alias("full_name"),
    )


@query("concat_na", """
select c_custkey, 'Hello, ' || first || ' ' || coalesce(last, '[none]') as greeting
from (select c_custkey, case when c_custkey % 11 = 0 then null else c_mktsegment end as first,
 case when c_custkey % 3 = 0 then null else c_name end as last from customer)""")
def concat_na(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    first, last = F.when(key % 11 != 0, F.col("c_mktsegment")), F.when(key % 3 != 0, F.col("c_name"))
    greeting = tx.cat_with_na(F.concat(F.lit("Hello, "), first), [last], " ", "[none]")
    return t.customer.select("c_custkey", greeting.alias("greeting"))


@query("regex_findall", r"""
select c_custkey, array_to_string(regexp_extract_all(s, 'a.b'), '|') as any_char,
 array_to_string(regexp_extract_all(s, '\$\d+'), '|') as prices,
 array_to_string(regexp_extract_all(s, '[\d-]'), '|') as digits,
 array_to_string(regexp_extract_all(s, '[^\w\s]'), '|') as marks,
 array_to_string(regexp_extract_all(s, '010-\d{4}-\d{4}'), '|') as phones,
 array_to_string(regexp_extract_all(s, 'ca+t'), '|') as plus, array_to_string(regexp_extract_all(s, 'ca?t'), '|') as optional
from (select c_custkey, 'a_b, caat ct $' || c_nationkey || '; 010-' || lpad(cast(c_custkey % 10000 as varchar), 4, '0')
 || '-1234 cat ' || c_mktsegment as s from customer)""")
def regex_findall(t: Tables) -> DataFrame:
    s = F.concat(
        F.lit("a_b, caat ct $"), F.col("c_nationkey").cast("string"), F.lit("; 010-"),
        F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"), F.lit("-1234 cat "), F.col("c_mktsegment"),
    )
    patterns = {
        "any_char": "a.b", "prices": r"\$\d+", "digits": r"[\d-]", "marks": r"[^\w\s]",
        "phones": r"010-\d{4}-\d{4}", "plus": "ca+t", "optional": "ca?t",
    }
    rows = t.customer.select("c_custkey", s.alias("s"))
    return rows.select(
        "c_custkey", *[F.array_join(tx.find_all("s", p), "|").alias(n) for n, p in patterns.items()]
    )


@query("regex_anchors", """
select p_partkey, p_name, regexp_matches(p_name, '^red') as starts_red, regexp_matches(p_name, 'ring$') as ends_ring
from part where regexp_matches(p_name, '^(red|blue)|ring$')""")
def regex_anchors(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.filter(name.rlike("^(red|blue)|ring$")).select(
        "p_partkey", "p_name", name.rlike("^red").alias("starts_red"), name.rlike("ring$").alias("ends_ring")
    )


SLUG_A = r"""coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace({0}, '[^\p{{L}}\p{{N}}_\s-]', '', 'g'),
 '[\s_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), ''), 'untitled')"""
SLUG_B = r"""coalesce(nullif(left(replace(regexp_replace(regexp_replace(coalesce({0}, ''), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'),
 '^\s+|\s+$', '', 'g'), ' ', '-'), 120), ''), 'unknown')"""


@query("slugs", f"""
select doc_id, {SLUG_A.format('text')} as slug, {SLUG_B.format('text')} as plain_slug from documents""")
def slugs(t: Tables) -> DataFrame:
    return t.spread("documents", "doc_id").select("doc_id", tx.slug("text").alias("slug"), tx.plain_slug("text").alias("plain_slug"))


@query("url_parts", r"""
select page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) as path,
 regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host,
 case when regexp_matches(img, '\.jpe?g$') then 'jpg' when ends_with(img, '.png') then 'png' else 'jpg' end as ext,
 regexp_extract(img, '([^/]*)\.[^.]*$', 1) as stem
from (select *, '/media/p' || page_id || case page_id % 4 when 0 then '.jpeg' when 1 then '.png' when 2 then '.gif'
 else '.jpg' end as img from pages)""")
def url_parts(t: Tables) -> DataFrame:
    kind = F.get(F.array(*map(F.lit, (".jpeg", ".png", ".gif", ".jpg"))), (F.col("page_id") % 4).cast("int"))
    rows = t.pages.withColumn("img", F.concat(F.lit("/media/p"), F.col("page_id").cast("string"), kind))
    return rows.select(
        "page_id", tx.url_path("url").alias("path"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host"),
        tx.image_extension(F.concat("img", F.lit("?x=1.webp"))).alias("ext"), tx.file_stem("img").alias("stem"),
    )


@query("unique_names", """
select p_partkey, case when n = 1 then p_name else p_name || '-' || n end as file_name
from (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) as n from part)""")
def unique_names(t: Tables) -> DataFrame:
    return rel.unique_names(t.part.select("p_partkey", "p_name"), "p_name", "p_partkey", "file_name").drop("p_name")


@query("split_records", """
with r as (select event_id, case when event_id % 5 = 0 then event_type || '@@' || value
 else event_id || '@@' || event_type || '@@' || props end as line from events)
select event_id, split_part(line, '@@', 1) as id_text, split_part(line, '@@', 2) as kind, split_part(line, '@@', 3) as rest
from r where len(string_split(line, '@@')) = 3""")
def split_records(t: Tables) -> DataFrame:
    line = F.when(F.col("event_id") % 5 == 0, F.concat_ws("@@", "event_type", F.lit("x"), F.lit("y"), F.lit("z")))
    line = line.otherwise(F.concat_ws("@@", F.col("event_id").cast("string"), "event_type", "props"))
    rows = t.events.select("event_id", line.alias("line"))
    return tx.record_parts(rows, "line", "@@", ["id_text", "kind", "rest"]).drop("line")


@query("price_text", """
with r as (select p_partkey, case p_partkey % 4 when 0 then null when 1 then 'free' else ' Â£' ||
 cast(cast(p_retailprice as decimal(15,2)) as varchar) || ' ' end as raw from part)
select p_partkey, trim(replace(coalesce(raw, ''), 'Â', '')) as clean,
 try_cast(nullif(regexp_extract(raw, '[0-9.]+'), '') as float) as price from r""")
def price_text(t: Tables) -> DataFrame:
    kind = F.col("p_partkey") % 4
    price = F.concat(F.lit(" Â£"), c.money("p_retailprice").cast("string"), F.lit(" "))
    raw = F.when(kind == 0, F.lit(None)).when(kind == 1, "free").otherwise(price)
    rows = t.part.select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", tx.clean_money_text("raw").alias("clean"), tx.first_number("raw", "float").alias("price"))


# ---- JSON ----


@query("json_extract", """
select event_id, cast(json_extract(props, '$.k') as integer) as k, coalesce(cast(json_extract(props, '$.rain') as double), 0.0)
 as rain from events""")
def json_extract(t: Tables) -> DataFrame:
    rows = pl.parse_payload(t.events.select("event_id", "props"), "props", "k int, rain double")
    return rows.select("event_id", F.col("payload.k").alias("k"), pl.field_or("payload.rain", 0.0).alias("rain"))


@query("json_variant", """
select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
where cast(json_extract(props, '$.k') as bigint) > 50""")
def json_variant(t: Tables) -> DataFrame:
    k = pl.json_field("props", "$.k", "bigint").alias("k")
    return t.events.select("event_id", k).filter(F.col("k") > 50)


@query("explode_payload", """
select user_id, cast(i as integer) as position, event_id * 10 + i as record_id, event_type as kind
from events, generate_series(0, 1) g(i) where event_id % 13 <> 0""")
def explode_payload(t: Tables) -> DataFrame:
    record = F.array(*[
        F.struct(F.lit(i).alias("position"), (F.col("event_id") * 10 + i).alias("record_id"), F.col("event_type").alias("kind"))
        for i in (0, 1)
    ])
    body = F.when(F.col("event_id") % 13 == 0, F.lit('{"error": "none"}')).otherwise(
        F.to_json(F.struct(F.struct(record.alias("row")).alias("result")))
    )
    rows = t.events.select("user_id", body.alias("body"))
    parsed = pl.parse_payload(
        rows, "body", "result struct<row:array<struct<position:int,record_id:bigint,kind:string>>>"
    )
    return pl.explode_records(parsed, "payload.result.row", ["user_id"])


@query("record_json", """
select c_custkey, '{"id":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' as doc from customer""")
def record_json(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))).alias("doc")
    )


@query("pairs_map", """
select p_partkey, p_brand as brand, cast(p_size as varchar) as size, p_type as first_value from part""")
def pairs_map(t: Tables) -> DataFrame:
    keys = F.array(F.lit("type"), F.lit("brand"), F.lit("size"), F.lit("brand"))
    values = F.array(F.col("p_type"), F.lit("old"), F.col("p_size").cast("string"), F.col("p_brand"))
    rows = t.part.select("p_partkey", pl.pairs_to_map(keys, values).alias("m"), values.alias("v"))
    return rows.select(
        "p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["size"].alias("size"),
        pl.first_of("v").alias("first_value"),
    )


@query("mean_of_small_values", """
select event_type, round(avg(cast(value as double) / 1000), 9) as mean_value from events group by 1""")
def mean_of_small_values(t: Tables) -> DataFrame:
    rows = rel.partition_mean(t.events.select("event_type", (F.col("value") / 1000).alias("v")), ["event_type"], "v", "m")
    return rows.groupBy("event_type").agg(F.round(F.max("m"), 9).alias("mean_value"))


# x, x and x-2 in one table: the second x may not become x-2.
@query("unique_names_taken", """
with r as (select event_id, event_type || case event_id % 1000 when 7 then '-2' when 8 then '-3' else '' end as base from events)
select count(*) as n_rows, count(*) as n_names, count(distinct base) as n_kept from r""")
def unique_names_taken(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 1000
    base = F.concat("event_type", F.when(kind == 7, "-2").when(kind == 8, "-3").otherwise(""))
    named = rel.unique_names(t.events.select("event_id", base.alias("base")), "base", "event_id", "out")
    return named.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("out").alias("n_names"),
                     F.countDistinct(F.when(F.col("out") == F.col("base"), F.col("base"))).alias("n_kept"))
