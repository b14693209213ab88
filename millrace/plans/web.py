"""Web-page queries: the stored pages, and shop pages that Spark builds from the part table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import money
from millrace.functions.payload import first_of
from millrace.operators import web
from millrace.plans.registry import Tables, query

WORDS = ("Zero", "One", "Two", "Three", "Four", "Five")


@query("page_title", r"""
select page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') as title from pages""")
def page_title(t: Tables) -> DataFrame:
    return t.pages.select("page_id", web.page_title("html").alias("title"))


@query("page_links", """
select page_id, href from (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages)""")
def page_links(t: Tables) -> DataFrame:
    return web.extract_links(t.spread("pages", "page_id"), keep=("page_id",)).select("page_id", "href")


@query("page_absolute_links", r"""
select page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || href as link from (
 select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages)""")
def page_absolute_links(t: Tables) -> DataFrame:
    links = web.extract_links(t.spread("pages", "page_id"), keep=("page_id",))
    return links.select("page_id", "link")


@query("page_heading", r"""
select page_id, trim(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&')) as h1,
 trim(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&amp;', '&')) as title from pages""")
def page_heading(t: Tables) -> DataFrame:
    return web.with_parts(t.spread("pages", "page_id")).select("page_id", F.col("parts.h1").alias("h1"), F.col("parts.title").alias("title"))


def _price(c: Column | str) -> Column:
    return F.concat(F.lit("Â£"), money(c).cast("string"))


def listing_pages(t: Tables) -> DataFrame:
    """One listing page per part, with an item for each of four editions."""
    page, url_of = F.col("p_partkey"), "http://shop.example.com/list/page-"

    def item(i: Column) -> Column:
        number = (page * 4 + i).cast("string")
        word = F.get(F.array(*map(F.lit, WORDS)), ((page + i) % 6).cast("int"))
        return F.concat(
            F.lit('<li><article class="product_pod"><p class="star-rating '), word, F.lit('"></p><h3><a href="../item/'),
            number, F.lit('.html" title="'), F.col("p_name"), F.lit(" &amp; "), number, F.lit('">x</a></h3>'),
            F.lit('<p class="price_color">'), _price(F.col("p_retailprice") + i), F.lit("</p></article></li>"),
        )

    foot = F.concat(
        F.lit('</ol><ul class="pager"><li class="current"> Page '), page.cast("string"), F.lit(" of 50 </li>"),
        F.lit('<li class="next"><a href="page-'), (page + 1).cast("string"), F.lit('.html">next</a></li></ul>'),
    )
    items = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), item), "")
    head = F.lit("<html><body><script>var t='</p>'</script><ol>")
    return t.spread("part", "p_partkey").select(
        page.alias("page"), F.concat(F.lit(url_of), page.cast("string"), F.lit(".html")).alias("url"),
        F.concat(head, items, foot).alias("html"),
    )


@query("listing_items", """
select 'http://shop.example.com/list/page-' || p_partkey || '.html' as url, cast(i as integer) as position,
 p_name || ' & ' || (p_partkey * 4 + i) as title, cast(cast(p_retailprice + i as decimal(15,2)) as double) as price,
 cast((p_partkey + i) % 6 as integer) as rating, 'http://shop.example.com/item/' || (p_partkey * 4 + i) || '.html' as link
from part, generate_series(0, 3) g(i)""")
def listing_items(t: Tables) -> DataFrame:
    return web.extract_listing(listing_pages(t).drop("page"))


@query("page_navigation", """
select p_partkey as page, 'http://shop.example.com/list/page-' || (p_partkey + 1) || '.html' as next_url,
 50 as total_pages from part""")
def page_navigation(t: Tables) -> DataFrame:
    return web.page_navigation(listing_pages(t), keep=("page",)).drop("url")


def detail_pages(t: Tables) -> DataFrame:
    """One detail page per part; some lack the code, the price or the description."""
    key = F.col("p_partkey")
    id_text = key.cast("string")

    def row(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"<tr><th>{name}</th><td>"), F.lit(value) if isinstance(value, str) else value, F.lit("</td></tr>"))

    upc = F.when(key % 10 == 0, "").otherwise(row("UPC", F.concat(F.lit("u"), id_text)))
    price = F.when(key % 7 == 3, "").otherwise(F.concat(F.lit('<p class="price_color">'), _price("p_retailprice"), F.lit("</p>")))
    about = F.when(key % 4 == 1, "").otherwise(
        F.concat(F.lit('<div id="product_description"><h2>About</h2></div><p> About '), F.col("p_type"), F.lit(" <b>parts</b> </p>"))
    )
    html = F.concat(
        F.lit('<body><div class="item active"><img src="../../media/'), id_text, F.lit('.jpg"></div>'),
        F.lit('<div class="col product_main"><h1> '), F.col("p_name"), F.lit(" "), id_text, F.lit(" </h1>"), price, F.lit("</div>"),
        about, F.lit('<table class="table table-striped">'), upc, row("Product Type", F.col("p_type")),
        row("Price (excl. tax)", _price("p_retailprice")), row("Price (incl. tax)", _price("p_retailprice")), row("Tax", "Â£0.00"),
        row("Availability", F.concat(F.lit("In stock ("), F.col("p_size").cast("string"), F.lit(")"))),
        row("Number of reviews", F.when(key % 5 == 0, "many").otherwise((key % 9).cast("string"))), F.lit("</table></body>"),
    )
    url = F.concat(F.lit("http://shop.example.com/catalogue/p_"), id_text, F.lit("/index.html"))
    return t.spread("part", "p_partkey").select(url.alias("url"), html.alias("html"))


DETAIL = """select p_name || ' ' || p_partkey as title, case when p_partkey % 10 <> 0 then 'u' || p_partkey end as upc,
 p_type as product_type, '£' || cast(cast(p_retailprice as decimal(15,2)) as varchar) as price_excl_tax,
 '£' || cast(cast(p_retailprice as decimal(15,2)) as varchar) as price_incl_tax, '£0.00' as tax,
 'In stock (' || p_size || ')' as availability,
 case when p_partkey % 5 = 0 then 'many' else cast(p_partkey % 9 as varchar) end as num_reviews,
 case when p_partkey % 4 = 1 then '' else 'About ' || p_type || ' parts' end as description,
 'http://shop.example.com/media/' || p_partkey || '.jpg' as image_url,
 'http://shop.example.com/catalogue/p_' || p_partkey || '/index.html' as url from part"""


@query("page_detail_map", DETAIL)
def page_detail_map(t: Tables) -> DataFrame:
    return web.extract_detail(detail_pages(t))


@query("books_clean", f"""
select * replace (cast(regexp_extract(price_excl_tax, '[0-9.]+') as float) as price_excl_tax,
 cast(regexp_extract(price_incl_tax, '[0-9.]+') as float) as price_incl_tax,
 cast(regexp_extract(tax, '[0-9.]+') as float) as tax, try_cast(num_reviews as integer) as num_reviews) from ({DETAIL})""")
def books_clean(t: Tables) -> DataFrame:
    return web.clean_books(web.extract_detail(detail_pages(t)))


@query("reduced_detail", f"""
select title, cast(substr(price_incl_tax, 2) as float) as price, upc, image_url, url, coalesce(upc, replace(title, ' ', '-')) as id
from ({DETAIL}) where cast(regexp_extract(url, 'p_(\\d+)', 1) as bigint) % 7 <> 3""")
def reduced_detail(t: Tables) -> DataFrame:
    return web.reduced_detail(detail_pages(t))[0]


@query("detail_quarantine", f"""
select url from ({DETAIL}) where cast(regexp_extract(url, 'p_(\\d+)', 1) as bigint) % 7 = 3""")
def detail_quarantine(t: Tables) -> DataFrame:
    return web.reduced_detail(detail_pages(t))[1]


def recorded(request: dict) -> tuple[int, str]:
    """Transport that answers with the response recorded in the request row."""
    if request["status"] == 0:
        raise ConnectionError("no answer")
    return int(request["status"]), request["body"]


def _requests(t: Tables) -> DataFrame:
    """One request per customer, with its recorded answer: a JSON page of the customer."""
    key = F.col("c_custkey")
    status = F.when(key % 17 == 0, 503).when(key % 19 == 0, 404).when(key % 23 == 0, 0).otherwise(200)
    record = F.struct(key.alias("id"), F.col("c_mktsegment").alias("usage"), F.col("c_acctbal").cast("string").alias("amount"))
    body = F.when(key % 13 == 0, F.lit("{broken")).otherwise(
        F.to_json(F.struct(F.struct(F.array(record).alias("row")).alias("sales")))
    )
    url = F.concat(F.lit("http://api.example.com/customers/"), key.cast("string"))
    return t.customer.select(url.alias("url"), status.alias("status"), body.alias("body"))


OK = "c_custkey % 17 <> 0 and c_custkey % 19 <> 0 and c_custkey % 23 <> 0"


@query("fetch_pages", f"""
select 'http://api.example.com/customers/' || c_custkey as url,
 case when c_custkey % 17 = 0 then 'status 503' when c_custkey % 19 = 0 then 'status 404'
  when c_custkey % 23 = 0 then 'ConnectionError: no answer' end as error,
 cast(case when c_custkey % 17 = 0 then 3 when c_custkey % 19 = 0 then 1 when c_custkey % 23 = 0 then 3 else 1 end as integer)
  as attempts from customer""")
def fetch_pages(t: Tables) -> DataFrame:
    return web.fetch(_requests(t), recorded, parallelism=8, retries=2, backoff=0.0).select("url", "error", "attempts")


@query("rest_records", f"""
select 'http://api.example.com/customers/' || c_custkey as url, c_custkey as id, c_mktsegment as usage from customer
where {OK} and c_custkey % 13 <> 0 and contains(c_mktsegment, 'BUILD')""")
def rest_records(t: Tables) -> DataFrame:
    schema = "sales struct<row:array<struct<id:bigint,usage:string,amount:string>>>"
    rows = web.read_rest(_requests(t), recorded, schema, "sales.row", parallelism=8, retries=1, backoff=0.0)
    return rows.filter(F.col("usage").contains("BUILD")).select("url", "id", "usage")


@query("rest_default_record", f"""
select 'http://api.example.com/customers/' || c_custkey as url,
 case when {OK} and c_custkey % 13 <> 0 then c_mktsegment else 'unknown' end as usage, 26.0::double as temperature from customer""")
def rest_default_record(t: Tables) -> DataFrame:
    answers = web.fetch(_requests(t), recorded, parallelism=8, retries=0, backoff=0.0)
    schema = "sales struct<row:array<struct<id:bigint,usage:string,amount:string>>>, main struct<temp:double>"
    usage = first_of("payload.sales.row")["usage"]
    first = web.with_default_record(
        answers, schema, {"usage": (usage, "unknown"), "temperature": (F.col("payload.main.temp"), 26.0)}
    )
    return first.select("url", "usage", "temperature")
