"""File, partition and stream queries: each writes a table to the scratch folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import cents, coerce_types, exact_avg, exact_sum, money
from millrace.functions.temporal import parse_date
from millrace.plans import loglines
from millrace.plans.registry import Tables, query
from millrace.session import scratch
from millrace.sources import files
from millrace.streaming import jobs

CUSTOMER = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


@query("file_roundtrip_csv", CUSTOMER)
def file_roundtrip_csv(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    files.write_table(t.customer, path, "csv")
    return files.read_table(t.spark, path, "csv", schema=t.customer.schema)


@query("file_roundtrip_gz", CUSTOMER)
def file_roundtrip_gz(t: Tables) -> DataFrame:
    path = scratch(t.spark, "gz")
    files.write_table(t.customer, path, "csv", compression="gzip")
    return files.read_table(t.spark, path, "csv", schema=t.customer.schema)


@query("file_roundtrip_jsonl", "select doc_id, text, lang, source, n_chars from documents")
def file_roundtrip_jsonl(t: Tables) -> DataFrame:
    path = scratch(t.spark, "jsonl")
    files.write_table(t.documents, path, "jsonl")
    return files.read_table(t.spark, path, "jsonl", schema=t.documents.schema)


@query("file_roundtrip_parquet", "select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def file_roundtrip_parquet(t: Tables) -> DataFrame:
    path = scratch(t.spark, "parquet")
    files.write_table(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path, "parquet")
    return files.read_table(t.spark, path, "parquet")


@query("csv_first_upper", """
select upper(c_name) as c_name, c_mktsegment, cast(c_custkey as varchar) as c_custkey from customer""")
def csv_first_upper(t: Tables) -> DataFrame:
    path = scratch(t.spark, "upper")
    files.write_table(t.customer.select("c_name", "c_mktsegment", "c_custkey"), path, "csv")
    return files.with_first_upper(files.read_table(t.spark, path, "csv"))


@query("text_lines", """
select p_partkey // 700 as part, row_number() over (partition by p_partkey // 700 order by p_partkey) as line,
 p_name || '|' || p_partkey as value from part""")
def text_lines(t: Tables) -> DataFrame:
    """Lines of many files with the number of each in its file."""
    lines = t.part.select("p_partkey", F.concat_ws("|", "p_name", F.col("p_partkey").cast("string")).alias("value"))
    read = files.read_numbered_lines(t.spark, loglines.numbered_files(t, lines, "p_partkey", 700))
    return read.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "line", "value")


@query("json_array_scan", "select p_partkey as id, p_name as name from part")
def json_array_scan(t: Tables) -> DataFrame:
    """Documents of at most 100,000 records, one file each."""
    path = scratch(t.spark, "array")
    part = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    documents = part.groupBy(F.floor(F.col("id") / 100_000).alias("doc")).agg(
        F.to_json(F.collect_list(F.struct("id", "name"))).alias("value")
    )
    files.write_table(documents, path, "text", partition_by=["doc"])
    return files.read_table(t.spark, path, "json", schema="id bigint, name string").select("id", "name")


@query("partition_pruned_scan", f"""
select o_orderkey, o_totalprice, 1997 as part_year from orders where year(o_orderdate) = 1997""")
def partition_pruned_scan(t: Tables) -> DataFrame:
    path = scratch(t.spark, "years")
    files.write_year_partitions(t.orders, path, "o_orderdate", 1996, 2000)
    return files.read_year_partition(t.spark, path, 1997).select("o_orderkey", "o_totalprice", "part_year")


@query("year_buckets", """
select cast(least(greatest(year(o_orderdate), 1996), 2000) as integer) as part_year, count(*) as n from orders group by 1""")
def year_buckets(t: Tables) -> DataFrame:
    bucket = files.year_bucket("o_orderdate", 1996, 2000)
    return t.orders.groupBy(bucket.alias("part_year")).agg(F.count(F.lit(1)).alias("n"))


@query("record_load", """
select o_orderkey, cast(o_orderdate as date) as sold_on, cast(trunc(o_totalprice) as integer) as amount,
 cast(year(o_orderdate) as integer) as part_year from orders where o_orderkey % 6 not in (0, 1)""")
def record_load(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.when(key % 6 == 0, "").when(key % 6 == 1, "2024-99").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    raw = t.orders.select("o_orderkey", day.alias("sold_on"), money("o_totalprice").cast("string").alias("amount"))
    typed = raw.withColumn("sold_on", parse_date("sold_on", "yyyyMMdd")).filter(F.col("sold_on").isNotNull())
    typed = coerce_types(typed, {"amount": "number"})
    path = scratch(t.spark, "records")
    files.write_year_partitions(typed, path, "sold_on", 1900, 2100)
    return t.spark.read.parquet(path)


@query("sql_over_file", "select c_mktsegment, count(*) as n from customer where c_acctbal >= 100 group by 1")
def sql_over_file(t: Tables) -> DataFrame:
    path = f"{t.folder}/customer.parquet"
    return t.spark.sql(f"select c_mktsegment, count(*) as n from parquet.`{path}` where c_acctbal >= 100 group by 1")


@query("create_table_as", """
select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1""")
def create_table_as(t: Tables) -> DataFrame:
    path = scratch(t.spark, "ctas")
    name = "mart_" + path.rsplit("-", 1)[1]
    t.customer.createOrReplaceTempView(f"c_{name}")
    rows = t.spark.table(f"c_{name}").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    files.create_table_as(rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("n")), name, path)
    return t.spark.table(name)


@query("file_sizes", """
select p_brand as brand, sum(strlen(p_name || '|' || p_partkey) + 1)::bigint as length,
 case when length >= 1048576 then printf('%.2f MB', length / 1048576) when length >= 1024 then printf('%.2f KB', length / 1024) else printf('%d bytes', length) end as display, true as gzip_smaller
from part group by 1""")
def file_sizes(t: Tables) -> DataFrame:
    """Sizes of the files of each brand, whatever number of them, and whether compressed copies are smaller in all."""
    plain, packed = scratch(t.spark, "plain"), scratch(t.spark, "packed")
    rows = t.part.select("p_brand", F.concat_ws("|", "p_name", F.col("p_partkey").cast("string")).alias("value"))
    for path, compression in ((plain, None), (packed, "gzip")):
        files.write_table(rows, path, "text", partition_by=["p_brand"], compression=compression)
    brand = F.url_decode(F.regexp_extract("path", r"p_brand=([^/]*)/", 1)).alias("brand")
    sizes = files.file_sizes(t.spark, plain).groupBy(brand).agg(F.sum("length").alias("length"))
    whole = files.file_sizes(t.spark, plain).agg(F.sum("length")).scalar()
    other = files.file_sizes(t.spark, packed).agg(F.sum("length")).scalar()
    return sizes.select("brand", "length", files.shown_size("length").alias("display"), (other < whole).alias("gzip_smaller"))


# ---- streams ----


def _stream(t: Tables, name: str) -> DataFrame:
    like = t.spark.read.parquet(f"{t.folder}/{name}.parquet")
    return jobs.stream_files(t.spark, t.folder, like, pathGlobFilter=f"{name}.parquet")


@query("hourly_stream", """
select date_trunc('hour', ts) as window_start, cast(sum(cast(value as decimal(15,2))) as double) / count(value) as mean_value,
 cast(sum(cast(value as decimal(15,2))) as double) as total from events
group by 1 having date_trunc('hour', ts) + interval 1 hour <= (select max(ts) - interval 10 minutes from events)""")
def hourly_stream(t: Tables) -> DataFrame:
    aggregates = {"mean_value": exact_avg("value"), "total": exact_sum(cents("value"), 2).cast("double")}
    out, mark = scratch(t.spark, "hourly"), scratch(t.spark, "hourly-state")
    jobs.to_files(jobs.hourly(_stream(t, "events"), "ts", aggregates), out, mark).awaitTermination()
    return t.spark.read.parquet(out)


@query("alert_stream", """
select event_id, value, case when value >= 30 then 'Rain Warning' else 'Rain Advisory' end as level from events where value >= 15""")
def alert_stream(t: Tables) -> DataFrame:
    levels = [(30.0, "Rain Warning"), (15.0, "Rain Advisory")]
    out, mark = scratch(t.spark, "alerts"), scratch(t.spark, "alerts-state")
    found = jobs.alerts(_stream(t, "events").select("event_id", "value"), "value", levels)
    jobs.to_files(found, out, mark).awaitTermination()
    return t.spark.read.parquet(out)


@query("log_stream", f"""
select 'good' as kind, count(*) as n from {loglines.PARSED} where a or b
union all select 'bad', count(*) from {loglines.PARSED} where not (a or b)""")
def log_stream(t: Tables) -> DataFrame:
    source = scratch(t.spark, "lines")
    files.write_table(loglines.lines(t).select("value"), source, "text")
    good, bad, mark = (scratch(t.spark, x) for x in ("good", "bad", "logs-state"))
    jobs.tail_logs(t.spark.readStream.text(source), good, bad, mark).awaitTermination()
    n = F.count(F.lit(1)).alias("n")
    kept = t.spark.read.parquet(good).agg(n).select(F.lit("good").alias("kind"), "n")
    return kept.unionByName(t.spark.read.text(bad).agg(n).select(F.lit("bad").alias("kind"), "n"))


@query("keyed_load_stream", """
select p_name as title, coalesce(min(case when p_partkey < 50 then p_partkey end), min(case when p_partkey % 2 = 0 then p_partkey end),
 min(p_partkey)) as id from part group by 1""")
def keyed_load_stream(t: Tables) -> DataFrame:
    source = scratch(t.spark, "parts")
    rows = t.part.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("id"))
    meta, ids, mark = (scratch(t.spark, x) for x in ("meta", "ids", "load-state"))
    tables = {"meta": (meta, ["title", "id"]), "ids": (ids, ["title"])}
    # Four arrivals, each a batch of the same stream, which starts anew every time; the last one repeats the first.
    for arrival in (F.col("id") < 50, F.col("id") % 2 == 0, F.col("id") >= 50, F.col("id") < 50):
        files.write_table(rows.filter(arrival), source, "parquet", mode="append")
        jobs.keyed_load(jobs.stream_files(t.spark, source, rows), tables, "title", "id", mark).awaitTermination()
    return t.spark.read.parquet(meta).select("title", "id")
