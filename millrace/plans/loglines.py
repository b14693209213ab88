"""Log queries over text lines that are built from the events table, with known content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.functions.temporal import log_time_text
from millrace.operators import documents as docs
from millrace.operators import logs
from millrace.operators.relational import compare_versions
from millrace.plans.registry import Tables, query
from millrace.session import scratch, settle
from millrace.sources import files

STAMP = "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'"
STATUS = "case event_id % 4 when 0 then '200' when 1 then '404' when 2 then '500' else '301' end"
SIZE = "case when event_id % 9 = 0 then '-' else cast(event_id * 7 as varchar) end"
AGENT = """case event_id % 3 when 0 then 'Mozilla/5.0 (Windows NT 10.0; Win64; x64)'
 when 1 then 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) Mobile' else '-' end"""
HEAD = f"""'10.0.' || user_id % 256 || '.' || event_id % 256 || ' - ' || case when user_id % 4 = 0 then '-' else 'u' || user_id end
 || ' [' || {STAMP} || '] "GET /' || event_type || case when event_id % 5 = 0 then '?k=' || user_id else '' end
 || ' HTTP/1.1" ' || {STATUS} || ' ' || {SIZE} || ' "-" "' || {AGENT} || '"'"""
# One line in five is malformed: the marker, an agent with a status only, no date in the brackets, a blank, a cut quote.
LINES = f"""(select event_id, ts, user_id, event_type, case
 when event_id % 25 = 20 then '{logs.BROKEN}' when event_id % 25 = 21 then '"agent x" ' || {STATUS}
 when event_id % 25 = 22 then '172.16.4.' || user_id % 256 || ' - eve [noon yesterday] "PUT /cart/' || user_id || ' HTTP/2.0" 204 0 "-" "cart-sync/3"'
 when event_id % 25 = 23 then ' '
 when event_id % 25 = 24 then '172.16.4.9 - - [' || {STAMP} || '] "GET /img/' || event_id || '.png HTTP'
 when event_id % 2 = 0 then {HEAD}
 else {HEAD} || ' "h' || user_id % 3 || '.example.com" ' || printf('%.3f', event_id % 1000 / 1000.0) end as value from events)"""


def lines(t: Tables) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    stamp = log_time_text("ts")
    status = F.get(F.array(*map(F.lit, ("200", "404", "500", "301"))), (e % 4).cast("int"))
    size = F.when(e % 9 == 0, "-").otherwise((e * 7).cast("string"))
    agent = (
        F.when(e % 3 == 0, "Mozilla/5.0 (Windows NT 10.0; Win64; x64)")
        .when(e % 3 == 1, "Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) Mobile").otherwise("-")
    )
    user = F.when(u % 4 == 0, "-").otherwise(F.concat(F.lit("u"), u.cast("string")))
    extra = F.when(e % 5 == 0, F.concat(F.lit("?k="), u.cast("string"))).otherwise("")
    head = F.concat(
        F.format_string("10.0.%d.%d - %s [", u % 256, e % 256, user), stamp, F.lit('] "GET /'), F.col("event_type"),
        extra, F.lit(' HTTP/1.1" '), status, F.lit(" "), size, F.lit(' "-" "'), agent, F.lit('"'),
    )
    millis = F.lpad((e % 1000).cast("string"), 3, "0")
    kind = e % 25
    value = (
        F.when(kind == 20, logs.BROKEN).when(kind == 21, F.concat(F.lit('"agent x" '), status))
        .when(kind == 22, F.format_string(
            '172.16.4.%d - eve [noon yesterday] "PUT /cart/%d HTTP/2.0" 204 0 "-" "cart-sync/3"', u % 256, u))
        .when(kind == 23, " ")
        .when(kind == 24, F.concat(F.lit("172.16.4.9 - - ["), stamp, F.format_string('] "GET /img/%d.png HTTP', e)))
        .when(e % 2 == 0, head)
        .otherwise(F.concat(head, F.format_string(' "h%d.example.com" 0.', u % 3), millis))
    )
    return t.spread("events", "event_id").select("event_id", value.alias("value"))


# The line formats of operators/logs.py as the oracle needs them: without their ends, or in parts.
BASE = r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(\S+) (\S+) ([^"]+)" (\d+) (\S+) "([^"]*)" "([^"]*)"'
PARSED = f"""(select event_id, value, regexp_matches(value, '{BASE}$') as a,
 regexp_matches(value, '{BASE} "([^"]*)" (\\S+)$') and regexp_extract(value, '{BASE}', 2) = '-' as b from {LINES}
 where trim(value) <> '')"""


TAIL = r'" (\d+) (\S+) "([^"]*)" "([^"]*)"'


def _part(i: int) -> str:
    return f"regexp_extract(value, '{BASE}', {i})" if i < 10 else f"regexp_extract(value, '{TAIL}', {i - 7})"


PARSE_SQL = f"""
select event_id, case when a then 'apache_combined' else 'nginx_combined' end as log_format, {_part(1)} as ip,
 case when a then {_part(2)} end as identd, {_part(3)} as user, {_part(4)} as timestamp,
 case when {_part(4)} not like 'noon%' then strptime(left({_part(4)}, 20), '%d/%b/%Y:%H:%M:%S') end as ts,
 {_part(5)} as method, {_part(6)} as path, {_part(7)} as protocol, cast({_part(8)} as integer) as status,
 try_cast({_part(9)} as bigint) as size, {_part(10)} as referer, {_part(11)} as user_agent,
 case when b then regexp_extract(value, '" "([^"]*)" \\S+$', 1) end as host,
 case when b then cast(regexp_extract(value, ' (\\S+)$', 1) as double) end as request_time
from {PARSED} where a or b"""


def parsed(t: Tables) -> DataFrame:
    return logs.parse_access_logs(lines(t), keep=["event_id"])


@query("access_log_parse", PARSE_SQL)
def access_log_parse(t: Tables) -> DataFrame:
    return logs.split_rejects(parsed(t))[0]


#: Lines of one file.
FILE_LINES = 2000


@query("log_reject_split", f"""
select event_id // {FILE_LINES} as part, line, value from (select *, regexp_matches(value, '{BASE}$') as a,
 regexp_matches(value, '{BASE} "([^"]*)" (\\S+)$') and regexp_extract(value, '{BASE}', 2) = '-' as b from (
 select event_id, row_number() over (partition by event_id // {FILE_LINES} order by event_id) as line, value from {LINES})
 where trim(value) <> '') where not (a or b)""")
def log_reject_split(t: Tables) -> DataFrame:
    """Rejected lines of many files with the number of each in its file (blank lines count)."""
    numbered = files.read_numbered_lines(t.spark, numbered_files(t, lines(t), "event_id", FILE_LINES))
    parsed = logs.parse_access_logs(numbered, keep=["file", "line"])
    rejects = logs.split_rejects(parsed, keep=["file", "line"])[1]
    return rejects.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "line", "value")


def numbered_files(t: Tables, rows: DataFrame, key: str, size: int) -> str:
    """Write lines (``value``) into one file per ``size`` keys, in the order of the key."""
    path = scratch(t.spark, "lines")
    dealt = rows.withColumn("part", F.floor(F.col(key) / size).cast("long")).repartition("part").sortWithinPartitions("part", key)
    dealt.select("part", "value").write.partitionBy("part").text(path)
    return path


@query("log_parse_report", f"""
select case when a or b then 'parsed' else 'rejected' end as outcome, count(*) as n from {PARSED} group by 1""")
def log_parse_report(t: Tables) -> DataFrame:
    return logs.parse_report(parsed(t))


@query("combined_log_table", f"""
select ip as client, user as userid, ts as datetime, method, path as request, cast(status as smallint) as status, size,
 referer, user_agent from ({PARSE_SQL}) where log_format = 'apache_combined'""")
def combined_log_table(t: Tables) -> DataFrame:
    return logs.combined_table(logs.parse_access_logs(lines(t)))


@query("log_enrich", f"""
select event_id, split_part(path, '?', 1) as url_path, nullif(split_part(path, '?', 2), '') as url_query,
 case when contains(user_agent, 'iPhone') then 'mobile' when contains(user_agent, 'Windows') then 'desktop' end as device_type,
 case when contains(user_agent, 'iPhone') then 'iOS' when contains(user_agent, 'Windows') then 'Windows' end as os
from ({PARSE_SQL})""")
def log_enrich(t: Tables) -> DataFrame:
    rows = logs.enrich(logs.split_rejects(parsed(t))[0])
    return rows.select("event_id", "url_path", "url_query", "device_type", "os")


FULL_SQL = r'^(\S+) - (\S+) \[([^\]]+)\] "([^"]+)" (\d{3}) (\S+) "([^"]*)" "([^"]*)"$'


def _full(i: int) -> str:
    return f"case when f then regexp_extract(value, '{FULL_SQL}', {i}) end"


CLASSES = f"""
select event_id, case when broken then 'corrupted' when i then 'incomplete' when f then 'full' else 'unmatched' end as log_type,
 case when broken or not (i or f) then value end as message, {_full(1)} as ip, {_full(2)} as user, {_full(3)} as timestamp,
 {_full(4)} as request, cast(case when i then regexp_extract(value, '(\\d+)$', 1) else {_full(5)} end as integer) as status_code,
 try_cast({_full(6)} as bigint) as size, {_full(6)} as size_raw, nullif({_full(7)}, '-') as referer,
 case when i then 'agent x' else nullif({_full(8)}, '-') end as user_agent
from (select *, contains(value, 'BROKEN LINE') as broken, regexp_matches(value, '^"(.+)" (\\d{{3}})$') as i,
 regexp_matches(value, '{FULL_SQL}') as f from {LINES} where trim(value) <> '')"""


@query("error_line_classes", CLASSES)
def error_line_classes(t: Tables) -> DataFrame:
    return logs.classify_error_lines(lines(t), keep=["event_id"])


REJECTS = f"""(select event_id, case when event_id % 10 = 3 then event_id || '@@' || value
 else case when event_id % 10 = 4 then 'x' || event_id else cast(event_id as varchar) end || '@@' || value || '@@list index out of range' end
 as value from {LINES} where trim(value) <> '')"""


def reject_lines(t: Tables) -> DataFrame:
    e = F.col("event_id")
    rows = logs.read_lines(lines(t))
    key = F.when(e % 10 == 4, F.concat(F.lit("x"), e.cast("string"))).otherwise(e.cast("string"))
    record = F.when(e % 10 == 3, F.concat_ws("@@", e.cast("string"), "value")).otherwise(
        F.concat_ws("@@", key, "value", F.lit("list index out of range"))
    )
    return rows.withColumn("value", record)


REJ = r'@@(\S+) - (\S+) \[([^\]]+)\] "([^"]+)" (\d{3}) (\S+) "([^"]*)" "([^"]*)" "([^"]+)" (\S+)@@'


def _rej(i: int) -> str:
    return f"regexp_extract(value, '{REJ}', {i})" if i < 10 else "regexp_extract(value, '\" (\\S+)@@list', 1)"


REJECT_SQL = f"""
select event_id, '{logs.REJECT_TYPE}' as log_type, try_cast(split_part(value, '@@', 1) as bigint) as log_id, split_part(value, '@@', 1) as log_id_raw,
 {_rej(1)} as ip, {_rej(2)} as user, {_rej(3)} as timestamp_raw, strptime(left({_rej(3)}, 20), '%d/%b/%Y:%H:%M:%S') as timestamp,
 {_rej(4)} as request, cast({_rej(5)} as integer) as status_code, try_cast({_rej(6)} as bigint) as bytes, {_rej(6)} as bytes_raw,
 nullif({_rej(7)}, '-') as referer, nullif({_rej(8)}, '-') as user_agent, {_rej(9)} as host,
 cast({_rej(10)} as double) as response_time, {_rej(10)} as response_time_raw, 'list index out of range' as error_message
from {REJECTS} where regexp_matches(value, '{REJ}')"""


def rejects(t: Tables) -> DataFrame:
    return logs.parse_reject_records(reject_lines(t), keep=["event_id"])


@query("reject_records", REJECT_SQL)
def reject_records(t: Tables) -> DataFrame:
    return rejects(t)


# ---- document queries over the parsed records ----


@query("doc_find", f"select event_id, status_code, host from ({REJECT_SQL}) where status_code = 404 and host = 'h1.example.com'")
def doc_find(t: Tables) -> DataFrame:
    return docs.find(rejects(t), {"status_code": 404, "host": "h1.example.com"}).select("event_id", "status_code", "host")


@query("doc_gt", f"select event_id, response_time_raw, bytes_raw from ({REJECT_SQL}) where response_time > 0.5 and bytes >= 7000")
def doc_gt(t: Tables) -> DataFrame:
    found = docs.find(rejects(t), {"response_time_raw": {"$gt": 0.5}, "bytes_raw": {"$gte": 7000}})
    return found.select("event_id", "response_time_raw", "bytes_raw")


@query("doc_count", f"""
select count(*) filter (where log_type = 'incomplete') as n_incomplete, count(*) as n_total from ({CLASSES})""")
def doc_count(t: Tables) -> DataFrame:
    return error_line_classes(t).agg(
        F.count_if(F.col("log_type") == "incomplete").alias("n_incomplete"), F.count(F.lit(1)).alias("n_total")
    )


@query("doc_first5", f"select event_id, log_type from ({CLASSES}) order by event_id limit 5")
def doc_first5(t: Tables) -> DataFrame:
    return docs.find(error_line_classes(t), {}, limit=5, order=["event_id"]).select("event_id", "log_type")


@query("doc_ids", """
select sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}') as _id,
 c_custkey from customer""")
def doc_ids(t: Tables) -> DataFrame:
    return docs.with_ids(t.customer.select("c_custkey", "c_name", "c_mktsegment")).select("_id", "c_custkey")


@query("doc_revision_diff", f"""
select event_id, true as log_type_changed, true as ip_changed, false as status_code_changed, 'incomplete_modified' as new_log_type
from ({CLASSES}) where log_type = 'incomplete'""")
def doc_revision_diff(t: Tables) -> DataFrame:
    collection = settle(docs.with_ids(error_line_classes(t)), "documents")
    stored = collection.withColumn("source_doc_id", F.lit(None).cast("string"))
    picked = stored.filter(F.col("log_type") == "incomplete").drop("source_doc_id")
    revised = docs.derive_revision(
        picked, "_id", {"log_type": F.lit("incomplete_modified"), "ip": F.lit("192.168.1.100")}, "source_doc_id"
    )
    both = stored.unionByName(revised)
    pairs = compare_versions(both, "_id", "source_doc_id", ["event_id", "log_type", "ip", "status_code"])
    return pairs.select(
        F.col("old_event_id").alias("event_id"), "log_type_changed", "ip_changed", "status_code_changed", "new_log_type"
    )


@query("log_delete_range", f"""
select event_id, ts from ({PARSE_SQL}) where not coalesce(ts >= '2024-01-08 10:00:00' and ts < '2024-01-10 15:00:00', false)""")
def log_delete_range(t: Tables) -> DataFrame:
    rows = logs.split_rejects(parsed(t))[0].select("event_id", "ts")
    return docs.delete_where(rows, c.in_period("ts", "2024-01-08 10:00:00", "2024-01-10 15:00:00"))


@query("log_delete_report", f"""
select count(*) filter (where ts >= '2024-01-08 10:00:00' and ts < '2024-01-10 15:00:00') as deleted,
 count(*) - deleted as remaining from ({PARSE_SQL})""")
def log_delete_report(t: Tables) -> DataFrame:
    rows = logs.split_rejects(parsed(t))[0]
    return docs.delete_report(rows, c.in_period("ts", "2024-01-08 10:00:00", "2024-01-10 15:00:00"))
