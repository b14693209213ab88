"""Access-log parsing with a quarantine, error-line classes and reject records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip_ws
from millrace.functions.temporal import parse_log_time

# Line formats and the marker text that the parsed results must agree with.
COMBINED = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(\S+) (\S+) ([^"]+)" (\d+) (\S+) "([^"]*)" "([^"]*)"$'
)
EXTENDED = (
    r'^(\S+) - (\S+) \[([^\]]+)\] "(\S+) (\S+) ([^"]+)" (\d+) (\S+) "([^"]*)" "([^"]*)" "([^"]*)" (\S+)$'
)
BROKEN = "BROKEN LINE WITHOUT FIELDS"
REJECT_TYPE = "advertools_error"
INCOMPLETE = r'^"(.+)" (\d{3})$'
FULL = r'^(\S+) - (\S+) \[([^\]]+)\] "([^"]+)" (\d{3}) (\S+) "([^"]*)" "([^"]*)"$'
REJECTED = (
    r'^(\S+) - (\S+) \[([^\]]+)\] "([^"]+)" (\d{3}) (\S+) "([^"]*)" "([^"]*)" "([^"]+)" (\S+)$'
)

COMBINED_FIELDS = (
    "ip", "identd", "user", "timestamp", "method", "path", "protocol", "status", "size", "referer", "user_agent"
)
EXTENDED_FIELDS = (
    "ip", "user", "timestamp", "method", "path", "protocol", "status", "size", "referer", "user_agent",
    "host", "request_time",
)
FULL_FIELDS = ("ip", "user", "timestamp", "request", "status_code", "size", "referer", "user_agent")
REJECT_FIELDS = (
    "ip", "user", "timestamp", "request", "status_code", "bytes", "referer", "user_agent", "host", "response_time"
)
MARK, ESCAPE = "\u001f", "\u001e"


def _match(df: DataFrame, line: Column, pattern: str, fields: Sequence[str], out: str, only: Column | None = None) -> DataFrame:
    """Add the groups of an anchored pattern as a struct, null where the line does not match.

    One match per line: the groups are rewritten with a separator control character and split again, as a
    generated column, which later filters and projections do not repeat. A line that holds the separator itself is
    escaped first, by characters that the patterns treat alike, and its groups are turned back.
    """
    held = line.contains(MARK) | line.contains(ESCAPE)

    def hidden(x: Column) -> Column:
        return F.when(held, F.replace(F.replace(x, F.lit(ESCAPE), F.lit(ESCAPE + "a")), F.lit(MARK), F.lit(ESCAPE + "b"))).otherwise(x)

    def shown(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(ESCAPE + "b"), F.lit(MARK)), F.lit(ESCAPE + "a"), F.lit(ESCAPE))

    rewritten = F.regexp_replace(hidden(line), pattern, MARK.join(f"${i + 1}" for i in range(len(fields))))
    parts = F.split(rewritten, MARK, -1)
    once = df.select("*", F.explode(F.array(parts if only is None else F.when(only, parts))).alias("__parts"))
    plain = F.struct(*[F.get("__parts", F.lit(i)).alias(f) for i, f in enumerate(fields)])
    named = F.when(held, F.struct(*[shown(F.get("__parts", F.lit(i))).alias(f) for i, f in enumerate(fields)])).otherwise(plain)
    return once.withColumn(out, F.when(F.size("__parts") == len(fields), named)).drop("__parts")


def dash_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit("-"))


def whole_or_null(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+$"), c.try_cast("long"))


def read_lines(lines: DataFrame, c: str = "value") -> DataFrame:
    """Stripped, non-blank lines."""
    return lines.withColumn(c, strip_ws(c)).filter(F.col(c) != "")


def parse_access_logs(lines: DataFrame, c: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse each line by the first format that fits. Lines of neither format keep a null ``log_format``.

    A line with an unreadable time still parses; its ``ts`` is null and the raw text stays in ``timestamp``.
    """
    line = F.col(c)
    matched = _match(read_lines(lines, c), line, COMBINED, COMBINED_FIELDS, "__a")
    matched = _match(matched, line, EXTENDED, EXTENDED_FIELDS, "__b", only=F.col("__a").isNull())

    def pick(name: str) -> Column:
        a = F.col(f"__a.{name}") if name in COMBINED_FIELDS else F.lit(None).cast("string")
        b = F.col(f"__b.{name}") if name in EXTENDED_FIELDS else F.lit(None).cast("string")
        return F.coalesce(a, b)

    return matched.select(
        *keep,
        c,
        F.when(F.col("__a").isNotNull(), "apache_combined")
        .when(F.col("__b").isNotNull(), "nginx_combined").alias("log_format"),
        *[pick(f).alias(f) for f in ("ip", "identd", "user", "timestamp")],
        parse_log_time(pick("timestamp")).alias("ts"),
        *[pick(f).alias(f) for f in ("method", "path", "protocol")],
        pick("status").try_cast("int").alias("status"),
        whole_or_null(pick("size")).alias("size"),
        *[pick(f).alias(f) for f in ("referer", "user_agent", "host")],
        pick("request_time").try_cast("double").alias("request_time"),
    )


def split_rejects(parsed: DataFrame, c: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the raw lines of the quarantine with the columns to ``keep`` (file and line number, say)."""
    good = parsed.filter(F.col("log_format").isNotNull()).drop(c)
    return good, parsed.filter(F.col("log_format").isNull()).select(*keep, c)


def combined_table(parsed: DataFrame) -> DataFrame:
    """Typed table of combined-format rows under the column names of the log loader."""
    rows = parsed.filter(F.col("log_format") == "apache_combined")
    return rows.select(
        F.col("ip").alias("client"), F.col("user").alias("userid"), F.col("ts").alias("datetime"),
        "method", F.col("path").alias("request"), F.col("status").cast("smallint").alias("status"),
        "size", "referer", "user_agent",
    )


def enrich(parsed: DataFrame) -> DataFrame:
    """URL path and query, device class and operating system where the agent names them."""
    agent = F.col("user_agent")
    return parsed.withColumns({
        "url_path": F.regexp_extract("path", r"^([^?#]*)", 1),
        "url_query": F.nullif(F.regexp_extract("path", r"\?([^#]*)", 1), F.lit("")),
        "device_type": F.when(agent.rlike("iPad|Tablet"), "tablet")
        .when(agent.rlike("Mobile|iPhone|Android"), "mobile")
        .when(agent.rlike("Windows|Macintosh|X11"), "desktop"),
        "os": F.when(agent.rlike("iPhone|iPad"), "iOS")
        .when(agent.rlike("Android"), "Android")
        .when(agent.rlike("Windows"), "Windows")
        .when(agent.rlike("Mac OS X|Macintosh"), "macOS")
        .when(agent.rlike("Linux|X11"), "Linux"),
    })


def classify_error_lines(
    lines: DataFrame, c: str = "value", keep: Sequence[str] = (), unmatched: bool = True
) -> DataFrame:
    """Class and fields of the lines an access-log parser refused.

    Lines of no known class are kept as ``unmatched`` unless that is switched off.
    """
    line = F.col(c)
    broken = line.contains(BROKEN)
    parts = read_lines(lines, c)
    parts = _match(parts, line, INCOMPLETE, ("user_agent", "status_code"), "__i", only=~broken)
    parts = _match(parts, line, FULL, FULL_FIELDS, "__f", only=~broken & F.col("__i").isNull())
    kind = (
        F.when(broken, "corrupted")
        .when(F.col("__i").isNotNull(), "incomplete")
        .when(F.col("__f").isNotNull(), "full")
        .otherwise("unmatched")
    )
    out = parts.select(
        *keep,
        kind.alias("log_type"),
        F.when(kind.isin("corrupted", "unmatched"), line).alias("message"),
        *[F.col(f"__f.{f}").alias(f) for f in ("ip", "user", "timestamp", "request")],
        F.coalesce(F.col("__i.status_code"), F.col("__f.status_code")).try_cast("int").alias("status_code"),
        whole_or_null(F.col("__f.size")).alias("size"),
        F.col("__f.size").alias("size_raw"),
        dash_to_null(F.col("__f.referer")).alias("referer"),
        F.coalesce(F.col("__i.user_agent"), dash_to_null(F.col("__f.user_agent"))).alias("user_agent"),
    )
    return out if unmatched else out.filter(F.col("log_type") != "unmatched")


def parse_reject_records(
    lines: DataFrame, c: str = "value", keep: Sequence[str] = (), log_type: str = REJECT_TYPE
) -> DataFrame:
    """Records ``id@@line@@message``; others are dropped. Values of mixed type keep their raw text."""
    rows = read_lines(lines, c).withColumn("__p", F.split(F.col(c), "@@", -1)).filter(F.size("__p") == 3)
    middle = F.col("__p")[1]
    rows = _match(rows, middle, REJECTED, REJECT_FIELDS, "__m", only=middle.contains('] "')).filter(F.col("__m").isNotNull())
    m = F.col("__m")
    number = r"^\d*\.?\d*$"
    seconds = F.when(m["response_time"].rlike(number), m["response_time"].try_cast("double"))
    return rows.select(
        *keep,
        F.lit(log_type).alias("log_type"),
        whole_or_null(F.col("__p")[0]).alias("log_id"),
        F.col("__p")[0].alias("log_id_raw"),
        m["ip"].alias("ip"), m["user"].alias("user"),
        m["timestamp"].alias("timestamp_raw"), parse_log_time(m["timestamp"]).alias("timestamp"),
        m["request"].alias("request"), m["status_code"].try_cast("int").alias("status_code"),
        whole_or_null(m["bytes"]).alias("bytes"), m["bytes"].alias("bytes_raw"),
        dash_to_null(m["referer"]).alias("referer"), dash_to_null(m["user_agent"]).alias("user_agent"),
        m["host"].alias("host"),
        seconds.alias("response_time"), m["response_time"].alias("response_time_raw"),
        F.col("__p")[2].alias("error_message"),
    )


def parse_report(parsed: DataFrame) -> DataFrame:
    """Number of lines per outcome of the parse."""
    status = F.when(F.col("log_format").isNotNull(), "parsed").otherwise("rejected")
    return parsed.groupBy(status.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
