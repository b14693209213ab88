import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.functions import payload as pl
from millrace.functions import temporal as tm
from millrace.functions import text as tx


@pytest.fixture
def value(spark):
    """Evaluate one column on a one-row table."""
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


def test_half_even_and_guards(value):
    assert value(c.half_even(F.lit(0.125), 2)) == 0.12
    assert value(c.half_even(F.lit(2.5))) == 2.0
    assert value(c.percent_of(F.lit(1.0), F.lit(0.0))) is None
    assert value(c.divide_or_zero(F.lit(3.0), F.lit(0.0))) == 0.0
    assert value(c.divide_or_zero(F.lit(3.0), F.lit(None).cast("double"))) == 0.0


def test_number_or_zero(value):
    assert value(c.number_or_zero(F.lit("84.97"))) == 84
    assert value(c.number_or_zero(F.lit("84.97"), keep_fraction=True)) == 84.97
    assert value(c.number_or_zero(F.lit("n/a"))) == 0
    assert value(c.number_or_zero(F.lit(None).cast("string"))) == 0
    assert value(c.number_or_zero(F.lit("NaN"))) == 0


def test_clip_keeps_null(value):
    assert value(c.clip(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert value(c.clip(F.lit(-3.0), 0.0)) == 0.0
    assert value(c.clip(F.lit(130.0), 0.0, 100.0)) == 100.0


def test_band(value):
    levels = [(15.0, "advisory"), (30.0, "warning")]
    assert [value(c.band(F.lit(x), levels)) for x in (14.9, 15.0, 29.9, 30.0)] == [None, "advisory", "advisory", "warning"]


def test_lookup_and_paths(value):
    assert value(c.lookup(F.lit("Three"), {"Three": 3})) == 3
    assert value(c.lookup(F.lit("Many"), {"Three": 3})) == 0
    assert value(c.public_path(F.lit("ch/data/x.jpg"), "ch/")) == "/data/x.jpg"
    assert value(c.public_path(F.lit("data/x.jpg"), "ch/")) == "/data/x.jpg"
    assert value(c.public_path(F.lit("x.jpg"), "ch/")) == "/data/x.jpg"


def test_untrue_and_contains(value):
    unknown = F.lit(None).cast("boolean")
    assert value(c.untrue(unknown)) is True
    assert value(c.contains(F.lit(None).cast("string"), "x")) is False


def test_december_slice(spark):
    days = spark.sql("select timestamp_ntz'2024-12-31 23:59:59' as d union all select timestamp_ntz'2025-01-01 00:00:00'")
    assert days.filter(c.in_month("d", 2024, 12)).count() == 1


def test_strip_split_concat(spark, value):
    assert value(tx.strip_ws(F.lit("　 \thello world\r\n "))) == "hello world"
    row = tx.split_to_columns(spark.createDataFrame([("2023-10-27_A",)], "data string"), "data", "_", ["date", "category"])
    assert row.select("date", "category").first() == ("2023-10-27", "A")
    prefix = F.concat(F.lit("Hello, "), F.lit("Peter"))
    assert value(tx.cat_with_na(prefix, [F.lit(None).cast("string")], " ", "[none]")) == "Hello, Peter [none]"
    assert value(F.regexp_replace(F.lit("apple_100"), r"_\d+", "")) == "apple"


def test_find_all(value):
    assert value(tx.find_all(F.lit("apple, banana, a_b"), "a.b")) == ["a_b"]
    assert len(value(tx.find_all(F.lit("call 010-1234-5678"), r"[\d-]"))) == 13
    words = F.lit("caaat, caat, cat, ct")
    assert value(tx.find_all(words, "ca+t")) == ["caaat", "caat", "cat"]
    assert value(tx.find_all(words, "ca?t")) == ["cat", "ct"]


def test_slugs(value):
    assert value(tx.slug(F.lit("A Light in the_Attic!! — 2nd"))) == "A-Light-in-the-Attic-2nd"
    assert value(tx.slug(F.lit("별이 빛나는 밤"))) == "별이-빛나는-밤"
    assert value(tx.slug(F.lit("!!!"))) == "untitled"
    assert len(value(tx.slug(F.lit("a" * 200)))) == 80
    assert value(tx.plain_slug(F.lit(" It's  here "))) == "Its--here"
    assert value(tx.plain_slug(F.lit(None).cast("string"))) == "unknown"


def test_url_helpers(value):
    assert value(tx.image_extension(F.lit("http://a.b/c/d.JPEG?x=.png"))) == "jpg"
    assert value(tx.image_extension(F.lit("http://a.b/c/d.webp"))) == "webp"
    assert value(tx.image_extension(F.lit("http://a.b/c/d.svg"))) == "jpg"
    assert value(tx.image_extension(F.lit("http://a.b"))) == "jpg"
    assert value(tx.file_stem(F.lit("/x/y/abc.def.jpg"))) == "abc.def"
    assert value(tx.file_stem(F.lit(".hidden"))) == ".hidden"


def test_absolute_url(spark):
    df = spark.createDataFrame(
        [("http://a.b/c/d.html", "../e.jpg"), ("http://a.b/c/", "http://x.y/"), ("http://a.b", None), ("http://[", "x")],
        "base string, link string",
    )
    got = [r[0] for r in df.select(tx.absolute_url("base", "link")).collect()]
    assert got == ["http://a.b/e.jpg", "http://x.y/", None, None]


def test_price_text(value):
    assert value(tx.clean_money_text(F.lit(" Â£51.77 "))) == "£51.77"
    assert value(tx.clean_money_text(F.lit(None).cast("string"))) == ""
    assert value(tx.first_number(F.lit("£51.77"))) == 51.77
    assert value(tx.first_number(F.lit("free"))) is None


def test_record_parts(spark):
    df = spark.createDataFrame([("1@@b@@c",), ("1@@b",), ("1@@b@@c@@d",)], "line string")
    assert tx.record_parts(df, "line", "@@", ["a", "b", "c"]).select("a", "b", "c").collect() == [("1", "b", "c")]


def test_tolerant_dates(value):
    texts = ["2024-08-12", "2024/08/13", "invalid-date", "2024년 8월 15일"]
    assert [value(tm.parse_date(F.lit(t))) for t in texts] == [dt.date(2024, 8, 12), None, None, None]
    assert value(tm.parse_log_time(F.lit("17/Aug/2025:23:33:37 +0000"))) == dt.datetime(2025, 8, 17, 23, 33, 37)
    assert value(tm.parse_log_time(F.lit("bad/time/stamp"))) is None


def test_durations(value):
    a, b = F.lit("2023-10-01 09:00").cast("timestamp_ntz"), F.lit("2023-10-26 14:30").cast("timestamp_ntz")
    assert value(tm.whole_days(a, b)) == 25
    assert value(tm.seconds_between(a, b)) == 25 * 86_400 + 19_800
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    later = tm.shift(start, days=2, hours=3, minutes=30)
    assert value(tm.duration_days(start, later)) == 2.1458333333333335
    assert value(F.make_dt_interval(F.lit(2), F.lit(3), F.lit(30)) * 2) == dt.timedelta(days=4, hours=7)
    assert value(tm.whole_days(b, a)) == -26


def test_time_of_day(value):
    assert value(tm.time_text(tm.micros_of_day(14, 5, 9, 120))) == "14:05:09.000120"


def test_zone_and_year(value):
    noon = F.lit("2024-02-29 20:00").cast("timestamp_ntz")
    assert value(tm.to_zone(noon, "Asia/Seoul")) == dt.datetime(2024, 3, 1, 5, 0)
    assert value(tm.replace_year(noon, 2026, strict=False)) is None
    with pytest.raises(Exception, match="(?i)date"):
        value(tm.replace_year(noon, 2026))


def test_weekdays(spark):
    row = tm.calendar_parts(spark.sql("select timestamp_ntz'2024-08-14 10:11:12' as t"), "t").first()
    assert (row["weekday"], row["iso_weekday"], row["day_name"], row["quarter"]) == (2, 3, "Wednesday", 3)


def test_payload(spark, value):
    body = F.lit('{"main": {"temp": 1.5}, "weather": [{"id": 3}, {"id": 4}]}')
    assert value(pl.json_field(body, "$.main.temp", "double")) == 1.5
    assert value(pl.json_field(body, "$.rain", "double")) is None
    assert value(pl.json_field(F.lit("{broken"), "$.rain", "double")) is None
    df = pl.parse_payload(spark.range(1).select(body.alias("b")), "b", "weather array<struct<id:int>>")
    assert [r["id"] for r in pl.explode_records(df, "payload.weather").collect()] == [3, 4]
    keys, values = F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit("1"), F.lit("2"), F.lit("3"))
    assert value(pl.pairs_to_map(keys, values)) == {"b": "2", "a": "3"}


def test_audit_time(spark):
    assert tm.with_audit_time(spark.range(1)).first()["loaded_at"].year >= 2024


def test_exact_sum(spark):
    values = [0.1] * 30 + [-0.25, -1e9, 123456789.99, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    total = df.agg(c.exact_sum(c.cents("x"), 2).alias("s")).first()["s"]
    assert str(total) == "-876543207.26"
    assert df.filter("x is null").agg(c.exact_sum(c.cents("x"), 2), c.exact_avg("x")).first()[:] == (None, None)
