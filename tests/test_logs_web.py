import pyarrow as pa
import pytest

from millrace.operators import logs, web

AGENT = '"cart-sync/3 (batch; nightly)"'
REJECTED = (
    [logs.BROKEN, f"12:00 {logs.BROKEN}"] + [f"{AGENT} {s}" for s in (204, 418, 599)]
    + [f'172.16.4.{i} - - [02/Mar/2024:01:00:0{i} +0000] "GET /img/{i}.png HTTP' for i in range(4)]
)
LINES = [
    '10.0.0.5 - bob [14/Aug/2025:09:15:31 +0000] "GET /a?x=1 HTTP/1.1" 200 512 "-" "curl"',
    '10.0.0.5 - - [14/Aug/2025:09:15:31 +0000] "GET /b HTTP/2.0" 404 - "http://r" "UA" "example.com" 0.521',
    '172.16.4.1 ident eve [noon yesterday] "PUT /cart HTTP/2.0" 204 0 "-" "-"',
    '172.16.4.1 ident eve [noon] "PUT /cart HTTP/2.0" 204 0 "-" "-" "h" 0.1',
    "   ",
    "",
    '10.0.0.5 - - [14/Aug/2025:09:15:31 +0000] "GET /a\u001f HTTP/1.1" 200 512 "-" "curl"',
]


def text(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_formats_and_quarantine(spark):
    parsed = logs.parse_access_logs(text(spark, LINES)).collect()
    assert [r["log_format"] for r in parsed] == ["apache_combined", "nginx_combined", "apache_combined", None, "apache_combined"]
    first, second, third = parsed[:3]
    assert parsed[4]["path"] == "/a\u001f"
    assert (first["identd"], first["user"], first["status"], first["size"]) == ("-", "bob", 200, 512)
    assert (second["identd"], second["host"], second["request_time"], second["size"]) == (None, "example.com", 0.521, None)
    assert (third["ts"], third["timestamp"]) == (None, "noon yesterday")
    report = {r["outcome"]: r["n"] for r in logs.parse_report(logs.parse_access_logs(text(spark, LINES))).collect()}
    assert report == {"parsed": 4, "rejected": 1}


def test_enrich(spark):
    row = logs.enrich(logs.parse_access_logs(text(spark, LINES[:1]))).first()
    assert (row["url_path"], row["url_query"], row["os"]) == ("/a", "x=1", None)


def test_error_line_classes(spark):
    rows = logs.classify_error_lines(text(spark, REJECTED))
    counts = {r["log_type"]: r["count"] for r in rows.groupBy("log_type").count().collect()}
    assert counts == {"corrupted": 2, "incomplete": 3, "unmatched": 4}
    assert logs.classify_error_lines(text(spark, REJECTED), unmatched=False).count() == 5
    full = '10.0.0.5 - - [x] "GET / HTTP/1.1" 200 12k "-" "UA"'
    row = logs.classify_error_lines(text(spark, [full])).first()
    assert (row["log_type"], row["size"], row["size_raw"], row["referer"], row["user_agent"]) == ("full", None, "12k", None, "UA")


def test_reject_records(spark):
    line = '10.0.0.5 - - [14/Aug/2025:09:15:31 +0000] "GET /b HTTP/2.0" 404 - "http://r" "UA" "example.com" 0.521'
    records = [f"7@@{line}@@oops", f"x7@@{line.replace('0.521', 'slow')}@@oops", f"7@@{line}", "7@@nonsense@@oops"]
    rows = logs.parse_reject_records(text(spark, records)).collect()
    assert [(r["log_id"], r["log_id_raw"], r["response_time"], r["response_time_raw"]) for r in rows] == [
        (7, "7", 0.521, "0.521"), (None, "x7", None, "slow")
    ]
    assert {r["log_type"] for r in rows} == {logs.REJECT_TYPE}
    assert {r["log_type"] for r in logs.parse_reject_records(text(spark, records), log_type="mine").collect()} == {"mine"}
    assert rows[0]["bytes"] is None and rows[0]["bytes_raw"] == "-" and str(rows[0]["timestamp"]) == "2025-08-14 09:15:31"


LISTING = """<html><head><title>All &amp; more</title><script>var a = "<article class='product_pod'>";</script></head>
<!-- <article class="product_pod"> -->
<article class="product_pod"><p class="star-rating Three"></p><h3><a href="../a/1.html" title="It's &lt;b&gt;">It..</a></h3>
<div><p class="price_color">Â£51.77</p></div></article>
<article class="product_pod"><p class="star-rating Many"></p><h3><a href="2.html" title="Two">Two</a></h3></article>
<ul><li class="current">Page 2 of 50</li><li class="next"><a href="page-3.html">next</a></li></ul>"""


def pages(spark, *html):
    return spark.createDataFrame([(f"http://h/x/{i}.html", h) for i, h in enumerate(html)], "url string, html string")


def test_listing(spark):
    rows = [tuple(r)[2:] for r in web.extract_listing(pages(spark, LISTING, "", None)).collect()]
    assert rows == [("It's <b>", 51.77, 3, "http://h/a/1.html"), ("Two", None, 0, "http://h/x/2.html")]


def test_navigation(spark):
    rows = web.page_navigation(pages(spark, LISTING, "<p>alone</p>")).collect()
    assert [tuple(r)[1:] for r in rows] == [("http://h/x/page-3.html", 50), (None, None)]


def test_detail_and_quarantine(spark):
    good = """<div class="product_main"><h1>A <i>b</i></h1><p class="price_color">£7.10</p></div><img src="../i.png"/>
    <div id="product_description"><p>heading</p></div><span>-</span><p>Long text</p><table class="table table-striped">
    <tr><th>UPC</th><td>u1</td></tr><tr><th>Tax</th><td>Â£0.00</td></tr></table>"""
    rows = web.extract_detail(pages(spark, good, "<p>nothing")).collect()
    first = rows[0].asDict()
    assert {k: first[k] for k in ("title", "upc", "tax", "product_type", "description", "image_url", "num_reviews")} == {
        "title": "A b", "upc": "u1", "tax": "£0.00", "product_type": "", "description": "Long text",
        "image_url": "http://h/i.png", "num_reviews": None,
    }
    assert rows[1]["title"] is None and rows[1]["upc"] is None
    kept, bad = web.reduced_detail(pages(spark, good, "<p>nothing"))
    assert [(r["id"], r["price"]) for r in kept.collect()] == [("u1", pytest.approx(7.1))]
    assert [r["url"] for r in bad.collect()] == ["http://h/x/1.html"]


def test_title_pattern(spark):
    html = "<TITLE lang='en'>\nTwo lines\n</TITLE><title>second</title>"
    row = pages(spark, html, "none").select(web.page_title("html").alias("t")).collect()
    assert [r["t"] for r in row] == ["\nTwo lines\n", None]


def test_fetch_retries(spark, tmp_path):
    """Overload is tried again; other errors are not; no failure ends the job."""
    def transport(request):
        path = tmp_path / request["url"]
        tries = int(path.read_text()) if path.exists() else 0
        path.write_text(str(tries + 1))
        if request["url"] == "down":
            raise OSError("no route")
        return (503, "") if request["url"] == "busy" and tries < 2 else (404 if request["url"] == "gone" else 200, "{}")

    urls = spark.createDataFrame([(u,) for u in ("ok", "busy", "gone", "down")], "url string")
    got = {r["url"]: (r["status"], r["error"], r["attempts"]) for r in web.fetch(urls, transport, 2, 3, 0.0).collect()}
    assert got == {
        "ok": (200, None, 1), "busy": (200, None, 3), "gone": (404, "status 404", 1), "down": (None, "OSError: no route", 4)
    }


def test_each_page_is_parsed_once(spark):
    plan = web.reduced_detail(pages(spark, LISTING))[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_parts(") == 1


def test_description_is_the_next_sibling():
    other = '<div><div id="product_description"><h2>D</h2></div></div><div><p>of another block</p></div><p>later</p>'
    assert "description" not in web.read_page(other)
    assert web.read_page('<div id="product_description"></div>\n<p>one</p><p>two</p>')["description"] == "one"


def test_unclosed_tags_cost_linear_time():
    import time

    began = time.perf_counter()
    page = web.read_page("<h1>t</h1>" + "<p><b>word <li class=current>" * 40_000)
    assert page["h1"] == "t" and time.perf_counter() - began < 10


def test_pages_are_returned_some_at_a_time():
    """A large batch is never held as parsed objects in whole; empty, null and broken pages have their row."""
    pages = [f"<title>t{i}</title><a href='x{i}'>x</a>" for i in range(450)] + [None, "", "<li"]
    parts = list(web.page_parts.func(iter([pa.array(pages, pa.string()), pa.array([], pa.string())])))
    assert max(map(len, parts)) <= web.PAGES < len(pages) and all(p.type == web.PAGE_ARROW for p in parts)
    got = [row for part in parts for row in part.to_pylist()]
    assert [r["title"] for r in got] == [f"t{i}" for i in range(450)] + [None] * 3
    assert [r["links"] for r in got] == [[f"x{i}"] for i in range(450)] + [[]] * 3
