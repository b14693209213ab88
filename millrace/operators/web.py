"""Records from stored web pages, and a fetch job with an injected transport."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from millrace.functions.columns import col, lookup
from millrace.functions.payload import explode_records, pairs_to_map, parse_payload
from millrace.functions.text import absolute_url, clean_money_text, first_number, plain_slug

# Rating words and retried statuses.
RATINGS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
RETRY_STATUS = (429, 500, 502, 503, 504)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

TEXT, TEXTS = StringType(), ArrayType(StringType())
ITEM = StructType([StructField(f, TEXT) for f in ("title", "link", "price", "rating")])
PAGE_TEXTS = (
    "title", "h1", "main_h1", "price", "description", "main_image", "first_image", "next_link", "current_text"
)
PAGE_SCHEMA = StructType(
    [StructField(f, TEXT) for f in PAGE_TEXTS]
    + [StructField(f, TEXTS) for f in ("links", "heads", "cells")]
    + [StructField("items", ArrayType(ITEM))]
)
PAGE_ARROW = pa.struct(
    [(f, pa.string()) for f in PAGE_TEXTS] + [(f, pa.list_(pa.string())) for f in ("links", "heads", "cells")]
    + [("items", pa.list_(pa.struct([(f, pa.string()) for f in ITEM.names])))]
)
#: Pages whose parts a task holds as Python objects at a time.
PAGES = 200


class PageReader(HTMLParser):
    """Collects the few parts of a page the extractors need, in one walk over the text.

    What is open is counted by mark (a tag, or a tag with a class), so that a page of unclosed tags costs linear time.
    """

    MARKS = (("article", "product_pod"), ("div", "product_main"), ("table", "table-striped"), ("li", "next"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list, str]] = []
        self.count: Counter = Counter()
        self.texts: dict[str, list[str]] = {}
        self.out: dict = {"links": [], "heads": [], "cells": [], "items": []}
        self.row: dict = {}
        #: Number of tags open around the description's anchor; its text is the next ``p`` at the same place.
        self.description_at: int | None = None

    def begin(self, field: str) -> None:
        self.texts[field] = []
        tag, marks, _ = self.open[-1]
        self.open[-1] = (tag, marks, field)

    def push(self, tag: str, classes: frozenset) -> None:
        marks = [tag, *[m for m in self.MARKS if m[0] == tag and m[1] in classes]]
        if {"item", "active"} <= classes:
            marks.append("active item")
        self.count.update(marks)
        self.open.append((tag, marks, ""))

    def handle_starttag(self, tag: str, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        classes = frozenset(a.get("class", "").split())
        if tag == "a" and "href" in a:
            self.out["links"].append(a["href"])
        if tag == "img" and "src" in a:
            self.out.setdefault("first_image", a["src"])
            if self.count["active item"]:
                self.out.setdefault("main_image", a["src"])
        if tag in VOID:
            return
        around = len(self.open)
        self.push(tag, classes)
        if tag == "article" and "product_pod" in classes:
            self.out["items"].append({})
        elif self.count["article", "product_pod"] and self.out["items"]:
            self.in_item(tag, a, classes)
        elif tag == "title" and "title" not in self.out:
            self.begin("title")
        elif tag == "h1":
            self.begin("main_h1" if self.count["div", "product_main"] else "h1")
        elif tag == "p" and "price_color" in classes and "price" not in self.out:
            self.begin("price")
        elif tag == "li" and "current" in classes:
            self.begin("current_text")
        elif tag in ("th", "td") and self.count["table", "table-striped"]:
            self.begin(tag)
        elif tag == "tr":
            self.row = {}
        elif tag == "p" and self.description_at == around:
            self.begin("description")
            self.description_at = None
        if tag == "a" and self.count["li", "next"] and "href" in a:
            self.out.setdefault("next_link", a["href"])
        if a.get("id") == "product_description":
            self.description_at = around

    def in_item(self, tag: str, a: dict, classes: frozenset) -> None:
        current = self.out["items"][-1]
        if tag == "a" and self.count["h3"]:
            current.setdefault("title", a.get("title"))
            current.setdefault("link", a.get("href"))
        elif tag == "p" and "price_color" in classes and "price" not in current:
            self.begin("item_price")
        elif tag == "p" and "star-rating" in classes:
            words = [w for w in a["class"].split() if w != "star-rating"]
            current.setdefault("rating", words[0] if words else None)

    def handle_data(self, data: str) -> None:
        for texts in self.texts.values():
            texts.append(data)

    def handle_endtag(self, tag: str) -> None:
        while self.count[tag]:
            name, marks, field = self.open.pop()
            self.count.subtract(marks)
            if self.description_at is not None and len(self.open) < self.description_at:
                self.description_at = None  # the block around the anchor has ended
            if field:
                self.finish(field, "".join(self.texts.pop(field, [])).strip())
            if name == tag:
                break

    def finish(self, field: str, text: str) -> None:
        if field == "th":
            self.row["th"] = text
        elif field == "td":
            if "th" in self.row:
                self.out["heads"].append(self.row.pop("th"))
                self.out["cells"].append(text)
        elif field == "item_price":
            self.out["items"][-1]["price"] = text
        else:
            self.out.setdefault(field, text)

    def result(self) -> dict:
        self.close()
        while self.open:
            self.handle_endtag(self.open[-1][0])
        return self.out


def read_page(html: str | None) -> dict:
    reader = PageReader()
    reader.feed(html or "")
    return reader.result()


@F.arrow_udf(PAGE_SCHEMA)
def page_parts(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Parts of each page: one parse per page; some PAGES of an Arrow batch are read and returned at a time."""
    for batch in pages:
        for at in range(0, max(len(batch), 1), PAGES):
            yield pa.array([read_page(html) for html in batch.slice(at, PAGES).to_pylist()], PAGE_ARROW)


# Marked so that filters and projections on the parts never repeat the parse.
page_parts = page_parts.asNondeterministic()


def with_parts(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("parts", page_parts(F.col(html))).drop(html)


def extract_listing(pages: DataFrame, url: str = "url") -> DataFrame:
    """One row per item of a listing page: title, price, rating 1..5 (0 for an unknown word), link."""
    rows = with_parts(pages).select(url, F.posexplode("parts.items").alias("position", "item"))
    return rows.select(
        url, "position",
        F.col("item.title").alias("title"),
        first_number("item.price").alias("price"),
        lookup("item.rating", RATINGS, 0).alias("rating"),
        absolute_url(F.col(url), F.col("item.link")).alias("link"),
    )


def extract_detail(pages: DataFrame, url: str = "url") -> DataFrame:
    """One record per detail page, all text as on the page; absent parts are empty or null."""
    parts = with_parts(pages).withColumn("facts", pairs_to_map("parts.heads", "parts.cells"))

    def fact(name: str) -> Column:
        return F.try_element_at("facts", F.lit(name))

    def text(name: str) -> Column:
        return F.coalesce(fact(name), F.lit(""))

    picture = F.coalesce("parts.main_image", "parts.first_image", F.lit(""))
    return parts.select(
        F.col("parts.main_h1").alias("title"),
        fact("UPC").alias("upc"),
        text("Product Type").alias("product_type"),
        clean_money_text(fact("Price (excl. tax)")).alias("price_excl_tax"),
        clean_money_text(fact("Price (incl. tax)")).alias("price_incl_tax"),
        clean_money_text(fact("Tax")).alias("tax"),
        text("Availability").alias("availability"),
        fact("Number of reviews").alias("num_reviews"),
        F.coalesce("parts.description", F.lit("")).alias("description"),
        absolute_url(F.col(url), picture).alias("image_url"),
        F.col(url).alias("url"),
    )


def reduced_detail(pages: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Short records (id, title, price, upc, image, url), and the pages that lack a title or a price."""
    parts = with_parts(pages).withColumn("facts", pairs_to_map("parts.heads", "parts.cells"))
    picture = F.coalesce("parts.main_image", "parts.first_image", F.lit(""))
    rows = parts.select(
        F.col("parts.main_h1").alias("title"),
        first_number("parts.price", "float").alias("price"),
        F.try_element_at("facts", F.lit("UPC")).alias("upc"),
        absolute_url(F.col(url), picture).alias("image_url"),
        F.col(url).alias("url"),
    ).withColumn("id", F.coalesce("upc", plain_slug("title")))
    good = F.col("title").isNotNull() & F.col("price").isNotNull()
    return rows.filter(good), rows.filter(~good).select("url")


def clean_books(raw: DataFrame) -> DataFrame:
    """Typed table from raw detail records: numbers out of price texts, bad counts null."""
    return raw.withColumns({
        **{c: first_number(c, "float") for c in ("price_excl_tax", "price_incl_tax", "tax")},
        "num_reviews": F.col("num_reviews").try_cast("int"),
    })


def extract_links(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per link of each page, resolved against the page."""
    rows = with_parts(pages).select(*keep, url, F.posexplode("parts.links").alias("position", "href"))
    return rows.withColumn("link", absolute_url(F.col(url), F.col("href")))


def page_navigation(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """Next page and number of pages of each listing page, null where it names none."""
    rows = with_parts(pages)
    total = F.regexp_extract("parts.current_text", r"(?i)of\s+(\d+)", 1).try_cast("int")
    return rows.select(
        *keep, url,
        absolute_url(F.col(url), F.col("parts.next_link")).alias("next_url"),
        total.alias("total_pages"),
    )


def page_title(html: Column | str) -> Column:
    """Text of the title element as it stands in the source; the rest of a page is never read by pattern."""
    return F.nullif(F.regexp_extract(col(html), r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


Transport = Callable[[dict], tuple[int, str]]
FETCH_SCHEMA = "status int, body string, error string, attempts int"


def fetch(
    requests: DataFrame,
    transport: Transport,
    parallelism: int | None = None,
    retries: int = 3,
    backoff: float = 0.5,
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """Run one request per row with at most ``parallelism`` at a time.

    ``transport`` takes the row as a dict and returns (status, body). Overload and server errors are tried
    again with growing pauses; a request that keeps failing gives a row with its error, not a lost task.
    """
    columns = list(keep)

    def one(request: dict) -> tuple[int | None, str | None, str | None, int]:
        status, body, error, attempt = None, None, None, 0
        while attempt <= retries:
            attempt += 1
            try:
                status, body = transport(request)
                error = None if status < 400 else f"status {status}"
                if status not in RETRY_STATUS:
                    break
            except Exception as exc:
                status, body, error = None, None, f"{type(exc).__name__}: {exc}"
            if attempt <= retries and backoff:
                time.sleep(backoff * 2 ** (attempt - 1))
        return status, (body if error is None else None), error, attempt

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [one(r) for r in batch.to_dict("records")]
            answer = pd.DataFrame(answers, columns=["status", "body", "error", "attempts"], dtype=object)
            yield pd.concat([batch[columns].reset_index(drop=True), answer], axis=1)

    kept = ", ".join(f"`{c}` {dict(requests.dtypes)[c]}" for c in columns)
    spread = requests.repartition(parallelism) if parallelism else requests
    return spread.mapInPandas(run, f"{kept}, {FETCH_SCHEMA}")


def read_rest(
    requests: DataFrame,
    transport: Transport,
    schema: str,
    records: str,
    parallelism: int | None = None,
    keep: tuple[str, ...] = ("url",),
    retries: int = 3,
    backoff: float = 0.5,
) -> DataFrame:
    """Records of JSON answers: a failed or unreadable answer yields no rows."""
    answers = fetch(requests, transport, parallelism, retries, backoff, keep).filter(F.col("error").isNull())
    return explode_records(parse_payload(answers, "body", schema), f"payload.{records}", list(keep))


def with_default_record(answers: DataFrame, schema: str, defaults: Mapping[str, tuple[Column, object]]) -> DataFrame:
    """One row per answer with values taken from its ``payload``, or a default where the answer lacks them."""
    parsed = parse_payload(answers, "body", schema)
    return parsed.withColumns({
        out: F.coalesce(value, F.lit(default)) for out, (value, default) in defaults.items()
    }).drop("payload", "body")
