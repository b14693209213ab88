"""First sheet of workbooks as rows: one task per file, streaming over the sheet."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
BATCH = 10_000


def _column_number(reference: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]*", reference).group():
        n = n * 26 + ord(letter) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(MAIN + "t"))


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets/{MAIN}sheet")
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == sheet.get(RELATION):
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise ValueError("workbook without a first sheet")


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as text; the sheet is walked element by element and released behind."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                for _, node in ElementTree.iterparse(part):
                    if node.tag == MAIN + "si":
                        shared.append(_text(node))
                        node.clear()
        with book.open(_first_sheet(book)) as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag != MAIN + "row":
                    continue
                row: list[str | None] = []
                for position, cell in enumerate(node.iter(MAIN + "c")):
                    at = _column_number(cell.get("r")) if cell.get("r") else position
                    row += [None] * (at + 1 - len(row))
                    value = cell.find(MAIN + "v")
                    if cell.get("t") == "inlineStr":
                        row[at] = _text(cell)
                    elif value is not None:
                        row[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
                yield row
                node.clear()


def read_excel(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the first sheet of every workbook below ``path``; the first row names the columns.

    ``schema`` lists the wanted columns; cells that do not fit their type become null. Dates given as serial
    numbers become dates.
    """
    fields = spark.createDataFrame([], schema).schema.fields
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows = sheet_rows(content)
                header = next(rows, [])
                at = [header.index(n) if n in header else None for n in names]
                out: list = []
                for row in rows:
                    if any(v is not None for v in row):
                        out.append([file, *[row[i] if i is not None and i < len(row) else None for i in at]])
                    if len(out) >= BATCH:
                        yield pd.DataFrame(out, columns=["file", *names])
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["file", *names])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true")
    text = files.load(path).select("path", "content").mapInPandas(
        run, ", ".join(["file string", *[f"`{n}` string" for n in names]])
    )

    def typed(f):
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if kind in ("date", "timestamp_ntz"):
            serial = c.try_cast("double")
            seconds = F.round((serial - F.floor(serial)) * 86400).cast("int")
            moment = F.lit("1899-12-30").cast("timestamp_ntz") + F.make_dt_interval(
                F.floor(serial).cast("int"), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
            )
            return F.coalesce(moment.cast(kind), c.try_cast(kind)).alias(f.name)
        return (c if kind == "string" else c.try_cast(kind)).alias(f.name)

    return text.select("file", *[typed(f) for f in fields])
