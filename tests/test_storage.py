import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch, settle
from millrace.sources import files, jdbc
from millrace.sources.excel import read_excel
from millrace.streaming import jobs


def workbook(path, rows):
    """Small workbook with shared strings, a gap and a serial date."""
    shared, cells = [], []
    for i, row in enumerate(rows, 1):
        line = []
        for j, v in enumerate(row):
            if v is None:
                continue
            ref = f"{'ABCDEFG'[j]}{i}"
            if isinstance(v, str):
                shared.append(v)
                line.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                line.append(f'<c r="{ref}"><v>{v}</v></c>')
        cells.append(f'<row r="{i}">{"".join(line)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="s" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="r1" Target="worksheets/sheet1.xml"/></R>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}>{"".join(f"<si><t>{s}</t></si>" for s in shared)}</sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>{"".join(cells)}</sheetData></worksheet>')


def test_excel_folder(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["name", "day", "n"], ["x", 45292, 3], [None, None, 4.5], ["y", 45293.5, "bad"]])
    workbook(tmp_path / "b.xlsx", [["n", "name"], [7, "z"]])
    df = read_excel(spark, str(tmp_path), "name string, day date, n double")
    got = sorted(((r["name"], r["day"], r["n"]) for r in df.collect()), key=repr)
    assert got == sorted([
        ("x", dt.date(2024, 1, 1), 3.0), (None, None, 4.5), ("y", dt.date(2024, 1, 2), None), ("z", None, 7.0)
    ], key=repr)


def test_csv_keeps_awkward_text(spark):
    rows = [(1, 'a "quoted", text'), (2, ""), (3, None), (4, "별")]
    df = spark.createDataFrame(rows, "id int, t string")
    path = scratch(spark, "csv")
    files.write_table(df, path, "csv")
    assert sorted(tuple(r) for r in files.read_table(spark, path, "csv", schema=df.schema).collect()) == [
        (1, 'a "quoted", text'), (2, None), (3, None), (4, "별")
    ]


def test_jsonl_keeps_nulls_and_text(spark):
    df = spark.createDataFrame([(1, None), (2, "별")], "id int, t string")
    path = scratch(spark, "json")
    files.write_table(df, path, "jsonl")
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert lines == ['{"id":1,"t":null}', '{"id":2,"t":"별"}']


def test_first_upper_drops_empty_rows(spark):
    df = spark.createDataFrame([("a", "b"), (None, None), (None, "c")], "x string, y string")
    assert sorted((tuple(r) for r in files.with_first_upper(df).collect()), key=repr) == [("A", "b"), (None, "c")]


def test_partition_scan_reads_one_folder(spark):
    df = spark.sql("select explode(sequence(date'2022-06-01', date'2027-06-01', interval 1 year)) as d")
    path = scratch(spark, "years")
    files.write_year_partitions(df, path, "d", 2023, 2026)
    one = files.read_year_partition(spark, path, 2023)
    assert one.count() == 2 and files.read_year_partition(spark, path, 2026).count() == 2
    assert "PartitionFilters: [isnotnull(part_year" in one._jdf.queryExecution().executedPlan().toString()


def test_sizes_and_saving(spark):
    df = files.wide_rows(spark, 5000)
    plain, packed = scratch(spark, "plain"), scratch(spark, "packed")
    files.write_table(df, plain, "csv")
    files.write_table(df, packed, "csv", compression="gzip")
    assert files.total_size(spark, plain + "-absent") is None
    assert 0 < files.compression_saving(spark, plain, packed) < 100
    assert files.compression_saving(spark, plain + "-absent", packed) is None
    shown = files.file_sizes(spark, plain).filter(F.col("length") >= 1024).first()
    assert shown["display"].endswith(("KB", "MB"))
    scan = files.file_sizes(spark, plain).agg(F.sum("length"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in scan.split("ReadSchema")[-1]


def test_generators_do_not_depend_on_partitions(spark):
    one, many = (files.wide_rows(spark, 300, seed=7).repartition(n) for n in (1, 8))
    assert sorted(one.collect()) == sorted(many.collect())
    low, high = files.wide_rows(spark, 3000).agg(F.min("col_1"), F.max("col_1")).first()
    assert 1 <= low < high <= 1_000_000
    sales = files.hourly_sales(spark, 48)
    assert sales.agg(F.max("sale_datetime")).first()[0] == dt.datetime(2024, 1, 2, 23, 0)
    assert dict(sales.dtypes)["temperature"] == "decimal(5,2)"


def test_images_by_stem(spark, tmp_path):
    for name in ("u1.jpg", "u2.png", "u3.jpg"):
        (tmp_path / name).write_bytes(name.encode())
    wanted = spark.createDataFrame([("u1",), ("u3",), ("u9",), ("u1",)], "stem string")
    got = {r["stem"]: bytes(r["content"]) for r in files.read_images(spark, str(tmp_path), wanted).collect()}
    assert got == {"u1": b"u1.jpg", "u3": b"u3.jpg"}


def test_create_table_as(spark):
    df = spark.range(3)
    files.create_table_as(df, "made_table", scratch(spark, "t"))
    files.create_table_as(spark.range(9), "made_table", scratch(spark, "t"), replace=False)
    assert spark.table("made_table").count() == 3
    files.create_table_as(spark.range(9), "made_table", scratch(spark, "t"))
    assert spark.table("made_table").count() == 9
    spark.sql("drop table made_table")


def test_jdbc_options():
    read = jdbc.read_options("jdbc:x", "t", partition=("id", 1, 500_000, 8))
    assert (read["lowerBound"], read["upperBound"], read["numPartitions"]) == ("1", "500001", "8")
    write = jdbc.write_options("jdbc:x", "t", batch_size=1000, column_types={"a": "VARCHAR(10)", "b": "INT"}, truncate=True)
    assert write["createTableColumnTypes"] == "a VARCHAR(10), b INT" and write["truncate"] == "true"


def test_scratch_follows_the_session(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert settle(spark.range(5), "five").count() == 5


def test_spread(spark):
    assert files.spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8
    enough = spark.range(100, numPartitions=20)
    assert files.spread(enough) is enough


def test_stream_equals_batch(spark):
    rows = spark.sql("""select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 7 as int)) as ts,
        cast(id as double) as v from range(300)""")
    source = scratch(spark, "events")
    rows.coalesce(1).write.parquet(source)
    aggregates = {"total": F.sum("v")}
    stream = jobs.stream_files(spark, source, rows)
    out = scratch(spark, "out")
    jobs.to_files(jobs.hourly(stream, "ts", aggregates), out, scratch(spark, "state")).awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch = {tuple(r) for r in jobs.hourly(rows, "ts", aggregates).collect()}
    assert streamed < batch and len(batch) - len(streamed) == 1


def test_keyed_load_survives_a_repeat(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, id int")
    source, target = scratch(spark, "in"), scratch(spark, "table")
    rows.coalesce(1).write.parquet(source)
    for _ in range(2):
        stream = jobs.stream_files(spark, source, rows)
        jobs.keyed_load(stream, {"t": (target, ["k", "id"])}, "k", "id", scratch(spark, "state")).awaitTermination()
    assert sorted((r["k"], r["id"]) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 3)]


def test_keyed_load_over_restarts(spark):
    """Four arrivals, each after a restart: a key is loaded once, the first row by order within its first batch wins, null keys and null
    orders have their place, a batch whose commit was lost is written again with the same rows."""
    import os

    kind = "k string, at int, v string"
    source, target, mark = scratch(spark, "in"), scratch(spark, "table"), scratch(spark, "state")
    arrivals = [[("a", 5, "x"), ("a", 2, "y"), (None, 1, "z")], [("b", None, "none"), ("b", 9, "nine"), ("a", 0, "late")], [],
                [("c", 1, "c"), ("a", 2, "y"), ("b", 1, "late")]]
    stored = []
    for number, rows in enumerate(arrivals):
        spark.createDataFrame(rows, kind).repartition(3).write.mode("append").parquet(source)
        for again in range(2 if number == 3 else 1):
            if again:  # as if the driver had died before it noted the batch as done
                commits = mark.removeprefix("file:") + "/commits"
                last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
                for name in (last, f".{last}.crc"):
                    if os.path.exists(f"{commits}/{name}"):
                        os.remove(f"{commits}/{name}")
            jobs.keyed_load(jobs.stream_files(spark, source, spark.createDataFrame([], kind)), {"t": (target, ["k", "at", "v"])}, "k", "at",
                            mark).awaitTermination()
            stored.append(sorted(tuple(r) for r in spark.read.parquet(target).select("k", "at", "v").collect()))
    assert stored[0] == [("a", 2, "y")] and stored[1] == stored[2] == [("a", 2, "y"), ("b", 9, "nine")]
    assert stored[3] == stored[4] == [("a", 2, "y"), ("b", 9, "nine"), ("c", 1, "c")]


def test_line_numbers_over_many_blocks(spark):
    """Files of many blocks, empty lines, a last line without an end, an empty file."""
    import os

    path = scratch(spark, "lines").removeprefix("file:")
    os.makedirs(path)
    texts = {"a.txt": [f"line {i} " + "x" * (i % 70) for i in range(3000)], "b.txt": ["", "only", "", "end"], "c.txt": [f"{i}" for i in range(900)]}
    for name, lines in texts.items():
        with open(f"{path}/{name}", "w") as out:
            out.write("\n".join(lines))
    open(f"{path}/empty.txt", "w").close()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        numbered = files.read_numbered_lines(spark, path)
        assert numbered.rdd.getNumPartitions() > 20
        got = {(os.path.basename(r["file"]), r["line"]): r["value"] for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(name, i): line for name, lines in texts.items() for i, line in enumerate(lines, 1)}
    assert files.read_numbered_lines(spark, f"{path}/empty.txt").count() == 0


@pytest.mark.parametrize("stream", [False, True])
def test_alerts(spark, stream):
    rows = spark.createDataFrame([(1, 16.0), (2, 33.0), (3, 17.0), (4, 1.0)], "i int, rate double")
    levels = [(15.0, "Advisory"), (30.0, "Warning")]
    if not stream:
        assert [r["level"] for r in jobs.alerts(rows, "rate", levels).orderBy("i").collect()] == ["Advisory", "Warning", "Advisory"]
        return
    source, out = scratch(spark, "in"), scratch(spark, "out")
    rows.write.parquet(source)
    found = jobs.alerts(jobs.stream_files(spark, source, rows), "rate", levels)
    jobs.to_files(found, out, scratch(spark, "state")).awaitTermination()
    assert spark.read.parquet(out).count() == 3
