"""Plans: what is pruned, pushed down, pre-aggregated and kept out of Python."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from millrace.operators import relational as rel

EXPRESSIONS_ONLY = (
    "col_exprs", "guarded_division", "coerce_numeric", "bands", "clip", "vector_arith", "string_ops", "regex_findall",
    "slugs", "date_parts", "date_diff", "json_extract", "pairs_map", "access_log_parse", "error_line_classes",
    "reject_records", "interpolate_time", "ffill_by_user", "resample_hour", "self_similarity", "page_title",
)


def plan(spark, data, name, kind="executed"):
    execution = entry_points.queries()[name](spark, data)._jdf.queryExecution()
    return (execution.executedPlan() if kind == "executed" else execution.optimizedPlan()).toString()


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - {n for n in entry_points.queries() if "stream" in n}))
def test_no_pair_tables(spark, data, name):
    """No query multiplies two tables."""
    text = plan(spark, data, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", EXPRESSIONS_ONLY)
def test_no_python(spark, data, name):
    assert not re.search("Python|InPandas|InArrow", plan(spark, data, name))


def test_top_n_is_limited_before_the_shuffle(spark, data):
    text = plan(spark, data, "recent3_lines")
    exchange = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning(o_custkey" in line]
    limits = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line]
    assert len(limits) == 2 and limits[0] < exchange[0] < limits[1]


def test_pushed_filters_and_columns(spark, data):
    text = plan(spark, data, "order_month_slice")
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, data, "group_sum_expr")).group(1)
    assert schema.split(",") == ["l_quantity:double", "l_extendedprice:double", "l_returnflag:string"]


def test_partition_pruning(spark, data):
    assert re.search(r"PartitionFilters: \[isnotnull\(part_year", plan(spark, data, "partition_pruned_scan"))


@pytest.mark.parametrize("name", ["orders_above_year_avg", "running_monthly_sales", "order_gap"])
def test_lines_are_added_up_before_the_join(spark, data, name):
    """The first thing done with order lines is a partial aggregate."""
    lines = plan(spark, data, name).splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "l_orderkey" in line]
    assert scans and all(any("HashAggregate" in line for line in lines[i - 4:i]) for i in scans)


def test_partition_mean_has_no_window(spark, data):
    assert "Window" not in plan(spark, data, "payment_vs_avg")


def test_results_do_not_depend_on_partitions(spark, data):
    """Numbering, filling and ranking give the same for 1 and 16 shuffle partitions."""
    names = ("unique_names", "ffill_by_user", "recent3_lines", "knn_exact_ip")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append([sorted(map(tuple, entry_points.queries()[n](spark, data).collect()), key=repr) for n in names])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_page_is_a_top_k(spark):
    text = rel.page(spark.range(1000), [F.col("id")], 3, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=15, offset=10" in text
