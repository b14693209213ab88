"""Mixed documents: kinds are kept apart, arrays match by element, paths are set and cut, revisions compared."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import variants
from millrace.session import settle

DOCS = [
    {"a": 5, "b": {"c": "x", "d": [1, "y", {"z": 2}]}, "n": None}, {"a": "5", "b": 3}, {"a": 5.5, "t": True}, {"a": [4, 7], "b": {"c": "y"}},
    {"a": 9007199254740993}, {"o'k": {"we ird": 1}}, [1, 2], "text", {"a": True}, {"a": {"x": 1}},
]


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(90, "{broken"), (91, None)]
    good, bad = variants.collection(spark.createDataFrame(rows, "id int, text string"), "text", "id")
    assert sorted(map(tuple, bad.collect())) == [(90, "{broken"), (91, None)]
    return settle(good, "collection")


@pytest.mark.parametrize("query, want", [
    ({"a": 5}, [0]), ({"a": "5"}, [1]), ({"a": {"$gt": 5}}, [2, 3, 4]), ({"a": {"$gte": 5.0}}, [0, 2, 3, 4]), ({"a": {"$lt": 5}}, [3]),
    ({"a": 9007199254740993}, [4]), ({"a": 9007199254740992}, []), ({"a": True}, [8]), ({"a": {"$in": [7, "5"]}}, [1, 3]),
    ({"b.c": "y"}, [3]), ({"b.d": "y"}, [0]), ({"b.d": 1}, [0]), ({"b": {"$exists": True}}, [0, 1, 3]), ({"n": None}, list(range(10))),
    ({"n": {"$exists": True}}, [0]), ({"b.c": {"$ne": "x"}}, [1, 2, 3, 4, 5, 6, 7, 8, 9]), ({"o'k.we ird": 1}, [5]),
    ({"$or": [{"a": "5"}, {"$and": [{"a": {"$gt": 1}}, {"t": True}]}]}, [1, 2]), ({"a": {"$gt": "1"}}, [1]), ({}, list(range(10))),
])
def test_matches(stored, query, want):
    assert sorted(r["id"] for r in variants.find(stored, query).collect()) == want


def test_only_the_asked_fields_are_read(stored):
    plan = variants.find(stored, {"b.c": "x"}).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "doc:struct<" in plan


def texts(df):
    return {r[0]: json.loads(r[1]) for r in df.select("id", F.to_json("doc")).collect()}


def test_set_and_cut_paths(stored):
    got = texts(variants.update(stored, {"a": {"$gt": 5}}, {"b.e.f": "new", "a": 0}))
    assert got[2] == {"a": 0, "t": True, "b": {"e": {"f": "new"}}} and got[0] == DOCS[0]
    assert got[3] == {"a": 0, "b": {"c": "y", "e": {"f": "new"}}}
    one = texts(variants.update_one(stored, {"b": {"$exists": True}}, {"b.c": True}, "id"))
    assert one[0]["b"] == {"c": True, "d": [1, "y", {"z": 2}]} and one[1] == DOCS[1]
    assert texts(variants.update_one(stored, {"a": "nowhere"}, {"b": 1}, "id")) == texts(stored)
    replaced = texts(variants.update(stored, {"b": 3}, {"b.c": 1}))
    assert replaced[1] == {"a": "5", "b": {"c": 1}}
    cut = texts(stored.withColumn("doc", variants.without_path(F.col("doc"), "b.c")))
    assert cut[0]["b"] == {"d": [1, "y", {"z": 2}]} and cut[1] == DOCS[1] and cut[6] == [1, 2]


def test_kinds_per_path(stored):
    got = {(r["path"], r["kind"]): r["n"] for r in variants.path_kinds(stored).collect()}
    assert got["a", "number"] == 3 and got["a", "string"] == got["a", "array"] == got["a", "boolean"] == got["a", "object"] == 1
    assert got["b.d[]", "number"] == got["b.d[]", "string"] == got["b.d[].z", "number"] == 1 and got["n", "null"] == 1
    assert got["[]", "number"] == 2 and ("b.d[].z", "number") not in {
        (r["path"], r["kind"]) for r in variants.path_kinds(stored, levels=2).collect()}
    some = variants.merged_type(stored.filter("id in (0, 3)")).first()[0]
    assert "c: STRING" in some and variants.path_kinds(stored.limit(0)).count() == 0


def test_revisions_of_equal_documents_keep_apart(spark):
    two = settle(variants.collection(spark.createDataFrame([("p", '{"a": 1}'), ("q", '{"a": 1}')], "id string, text string"), "text", "id")[0], "two")
    revised = variants.revisions(two, {"a": 1}, {"a": 2, "b": 0}, "id", "of")
    assert revised.select("id").distinct().count() == 2
    pairs = variants.compare(two, revised, "id", "of", ["a", "b", "c"])
    assert sorted((r["original_id"], r["a_changed"], r["b_changed"], r["c_changed"]) for r in pairs.collect()) == [
        ("p", True, True, False), ("q", True, True, False)]
