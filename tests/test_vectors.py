import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import vectors as vf
from millrace.operators import vectors as vec
from millrace.session import scratch, settle


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8))
    x[300:] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6), x.astype(np.float32).astype(float)


@pytest.fixture(scope="module")
def queries(spark, base):
    rows = [(i, [float(v) for v in base[1][i]]) for i in (0, 7, 12)]
    return spark.createDataFrame(rows, "query_id long, vector array<float>")


def direct(x, metric, k):
    out = []
    for q in (0, 7, 12):
        s = x @ x[q] if metric == "ip" else -np.sum((x - x[q]) ** 2, axis=1)
        out += [(q, int(i), r + 1) for r, i in enumerate(np.lexsort((np.arange(len(x)), -s))[:k])]
    return out


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("parts", [(1024, 16_384, 2048), (2, 30, 7)])
def test_exact_search(base, queries, metric, parts, monkeypatch):
    """Same result for one task and for a grid of many; copies are ordered by id."""
    for name, value in zip(("QUERIES", "BASE", "PACK"), parts, strict=True):
        monkeypatch.setattr(vec, name, value)
    hits = vec.knn_exact(queries, base[0], 6, metric)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in hits.collect())
    assert [(q, i, r) for q, r, i in got] == direct(base[1], metric, 6)


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_products_of_a_task_are_held_some_at_a_time(metric):
    """However many queries and vectors meet in a task, it never holds all of their products (here 96 MB)."""
    rng = np.random.default_rng(3)
    queries, x = rng.normal(size=(3000, 8)), rng.normal(size=(4000, 8))
    ids = np.arange(len(x))
    tracemalloc.start()
    found = [i for _, i in vec._best(queries, x, ids, 4, metric)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 and len(found) == 3000
    for q in (0, 1, 499, 500, 2999):
        score = x @ queries[q] if metric == "ip" else -np.sum((x - queries[q]) ** 2, axis=1)
        assert found[q].tolist() == np.lexsort((ids, -score))[:4].tolist()


def test_centres_are_ordered_some_rows_at_a_time(monkeypatch):
    monkeypatch.setattr(vec, "SCORES", 50)
    rng = np.random.default_rng(4)
    x, centres = rng.normal(size=(23, 3)).astype(np.float32), rng.normal(size=(7, 3))
    vectors = pa.array(list(x), pa.list_(pa.float32()))
    parts = list(vec._ordered_cells([vectors.slice(0, 15), vectors.slice(15, 0), vectors.slice(15)], centres, 4))
    assert max(map(len, parts)) == 7 and sum(map(len, parts)) == 23
    far = np.sqrt(((x.astype(float)[:, None] - centres[None]) ** 2).sum(2))
    got = [row for part in parts for row in part.to_pylist()]
    assert [[c["cell"] for c in row] for row in got] == np.argsort(far, axis=1)[:, :4].tolist()
    assert [[c["far"] for c in row] for row in got] == [pytest.approx(sorted(f)[:4]) for f in far]
    with pytest.raises(ValueError, match="dimensions"):
        list(vec._ordered_cells([pa.array([[1.0, 2.0, 3.0], [1.0]])], centres, 1))


def test_queries_stay_in_the_executors(base, queries):
    """Neither side is collected or sent whole: the plan has no broadcast of vectors, and no coalesce."""
    import inspect

    source = inspect.getsource(vec.knn_exact) + inspect.getsource(vec._meet) + inspect.getsource(vec._pack)
    assert not any(word in source for word in (".collect(", "broadcast(", "coalesce("))


def test_text_ids_and_rows_without_numbers(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [float("nan"), 1.0]), ("d", None), (None, [9.0, 9.0]), ("e", [0.0, None])]
    base = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    asked = spark.createDataFrame([("q", [2.0, 1.0]), ("r", None)], "query_id string, vector array<float>")
    assert [tuple(r) for r in vec.knn_exact(asked, base, 5).orderBy("rank").collect()] == [("q", "a", 2.0, 1), ("q", "b", 2.0, 2)]
    with pytest.raises(Exception, match="dimensions"):
        vec.knn_exact(asked, spark.createDataFrame([("x", [1.0])], "vec_id string, embedding array<double>"), 5).collect()


@pytest.fixture(scope="module")
def clusters(spark):
    """Vectors around 12 places, one of them with most of the rows, in two halves."""
    rng = np.random.default_rng(9)
    places = rng.normal(size=(12, 10)) * 3
    at = np.where(rng.random(1200) < 0.5, 0, rng.integers(0, 12, 1200))
    x = (places[at] + rng.normal(size=(1200, 10)) * 0.4).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    asked = df.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return settle(df, "vectors"), settle(asked, "queries")


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_index_in_versions(spark, clusters, metric):
    """Recall as promised after the build and after each batch, exact search exact, grown cells split, old versions readable."""
    base, asked = clusters
    path = scratch(spark, "index")
    index = vec.CellIndex(spark, path)
    first = index.build(base.filter("vec_id < 600"), cells=12, metric=metric, largest=150)
    for low in (600, 900):
        index = vec.CellIndex(spark, path)  # opened anew: all it knows is stored
        before = index.store.version()
        now = index.append(base.filter(f"vec_id >= {low} and vec_id < {low + 300}"))
        rows = base.filter(f"vec_id < {low + 300}")
        exact = settle(vec.knn_exact(asked, rows, 10, metric), "exact")
        assert vec.recall(settle(index.search(asked), "found"), exact) >= 0.9
        plain = lambda df: sorted((r["query_id"], r["rank"], r["vec_id"]) for r in df.collect())
        assert plain(index.search(asked, visit=1, exact=True)) == plain(exact)
        assert now.number == before.number + 1 and index.rows().select("vec_id").distinct().count() == index.rows().count() == low + 300
    assert len(now.meta["centres"]) > len(first.meta["centres"])
    assert index.sizes().agg(F.sum("n")).first()[0] == 1200
    assert vec.CellIndex(spark, path).rows(1).count() == 600
    reach = now.meta["reach"]
    far = {r["cell"]: r["far"] for r in index.rows().groupBy("cell").agg(F.max("far").alias("far")).collect()}
    assert all(reach[str(c)] == f for c, f in far.items())


def test_index_prunes_cells(spark, clusters):
    base, asked = clusters
    index = vec.CellIndex(spark, scratch(spark, "index"))
    made = index.build(base, cells=12)
    assert made.meta["visit"] < len(made.meta["centres"])
    one = index.search(asked, visit=1)
    assert vec.recall(one, vec.knn_exact(asked, base, 10)) > 0.5
    with pytest.raises(vec.Moved):
        index.build(base, cells=12)


def test_index_of_nothing_and_of_copies(spark, base):
    none = base[0].limit(0)
    index = vec.CellIndex(spark, scratch(spark, "index"))
    index.build(none)
    asked = base[0].limit(2).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    assert index.search(asked).count() == 0
    same = vec.CellIndex(spark, scratch(spark, "index"))
    same.build(base[0].filter("vec_id >= 300"), cells=3, largest=5)
    same.append(base[0].filter("vec_id >= 300").withColumn("vec_id", F.col("vec_id") + 1000))
    assert same.search(asked, k=4, exact=True).count() == 8


def test_no_queries(base, queries):
    assert vec.knn_exact(queries.limit(0), base[0], 5).columns == ["query_id", "vec_id", "score", "rank"]
    assert vec.knn_exact(queries.limit(0), base[0], 5).count() == 0


def test_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in df.select(vf.l2_normalize("v")).collect()]
    assert got == [pytest.approx([0.6, 0.8]), [0.0, 0.0]]


def test_collection_checks_dimension(spark, base):
    path = scratch(spark, "vectors")
    assert vec.create_collection(base[0], path, "vec_id", "embedding", 8).count() == 400
    vec.insert_vectors(path, base[0].limit(3))
    assert spark.read.parquet(path).count() == 403
    with pytest.raises(Exception, match="not 9 long"):
        vec.create_collection(base[0], scratch(spark, "vectors"), "vec_id", "embedding", 9)


def test_embed_sets_bad_content_aside(spark):
    class Lengths:
        def encode(self, contents):
            return np.array([[len(c), 1 / len(c)] for c in contents])

    class Missing:
        def __init__(self):
            raise RuntimeError("no weights")

    df = spark.createDataFrame([(1, b"abc"), (2, b""), (3, None)], "id int, content binary")
    got = {r["id"]: r["vector"] for r in vec.embed(df, "content", Missing, fallback=Lengths).collect()}
    assert got[2] is None and got[3] is None
    assert np.linalg.norm(got[1]) == pytest.approx(1.0)
    with pytest.raises(Exception, match="no weights"):
        vec.embed(df, "content", Missing).collect()
