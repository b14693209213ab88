"""Vector queries over the embeddings table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import vectors as vf
from millrace.functions.columns import half_even
from millrace.operators import relational as rel
from millrace.operators import vectors as vec
from millrace.plans.registry import Tables, query
from millrace.session import scratch, settle

# The query vectors: every twentieth one.
PROBES = "(select vec_id as query_id from embeddings where vec_id % 20 = 0)"
RANKED = """
with q as (select query_id, embedding as qv from {probes} join embeddings on vec_id = query_id),
 s as (select query_id, vec_id, {score} as score from q, embeddings),
 r as (select *, cast(row_number() over (partition by query_id order by score {direction}, vec_id) as integer) as rank from s)
select query_id, vec_id, round_even(score * 1e6, 0) / 1e6 as score, rank from r where rank <= {k}"""
IP = "list_inner_product(qv::double[], embedding::double[])"
L2 = "list_sum(list_transform(list_zip(qv::double[], embedding::double[]), lambda p: (p[1] - p[2]) ** 2))"


def probes(t: Tables) -> DataFrame:
    """Every twentieth vector as a query."""
    chosen = t.embeddings.filter(F.col("vec_id") % 20 == 0)
    return chosen.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def _shown(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", half_even("score", 6))


@query("knn_exact_ip", RANKED.format(probes=PROBES, score=IP, direction="desc", k=10))
def knn_exact_ip(t: Tables) -> DataFrame:
    return _shown(vec.knn_exact(probes(t), t.embeddings, 10))


@query("knn_exact_l2", RANKED.format(probes=PROBES, score=L2, direction="asc", k=5))
def knn_exact_l2(t: Tables) -> DataFrame:
    return _shown(vec.knn_exact(probes(t), t.embeddings, 5, metric="l2"))


@query("l2_normalize", """
select vec_id, round_even(sqrt(list_inner_product(e, e)) * 1e5, 0) / 1e5 as length from (select vec_id,
 list_transform(embedding, lambda x: cast(x / (sqrt(list_inner_product(embedding::double[], embedding::double[])) + 1e-12) as float))::double[] as e
 from embeddings)""")
def l2_normalize(t: Tables) -> DataFrame:
    tripled = F.transform("embedding", lambda x: x * 3)
    unit = t.embeddings.select("vec_id", vf.l2_normalize(tripled).alias("unit"))
    return unit.select("vec_id", half_even(vf.norm("unit"), 5).alias("length"))


@query("self_similarity", f"""
select e.vec_id, round_even(list_inner_product(embedding::double[], c::double[]) * 1e6, 0) / 1e6 as ip,
 round_even(list_sum(list_transform(list_zip(embedding::double[], c::double[]), lambda p: (p[1] - p[2]) ** 2)) * 1e6, 0) / 1e6 as l2
from embeddings e join (select label, arg_min(embedding, vec_id) as c from embeddings group by label) using (label)""")
def self_similarity(t: Tables) -> DataFrame:
    first = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("c"))
    return t.embeddings.join(first, "label").select(
        "vec_id", half_even(vf.inner_product("embedding", "c"), 6).alias("ip"),
        half_even(vf.squared_distance("embedding", "c"), 6).alias("l2"),
    )


@query("search_page", f"""
select query_id, rank, vec_id, p_name, p_retailprice from ({RANKED.format(probes=PROBES, score=IP, direction="desc", k=20)}) h
left join part on vec_id = p_partkey where rank between 6 and 10""")
def search_page(t: Tables) -> DataFrame:
    """The second page of five of every query's hits, with their metadata."""
    hits = vec.knn_exact(probes(t), t.embeddings, 20)
    found = rel.attach_ranked(rel.page_of(hits, "rank", 2, 5), t.part, "vec_id", "p_partkey")
    return found.select("query_id", "rank", "vec_id", "p_name", "p_retailprice")


def _index(t: Tables, rows: DataFrame) -> vec.CellIndex:
    index = vec.CellIndex(t.spark, scratch(t.spark, "index"))
    index.build(rows, cells=32)
    return index


@query("ivf_search", f"""
with e as ({RANKED.format(probes=PROBES, score=IP, direction="desc", k=10)}) select query_id, true as recall_holds, true as scores_hold from e group by 1""")
def ivf_search(t: Tables) -> DataFrame:
    """Searches of the cell index, judged: whether at least 0.9 of all queries' true neighbours are found, and whether each
    score is that of its pair."""
    found = settle(_index(t, t.embeddings).search(probes(t)), "hits")
    exact = settle(vec.knn_exact(probes(t), t.embeddings, 10), "exact")
    whole = vec.recall(found, exact) >= 0.9
    right = F.abs(vf.inner_product("vector", "embedding") - F.col("score")) < 1e-9
    scored = found.join(probes(t), "query_id").join(t.embeddings, "vec_id").groupBy("query_id").agg(F.bool_and(right).alias("scores_hold"))
    return scored.select("query_id", F.lit(whole).alias("recall_holds"), "scores_hold")


@query("ivf_all_cells", RANKED.format(probes=PROBES, score=IP, direction="desc", k=10))
def ivf_all_cells(t: Tables) -> DataFrame:
    """Exact search through the index: cells that cannot hold a better hit are not visited."""
    return _shown(_index(t, t.embeddings).search(probes(t), visit=4, exact=True))


@query("ivf_append", RANKED.format(probes=PROBES, score=IP, direction="desc", k=10))
def ivf_append(t: Tables) -> DataFrame:
    """Half of the vectors are indexed, two batches are added to the stored index, grown cells are split: nothing is lost."""
    index = vec.CellIndex(t.spark, scratch(t.spark, "index"))
    index.build(t.embeddings.filter("vec_id % 2 = 0"), cells=16, largest=t.embeddings.count() // 12)
    for rest in (1, 3):
        index.append(t.embeddings.filter(F.col("vec_id") % 4 == rest))
    return _shown(index.search(probes(t), exact=True))


@query("vectors_by_id", "select vec_id, label from embeddings where vec_id between 10 and 60 and vec_id in (select s_suppkey from supplier)")
def vectors_by_id(t: Tables) -> DataFrame:
    some = vec.by_id_range(t.embeddings, "vec_id", 10, 60)
    return vec.by_ids(some, t.supplier.select(F.col("s_suppkey").alias("vec_id")), "vec_id").select("vec_id", "label")


@query("vector_collection", "select count(*) as n, 64 as dim from embeddings")
def vector_collection(t: Tables) -> DataFrame:
    path = scratch(t.spark, "vectors")
    half = F.col("vec_id") % 2 == 0
    vec.create_collection(t.embeddings.filter(half), path, "vec_id", "embedding", 64)
    vec.insert_vectors(path, t.embeddings.filter(~half).select("vec_id", "embedding"), "embedding", 64)
    stored = t.spark.read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim"))


class LetterCounts:
    """Small deterministic encoder: how often each vowel occurs in a text."""

    letters = "aeiou"

    def encode(self, contents) -> np.ndarray:
        return np.array([[text.count(letter) for letter in self.letters] for text in contents], dtype=float)


class BrokenEncoder:
    def __init__(self) -> None:
        raise RuntimeError("model files are not here")


@query("embed_documents", """
select doc_id, cast(i as integer) as position, round_even(cast(n / (sqrt(total) + 1e-12) as float)::double * 1e4, 0) / 1e4 as weight from (
 select doc_id, i, c[i + 1]::double as n, list_sum(list_transform(c, lambda x: x * x))::double as total from (
  select doc_id, list_transform(['a', 'e', 'i', 'o', 'u'], lambda v: len(text) - len(replace(text, v, ''))) as c from documents),
  generate_series(0, 4) g(i))""")
def embed_documents(t: Tables) -> DataFrame:
    encoded = vec.embed(t.spread("documents", "doc_id").select("doc_id", "text"), "text", BrokenEncoder, fallback=LetterCounts)
    long = encoded.select("doc_id", F.posexplode("vector").alias("position", "weight"))
    return long.withColumn("weight", half_even(F.col("weight").cast("double"), 4))
