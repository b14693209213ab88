"""Exact and cell-partitioned nearest-neighbour search, vector tables and batch encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import GUARD
from millrace.session import settle
from millrace.sources.versions import Moved, Store, Version

#: Query and base vectors that one task scores against each other, and rows of one packed block.
QUERIES, BASE, PACK = 1024, 16_384, 2048
#: Scores, or distances to centres, that a task holds at a time, whatever the number of its queries, vectors or centres.
SCORES = 2_000_000
#: Cells of an index at most (their centres go to every task), and stored vectors whose neighbours measure its recall.
MOST_CELLS, PROBE = 4096, 256


def create_collection(df: DataFrame, path: str, id_col: str, vector: str, dim: int) -> DataFrame:
    """Write an (id, vector) table, replacing an older one, and read it back; a wrong dimension raises."""
    checked = df.select(
        F.col(id_col),
        F.when(F.assert_true(F.size(vector) == dim, f"vector is not {dim} long").isNull(), F.col(vector)).alias(vector),
    )
    checked.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def insert_vectors(path: str, batch: DataFrame, vector: str | None = None, dim: int | None = None) -> None:
    """Append rows; with ``vector`` and ``dim`` a wrong dimension raises, as in ``create_collection``."""
    if vector is not None:
        right = F.assert_true(F.size(vector) == dim, f"vector is not {dim} long").isNull()
        batch = batch.withColumn(vector, F.when(right, F.col(vector)))
    batch.write.mode("append").parquet(path)


def _known(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has only numbers."""
    number = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    return rows.filter(F.col(vector).isNotNull()).filter(number)


def _pack(rows: DataFrame, name: str, out: str, vector: str) -> DataFrame:
    """(cell, id, vector) -> blocks of one cell: cell, n, the ids as ``out`` and the matrix as bytes."""
    kind = dict(rows.dtypes)[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for cell, part in batch.groupby("cell"):
                for at in range(0, len(part), PACK):
                    some = part.iloc[at:at + PACK]
                    matrix = np.stack(some[vector].to_numpy()).astype(np.float64)
                    packed.append((cell, len(some), some[name].to_numpy(), matrix.tobytes()))
            yield pd.DataFrame(packed, columns=["cell", "n", out, "matrix"])

    return rows.select("cell", name, vector).mapInPandas(run, f"cell int, n int, `{out}` array<{kind}>, matrix binary")


def _exact(base: np.ndarray, query: np.ndarray, metric: str) -> np.ndarray:
    """Scores, larger is better, whose last digit does not depend on what else is scored."""
    return (base * query).sum(axis=1) if metric == "ip" else -((base - query) ** 2).sum(axis=1)


def _best(queries: np.ndarray, base: np.ndarray, ids: np.ndarray, k: int, metric: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the scores and ids of its best k: a matrix product finds what can be among them, these are scored anew.

    The queries go through the product some at a time, so that SCORES products are held and not all of them."""
    lengths, norms = np.einsum("ij,ij->i", queries, queries), np.einsum("ij,ij->i", base, base)
    reach = np.sqrt(norms.max(initial=0.0))
    step = max(1, SCORES // max(1, len(base)))
    for at in range(0, len(queries), step):
        some = queries[at:at + step]
        rough = some @ base.T
        if metric == "l2":
            rough *= 2
            rough -= norms[None, :]
            rough -= lengths[at:at + step, None]
        for row, query, length in zip(rough, some, np.sqrt(lengths[at:at + step]), strict=True):
            if len(row) > k:
                slack = 16 * (len(query) + 8) * np.finfo(float).eps * (length + reach) ** 2
                near = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - slack)
            else:
                near = np.arange(len(row))
            score = _exact(base[near], query, metric)
            order = np.lexsort((ids[near], -score))[:k]
            yield score[order], ids[near][order]


def _matrix(blocks: pd.DataFrame) -> np.ndarray:
    parts = [np.frombuffer(m, np.float64).reshape(n, -1) for m, n in zip(blocks["matrix"], blocks["n"], strict=True)]
    if len({p.shape[1] for p in parts}) > 1:
        raise ValueError(f"vectors of {sorted({p.shape[1] for p in parts})} dimensions")
    return np.concatenate(parts)


def _score(qid: str, base_id: str, k: int, metric: str):
    """Packed queries and packed base vectors of a task -> the best k per query."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        asked = blocks["asked"].notna().to_numpy()
        left, right = blocks[asked], blocks[~asked]
        if not len(left) or not len(right):
            return pd.DataFrame({qid: [], base_id: [], "score": []})
        queries, base = _matrix(left), _matrix(right)
        names, ids = np.concatenate(left["asked"].to_numpy()), np.concatenate(right["ids"].to_numpy())
        if queries.shape[1] != base.shape[1]:
            raise ValueError(f"queries of {queries.shape[1]} dimensions, vectors of {base.shape[1]}")
        out = [(np.full(len(s), name), i, s) for name, (s, i) in zip(names, _best(queries, base, ids, k, metric), strict=True)]
        return pd.DataFrame({c: np.concatenate([o[at] for o in out]) for at, c in enumerate((qid, base_id, "score"))})

    return run


def _meet(queries: DataFrame, base: DataFrame, k: int, metric: str, qid: str, base_id: str, query_vector: str, base_vector: str) -> DataFrame:
    """The best k of every query among the base vectors of its cells: both sides have a ``cell``, a query once per cell.

    Vectors are packed into blocks first. The blocks of a cell form a grid: its queries are cut into parts of some QUERIES, its
    vectors into parts of some BASE, and each pair of parts is one task with one matrix product, so neither a large cell nor many
    queries of one cell meet in one task. k rows per query leave a task.
    """
    if metric not in ("ip", "l2"):
        raise ValueError(f"unknown metric {metric}")
    left = _pack(_known(queries.filter(F.col(qid).isNotNull()), query_vector), qid, "asked", query_vector)
    right = _pack(_known(base.filter(F.col(base_id).isNotNull()), base_vector), base_id, "ids", base_vector)
    # Counted on the cells alone: rows that are left out make the parts a little smaller.
    parts = lambda rows, most, name: rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    sizes = parts(queries, QUERIES, "rows").join(parts(base, BASE, "columns"), "cell")
    of = lambda c, n: F.pmod(F.xxhash64("cell", c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    down = left.join(sizes, "cell").withColumn("down", of("asked", "rows")).withColumn("across", each("columns"))
    across = right.join(sizes, "cell").withColumn("across", of("ids", "columns")).withColumn("down", each("rows"))
    wanted = ["cell", "down", "across", "n", "matrix"]
    dealt = down.select(*wanted, "asked").unionByName(across.select(*wanted, "ids"), allowMissingColumns=True)
    kinds = dict(queries.dtypes)[qid], dict(base.dtypes)[base_id]
    found = dealt.groupBy("cell", "down", "across").applyInPandas(
        _score(qid, base_id, k, metric), f"`{qid}` {kinds[0]}, `{base_id}` {kinds[1]}, score double")
    window = Window.partitionBy(qid).orderBy(F.desc("score"), F.col(base_id))
    ranked = found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.withColumn("score", F.abs("score")) if metric == "l2" else ranked


def knn_exact(
    queries: DataFrame, base: DataFrame, k: int, metric: str = "ip", qid: str = "query_id",
    base_id: str = "vec_id", query_vector: str = "vector", base_vector: str = "embedding",
) -> DataFrame:
    """The k nearest base vectors per query: columns query id, base id, score, rank.

    ``score`` is the inner product, or the squared distance for ``l2``; equal scores are ordered by id. Rows without a vector, or
    with a null or NaN component, are left out. Queries and base are tables of any size: blocks of both meet in the executors.
    """
    def one(name: str) -> Column:
        """One cell for all: a remainder by 1, as a literal would be folded and the sizes joined without a key."""
        return F.pmod(F.xxhash64(name), F.lit(1)).cast("int").alias("cell")

    return _meet(queries.select(qid, query_vector, one(qid)), base.select(base_id, base_vector, one(base_id)), k, metric, qid, base_id,
                 query_vector, base_vector)


class Encoder(Protocol):
    """Turns a batch of contents into a matrix with one row per content."""

    def encode(self, contents: Sequence) -> np.ndarray: ...


def embed(
    df: DataFrame, content: str, encoder: Callable[[], Encoder], out: str = "vector",
    fallback: Callable[[], Encoder] | None = None, batch: int = 100,
) -> DataFrame:
    """Unit vectors of a content column (text or bytes).

    ``encoder`` builds the model, once per Python worker. With a ``fallback`` the model is first built on the driver, which
    decides for all workers: a worker that then fails ends the job, so one table never mixes two encoders.
    Content that cannot be encoded gives null, so that it can be set aside.
    """
    load = encoder
    if fallback is not None:
        try:
            encoder()
        except Exception:
            load = fallback

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for contents in batches:
            result: list = [None] * len(contents)
            known = np.flatnonzero(contents.notna().to_numpy())
            values = contents.to_numpy()
            for start in range(0, len(known), batch):
                part = known[start:start + batch]
                for at, vector in zip(part, _encode(model, [values[i] for i in part]), strict=True):
                    result[at] = vector
            yield pd.Series(result, dtype=object)

    return df.withColumn(out, encode(F.col(content)))


def _encode(model: Encoder, contents: list) -> list:
    """Normalised vectors; if a batch fails, its items are tried one by one."""
    try:
        raw = np.asarray(model.encode(contents), dtype=np.float64)
        unit = raw / (np.linalg.norm(raw, axis=1, keepdims=True) + GUARD)
        return list(unit.astype(np.float32))
    except Exception:
        if len(contents) == 1:
            return [None]
        return [v for one in contents for v in _encode(model, [one])]


def nearest_cells(vectors: DataFrame, centres: np.ndarray, vector: str, cells: int | None = None) -> DataFrame:
    """Rows with ``near``: the ``cells`` closest centres (number, distance), closest first, lowest number on ties.
    The centres are a few thousand vectors at most (see ``CellIndex``), and SCORES distances are held at a time."""
    sent = vectors.sparkSession.sparkContext.broadcast(centres)
    most = len(centres) if cells is None else min(cells, len(centres))

    @F.arrow_udf("array<struct<cell:int,far:double>>")
    def ordered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _ordered_cells(batches, sent.value, most)

    return vectors.withColumn("near", ordered(vector))


def _ordered_cells(batches: Iterable[pa.Array], centres: np.ndarray, most: int) -> Iterator[pa.Array]:
    """Vectors -> their ``most`` closest centres as lists of (cell, far), some rows of a batch at a time."""
    step = max(1, SCORES // max(1, len(centres)))
    for batch in batches:
        if not len(batch):
            yield pa.array([], pa.list_(pa.struct([("cell", pa.int32()), ("far", pa.float64())])))
        for at in range(0, len(batch), step):
            x = _arrow_matrix(batch.slice(at, step))
            far = np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(1)[None, :], 0))
            order = np.argsort(np.round(far, 9), axis=1, kind="stable")[:, :most]
            pairs = pa.StructArray.from_arrays(
                [pa.array(order.ravel(), pa.int32()), pa.array(np.take_along_axis(far, order, 1).ravel(), pa.float64())], ["cell", "far"])
            yield pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * most, pairs)


def _arrow_matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list array as a matrix of doubles."""
    sizes = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(sizes) > 1:
        raise ValueError(f"vectors of {sizes} dimensions")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


class CellIndex:
    """A durable index of vectors in cells around centres.

    Every version (see ``sources.versions``) holds the folders of each cell, the centres, how far the farthest vector of a cell lies
    from its centre, and how many cells a search has to visit for the wanted recall, measured when the index is built and again when
    cells are split. A batch goes to the stored centres; a cell that has grown beyond ``largest`` vectors is split around two
    centres of its own, and only its folders are rewritten.
    """

    def __init__(self, spark: SparkSession, path: str, base_id: str = "vec_id", vector: str = "embedding") -> None:
        self.spark, self.store, self.base_id, self.vector = spark, Store(spark, path), base_id, vector

    # ---- build ----

    def build(self, base: DataFrame, cells: int = 128, recall: float = 0.95, k: int = 10, metric: str = "ip", seed: int = 42,
              training: DataFrame | None = None, max_iter: int = 10, largest: int | None = None, probe: int = PROBE) -> Version:
        """First version: centres are fitted on ``training`` (all vectors if it is not given; give a sample of a large table), and every
        vector is stored in the cell of its closest centre. At most MOST_CELLS cells."""
        known = _known(base.select(self.base_id, self.vector), self.vector)
        sample = _known(training.select(self.base_id, self.vector), self.vector) if training is not None else known
        centres = self._fit(sample, min(cells, MOST_CELLS), seed, max_iter)
        rows = self._celled(known, centres)
        written = self.store.write(rows, F.col("cell"))
        made = Version(0, written, rows.schema, {})
        if largest is None:
            counted = self.store.read(made).groupBy("cell").count().agg(F.sum("count").alias("n")).first()["n"] or 0
            largest = max(64, 4 * -(-counted // max(len(centres), 1)))
        meta = {"centres": centres.tolist(), "k": k, "metric": metric, "recall": recall, "largest": largest, "seed": seed, "probe": probe}
        meta["reach"] = self._reach(made, written, {})
        meta["visit"] = self._calibrated(made, meta)
        return self.store.commit(None, rows.schema, replaced=written, meta=meta)

    def _fit(self, sample: DataFrame, cells: int, seed: int, max_iter: int) -> np.ndarray:
        if sample.isEmpty():
            return np.zeros((0, 0))
        features = sample.select(array_to_vector(F.col(self.vector)).alias("features")).persist()
        try:
            model: KMeansModel = KMeans(k=max(cells, 2), seed=seed, maxIter=max_iter, featuresCol="features").fit(features)
        finally:
            features.unpersist()
        return np.array(model.clusterCenters())

    def _celled(self, rows: DataFrame, centres: np.ndarray) -> DataFrame:
        placed = nearest_cells(rows, centres, self.vector, 1)
        first = F.get("near", F.lit(0))
        return placed.select(self.base_id, self.vector, first["cell"].alias("cell"), first["far"].alias("far"))

    def _reach(self, version: Version, cells: Iterable[int], before: Mapping[str, float]) -> dict[str, float]:
        """Distance from the centre of each cell to its farthest vector; only the given cells are read."""
        rows = self.store.read(version, cells).groupBy("cell").agg(F.max("far").alias("far")).collect()  # one row per cell
        return {**before, **{str(r["cell"]): r["far"] for r in rows}}

    def _calibrated(self, version: Version, meta: dict) -> int:
        """Cells to visit so that ``recall`` of the true neighbours of ``probe`` stored vectors (by a hash of the id) are found.

        Each neighbour lies at some place in its query's order of cells; the wanted share of these places is the answer."""
        rows = self.store.read(version)
        centres = np.array(meta["centres"])
        if not len(centres) or not version.parts:
            return 1
        some = rows.orderBy(F.xxhash64(self.base_id), self.base_id).limit(meta["probe"]).select(
            F.col(self.base_id).alias("__q"), F.col(self.vector).alias("__v"))
        picked = settle(nearest_cells(some, centres, "__v").withColumn("near", F.col("near.cell")), "probes")
        hits = knn_exact(picked, rows, meta["k"] + 1, meta["metric"], "__q", self.base_id, "__v", self.vector)
        others = hits.filter(F.col("__q") != F.col(self.base_id))  # a probe's own row says nothing
        place = F.array_position("near", F.col("cell"))
        places = others.join(rows.select(self.base_id, "cell"), self.base_id).join(picked.select("__q", "near"), "__q").groupBy(
            place.cast("int").alias("place")).agg(F.count(F.lit(1)).alias("n")).orderBy("place").collect()  # one row per cell at most
        total, upto = sum(r["n"] for r in places), 0
        for r in places:
            upto += r["n"]
            if upto >= meta["recall"] * total:
                return int(r["place"])
        return len(centres)

    # ---- append ----

    def append(self, batch: DataFrame, attempts: int = 3) -> Version:
        """Add vectors to the cells of the stored centres; cells that have grown too large are split. A writer that was faster
        makes the batch start again from its version."""
        rows = _known(batch.select(self.base_id, self.vector), self.vector)
        for attempt in range(attempts):
            base = self._current()
            added = self.store.write(self._celled(rows, np.array(base.meta["centres"])), F.col("cell"))
            parts = {c: (*base.parts.get(c, ()), *added.get(c, ())) for c in {*base.parts, *added}}
            grown = Version(base.number, parts, base.schema, base.meta)
            try:
                return self._commit_split(base, grown, added)
            except Moved:
                if attempt == attempts - 1:
                    raise
        raise ValueError("at least one attempt is needed")

    def _commit_split(self, base: Version, grown: Version, added: dict) -> Version:
        meta, centres = dict(base.meta), [list(c) for c in base.meta["centres"]]
        sizes = self.store.read(grown, added).groupBy("cell").count().filter(F.col("count") > meta["largest"]).collect()
        room = max(0, MOST_CELLS - len(centres))
        replaced: dict[int, tuple] = {}
        for cell in sorted(r["cell"] for r in sizes)[:room]:
            rows = self.store.read(grown, [cell]).drop("cell", "far")
            halves = self._fit(rows, 2, meta["seed"], 10)
            if len(halves) < 2:  # one place only: there is nothing to split
                continue
            numbers = [cell, len(centres)]
            placed = self._celled(rows, halves)
            moved = placed.withColumn("cell", F.when(F.col("cell") == 0, F.lit(numbers[0])).otherwise(F.lit(numbers[1])).cast("int"))
            written = self.store.write(moved, F.col("cell"))
            replaced |= {n: written.get(n, ()) for n in numbers}
            centres[cell] = halves[0].tolist()
            centres.append(halves[1].tolist())
        meta["centres"] = centres
        now = Version(base.number, {**grown.parts, **{c: f for c, f in replaced.items() if f}}, base.schema, {})
        meta["reach"] = self._reach(now, {*added, *replaced}, meta["reach"])
        if replaced:
            meta["visit"] = self._calibrated(now, meta)
        kept = {c: f for c, f in added.items() if c not in replaced}
        return self.store.commit(base, base.schema, replaced=replaced, added=kept, meta=meta)

    # ---- search ----

    def search(self, queries: DataFrame, k: int | None = None, visit: int | None = None, exact: bool = False, qid: str = "query_id",
               query_vector: str = "vector", number: int | None = None) -> DataFrame:
        """The k best vectors per query among those of its ``visit`` closest cells: query id, base id, score, rank.

        Without ``visit``, as many cells as the index measured for its recall. With ``exact``, a second round visits every further
        cell whose farthest vector could still reach the query's k-th score, so that the result is that of ``knn_exact``. Queries are
        exploded to their cells, and each cell's queries and vectors meet block by block.
        """
        version = self._current() if number is None else self.store.version(number)
        meta, k = version.meta, k or version.meta["k"]
        centres, rows = np.array(meta["centres"]), self.store.read(version)
        names = qid, self.base_id, query_vector, self.vector
        asked = _known(queries.select(qid, query_vector).filter(F.col(qid).isNotNull()), query_vector)
        if not len(centres):
            return knn_exact(asked, rows, k, meta["metric"], *names)
        visit = visit or meta["visit"]
        near = settle(nearest_cells(asked, centres, query_vector, None if exact else visit), "visits")
        cells = near.select(qid, query_vector, F.posexplode("near").alias("place", "at")).select(
            qid, query_vector, "place", F.col("at.cell").alias("cell"), F.col("at.far").alias("far"))
        first = _meet(cells.filter(F.col("place") < visit).select(qid, query_vector, "cell"), rows, k, meta["metric"], *names)
        if not exact:
            return first
        found = settle(first, "first")
        kth = found.groupBy(qid).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        reach = self.spark.createDataFrame([(int(c), float(r)) for c, r in meta["reach"].items()], "cell int, reach double")
        bound = cells.filter(F.col("place") >= visit).join(F.broadcast(reach), "cell").join(kth, qid, "left")
        closest = F.greatest(F.col("far") - F.col("reach"), F.lit(0.0)) - F.lit(1e-6)
        length = _length(query_vector)
        if meta["metric"] == "l2":
            could = F.greatest(closest, F.lit(0.0)) * F.greatest(closest, F.lit(0.0)) <= F.col("high")
        else:  # q.x = q.c + q.(x - c), and q.c follows from the distance between q and c
            at = F.get(F.array(*[F.lit(float(v)) for v in (centres**2).sum(1)]), F.col("cell"))
            could = (length * length + at - F.col("far") * F.col("far")) / 2 + length * F.col("reach") + 1e-6 >= F.col("low")
        more = bound.filter(F.coalesce(F.col("n") < k, F.lit(True)) | could).select(qid, query_vector, "cell")
        second = _meet(more, rows, k, meta["metric"], *names)
        order = F.desc("score") if meta["metric"] == "ip" else F.asc("score")
        window = Window.partitionBy(qid).orderBy(order, F.col(self.base_id))
        return found.unionByName(second).withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)

    def sizes(self, number: int | None = None) -> DataFrame:
        """Vectors per cell."""
        return self.store.read(self._current() if number is None else self.store.version(number)).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))

    def rows(self, number: int | None = None) -> DataFrame:
        return self.store.read(self._current() if number is None else self.store.version(number))

    def _current(self) -> Version:
        version = self.store.version()
        if version is None:
            raise ValueError(f"no index below {self.store.path}")
        return version


def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def recall(found: DataFrame, exact: DataFrame, qid: str = "query_id", base_id: str = "vec_id") -> float:
    """Share of the true neighbours that a search has found."""
    row = exact.select(qid, base_id).join(found.select(qid, base_id, F.lit(1).alias("hit")), [qid, base_id], "left").agg(
        F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits")).first()
    return row["hits"] / row["n"] if row["n"] else 1.0


def by_ids(collection: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Stored vectors of the given ids."""
    return collection.join(ids.select(id_col), id_col, "left_semi")


def by_id_range(collection: DataFrame, id_col: str, lo, hi) -> DataFrame:
    return collection.filter(F.col(id_col).between(F.lit(lo), F.lit(hi)))
