"""Hard-negative mining by Four-Russians scoring.

Vectors become whole numbers. A candidate is stored as bit planes: per plane one byte for every eight dimensions. For each anchor
and group of eight dimensions a table holds the sums of all 256 subsets of the anchor's eight numbers; a candidate's byte picks
its subset sum, and shifting and adding the planes gives the exact inner product. Blocks of anchors meet blocks of candidates on
a grid of tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.session import settle

#: Anchors and candidates that one task of the grid scores against each other.
ANCHORS, CANDIDATES = 1024, 16_384
#: Rows of a tile: its tables and sums stay in the processor's cache.
TILE = 256
#: Largest size of a component, and of a score, as whole numbers.
LARGEST, LARGEST_SCORE = 2**40, 2**62


def planes(values: np.ndarray, width: int) -> np.ndarray:
    """Whole numbers (rows, groups * 8) as two's complement bit planes: bytes (rows, width, groups)."""
    bits = (values[:, None, :] >> np.arange(width, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(values: np.ndarray) -> np.ndarray:
    """Per group of eight dimensions, subset and anchor the sum of the anchor's numbers in the subset: (groups, 256, anchors)."""
    grouped = values.reshape(len(values), -1, 8).transpose(1, 2, 0)
    sums = np.zeros((grouped.shape[0], 256, len(values)), np.int64)
    for bit in range(8):
        at = 1 << bit
        sums[:, at:2 * at] = sums[:, :at] + grouped[:, bit:bit + 1]
    return sums


def scores(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors): from the sign plane down, the sum so far is doubled and the plane's subset sums added."""
    total = np.zeros((len(packed), sums.shape[2]), sums.dtype)
    looked = np.empty_like(total)
    width = packed.shape[1]
    for plane in range(width - 1, -1, -1):
        total <<= 1
        for group in range(sums.shape[0]):
            np.take(sums[group], packed[:, plane, group], axis=0, out=looked)
            if plane == width - 1:
                total -= looked
            else:
                total += looked
    return total


def _packed(dims: int, width: int):
    """Rows with ``q`` (whole numbers) -> ``anchor`` rows keep the numbers, all rows get their planes."""

    def run(batches):
        for batch in batches:
            values = np.zeros((len(batch), dims), np.int64)
            for i, q in enumerate(batch["q"]):
                values[i, :len(q)] = q
            out = batch[["row", "vec_id", "label"]].copy()
            out["planes"] = [p.tobytes() for p in planes(values, width)]
            chosen = batch["anchor"].to_numpy()
            out["numbers"] = [v.tobytes() if a else None for v, a in zip(values, chosen, strict=True)]
            yield out

    return run


def whole(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label (long) and q, the components as floor(scale * x); rows with a null id, label or vector or with a null or non-finite
    component are left out. Other columns are not read."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), parts.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = given.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(finite)
    return known.select("vec_id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("q"))


def _dealt(packed: DataFrame, anchors: DataFrame, rows: int, columns: int) -> DataFrame:
    """Anchors once per column and candidates once per row of the grid; ``numbers`` is null for candidates."""
    across = F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))
    down = F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))
    left = anchors.withColumn("across", across).withColumn("down", F.pmod(F.xxhash64("row"), F.lit(rows)).cast("int"))
    right = packed.withColumn("down", down).withColumn("across", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(columns)).cast("int"))
    return left.unionByName(right, allowMissingColumns=True)


def _tiles(part: pd.DataFrame, dims: int, width: int, small: bool, visit: Callable) -> None:
    """Calls ``visit(anchor rows, candidate rows, scores)`` for each tile of a task's anchors and candidates, by label."""
    held = part["numbers"].notna().to_numpy()
    anchors, others = part[held].sort_values(["label", "row"]), part[~held].sort_values(["label", "row"])
    if not len(anchors) or not len(others):
        return
    numbers = np.stack([np.frombuffer(b, np.int64) for b in anchors["numbers"]])
    packed = np.stack([np.frombuffer(b, np.uint8).reshape(width, dims // 8) for b in others["planes"]])
    for a in range(0, len(anchors), TILE):
        sums = subset_sums(numbers[a:a + TILE])
        sums = sums.astype(np.int32) if small else sums
        for c in range(0, len(others), TILE):
            mine, theirs = anchors.iloc[a:a + TILE], others.iloc[c:c + TILE]
            visit(mine, theirs, lambda s=sums, c=c: scores(s, packed[c:c + TILE]))


def _best(found: dict, key, score: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Keep the k best (score, id) of a key: higher scores first, then smaller ids."""
    if key in found:
        score, ids = np.concatenate([found[key][0], score]), np.concatenate([found[key][1], ids])
    if len(score) > 4 * k:
        keep = score >= np.partition(score, len(score) - k)[len(score) - k]
        score, ids = score[keep], ids[keep]
    order = np.lexsort((ids, -score))[:k]
    found[key] = score[order], ids[order]


def _positives(dims: int, width: int, small: bool, k: int):
    """A task's anchors and candidates -> the best k other rows of an anchor's label."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, tuple] = {}

        def visit(mine, theirs, score):
            a, c = mine["label"].to_numpy(), theirs["label"].to_numpy()
            if a[0] > c[-1] or c[0] > a[-1]:
                return
            value, rows, ids = score(), theirs["row"].to_numpy(), theirs["vec_id"].to_numpy()
            for i, (row, label) in enumerate(zip(mine["row"], a, strict=True)):
                use = (c == label) & (rows != row)
                if use.any():
                    _best(found, row, value[use, i].astype(np.int64), ids[use], k)

        _tiles(part, dims, width, small, visit)
        out = [(row, int(i), int(s)) for row, (score, ids) in found.items() for s, i in zip(score, ids, strict=True)]
        return pd.DataFrame(out, columns=["row", "positive_id", "positive_score"]).astype("int64")

    return run


def _negatives(dims: int, width: int, small: bool, k: int, low: int, high: int):
    """A task's anchors (with their positives) and candidates -> the best k rows of another label in the band of each positive's score."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found: dict[tuple[int, int], tuple] = {}
        known = {r: [int(s) for s in p] for r, p in zip(part["row"], part["scores"], strict=True) if p is not None}

        def visit(mine, theirs, score):
            c, ids = theirs["label"].to_numpy(), theirs["vec_id"].to_numpy()
            value = score()
            for i, (row, label) in enumerate(zip(mine["row"], mine["label"], strict=True)):
                if row not in known:
                    continue
                bounds = known[row]
                # From low/100 to high/100 of the score: floors and ceilings of whole numbers are exact.
                column = value[:, i]
                least, most = min(-(-low * s // 100) for s in bounds), max(high * s // 100 for s in bounds)
                use = np.flatnonzero((column >= least) & (column <= most) & (c != label))
                if not len(use):
                    continue
                near, names = column[use].astype(np.int64), ids[use]
                for s in bounds:
                    fit = (near >= -(-low * s // 100)) & (near <= high * s // 100)
                    if fit.any():
                        _best(found, (row, s), near[fit], names[fit], k)

        _tiles(part, dims, width, small, visit)
        out = [(*key, int(i), int(s)) for key, (score, ids) in found.items() for s, i in zip(score, ids, strict=True)]
        return pd.DataFrame(out, columns=["row", "positive_score", "negative_id", "negative_score"]).astype("int64")

    return run


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank (int), negative_id, positive_score, negative_score (longs) of ``whole`` rows.

    Anchors are rows whose vec_id is divisible by ``every``. An anchor's positives are its first ``positives`` other rows of the same
    label; for each, the first ``negatives`` rows of another label whose score is from ``low`` to ``high`` percent of the positive's.
    Scores are inner products of the whole numbers, higher ones first, ties by smaller vec_id. Rows of equal vec_id are rows of
    their own: an anchor that occurs twice is an anchor twice, and each is the other's candidate. Shorter vectors count as filled up with
    zeros; an empty vector scores 0. An empty table gives no rows. Components beyond 2^40, or scores that may not fit a long, end the job
    with a message.
    """
    spark = rows.sparkSession
    kept = settle(rows.select("vec_id", "label", "q", F.monotonically_increasing_id().alias("row"),
                              (F.col("vec_id") % every == 0).alias("anchor")), "vectors")
    size = F.greatest(F.abs(F.coalesce(F.array_max("q"), F.lit(0))), F.abs(F.coalesce(F.array_min("q"), F.lit(0))))
    head = kept.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("a"), F.max(F.size("q")).alias("dims"),
                    F.max(size).alias("size")).first()
    largest, dims = int(head["size"] or 0), max(8, -(-int(head["dims"] or 0) // 8) * 8)
    if largest > LARGEST or largest * largest * dims > LARGEST_SCORE:
        raise ValueError(f"components up to {largest} of {dims} dimensions give scores beyond a long")
    width, small = largest.bit_length() + 1, largest * (largest + 1) * 2 * dims < 2**31
    packed = settle(kept.mapInPandas(_packed(dims, width), "row long, vec_id long, label long, planes binary, numbers binary"), "planes")
    anchors = packed.filter("numbers IS NOT NULL").select("row", "vec_id", "label", "numbers")
    candidates = packed.select("row", "vec_id", "label", "planes")
    grid = -(-max(head["a"], 1) // ANCHORS), -(-max(head["n"], 1) // CANDIDATES)

    first = _dealt(candidates, anchors, *grid).groupBy("down", "across").applyInPandas(
        _positives(dims, width, small, positives), "row long, positive_id long, positive_score long")
    by_score = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    chosen = settle(first.withColumn("__k", F.row_number().over(by_score)).filter(F.col("__k") <= positives).drop("__k"), "positives")
    bounds = chosen.groupBy("row").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))  # at most ``positives``
    second = _dealt(candidates, anchors.join(bounds, "row"), *grid).groupBy("down", "across").applyInPandas(
        _negatives(dims, width, small, negatives, low, high), "row long, positive_score long, negative_id long, negative_score long")
    by_score = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = second.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    named = chosen.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(hard, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = whole(table(spark, folder, "embeddings"))
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved)
