"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text becomes a few statistics in whole numbers. Cosines of seeded random directions approximate a Gaussian kernel over them. Each
partition sums its part of the normal equations per fold; the parts are added up in a tree, so that the driver solves a system of
fixed size. Scores of documents by a fit without their fold are binned, and an isotonic curve over the bins turns scores into
probabilities. All sums are of whole numbers, so that the order of rows and partitions does not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty
from millrace.session import settle

#: Statistics are kept in parts of this.
UNIT = 10_000
#: Random features, kernel width in standard deviations per statistic, penalty per row, and the grid of a cosine.
FEATURES, WIDTH, PENALTY, GRID, SEED = 256, 0.9, 1e-3, 4096, 11
#: Folds of the documents labelled; each is scored by a fit of the others.
FOLDS = 4
#: Bins of a raw score, from -1 to 2.
BINS = 1000
#: Partial sums that the driver adds up at most, per fold.
LAST_SUMS = 8
#: Rows whose products are summed at a time: sums of GRID * GRID * rows stay exact in doubles.
ROWS = 4096

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_OTHER = np.zeros(256, bool)
_OTHER[list(b"!?@^_~=+/\\{}[]()`")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".,;:'\"-")] = True


def statistics_of(text: str) -> list[int]:
    """Statistics of one text, in parts of UNIT: sizes as logarithms, the rest as shares. An empty text has all zeros."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0] * STATISTICS
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = counts[65:91].sum() + counts[97:123].sum()
    size = len(data)
    solid = size - counts[[32, 9, 10, 11, 12, 13]].sum()
    distinct = Counter(words)
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    threes = len(set(zip(words, words[1:], words[2:], strict=False))) if n > 2 else 0
    lines = [line for line in data.split(b"\n") if line.strip()]
    edges = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    bare = sum(len(w) == 1 and not w.isalnum() and w[0] < 128 for w in words)
    held = counts[counts > 0] / size
    values = (
        np.log1p(n) / 10, np.log1p(size) / 10, solid / n / 20, np.log1p(max(map(len, distinct))) / 10,
        counts[65:91].sum() / max(letters, 1), counts[_SYMBOLS].sum() / solid, counts[_OTHER].sum() / solid,
        counts[_STOPS].sum() / solid, counts[48:58].sum() / solid, counts[128:].sum() / solid, counts[10] / size,
        len(distinct) / n, max(distinct.values()) / n, repeated / n, 1 - threes / max(n - 2, 1) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines), edges / n, bare / n, -(held * np.log2(held)).sum() / 8,
    )
    return [int(round(float(v) * UNIT)) for v in values]


STATISTICS = 19


def statistics(text: Column) -> Column:
    """The statistics of a text; null counts as empty."""

    @F.pandas_udf("array<int>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(statistics_of(t), np.int32) for t in texts], dtype=object)

    return measured(F.coalesce(text.cast("string"), F.lit("")))


@dataclass(frozen=True)
class Model:
    """Means and widths of the statistics, weights of the random features, and the curve from raw scores to probabilities;
    ``weights`` is None if the labels had one class only (or were too few), then ``prior`` is every score."""

    mean: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    curve: tuple[np.ndarray, np.ndarray] | None
    prior: float


def cosines(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features as whole numbers from -GRID to GRID, and a constant."""
    seeded = np.random.default_rng(SEED)
    directions = seeded.normal(size=(len(mean), FEATURES)) / (WIDTH * np.sqrt(len(mean)))
    phase = seeded.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -6, 6)
    angle = phase + sum(x[:, [i]] * directions[i] for i in range(len(mean)))  # no product whose order of adding may change
    return np.c_[np.round(np.cos(angle) * GRID), np.full(len(x), float(GRID))]


def _partial(mean: np.ndarray, scale: np.ndarray):
    """Rows (fold, stats, label) of a partition -> per fold the sums of products, of products with the label, and counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, rows in batch.groupby("fold"):
                for at in range(0, len(rows), ROWS):
                    part = rows.iloc[at:at + ROWS]
                    z = cosines(np.stack(part["stats"].to_numpy()).astype(float), mean, scale)
                    z = np.c_[z, part["label"].to_numpy().astype(float)]
                    total = (z.T @ z).astype(np.int64)
                    sums[fold] = sums[fold] + total if fold in sums else total
        yield pd.DataFrame([(int(f), s.tobytes()) for f, s in sums.items()], columns=["fold", "sums"])

    return run


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for fold, held in zip(batch["fold"], batch["sums"], strict=True):
            one = np.frombuffer(held, np.int64)
            sums[fold] = sums[fold] + one if fold in sums else one
    yield pd.DataFrame([(int(f), s.tobytes()) for f, s in sums.items()], columns=["fold", "sums"])


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the summed matrix of features, constant and label."""
    kind = "fold int, sums binary"
    parts = settle(rows.mapInPandas(_partial(mean, scale), kind).select("fold", "sums", F.spark_partition_id().alias("at")), "sums")
    left = parts.agg(F.count_distinct("at")).first()[0]
    while left > LAST_SUMS:
        left = -(-left // LAST_SUMS)
        merged = parts.withColumn("at", F.pmod(F.col("at"), F.lit(left))).repartition(left, "at").mapInPandas(_added, kind)
        parts = settle(merged.select("fold", "sums", F.spark_partition_id().alias("at")), "sums")
    out: dict[int, np.ndarray] = {}
    for r in parts.select("fold", "sums").collect():  # at most LAST_SUMS * FOLDS matrices of fixed size
        one = np.frombuffer(r["sums"], np.int64).reshape(FEATURES + 2, FEATURES + 2)
        out[r["fold"]] = out.get(r["fold"], 0) + one
    return out


def _ridge(total: np.ndarray) -> np.ndarray:
    """Weights of the features and the constant from a summed matrix."""
    a, b = total[:-1, :-1].astype(float) / GRID**2, total[:-1, -1].astype(float) / GRID
    rows = a[-1, -1]
    penalty = np.full(len(a), PENALTY * max(rows, 1.0) * FEATURES / 100)
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


def isotonic(bins: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, rows, rows of label 1) -> places and probabilities of the best rising steps, by pooling neighbours that fall. Each
    step counts half a row of either label more, so that none is certain."""
    steps: list[list[float]] = []
    for at, n, ones in sorted(bins):
        steps.append([at * n, n, ones])
        while len(steps) > 1 and steps[-2][2] * steps[-1][1] >= steps[-1][2] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    place = np.array([s / n for s, n, _ in steps]) / BINS
    share = np.array([(ones + 0.5) / (n + 1) for _, n, ones in steps])
    return place, np.maximum.accumulate(share)


def _raw(stats: np.ndarray, model: Model, weights: np.ndarray) -> np.ndarray:
    return (cosines(stats, model.mean, model.scale) * (weights / GRID)).sum(axis=1)


def train(measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Model:
    """A model from ``measured`` (id, ``stats``) and ``labels`` (id, label 0 or 1; null or other labels and null ids are left out).

    An id with both labels counts as 1; rows of ``measured`` with equal ids are rows of their own. All labelled rows are used: nothing but
    sums and at most 3 * BINS counts per fold reach the driver. Folds go by the statistics, so that copies share one.
    """
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("__id").isNotNull()).groupBy("__id").agg(F.max("label").alias("label"))
    rows = settle(measured.select(F.col(doc_id).alias("__id"), "stats").join(known, "__id").select(
        F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int").alias("fold"), "stats", "label"), "labelled")
    values = [F.get("stats", F.lit(i)).cast("decimal(12,0)") for i in range(STATISTICS)]
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(values)],
                     *[F.sum(v * v).alias(f"q{i}") for i, v in enumerate(values)]).first()
    n, ones = whole["n"], whole["ones"] or 0
    if n < 8 or ones in (0, n):
        return Model(None, None, None, None, ones / n if n else 0.5)
    mean = np.array([int(whole[f"s{i}"]) / n for i in range(STATISTICS)])
    spread = np.array([int(n * whole[f"q{i}"] - whole[f"s{i}"] * whole[f"s{i}"]) / n**2 for i in range(STATISTICS)])
    scale = np.sqrt(np.maximum(spread, 0)) + UNIT / 1000
    sums = _normal_equations(rows, mean, scale)
    total = sum(sums.values())
    model = Model(mean, scale, _ridge(total), None, ones / n)
    without = {fold: _ridge(total - one) for fold, one in sums.items()}

    @F.pandas_udf("int")
    def binned(fold: pd.Series, stats: pd.Series) -> pd.Series:
        x = np.stack(stats.to_numpy()).astype(float)
        raw = np.zeros(len(x))
        for f, weights in without.items():
            mine = (fold == f).to_numpy()
            if mine.any():
                raw[mine] = _raw(x[mine], model, weights)
        return pd.Series(np.round(np.clip(raw, -1, 2) * BINS).astype(np.int32))

    counted = rows.withColumn("bin", binned("fold", "stats")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).collect()  # at most 3 * BINS + 1 rows
    curve = isotonic([(r["bin"], r["n"], r["ones"]) for r in counted])
    return Model(mean, scale, model.weights, curve, ones / n)


def score(stats: Column, model: Model) -> Column:
    """Probability of label 1 by the statistics; on a level step a hundredth follows the raw score, so that order is kept."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for given in batches:
            if model.weights is None or not len(given):
                yield pd.Series(np.full(len(given), model.prior))
                continue
            raw = np.clip(_raw(np.stack(given.to_numpy()).astype(float), model, model.weights), -1, 2)
            yield pd.Series(0.99 * np.interp(raw, *model.curve) + 0.01 * (raw + 1) / 3)

    return scored(stats)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``stats`` of every row, stored: each text is read once. Null texts are empty; other columns are not read."""
    return settle(docs.select(F.col(doc_id), statistics(text_or_empty(text)).alias("stats")), "statistics")


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids from which nothing is learnt; a null id is not among them."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@query("op11_kernel_quality")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    measured = measure(table(spark, folder, "documents"))
    model = train(measured, table(spark, folder, "labels").filter(~held_out(F.col("doc_id"))))
    scored = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("stats"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
