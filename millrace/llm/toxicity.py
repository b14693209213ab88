"""Toxicity by compression distance: windows of a text are compressed with a dictionary of toxic and one of ordinary text.

Both dictionaries hold the same ordinary content, learnt by the zstandard trainer; the toxic one further holds the passages
that mark toxic texts. How much shorter a window gets with the toxic dictionary is its gain. A document's share of windows per
gain, its best windows and the mean are calibrated to a probability on labelled documents that made no dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty

#: Bounds of the labelled sample: toxic documents, ordinary documents, and the longest text (code points) in it.
TOXIC_DOCS, ORDINARY_DOCS, LONGEST = 1500, 4000, 200_000
#: Window length and step, bytes of ordinary content, and the choices of piece lengths.
WINDOW, STEP, CONTENT, GRAMS = 56, 44, 6000, ((5,), (8,), (5, 8))
#: A piece marks toxic text if so many times as many toxic as ordinary documents hold it, and at least this share and this number of the toxic ones.
TIMES, SHARE, LEAST = 33.0, 0.01, 6


@dataclass(frozen=True)
class Model:
    """Dictionary contents and weights; ``weights`` is None if the labels had one class only, then ``prior`` is every score."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    prior: float


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace").lower()


def _flat(text: str) -> bytes:
    return b" " + b" ".join(_bytes(text).split()) + b" "


def _grams(flat: bytes, n: int) -> np.ndarray:
    """Each run of n (at most 8) bytes as a number, once."""
    a = np.frombuffer(flat, dtype=np.uint8).astype(np.uint64)
    if len(a) < n:
        return np.zeros(0, np.uint64)
    v = np.zeros(len(a) - n + 1, np.uint64)
    for i in range(n):
        v = (v << np.uint64(8)) | a[i:len(a) - n + 1 + i]
    return np.unique(v)


def _marks(toxic: list[bytes], ordinary: list[bytes], n: int) -> set[int]:
    """The pieces of n bytes that mark toxic texts."""
    known, counts = np.unique(np.concatenate([_grams(f, n) for f in toxic]), return_counts=True)
    frequent = counts >= max(LEAST, SHARE * len(toxic))
    known, counts = known[frequent], counts[frequent]
    if not len(known):
        return set()
    other = np.zeros(len(known), np.int64)
    for f in ordinary:
        seen = _grams(f, n)
        at = np.minimum(np.searchsorted(known, seen), len(known) - 1)
        other[at[known[at] == seen]] += 1
    ratio = ((counts + 0.5) / (len(toxic) + 1)) / ((other + 0.5) / (len(ordinary) + 1))
    return set(known[ratio > TIMES].tolist())


def _passages(toxic: list[str], ordinary: list[str], lengths: tuple[int, ...]) -> bytes:
    """The runs of pieces inside words that mark toxic texts, the most frequent ones last."""
    bad, good = [_flat(t) for t in toxic], [_flat(t) for t in ordinary]
    found: dict[bytes, int] = {}
    for n in lengths:
        marks = _marks(bad, good, n)
        for f in bad:
            for word in set(f.split()):
                padded, start = b" " + word + b" ", None
                for i in range(len(padded) - n + 2):
                    if i <= len(padded) - n and int.from_bytes(padded[i:i + n], "big") in marks:
                        start = i if start is None else start
                    elif start is not None:
                        run = padded[start:i - 1 + n]
                        found[run] = found.get(run, 0) + 1
                        start = None
    ranked = sorted((r for r, k in found.items() if k >= max(LEAST, SHARE * len(toxic))), key=lambda r: (-found[r], r))
    kept = [r for i, r in enumerate(ranked) if not any(r in q for q in ranked[:i])]
    return b"".join(reversed(kept))


def _content(texts: list[str]) -> bytes:
    windows = [b for t in texts for b in (lambda x: [x[i:i + 64] for i in range(0, len(x), 64)])(_bytes(t)[:2048])]
    try:
        return zstandard.train_dictionary(16_384, windows).as_bytes()[-CONTENT:]
    except zstandard.ZstdError:  # too little text for the trainer
        return b"".join(windows)[-CONTENT:]


class Gains:
    """Gain of each window of a text under a model's dictionaries."""

    def __init__(self, model: Model) -> None:
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=5, search_log=4, window_log=16, hash_log=14, chain_log=14,
            write_content_size=False, write_checksum=False, write_dict_id=False)

        def compressor(content: bytes):
            if len(content) < 8:  # no dictionary is as short
                return zstandard.ZstdCompressor(compression_params=settings)
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(compression_params=settings, dict_data=held)

        self.ordinary, self.toxic = compressor(model.ordinary), compressor(model.ordinary + model.toxic)

    def __call__(self, text: str) -> np.ndarray:
        b, a, c = _bytes(text), self.ordinary.compress, self.toxic.compress
        return np.array([len(a(w)) - len(c(w)) for w in (
            b[i:i + WINDOW] for i in range(0, max(1, len(b) - WINDOW + STEP), STEP))], dtype=np.int64)


def features(gain: np.ndarray) -> list[float]:
    best = np.sort(gain)[::-1]
    return [float(best[0]), float(best[:2].mean()), float(best[:4].mean()), *[float((gain >= k).mean()) for k in range(1, 6)],
            *[float(np.log1p((gain >= k).sum())) for k in (2, 3, 4)], float(gain.mean()), float(np.log(len(gain)))]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression with a small penalty, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.eye(len(w)), x.T @ (weight * (p - y)) + w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], prior: float) -> Model:
    """Train on labelled texts: three of four make the dictionaries, every fourth calibrates; ``prior`` is the share of
    toxic documents among all labelled ones."""
    if len(toxic) < 8 or len(ordinary) < 8:
        return Model(b"", b"", None, None, None, prior)
    part = lambda texts, held: [t for i, t in enumerate(texts) if (i % 4 == 3) == held]
    content, bad, good = _content(part(ordinary, False)), part(toxic, True), part(ordinary, True)
    y = np.r_[np.ones(len(bad)), np.zeros(len(good))]
    weight = np.where(y == 1, prior / len(bad), (1 - prior) / len(good)) * len(y)
    best: tuple[float, Model] | None = None
    for lengths in GRAMS:  # the choice that calibrates best
        toxic_part = _passages(part(toxic, False), part(ordinary, False), lengths)
        gains = Gains(Model(content, toxic_part, None, None, None, prior))
        x = np.array([features(gains(t)) for t in bad + good])
        mean, scale = x.mean(0), x.std(0) + 1e-9
        x = np.c_[(x - mean) / scale, np.ones(len(x))]
        weights = _fit(x, y, weight)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -float((weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean())
        if best is None or loss < best[0]:
            best = loss, Model(content, toxic_part, mean, scale, weights, prior)
    return best[1]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from labelled documents: ``labels`` has the id and the label (0 or 1; null or other values are left out).

    The sample holds at most TOXIC_DOCS and ORDINARY_DOCS different texts, chosen by a hash of the text. A text with both
    labels counts as toxic. Null ids match nothing. The texts of the sample are all that comes to the driver.
    """
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).filter(
        F.col("__label").isin(0, 1))
    hashed = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(text_or_empty(text)).alias("__h"),
                         F.length(text_or_empty(text)).alias("__n")).filter(F.col("__n").between(1, LONGEST))
    texts = hashed.join(known, "__id").groupBy("__h").agg(F.max("__label").alias("__label"), F.min("__id").alias("__id"))
    texts = texts.persist()
    counts = {r["__label"]: r["count"] for r in texts.groupBy("__label").count().collect()}
    chosen = [r for k, most in ((1, TOXIC_DOCS), (0, ORDINARY_DOCS))
              for r in texts.filter(F.col("__label") == k).orderBy("__h").limit(most).collect()]
    texts.unpersist()
    if not chosen:
        return fit([], [], 0.5)
    spark = docs.sparkSession
    picked = spark.createDataFrame(chosen, texts.schema).select("__h", "__label", "__id")
    rows = docs.select(F.col(doc_id).alias("__id"), text_or_empty(text).alias("__text")).join(
        F.broadcast(picked), "__id").filter(F.xxhash64("__text") == F.col("__h")).dropDuplicates(["__h"]).collect()
    by_label = {k: [r["__text"] for r in sorted(rows, key=lambda r: r["__h"]) if r["__label"] == k] for k in (0, 1)}
    return fit(by_label[1], by_label[0], counts.get(1, 0) / sum(counts.values()))


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic, 0 to 1. Null and empty texts are one window without bytes."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if model.weights is None:
            for texts in batches:
                yield pd.Series(np.full(len(texts), model.prior))
            return
        gains = Gains(model)
        for texts in batches:
            x = np.array([features(gains(t)) for t in texts]).reshape(len(texts), len(model.mean))
            z = np.c_[(x - model.mean) / model.scale, np.ones(len(x))] @ model.weights
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return scored(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids from which nothing is learnt."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(spark: SparkSession, folder: str) -> Model:
    """The model from the documents and labels of a folder, without the held-out fifth."""
    labels = table(spark, folder, "labels").filter(~held_out(F.col("doc_id")))
    return train(table(spark, folder, "documents"), labels)


@query("op9_toxicity_compression")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    model = learn(spark, folder)
    scored = table(spark, folder, "documents").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
