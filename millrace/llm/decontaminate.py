"""Benchmark decontamination: windows of a document as long as an item, compared with the items by SimHash.

A window is laid wherever a shingle of the document is a shingle of an item, so that both shingles lie on each other; any other
window has similarity 0. Its fingerprint is looked up in blocks of bits: with one block more than the radius, fingerprints
within the radius agree in some block. What is within the radius is verified by the exact similarity of the shingles,
weighted by how often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.shingles import Words, shingle_hashes, word_hashes

BITS, RADIUS = 64, 20
#: Items that go to the tasks at a time; more items mean more passes over the documents.
ITEMS = 5000
SCHEMA = "doc_id long, item_id long, similarity double, start long, end long"
_SHIFTS = np.arange(BITS, dtype=np.uint64)


def _bits(shingles: np.ndarray) -> np.ndarray:
    return ((shingles[:, None] >> _SHIFTS) & np.uint64(1)).astype(np.int32)


def _pack(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints from the number of ones per bit among ``counts`` shingles."""
    return ((2 * ones > counts[:, None]).astype(np.uint64) << _SHIFTS).sum(axis=1, dtype=np.uint64)


class Items:
    """Benchmark items with their shingle places, fingerprints and blocks of bits."""

    def __init__(self, rows: list[tuple[int, str | None]], width: int, radius: int = RADIUS) -> None:
        self.width, self.radius, known = width, radius, Words()
        words = [(i, word_hashes(t, known, True)) for i, t in rows]
        words = [(i, w) for i, w in words if len(w)]
        self.ids = [i for i, _ in words]
        self.lengths = np.array([len(w) for _, w in words], np.int64)
        self.short = sorted({len(w) for _, w in words if len(w) < width})
        runs = [shingle_hashes(w, width) for _, w in words]
        self.sets = [np.unique(r, return_counts=True) for r in runs]
        self.sizes = np.array([len(r) for r in runs], np.int64)
        shingle = np.concatenate([*runs, np.zeros(0, np.uint64)])
        by = np.argsort(shingle, kind="stable")
        self.shingle = shingle[by]
        self.item = np.repeat(np.arange(len(runs)), self.sizes)[by]
        self.place = np.concatenate([*(np.arange(len(r)) for r in runs), np.zeros(0, np.int64)])[by]
        self.prints = _pack(np.array([_bits(r).sum(0) for r in runs]).reshape(-1, BITS), self.sizes)
        edges = [k * BITS // (radius + 1) for k in range(radius + 2)]
        self.blocks = []
        for a, b in zip(edges, edges[1:]):
            mask = np.uint64(((1 << (b - a)) - 1) << a)
            held: dict[int, list[int]] = {}
            for k, value in enumerate((self.prints & mask).tolist()):
                held.setdefault(value, []).append(k)
            self.blocks.append((mask, {v: np.array(ks) for v, ks in held.items()}))

    def near(self, mark: np.uint64) -> np.ndarray:
        """All items whose fingerprint differs in at most ``radius`` bits."""
        parts = [held[v] for mask, held in self.blocks if (v := int(mark & mask)) in held]
        if not parts:
            return np.zeros(0, np.int64)
        some = np.unique(np.concatenate(parts))
        return some[np.bitwise_count(self.prints[some] ^ mark) <= self.radius]

    def windows(self, runs: np.ndarray, n_words: int) -> np.ndarray:
        """Distinct (start, words) of the windows to look at; the rows of ``runs`` are the document's shingles in order."""
        low, high = np.searchsorted(self.shingle, runs, "left"), np.searchsorted(self.shingle, runs, "right")
        n = high - low
        if not n.any():
            return np.zeros((0, 2), np.int64)
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        items = self.item[at]
        start = np.repeat(np.arange(len(runs)), n) - self.place[at]
        start = np.clip(start, 0, np.maximum(n_words - self.lengths[items], 0))
        return np.unique(np.stack([start, np.minimum(self.lengths[items], n_words - start)], axis=1), axis=0)

    def matches(self, words: np.ndarray, least: float) -> list[tuple]:
        """(item, similarity, start, end) of the best window per item of a document given as word hashes."""
        best: dict[int, tuple] = {}
        if not len(words) or not len(self.ids):
            return []
        for width in [self.width, *self.short]:
            # An item of fewer words than a shingle is one shingle; a run of as many words of the document is its window.
            if len(words) < width and width == self.width:
                runs = shingle_hashes(words, len(words))
            elif len(words) < width:
                continue
            else:
                runs = shingle_hashes(words, width)
            spans = self.windows(runs, len(words))
            if not len(spans):
                continue
            size = min(width, len(words))
            counts = np.maximum(spans[:, 1] - size + 1, 1)
            if len(runs) <= 4 * int(counts.sum()):
                sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(_bits(runs), axis=0, dtype=np.int32)])
                ones = sums[spans[:, 0] + counts] - sums[spans[:, 0]]
            else:
                ones = np.array([_bits(runs[s:s + c]).sum(0) for s, c in zip(spans[:, 0], counts, strict=True)])
            for (start, length), mark, count in zip(spans.tolist(), _pack(ones, counts), counts.tolist(), strict=True):
                near = self.near(mark)
                if not len(near):
                    continue
                own, often = np.unique(runs[start:start + count], return_counts=True)
                for k in near.tolist():
                    other, times = self.sets[k]
                    _, x, y = np.intersect1d(own, other, assume_unique=True, return_indices=True)
                    both = int(np.minimum(often[x], times[y]).sum())
                    similarity = both / (count + int(self.sizes[k]) - both)
                    if similarity >= least and (k not in best or (-similarity, start) < (-best[k][0], best[k][1])):
                        best[k] = (similarity, start, start + length)
        return [(self.ids[k], *v) for k, v in sorted(best.items())]


def _search(items: Items, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words()
        for batch in batches:
            found = [(i, *m) for i, t in zip(batch["doc_id"], batch["text"], strict=True)
                     for m in items.matches(word_hashes(t, known, True), least)]
            yield pd.DataFrame(found, columns=["doc_id", "item_id", "similarity", "start", "end"]).astype(
                {"doc_id": "Int64", "item_id": "Int64", "similarity": "float64", "start": "int64", "end": "int64"})

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """Documents and the items they hold: doc_id, item_id, similarity, start, end (words, end exclusive) of the best window.

    One row per document row and item, the first of equally good windows. Words are lower-cased. Null and empty texts and
    items hold nothing; null ids are kept as they are; repeated rows give repeated results; an empty benchmark gives none.
    The items go to the tasks in blocks of bounded size, whatever their number.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in _item_blocks(benchmark, width, item_id, item_text, block):
        one = given.mapInPandas(_search(items, least), SCHEMA)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def _item_blocks(benchmark: DataFrame, width: int, item_id: str, item_text: str, block: int) -> Iterator[Items]:
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter(
        "t IS NOT NULL").orderBy("i", "t").toLocalIterator()
    while part := [(r["i"], r["t"]) for r in islice(rows, block)]:
        yield Items(part, width)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, width: int = 5, text: str = "text",
                        item_id: str = "item_id", item_text: str = "text", block: int = ITEMS) -> DataFrame:
    """The documents that hold no item, in the columns of the input. Each row is judged by its own text, whatever its id, so
    rows without an id and repeated ids are decided like any other; null texts hold nothing."""
    for items in _item_blocks(benchmark, width, item_id, item_text, block):
        docs = docs.filter(~_holds(items, least)(F.coalesce(F.col(text), F.lit(""))))
    return docs


def _holds(items: Items, least: float):
    @F.pandas_udf("boolean")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Words()
        for texts in batches:
            yield pd.Series([bool(items.matches(word_hashes(t, known, True), least)) for t in texts], dtype=bool)

    return held


@query("op1_benchmark_simhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
