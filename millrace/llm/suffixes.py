"""Removal of every byte that lies in a string of LENGTH bytes which also starts somewhere else in the corpus.

Suffixes are sampled by content: each string has one anchor, the leftmost smallest hash of 16 bytes among its first WINDOW
places, so equal strings have it at equal offsets. All strings of an anchor share the leading CORE bytes of the anchor's suffix.

1. Suffixes whose leading bytes occur once are done (counted by hash). Where the whole run of strings around an anchor
   occurs twice, all its strings are repeated (counted by a 128-bit hash).
2. What is left are the borders of repeated passages: leading bytes that are shared, but a run that is not. Sampled splitters
   range-partition these suffixes by their leading bytes, and no border of a range cuts equal leading bytes. Each bucket
   sorts its suffixes by multikey quicksort, compares neighbours, does the same for the bytes before the anchor read
   backwards, and a string is repeated if another suffix shares both its part after and its part before the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty
from millrace.llm.shingles import mixed
from millrace.session import settle

LENGTH, WINDOW, GRAM = 400, 128, 16
CORE = LENGTH - WINDOW + 1
#: Different suffixes of equal leading bytes that one bucket sorts; beyond that their strings are counted one by one, by hash.
BUCKET = 100_000
#: Per-text lists are broadcast only if so few texts and places were counted.
BROADCAST_TEXTS, BROADCAST_PLACES = 200_000, 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of the base of the running hash, and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse)], dtype=np.uint64)
        return self.up, self.down


class Anchors:
    """Runs of string starts with one anchor: anchor, first, last (places in the text), and hashes of byte ranges."""

    def __init__(self, raw: bytes, powers: Powers) -> None:
        n = len(raw)
        words = np.ndarray((n - 7,), "<u8", raw, 0, (1,))
        with np.errstate(over="ignore"):
            grams = mixed(words[:n - GRAM + 1] * _BASE + mixed(words[8:8 + n - GRAM + 1]))
            self.down = powers(n)[1]
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * powers(n)[0][:len(grams)], dtype=np.uint64)])
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span < WINDOW:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        at = (least[:n - LENGTH + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        self.anchor, self.first, self.last = at[starts], starts, np.r_[starts[1:], len(at)] - 1

    def hashes(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        """64 bits for the bytes of each range (of at least 16 bytes); equal bytes have equal hashes."""
        with np.errstate(over="ignore"):
            h = (self.sums[end - GRAM + 1] - self.sums[start]) * self.down[start]
        return mixed(h ^ mixed((end - start).astype(np.uint64) + np.uint64(salt << 32))).astype(np.int64)

    def cores(self) -> np.ndarray:
        return self.hashes(self.anchor, self.anchor + CORE, 1)

    def wholes(self) -> np.ndarray:
        """Hash of the whole run and of the anchor's place in it."""
        h = self.hashes(self.first, self.last + LENGTH, 2).astype(np.uint64)
        return mixed(h ^ mixed((self.anchor - self.first).astype(np.uint64))).astype(np.int64)


def _texts(batch: pd.DataFrame) -> Iterator[tuple[int, bytes]]:
    for i, text in enumerate(batch["text"]):
        raw = text.encode("utf-8", "replace")
        if len(raw) >= LENGTH:
            yield i, raw


def _cores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    powers = Powers()
    for batch in batches:
        parts = [Anchors(raw, powers).cores() for _, raw in _texts(batch)]
        for k in range(0, len(parts), 2000):
            yield pd.DataFrame({"core": np.concatenate(parts[k:k + 2000])})


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    powers = Powers()
    for batch in batches:
        h1, h2, rows, size = batch["h1"].to_numpy(), batch["h2"].to_numpy(), [], 0
        for i, raw in _texts(batch):
            a = Anchors(raw, powers)
            rows.append((a.cores(), a.wholes(), np.full(len(a.first), h1[i]), np.full(len(a.first), h2[i]), a.first, a.last, a.anchor))
            size += len(a.first)
            if size > 200_000:
                yield pd.DataFrame(dict(zip(RUN, map(np.concatenate, zip(*rows, strict=True)), strict=True)))
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(dict(zip(RUN, map(np.concatenate, zip(*rows, strict=True)), strict=True)))


RUN = ("core", "whole", "h1", "h2", "first", "last", "anchor")


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts with their border runs -> the bytes of each run."""
    for batch in batches:
        rows = []
        for row in batch.itertuples():
            raw = row.text.encode("utf-8", "replace")
            for p in row.places:
                rows.append((p["core"], p["whole"], row.h1, row.h2, p["first"], p["last"], p["anchor"], p["n"], p["many"],
                             raw[p["anchor"]:p["anchor"] + 32], raw[p["first"]:p["last"] + LENGTH]))
            if len(rows) > 5_000:
                yield pd.DataFrame(rows, columns=CONTEXT)
                rows = []
        yield pd.DataFrame(rows, columns=CONTEXT)


CONTEXT = [*RUN, "n", "many", "lead", "bytes"]


def multikey_order(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the rows (bytes, a multiple of 8 wide) within ascending groups: multikey quicksort, eight bytes at a time.

    Only rows that are still equal to another one take part in the next step.
    """
    words = rows.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    tied = np.r_[False, group[order][1:] == group[order][:-1]]  # equal to the row before, so far
    for column in range(words.shape[1]):
        live = np.flatnonzero(tied | np.r_[tied[1:], False])
        if not len(live):
            break
        block = np.cumsum(~tied)[live]
        value = words[order[live], column]
        again = np.lexsort((value, block))
        order[live], value = order[live][again], value[again]
        tied[live] = np.r_[False, (value[1:] == value[:-1]) & (block[1:] == block[:-1])]
    return order


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the common start of each row and the one before."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 50_000):
        differ = rows[a:a + 50_000] != rows[a - 1:a - 1 + len(rows[a:a + 50_000])]
        out[a:a + 50_000] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def repeated_strings(core: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, texts: list[bytes]) -> list[tuple]:
    """(row, from, to): ranges covered by strings that another row holds too. All rows of a core must be given."""
    n = len(texts)
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, WINDOW), np.uint8)
    for i, raw in enumerate(texts):
        a = np.frombuffer(raw, np.uint8)
        k = anchor[i] - first[i]
        right[i, :len(a) - k] = a[k:]
        left[i, :k] = a[:k][::-1]
    _, group = np.unique(core, return_inverse=True)
    ranges = []
    for side in (right, left):
        order = multikey_order(side, group)
        shared = _common(side[order])
        shared[np.r_[True, group[order][1:] != group[order][:-1]]] = -1
        ranges.append((order, shared))
    low, high = anchor - last, anchor - first
    marks = np.zeros((n, WINDOW), bool)
    ids = np.empty((2, n), np.int64)
    for offset in range(WINDOW):
        rows = np.flatnonzero((low <= offset) & (offset <= high))
        if len(rows) < 2:
            continue
        for side, (order, shared), need in zip(ids, ranges, (LENGTH - offset, offset), strict=True):
            side[order] = np.cumsum(shared < need)
        both = ids[0, rows] * n + ids[1, rows]
        _, where, count = np.unique(both, return_inverse=True, return_counts=True)
        marks[rows[count[where] > 1], offset] = True
    out = []
    for i in np.flatnonzero(marks.any(1)):
        starts = anchor[i] - np.flatnonzero(marks[i])[::-1]
        cuts = np.flatnonzero(np.diff(starts) > 1)
        for a, b in zip(np.r_[starts[0], starts[cuts + 1]], np.r_[starts[cuts], starts[-1]], strict=True):
            out.append((i, int(a), int(b) + LENGTH))
    return out


def _sorted_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Border runs in order of their leading bytes -> ranges (h1, h2, from, to) of repeated strings."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        open_core = rows["core"].iloc[-1]
        rest, done = rows[rows["core"] == open_core], rows[rows["core"] != open_core]
        if len(done):
            yield _ranges(done.reset_index(drop=True))
    if rest is not None and len(rest):
        yield _ranges(rest.reset_index(drop=True))


def _ranges(rows: pd.DataFrame) -> pd.DataFrame:
    found = repeated_strings(*(rows[c].to_numpy() for c in ("core", "first", "last", "anchor")), rows["bytes"].tolist())
    at = np.array([f[0] for f in found], np.int64)
    out = rows.iloc[at][["h1", "h2", "n"]]
    out = out.assign(**{"from": [f[1] for f in found], "to": [f[2] for f in found]})
    return out[out["n"] == 1][["h1", "h2", "from", "to"]]  # runs found twice are already covered as a whole


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each string of a border run by hash, for leading bytes that too many suffixes share."""
    for batch in batches:
        for row in batch.itertuples():
            starts = range(row.last - row.first + 1)
            digest = [hashlib.blake2b(row.bytes[s:s + LENGTH], digest_size=16).digest() for s in starts]
            yield pd.DataFrame({"string": digest, "h1": row.h1, "h2": row.h2, "from": [row.first + s for s in starts]})


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ranges of a text -> the maximal ranges that they cover."""
    for batch in batches:
        starts, ends = [], []
        for a, b in zip(batch["from"], batch["to"], strict=True):
            reach = np.maximum.accumulate(b)
            new = np.r_[True, a[1:] > reach[:-1]]
            starts.append(a[new])
            ends.append(reach[np.r_[new[1:], True]])
        yield pd.DataFrame({"h1": batch["h1"], "h2": batch["h2"], "from": starts, "to": ends})


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first in range(0, len(batch), 500):
            part, rows = batch.iloc[first:first + 500], []
            for doc, text, starts, ends in zip(part["doc_id"], part["text"], part["from"], part["to"], strict=True):
                raw, at, kept, spans = text.encode("utf-8", "replace"), 0, [], []
                if starts is not None:
                    spans = [f"{a}:{b}" for a, b in zip(starts, ends, strict=True)]
                    for a, b in zip(starts, ends, strict=True):
                        kept.append(raw[at:a])
                        at = b
                kept = b"".join([*kept, raw[at:]])
                rows.append((doc, len(raw), len(raw) - len(kept), len(spans), kept, ",".join(spans), kept.decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed", "text"]).astype({"doc_id": "Int64"})


def _beside(keyed: DataFrame, per_text: DataFrame, places: int, how: str) -> DataFrame:
    """Texts with their stored lists; the lists are broadcast only if they were counted and are few."""
    few = places <= BROADCAST_PLACES and per_text.count() <= BROADCAST_TEXTS
    return keyed.join(F.broadcast(per_text) if few else per_text, ["h1", "h2"], how)


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Ranges that repeated strings cover: h1, h2 (hashes of a text), from and to (sorted arrays, bytes, end exclusive)."""
    keyed = docs.select(text_or_empty(text).alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    shared = settle(keyed.select("text").mapInPandas(_cores, "core long").groupBy("core").count().filter(
        "count > 1").select("core"), "cores")
    runs = keyed.mapInPandas(_runs, "core long, whole long, h1 long, h2 long, first int, last int, anchor int")
    few = F.broadcast(shared) if shared.count() <= 1_000_000 else shared
    live = settle(runs.join(few, "core", "left_semi"), "runs")
    wholes = live.groupBy("core", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("h1", "h2", "first", "last", "anchor")).alias("at"))
    cores = wholes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    counted = settle(wholes.join(cores, "core").select("core", "whole", "n", "at", "kinds", "least"), "wholes")
    covered = live.join(counted.filter("n > 1").select("core", "whole"), ["core", "whole"], "left_semi").select(
        "h1", "h2", F.col("first").alias("from"), (F.col("last") + LENGTH).alias("to"))

    border = counted.filter("kinds > 1 AND least = 1").select("core", "whole", "n", "at.*", (F.col("kinds") > BUCKET).alias("many"))
    per_text = settle(border.groupBy("h1", "h2").agg(F.collect_list(
        F.struct("core", "whole", "first", "last", "anchor", "n", "many")).alias("places")), "borders")
    places = per_text.agg(F.sum(F.size("places"))).first()[0] or 0
    contexts = settle(_beside(keyed, per_text, int(places), "inner").select("h1", "h2", "text", "places").mapInPandas(
        _contexts, "core long, whole long, h1 long, h2 long, first int, last int, anchor int, n long, many boolean, "
        "lead binary, bytes binary").dropDuplicates(["core", "whole"]), "contexts")
    spans = "h1 long, h2 long, from int, to int"
    sorted_in = contexts.filter("NOT many").repartitionByRange("lead", "core").sortWithinPartitions("lead", "core")
    edges = sorted_in.mapInPandas(_sorted_buckets, spans)
    if contexts.filter("many").isEmpty():
        found = covered.unionByName(edges)
    else:
        strings = contexts.filter("many").mapInPandas(_strings, "string binary, h1 long, h2 long, from int")
        twice = strings.groupBy("string").count().filter("count > 1").select("string")
        found = covered.unionByName(edges).unionByName(strings.join(twice, "string", "left_semi").select(
            "h1", "h2", "from", (F.col("from") + LENGTH).alias("to")))
    ranges = found.distinct().groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("r"))
    parts = ranges.select("h1", "h2", F.transform("r", lambda x: x["from"]).alias("from"), F.transform("r", lambda x: x["to"]).alias("to"))
    return settle(parts.mapInPandas(_merged, "h1 long, h2 long, from array<int>, to array<int>"), "ranges")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining UTF-8 bytes), and removed, the ranges that
    went (bytes of the input, ``start:end`` with the end exclusive, joined by commas), and text, the remaining text: where a cut
    goes through a character, its bytes show as the replacement character.

    Strings are judged on the input; a null text is empty; texts shorter than LENGTH bytes stay whole. Equal rows are
    documents of their own, so their long texts go entirely. Only id and text are read.
    """
    found = repeats(docs, text)
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    places = found.agg(F.sum(F.size("from"))).first()[0] or 0
    return _beside(keyed, found, int(places), "left").select("doc_id", "text", "from", "to").mapInPandas(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed string, text string")


@query("op6_suffix_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "removed", "text")
