"""Line deduplication by alignment: documents that share lines are aligned, and the later one loses the common blocks.

The later document of a pair is the one with the larger id. Of all earlier holders of a line or of a run of lines, the first
is the one to align with: it keeps what is repeated, so the pairs stay as many as (document, first holder) combinations,
whatever the size of a group of copies. Runs matter where lines of a common block have first holders of their own, or stand
there in another order.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty
from millrace.session import settle

#: Shortest block of common lines that is deleted, in words over all of its lines.
BLOCK_WORDS = 5
#: Ids are broadcast only if their counted rows are few.
BROADCAST_IDS = 1_000_000


def _unique(lines: list[int], low: int, high: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for i in range(low, high):
        seen[lines[i]] = -1 if lines[i] in seen else i
    return {k: i for k, i in seen.items() if i >= 0}


def _longest_rising(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (i, j), sorted by i, with rising j (patience sorting)."""
    tops: list[int] = []
    heads: list[int] = []
    back: list[int] = []
    for at, (_, j) in enumerate(places):
        pile = bisect_left(tops, j)
        back.append(heads[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            heads.append(at)
        else:
            tops[pile], heads[pile] = j, at
    out, at = [], heads[-1] if heads else -1
    while at >= 0:
        out.append(places[at])
        at = back[at]
    return out[::-1]


def align(one: list[int], two: list[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs of places of lines that are aligned.

    Equal lines at both ends are aligned; between them, lines that occur once on either side are, as far as their
    order agrees; the stretches between those are aligned in turn. Stretches wait in a list, so depth costs no stack.
    """
    out, waiting = [], [(0, len(one), 0, len(two))]
    while waiting:
        a, b, c, d = waiting.pop()
        while a < b and c < d and one[a] == two[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and one[b - 1] == two[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        left, right = _unique(one, a, b), _unique(two, c, d)
        fixed = _longest_rising(sorted((i, right[k]) for k, i in left.items() if k in right))
        for (i, j), (k, m) in zip([(a - 1, c - 1), *fixed], [*fixed, (b, d)]) if fixed else ():
            waiting.append((i + 1, k, j + 1, m))
        out += fixed
    return sorted(out)


def _blocks(later: list[int], words: list[int], earlier: list[int], least: int) -> list[int]:
    """Places of the later document's lines in aligned common blocks of enough words."""
    gone: list[int] = []
    block: list[int] = []
    before = (-2, -2)
    for i, j in [*align(later, earlier), (-9, -9)]:
        if block and (i, j) != (before[0] + 1, before[1] + 1):
            if sum(words[k] for k in block) >= least:
                gone += [k for k in block if words[k]]
            block = []
        if i >= 0:
            block.append(i)
        before = (i, j)
    return gone


def _runs(lines: list[int], words: list[int], least: int) -> set[int]:
    """Hashes of the runs of lines that two documents with a common block share.

    Those are, for each line with words, the run to the next such line, and the shortest runs of ``least`` words that start or
    end with it: in a block of as many words, every line is in one of these. A run of one line is left out.
    """
    held = [i for i, w in enumerate(words) if w]
    ends = set(zip(held, held[1:]))
    total, low = 0, 0
    for high, i in enumerate(held):  # the shortest run that ends here
        total += words[i]
        while total - words[held[low]] >= least:
            total -= words[held[low]]
            low += 1
        if total >= least and low < high:
            ends.add((held[low], i))
    total, high = 0, 0
    for low, i in enumerate(held):  # the shortest run that starts here
        while total < least and high < len(held):
            total += words[held[high]]
            high += 1
        if total >= least and high - 1 > low:
            ends.add((i, held[high - 1]))
        total -= words[i]
    return {hash(tuple(lines[i:j + 1])) for i, j in ends}


def _run_hashes(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(i, h) for i, lines, words in zip(batch["id"], batch["lines"], batch["words"], strict=True)
                     for h in _runs(lines.tolist(), words.tolist(), least)]
            yield pd.DataFrame(found, columns=["id", "h"], dtype="int64")

    return run


def _aligned(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for later, lines, words, other in zip(batch["id"], batch["lines"], batch["words"], batch["other"], strict=True):
                rows += [(later, k) for k in _blocks(list(lines), list(words), list(other), least)]
            yield pd.DataFrame(rows, columns=["id", "at"], dtype="int64")

    return run


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rare: int | None = None,
                   least: int = BLOCK_WORDS) -> DataFrame:
    """Lines to delete: id, removed (sorted places of lines, from 0). Only documents that lose a line are in it.

    Lines end at \\n; lines without a word stay and make no pair. Two documents are aligned if the larger id has the other
    as the first holder of a line or of a short run of lines (two, or as many as have ``least`` words), however many documents
    hold it; a caller that names ``rare`` gets first holders of lines only, without pairs of a single line that more
    documents hold. Documents are judged on the input. Of rows with equal ids the one with the most lines (then the largest hash) stands for the id. Rows
    without an id and null or empty texts lose nothing.
    """
    line = F.transform(F.split(text_or_empty(text), "\n"), lambda x: F.struct(
        F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("w")))
    split = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), line.alias("l")).select(
        "id", F.transform("l", lambda x: x["h"]).alias("lines"), F.transform("l", lambda x: x["w"]).alias("words"))
    listed = settle(split, "lines")
    repeated = listed.groupBy("id").count().filter("count > 1").select("id")
    if not repeated.isEmpty():
        best = listed.join(repeated, "id", "left_semi").groupBy("id").agg(F.max(
            F.struct(F.size("lines"), F.xxhash64("lines"), "lines", "words")).alias("x")).select("id", "x.lines", "x.words")
        listed = settle(listed.join(repeated, "id", "left_anti").unionByName(best), "lines")
    each = listed.select("id", F.explode(F.arrays_zip("lines", "words")).alias("x")).filter("x.words > 0").select(
        "id", F.col("x.lines").alias("h")).distinct()
    holders = each.groupBy("h").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = each.join(holders, "h").filter("id > first").groupBy("id", "first").agg(
        F.count(F.lit(1)).alias("shared"), F.min("n").alias("least"))
    if rare is not None:
        met = met.filter((F.col("least") <= rare) | (F.col("shared") > 1))
    else:
        runs = settle(listed.filter(F.size("lines") > 1).mapInPandas(_run_hashes(least), "id long, h long"), "runs")
        begun = runs.groupBy("h").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = met.select("id", "first").unionByName(
            runs.join(begun, "h").filter("id > first").select("id", "first")).distinct()
    pairs = settle(met.select("id", "first"), "pairs")
    later = pairs.join(listed, "id")
    both = later.join(listed.select(F.col("id").alias("first"), F.col("lines").alias("other")), "first")
    gone = both.select("id", "lines", "words", "other").mapInPandas(_aligned(least), "id long, at long")
    return settle(gone.groupBy("id").agg(F.sort_array(F.collect_set("at")).alias("removed")), "removed")


def remove_lines(docs: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the given lines, in the columns of the input; a text that loses every line becomes empty."""
    few = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    gone = few.select(F.col("id").alias("__id"), F.col("removed").alias("__removed"))
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("__removed", i.cast("long"))), "\n")
    return docs.join(gone, F.col(doc_id) == F.col("__id"), "left").withColumn(
        text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)


@query("op3_patience_lines")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    removed = repeated_lines(docs).withColumnsRenamed({"id": "doc_id"})
    counted = docs.select("doc_id", F.size(F.split(text_or_empty(), "\n")).cast("long").alias("n_lines"))
    few = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    return counted.join(few, "doc_id", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("removed", lambda x: x.cast("string")), ","), F.lit("")).alias("removed"))
