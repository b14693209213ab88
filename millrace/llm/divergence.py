"""Source divergence audit by chunk factorization.

Documents are counted as white-space chunks, per block of documents with one list of distinct chunks. The lists meet by slices of the
chunks: there every globally distinct chunk is split into terms once, and its terms go back to the blocks that hold it. Each
block then adds up, per source and term, distinct documents and occurrences. What sources differ in follows from those counts
in whole numbers. Lists and documents travel as packed arrays.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty
from millrace.session import settle

#: Runs of letters A-Z, a-z and of characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A term counts in a language if so many of its documents hold it.
LEAST_DOCS = 30
#: Shares are in parts of this, with so many occurrences added to each.
SCALE, ADDED = 1_000_000_000, 5
#: Terms that a source reports.
TOP = 50
#: Bytes of text in the blocks that a task holds open, and sources and terms of one comparison.
BLOCK_BYTES = 16_000_000
#: Chunks of documents that a block expands to terms at a time.
ENTRIES = 300_000
SOURCES, TERMS = 256, 4096


_UPPER, _TERM = re.compile("[A-Z]+"), re.compile(TERM)


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes."""
    return zstandard.compress(numbers.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(held: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(held), np.uint8).reshape(4, -1).T).view(np.int32).ravel()


class _Ids(dict):
    """Chunks numbered as they come."""

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = number = len(self)
        return number


class _Block:
    """Documents of one language as numbers of distinct chunks."""

    def __init__(self) -> None:
        self.ids, self.sources, self.size = _Ids(), _Ids(), 0
        self.source: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, source: str, text: str) -> None:
        counts = Counter(text.encode("utf-8", "replace").split())
        self.source.append(self.sources[source])
        self.numbers.append(np.fromiter(map(self.ids.__getitem__, counts), np.int32, len(counts)))
        self.counts.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.size += len(text) + 64

    def rows(self, block: int, lang: str, slices: int) -> Iterator[tuple]:
        """One row of all documents, then one per slice that has chunks."""
        numbers = np.concatenate(self.numbers)
        lengths = np.array([len(x) for x in self.numbers])
        yield (block, lang, None, _packed(numbers), None, None, _packed(np.concatenate(self.counts)), _packed(lengths),
               _packed(np.array(self.source)), list(self.sources))
        chunks, docs = list(self.ids), np.bincount(numbers, minlength=len(self.ids))
        of = np.fromiter((xxhash.xxh3_64_intdigest(c) % slices for c in chunks), np.int64, len(chunks))
        order = np.argsort(of, kind="stable")
        ends = np.flatnonzero(np.diff(of[order])) + 1
        for ids in np.split(order, ends) if len(order) else []:
            joined = zstandard.compress(b"\n".join([chunks[i] for i in ids]), 3)
            yield block, lang, int(of[ids[0]]), _packed(ids), joined, _packed(docs[ids]), None, None, None, None


_BLOCK = ("block long, lang string, slice int, ids binary, chunks binary, docs binary, counts binary, lengths binary, source binary, "
          "sources array<string>")


def _encode(slices: int, bytes_: int):
    """(lang, source, text) -> per block a row of its documents (ids, counts, lengths, source, sources) and, per slice of the
    chunks, a row of those it holds (ids, chunks, docs)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[str, _Block] = defaultdict(_Block)
        made, task, size = 0, TaskContext.get().partitionId(), 0
        columns = [c.split()[0] for c in _BLOCK.split(", ")]

        def closed(lang: str) -> Iterator[pd.DataFrame]:
            nonlocal made
            rows = open_.pop(lang).rows((task << 32) + made, lang, slices)
            made += 1
            while part := list(islice(rows, 256)):
                yield pd.DataFrame(part, columns=columns).astype({"slice": "Int32"})

        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                open_[lang].add(source, text)
                size += len(text) + 64
                if size > bytes_:
                    largest = max(open_, key=lambda k: open_[k].size)
                    size -= open_[largest].size
                    yield from closed(largest)
        for lang in list(open_):
            yield from closed(lang)

    return run


def _terms_of(chunk: bytes) -> Counter:
    found = _TERM.findall(chunk.decode("utf-8", "replace"))
    return Counter(_UPPER.sub(lambda m: m[0].lower(), t) for t in found)


_SPLIT = "slice int, block long, lang string, ids binary, terms binary, times binary, term string, number int, docs long"


def _split(rows: pd.DataFrame) -> pd.DataFrame:
    """All blocks' chunks of a slice -> per block the terms of its chunks (ids, terms, times), and the slice's terms per language
    with a bound on their documents. Each chunk is split once."""
    known, terms, starts, term, times = _Ids(), _Ids(), [0], [], []
    parts = []
    for block, lang, ids, chunks, docs in rows[["block", "lang", "ids", "chunks", "docs"]].itertuples(index=False):
        at = []
        for chunk in zstandard.decompress(chunks).split(b"\n"):
            fresh = len(known)
            at.append(known[chunk])
            if len(known) > fresh:
                found = _terms_of(chunk)
                term += [terms[t] for t in found]
                times += found.values()
                starts.append(len(term))
        parts.append((block, lang, _unpacked(ids), np.array(at), _unpacked(docs)))
    start, term, times = np.array(starts), np.array(term, np.int64), np.array(times, np.int64)
    number, names, bound = int(rows["slice"].iloc[0]), list(terms), {}
    out = []
    for block, lang, ids, at, docs in parts:
        width = start[at + 1] - start[at]
        where = np.repeat(start[at] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        sums = bound.setdefault(lang, np.zeros(len(names), np.int64))
        sums += np.bincount(term[where], np.repeat(docs, width), len(names)).astype(np.int64)
        out.append((number, block, lang, _packed(np.repeat(ids, width)), _packed(term[where]), _packed(times[where]), None, None, None))
    for lang, sums in bound.items():
        out += [(number, None, lang, None, None, None, names[i], i, int(sums[i])) for i in np.flatnonzero(sums)]
    columns = [c.split()[0] for c in _SPLIT.split(", ")]
    return pd.DataFrame(out, columns=columns).astype({"block": "Int64", "number": "Int32", "docs": "Int64"})


def _named(packs: pd.DataFrame, able: pd.DataFrame) -> pd.DataFrame:
    """A slice's packs and its terms that may be kept, by name -> per block the ids of chunks with the numbers of their terms."""
    out = []
    for lang, numbers in able.groupby("tongue"):
        name = np.full(int(numbers["term"].max()) + 1, -1, np.int64)
        name[numbers["term"].to_numpy(np.int64)] = numbers["name"].to_numpy(np.int64)
        for block, ids, terms, times in packs.loc[packs["lang"] == lang, ["block", "ids", "terms", "times"]].itertuples(index=False):
            term = _unpacked(terms)
            found = np.where(term < len(name), name[np.minimum(term, len(name) - 1)], -1)
            use = found >= 0
            if use.any():
                out.append((block, _packed(_unpacked(ids)[use]), found[use].tobytes(), _packed(_unpacked(times)[use])))
    return pd.DataFrame(out, columns=["at", "ids", "names", "times"])


_CELLS = "lang string, slice int, sources array<string>, source binary, name binary, docs binary, n binary"


def _summed(cells: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct cells with the sums of their values."""
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
    return (cells[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values])


def _count(slices: int):
    """A block's documents and the terms of its chunks -> per slice of the terms the documents and occurrences of each source
    and term."""

    def run(docs: pd.DataFrame, packs: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in _CELLS.split(", ")]
        if not len(docs) or not len(packs):
            return pd.DataFrame(columns=columns)
        chunk, times = (np.concatenate([_unpacked(x) for x in packs[c]]) for c in ("ids", "times"))
        names, term = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in packs["names"]]), return_inverse=True)
        order = np.argsort(chunk, kind="stable")
        chunk, term, times = chunk[order], term[order].astype(np.int64), times[order].astype(np.int64)
        block, width = docs.iloc[0], np.int64(len(names))
        ids, counts, lengths, source = (_unpacked(block[c]) for c in ("ids", "counts", "lengths", "source"))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        found, at = [], 0
        while at < len(lengths):  # some documents at a time, so that memory follows the block and not its expansion
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + ENTRIES, "right")) - 1)
            here = slice(starts[at], starts[end])
            low = np.searchsorted(chunk, ids[here], "left")
            many = np.searchsorted(chunk, ids[here], "right") - low
            where = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            doc = np.repeat(np.repeat(np.arange(at, end), lengths[at:end]), many)
            key, n = _summed(doc * width + term[where], np.repeat(counts[here].astype(np.int64), many) * times[where])
            found.append(_summed(source[key // width] * width + key % width, np.ones(len(key), np.int64), n))  # each term of a document once
            at = end
        cells, held, n = _summed(*[np.concatenate(x) for x in zip(*found, strict=True)])
        name = names[cells % width]
        of = (name ^ (name >> 33)) % slices
        order = np.argsort(of, kind="stable")
        out = []
        for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(order) else []:
            out.append((block["lang"], int(of[part[0]]), block["sources"], _packed(cells[part] // width), zstandard.compress(name[part].tobytes(), 1),
                        _packed(held[part]), _packed(n[part])))
        return pd.DataFrame(out, columns=columns)

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The blocks' counts of a language and slice -> lang, source, name, docs, n."""
    known, source, name, docs, n = _Ids(), [], [], [], []
    for row in rows.itertuples(index=False):
        source.append(np.array([known[s] for s in row.sources])[_unpacked(row.source)])
        name.append(np.frombuffer(zstandard.decompress(row.name), np.int64))
        docs.append(_unpacked(row.docs).astype(np.int64))
        n.append(_unpacked(row.n).astype(np.int64))
    names, at = np.unique(np.concatenate(name), return_inverse=True)
    cells, held, total = _summed(np.concatenate(source) * np.int64(len(names)) + at, np.concatenate(docs), np.concatenate(n))
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "source": np.array(list(known), object)[cells // len(names)],
                         "name": names[cells % len(names)], "docs": held, "n": total})


def term_counts(docs: DataFrame, least: int = LEAST_DOCS, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, docs (distinct documents), n (occurrences) of every term in at least ``least`` documents of a language.

    Null texts, languages and sources are empty strings; each row is a document of its own, whatever its id. A
    language's chunks of a term are together in at least as many documents as the term, so that terms below ``least``
    by that bound are not joined back; all others are counted exactly. There are as many slices of the chunks as partitions of the
    documents, so that a slice of all lists is about as long as the list of one partition.
    """
    given = docs.select(*[text_or_empty(F.col(c).cast("string")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    slices = max(1, given.rdd.getNumPartitions())
    blocks = settle(given.mapInPandas(_encode(slices, BLOCK_BYTES), _BLOCK), "blocks")
    lists = blocks.filter("slice IS NOT NULL").select("slice", "block", "lang", "ids", "chunks", "docs")
    split = settle(lists.groupBy("slice").applyInPandas(_split, _SPLIT), "terms")
    terms = split.filter("term IS NOT NULL").select("slice", "lang", "term", "number", "docs")
    able = settle(terms.groupBy("lang", "term").agg(F.sum("docs").alias("bound")).filter(F.col("bound") >= least).select(
        "lang", "term", F.monotonically_increasing_id().alias("name")), "able")
    named = terms.join(able, ["lang", "term"]).select(F.col("slice").alias("of"), F.col("lang").alias("tongue"), F.col("number").alias("term"), "name")
    packs = split.filter("term IS NULL").select("slice", "block", "lang", "ids", "terms", "times")
    back = packs.groupBy("slice").cogroup(named.groupBy("of")).applyInPandas(_named, "at long, ids binary, names binary, times binary")
    held = blocks.filter("slice IS NULL").select("block", "lang", "ids", "counts", "lengths", "source", "sources")
    part = held.groupBy("block").cogroup(back.groupBy("at")).applyInPandas(_count(slices), _CELLS)
    counted = settle(part.groupBy("lang", "slice").applyInPandas(_added, "lang string, source string, name long, docs long, n long"), "counted")
    kept = counted.groupBy("name").agg(F.sum("docs").alias("__docs")).filter(F.col("__docs") >= least).select("name")
    words = able.join(kept, "name").select("name", "term")
    return counted.join(words, "name").select("lang", "source", "term", "docs", "n")


def _share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)) in whole numbers."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    over, under = F.lit(SCALE).cast("decimal(38,0)") * (count + ADDED), (total + ADDED * terms).cast("decimal(38,0)")
    quotient = F.call_function("div", over.cast("decimal(38,0)"), under)
    return F.lit(1).cast("long") + F.when(under > 0, quotient).otherwise(F.lit(0).cast("long"))


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """Shares of two blocks of sources in some terms of a language (term null: the share of a term that the source lacks, and
    how many terms there are) -> sum of differences per pair of sources."""
    lang, low, high = rows["lang"].iloc[0], int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
    at, names = pd.factorize(rows["source"])
    base = rows["term"].isna().to_numpy()
    none, width = np.zeros(len(names), np.int64), int(rows["width"].max())
    none[at[base]] = rows["p"].to_numpy()[base]
    side = np.zeros(len(names), np.int64)
    side[at] = rows["side"].to_numpy()
    column, held = pd.factorize(rows["term"].to_numpy()[~base])
    share = np.repeat(none[:, None], len(held), axis=1)
    share[at[~base], column] = rows["p"].to_numpy()[~base]
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    out = []
    for i in left:
        value = np.abs(share[right] - share[i]).sum(axis=1) + (width - len(held)) * np.abs(none[right] - none[i])
        out.append(pd.DataFrame({"lang": lang, "source": names[i], "item": names[right], "value": value}))
        if low != high:
            out.append(pd.DataFrame({"lang": lang, "source": names[right], "item": names[i], "value": value}))
    found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"lang": [], "source": [], "item": [], "value": []})
    return found[found["source"] != found["item"]].astype({"value": "int64"})


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """lang, source, part, item, value (long), rank: how sources of a language differ, and their marking terms.

    Shares are ``_share`` of a group's (lang, source) or a language's count of a kept term, so that a group without terms has shares
    too. Part ``pair``: each other source of the language with the sum of absolute differences over all kept terms. Part ``term``: kept
    terms that the group holds with a larger share than its language, by the difference, the first ``top``. Ranks
    go by value descending, then by the item's bytes. An empty table gives no rows; other columns are not read.
    """
    counted = settle(term_counts(docs, least, text, lang, source), "kept")
    groups = docs.select(*[text_or_empty(F.col(c).cast("string")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    width = counted.groupBy("lang").agg(F.count_distinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_group = settle(groups.join(totals, ["lang", "source"], "left").join(width, "lang", "left").fillna(
        0, ["total", "terms", "lang_total"]), "groups")
    shares = settle(counted.join(per_group, ["lang", "source"]).select(
        "lang", "source", "term", "n", _share("n", "total", "terms").alias("p"), "terms", "lang_total"), "shares")

    # Part pair: shares of blocks of sources meet per slice of the terms; what a source lacks has one share.
    sizes = per_group.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("terms").alias("terms")).select(
        "lang", F.ceil(F.col("sources") / SOURCES).cast("int").alias("sides"),
        F.greatest(F.ceil(F.col("terms") / TERMS), F.lit(1)).cast("int").alias("slices"))
    slice_of = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int")
    side_of = F.pmod(F.xxhash64("source"), F.col("sides")).cast("int")
    widths = counted.select("lang", "term").distinct().join(sizes, "lang").groupBy("lang", slice_of.alias("slice")).agg(
        F.count(F.lit(1)).alias("width"))
    lacking = per_group.join(sizes, "lang").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).join(
        widths, ["lang", "slice"], "left").select(
        "lang", "source", F.lit(None).cast("string").alias("term"),
        F.when(F.col("terms") > 0, _share(F.lit(0), "total", "terms")).otherwise(0).alias("p"),
        "slice", F.coalesce("width", F.lit(0)).alias("width"), side_of.alias("side"), "sides")
    holding = shares.select("lang", "source", "term", "p").join(sizes, "lang").select(
        "lang", "source", "term", "p", slice_of.alias("slice"), F.lit(0).cast("long").alias("width"), side_of.alias("side"), "sides")
    met = lacking.unionByName(holding).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).withColumn(
        "low", F.least("side", "with")).withColumn("high", F.greatest("side", "with")).drop("with", "sides")
    pairs = met.groupBy("lang", "low", "high", "slice").applyInPandas(
        _distances, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    # Part term: a group's shares beside those of its language.
    whole = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    beside = shares.join(whole, ["lang", "term"]).withColumn("q", _share("lang_n", "lang_total", "terms"))
    marking = beside.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (
        F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda part: part.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(marking).filter(F.col("rank") <= top))


OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '{TERM}') AS terms FROM documents
), t AS (
  SELECT r, lang, source, translate(term, '{UPPER}', '{LOWER}') AS term FROM (SELECT r, lang, source, unnest(terms) AS term FROM d)
), k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang
), g AS (
  SELECT a.lang, a.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) a
  LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) s USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000 * CAST(coalesce(c.n, 0) + 5 AS HUGEINT)) // CAST(g.total + 5 * g.v AS HUGEINT) AS BIGINT) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT lang, term, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // CAST(sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)
         AS HUGEINT) AS BIGINT) AS q FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    GROUP BY x.lang, x.source, y.source) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
), marks AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marks)) WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
