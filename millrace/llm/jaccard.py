"""Similarity join on word shingles by a token-group matrix, and the components of its links.

Equal sets are one class. Classes that can reach the similarity share the content of a part of the token space (below).
Among those, the number of tokens per slot of a hash bounds the overlap from above; what reaches the bound is connected to
families. In a family, similar documents form groups; each group keeps the union of its tokens; a document's overlap with the
union bounds its overlap with every member, so only groups that reach the bound are opened. For the number of links every pair
of an opened group is verified; where only components are asked for, no further pair between two connected ones matters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.components import components
from millrace.llm.shingles import Words, mixed, shingle_hashes, word_hashes
from millrace.session import settle

#: Tokens that one block of a large family may hold; a task works on two blocks.
BLOCK_TOKENS = 1_000_000
#: Ids are broadcast only if their counted rows are at most so many.
BROADCAST_IDS = 1_000_000
#: Words of short texts that are hashed in one go.
RUN_WORDS = 50_000
#: Documents in a group of the matrix.
GROUP_DOCS = 32
#: Documents of one part that a task compares at a time, and parts per task.
PART_DOCS, PARTS_PER_TASK = 2000, 20_000


class Parts:
    """Signatures such that documents of similarity >= percent / 100 share at least one.

    Sizes fall into classes. For sizes a <= b that can reach the similarity, at most (a + b)(100 - p) / (100 + p) tokens
    are in one set only. With k + 1 parts of the token space more than that for the class of a, k + 1 parts have the same
    content in both. A document with at most k empty parts need not sign for those: one of the k + 1 is not empty. A
    document signs for its own class and for those of the smaller partners that it can have.
    """

    def __init__(self, percent: int, ratio: float = 1.2) -> None:
        self.percent, low = percent, [1]
        while low[-1] < 2**31:
            low.append(max(low[-1] + 1, int(low[-1] * ratio)))
        self.low = np.array(low)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        n, p = len(tokens), self.percent
        first = int(np.searchsorted(self.low, -(-n * p // 100), side="right")) - 1
        last = int(np.searchsorted(self.low, n, side="right")) - 1
        scrambled = mixed(tokens + np.uint64(0x51ED270B))
        out = []
        for c in range(max(first, 0), last + 1):
            high = int(self.low[c + 1]) - 1
            most = (high + high * 100 // p) * (100 - p) // (100 + p)
            spare = most // 8
            m = most + spare + 1
            part = ((tokens >> np.uint64(17)) % np.uint64(m)).astype(np.int64)
            content, held = np.zeros(m, np.uint64), np.bincount(part, minlength=m) > 0
            np.add.at(content, part, scrambled)
            signs = mixed(content ^ mixed(np.arange(m, dtype=np.uint64) + np.uint64(c << 40)))
            out.append(signs[held] if m - held.sum() <= spare else signs)
        # 40 bits are enough: a chance match is only one more candidate.
        return (np.concatenate(out) >> np.uint64(24)).astype(np.int64)


def _sets(texts: pd.Series, width: int, known: Words) -> Iterator[np.ndarray]:
    """The sorted set of each text. Some texts at a time are hashed as one row of words; shingles across their borders are left out."""
    words, size = [], 0
    for text in texts:
        words.append(word_hashes(text, known))
        size += len(words[-1])
        if size > RUN_WORDS:
            yield from _distinct(words, width)
            words, size = [], 0
    if words:
        yield from _distinct(words, width)


def _distinct(words: list[np.ndarray], width: int) -> Iterator[np.ndarray]:
    runs, at = shingle_hashes(np.concatenate(words), width), 0
    for own in words:
        tokens = np.sort(runs[at:at + len(own) - width + 1] if len(own) >= width else shingle_hashes(own, width))
        at += len(own)
        first = np.ones(len(tokens), bool)
        np.not_equal(tokens[1:], tokens[:-1], out=first[1:])
        yield tokens[first]


def _keys(width: int):
    """(id, text) -> id, n, and 128 bits that stand for the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words()
        for batch in batches:
            rows = [(len(s), *_key(s)) for s in _sets(batch["text"], width, known)]
            n, k1, k2 = np.array(rows, np.int64).reshape(-1, 3).T
            yield pd.DataFrame({"id": batch["id"], "n": n, "k1": k1, "k2": k2})

    return run


def _signatures(width: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, parts = Words(), Parts(percent)
        for batch in batches:
            ids, signs, size = [], [], 0
            for i, s in zip(batch["id"], _sets(batch["text"], width, known), strict=True):
                if len(s):
                    signs.append(parts.of(s))
                    ids.append(np.full(len(signs[-1]), i, np.int64))
                    size += len(signs[-1])
                if size > 500_000:
                    yield pd.DataFrame({"sig": np.concatenate(signs), "id": np.concatenate(ids)})
                    ids, signs, size = [], [], 0
            if signs:
                yield pd.DataFrame({"sig": np.concatenate(signs), "id": np.concatenate(ids)})

    return run


def _key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    return (int(mixed(tokens).sum(dtype=np.uint64).astype(np.int64)),
            int(np.bitwise_xor.reduce(mixed(tokens ^ np.uint64(0xA5A5A5A5)), initial=np.uint64(0)).astype(np.int64)))


def _stored(width: int, whole: bool):
    """(id, text) -> id, n, the tokens of the set or only their slots, and with the tokens their 128 bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                sets = list(_sets(part["text"], width, known))
                out = pd.DataFrame({"id": part["id"], "n": [len(s) for s in sets],
                                    "held": [(s if whole else slots(s)).tobytes() for s in sets]})
                if whole:
                    out[["k1", "k2"]] = np.array([_key(s) for s in sets], np.int64).reshape(-1, 2)
                yield out

    return run


def slots(tokens: np.ndarray) -> np.ndarray:
    """Tokens per slot of a hash, about four to eight in each; the slots are a power of two, so that halves can be added."""
    n = max(16, 1 << max(0, (len(tokens) // 4).bit_length() - 1))
    return np.bincount((mixed(tokens) & np.uint64(n - 1)).astype(np.int64), minlength=n).astype(np.uint16)


def folded(counts: np.ndarray, n: int) -> np.ndarray:
    counts = counts.astype(np.uint32)  # the sums of a very long text leave 16 bits
    while len(counts) > n:
        counts = counts[:len(counts) // 2] + counts[len(counts) // 2:]
    return counts


def forest(sizes: np.ndarray, matrix: np.ndarray, left: np.ndarray, right: np.ndarray, label: np.ndarray,
           percent: int) -> list[tuple[int, int]]:
    """Edges that connect all pairs (left, right) whose common slots can reach the similarity and whose labels differ; what is
    connected gets one label."""
    edges = []
    for i in left:
        rest = right[label[right] != label[i]]
        if not len(rest):
            continue
        both = np.minimum(matrix[rest], matrix[i]).sum(axis=1, dtype=np.int64)
        for j in rest[(100 + percent) * both >= percent * (sizes[rest] + sizes[i])]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                edges.append((int(i), int(j)))
    return edges


def block_edges(sizes: np.ndarray, counts: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges of one block of a list (``left`` is ``right``) or of two: within a block a forest, between two blocks only what
    their own forests leave apart, so that a family of many blocks costs one edge per pair of blocks."""
    n = min(len(c) for c in counts)
    matrix, label = np.array([folded(c, n) for c in counts]), np.arange(len(counts))
    if not np.array_equal(left, right):
        for block in (left, right):
            forest(sizes, matrix, block, block, label, percent)
    return forest(sizes, matrix, left, right, label, percent)


def _connect(percent: int):
    """Rows (sig, low, high, block, id, n, slots) of some parts -> edges of their forests."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sig", "id"], kind="stable")
        ids, sizes, block = rows["id"].to_numpy(), rows["n"].to_numpy(), rows["block"].to_numpy()
        counts = [np.frombuffer(x, np.uint16) for x in rows["slots"]]
        sig = rows["sig"].to_numpy()
        ends = np.r_[np.flatnonzero(sig[1:] != sig[:-1]) + 1, len(sig)]
        low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
        found, at = set(), 0
        for end in ends:
            here = np.arange(end - at)
            of = block[at:end]
            left, right = here[of == low[at]], here[of == high[at]]
            if len(left) and len(right):
                found.update((int(ids[at + i]), int(ids[at + j])) for i, j in block_edges(
                    sizes[at:end], counts[at:end], left, right, percent) if ids[at + i] != ids[at + j])
            at = end
        return pd.DataFrame(list(found), columns=["a", "b"], dtype="int64")

    return run


class Groups:
    """Groups of similar documents with the union of their tokens: token -> groups that hold it."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        # Equal smallest tokens (a min-hash) bring similar documents together.
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), int(sets[i][1]) if len(sets[i]) > 1 else 0, i))
        self.members = [order[i:i + GROUP_DOCS] for i in range(0, len(order), GROUP_DOCS)]
        unions = [np.unique(np.concatenate([sets[i] for i in g])) for g in self.members]
        token, group = np.concatenate(unions), np.repeat(np.arange(len(unions)), [len(u) for u in unions])
        by = np.argsort(token, kind="stable")
        self.token, self.group = token[by], group[by]
        self.smallest = np.array([sizes[g].min() for g in self.members])
        self.largest = np.array([sizes[g].max() for g in self.members])
        self.joined = [np.concatenate([sets[i] for i in g]) for g in self.members]
        self.starts = [np.concatenate([[0], np.cumsum(sizes[g])[:-1]]) for g in self.members]

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """Common tokens of a set and each group's union."""
        low, high = np.searchsorted(self.token, tokens, "left"), np.searchsorted(self.token, tokens, "right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.group[at], minlength=len(self.members))


def link_blocks(ids: list, comps: list, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple]:
    """Links between documents ``left`` and ``right`` (positions) that connect different components, as a spanning forest."""
    if not len(left) or not len(right):
        return []
    parent = {c: c for c in comps}

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    sizes = np.array([len(s) for s in sets])
    matrix = Groups([sets[i] for i in right], sizes[right])
    links = []
    for q in left:
        n = sizes[q]
        bound = -(-percent * np.maximum(n, matrix.smallest) // 100)
        open_groups = np.flatnonzero((matrix.overlaps(sets[q]) >= bound) & (100 * matrix.largest >= percent * n))
        for g in open_groups:
            members = right[matrix.members[g]]
            mine = find(comps[q])
            if all(find(comps[d]) == mine for d in members):
                continue
            tokens = matrix.joined[g]
            at = np.minimum(np.searchsorted(sets[q], tokens), n - 1)
            both = np.add.reduceat((sets[q][at] == tokens).astype(np.int64), matrix.starts[g])
            for d, k in zip(members, both, strict=True):
                if 100 * k >= percent * (n + sizes[d] - k) and find(comps[d]) != find(comps[q]):
                    parent[find(comps[d])] = find(comps[q])
                    links.append((ids[q], ids[d]))
    return links


def count_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, weights: np.ndarray,
                percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Per position the weight of all that it links to between ``left`` and ``right`` (the same, or disjoint), and links
    (positions) that connect what is linked."""
    counts, links = np.zeros(len(sets), np.int64), []
    if not len(left) or not len(right):
        return counts, links
    label, same = np.arange(len(sets)), np.array_equal(left, right)
    sizes = np.array([len(s) for s in sets])
    matrix = Groups([sets[i] for i in right], sizes[right])
    members = [right[g] for g in matrix.members]
    # Tokens as positions in one sorted list: a set is marked there, and each member adds up its marks.
    every = np.unique(np.concatenate([sets[i] for i in right]))
    joined = [np.searchsorted(every, x).astype(np.int32) for x in matrix.joined]
    marks = np.zeros(len(every), bool)
    for q in left:
        n = sizes[q]
        bound = -(-percent * np.maximum(n, matrix.smallest) // 100)
        open_groups = np.flatnonzero((matrix.overlaps(sets[q]) >= bound) & (100 * matrix.largest >= percent * n))
        if not len(open_groups):
            continue
        at = np.minimum(np.searchsorted(every, sets[q]), len(every) - 1)
        at = at[every[at] == sets[q]]
        marks[at] = True
        docs = np.concatenate([members[g] for g in open_groups])
        ends = np.cumsum(sizes[docs])
        both = np.add.reduceat(marks[np.concatenate([joined[g] for g in open_groups])], np.r_[0, ends[:-1]], dtype=np.int64)
        marks[at] = False
        linked = docs[(100 * both >= percent * (n + sizes[docs] - both)) & (docs != q)]
        counts[q] += weights[linked].sum()
        if not same:
            counts[linked] += weights[q]
        for d in linked[label[linked] != label[q]]:
            if label[d] != label[q]:
                label[label == label[d]] = label[q]
                links.append((int(q), int(d)))
    return counts, links


def _verify(percent: int):
    """Rows of a bin or of two blocks of a family -> links that connect (a, b), and per set (a null, k1, k2) the documents that
    it links to."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("a", "b", "k1", "k2", "n")})]
        for _, family in part.groupby("family", sort=False):
            sets = [np.frombuffer(x, np.uint64) for x in family["tokens"]]
            ids, block = family["id"].to_numpy(), family["block"].to_numpy()
            low, high = int(family["low"].iloc[0]), int(family["high"].iloc[0])
            counts, links = count_links(sets, np.flatnonzero(block == low), np.flatnonzero(block == high),
                                        family["weight"].to_numpy(), percent)
            ends = ids[np.array(links, np.int64).reshape(-1, 2)]
            out.append(pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]}, dtype="Int64"))
            held = counts > 0
            out.append(pd.DataFrame({"k1": family["k1"].to_numpy()[held], "k2": family["k2"].to_numpy()[held], "n": counts[held]},
                                    dtype="Int64"))
        return pd.concat(out, ignore_index=True)[["a", "b", "k1", "k2", "n"]]

    return run


def _open_groups(percent: int):
    """Rows of a bin or of two blocks of a family -> links."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, family in part.groupby("family", sort=False):
            sets = [np.frombuffer(x, np.uint64) for x in family["tokens"]]
            ids, comps, block = family["id"].tolist(), family["component"].tolist(), family["block"].to_numpy()
            low, high = int(family["low"].iloc[0]), int(family["high"].iloc[0])
            links += link_blocks(ids, comps, sets, np.flatnonzero(block == low), np.flatnonzero(block == high), percent)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _among(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents whose id is (semi) or is not (anti) in a stored list; the list is broadcast only if it is short."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def link_classes(docs: DataFrame, width: int, percent: int, classes: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between ids of different sets, enough to connect all that the similarity connects.

    With ``classes`` (k1, k2, class, size) every pair is verified, and rows of a null a hold the number n of documents with
    other sets that the documents of the set (k1, k2) link to, or a part of it: they are to be added up.
    """
    signs = docs.mapInPandas(_signatures(width, percent), "sig long, id long")
    # Counted by the signature alone, dealt out as it is: nearly all occur once, so that counting first would save nothing.
    shared = signs.select("sig").repartition("sig").groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("sig")
    signed = settle(signs.join(shared.hint("shuffle_hash"), "sig", "left_semi"), "signs").distinct()
    # Signatures of the same documents say the same: one stands for all of a list (by its length and 128 bits of its ids).
    lists = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("s"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                      F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    kept = lists.filter("s > 1").groupBy("s", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "s")
    buckets = settle(signed.join(kept, "sig"), "buckets")
    members = settle(buckets.select("id").distinct(), "members")
    held = "id long, n long, held binary"
    counted = settle(_among(docs, members, "left_semi").mapInPandas(_stored(width, False), held).distinct(), "slots")

    # Families: what shares a part and can reach the similarity by its slots.
    parts = buckets.withColumn("blocks", F.ceil(F.col("s") / PART_DOCS).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tasks = -(-(parts.count() or 1) // PARTS_PER_TASK)
    met = _met(parts, "sig", tasks).join(counted.withColumnRenamed("held", "slots"), "id")
    edges = settle(met.select("task", "low", "high", "sig", "block", "id", "n", "slots").groupBy("task", "low", "high").applyInPandas(
        _connect(percent), "a long, b long").distinct(), "edges")
    families = settle(components(edges), "families")
    sets = settle(_among(docs, settle(families.select("id"), "members"), "left_semi").mapInPandas(
        _stored(width, True), held + ", k1 long, k2 long").withColumnRenamed("held", "tokens").dropDuplicates(
        ["id", "tokens"]), "sets")

    # The token-group matrix of each family.
    rows = families.withColumnRenamed("component", "family").join(sets.select("id", "n", "k1", "k2"), "id")
    per_family = rows.groupBy("family").agg(F.sum("n").alias("tokens"))
    total = per_family.agg(F.sum("tokens")).first()[0] or 0
    blocks = per_family.withColumn("blocks", F.ceil(F.col("tokens") / BLOCK_TOKENS).cast("int")).select("family", "blocks")
    tasks = -(-int(total) // BLOCK_TOKENS)
    if classes is None:
        dealt = rows.select("id", "family").distinct().join(blocks, "family").withColumn(
            "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        more = _met(dealt, "family", tasks).join(sets.select("id", "tokens"), "id").select(
            "task", "low", "high", "family", "id", F.col("id").alias("component"), "block", "tokens").groupBy(
            "task", "low", "high").applyInPandas(_open_groups(percent), "a long, b long")
        return settle(more, "links")
    # One set stands for its class.
    key = ["id", "k1", "k2"]
    kept = rows.select("family", *key).join(classes.select(
        F.col("class").alias("id"), "k1", "k2", F.col("size").alias("weight")), key)
    dealt = kept.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64(*key), F.col("blocks")).cast("int"))
    more = _met(dealt, "family", tasks).join(sets.select(*key, "tokens"), key).select(
        "task", "low", "high", "family", *key, "weight", "block", "tokens").groupBy(
        "task", "low", "high").applyInPandas(_verify(percent), "a long, b long, k1 long, k2 long, n long")
    return settle(more, "links")


def _met(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """Each row once per pair of blocks (low <= high) that its block belongs to. A key of one block shares a task with others;
    the blocks of a large one have tasks of their own."""
    return rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).withColumn(
        "task", F.when(F.col("blocks") > 1, F.xxhash64(key)).otherwise(F.pmod(F.xxhash64(key), F.lit(max(tasks, 1)))))


def similar(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
            count: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that links reach, itself included), and
    n_links, the number of other documents that it links to, copies included; ``count`` = False leaves n_links out and
    verifies only what connects.

    Documents link when 100 * common >= percent * all of their distinct ``width``-word shingles. Without words (a null text
    is empty) a document links with nothing. Rows of equal id count as one document when links are followed; n_links is
    that of the row's own text and counts an id once per text that it has. A row without an id links with nothing and has
    no component. Other columns are not read.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    keyed = settle(given.mapInPandas(_keys(width), "id long, n long, k1 long, k2 long"), "keys")
    able = keyed.filter("id IS NOT NULL AND n > 0")
    classes = able.groupBy("k1", "k2").agg(F.min("id").alias("class"))
    members = settle(able.join(classes, ["k1", "k2"]).select("id", "class", "k1", "k2").distinct(), "classes")
    copies = settle(members.groupBy("id").agg(F.max(F.col("class") == F.col("id")).alias("first")).filter("NOT first").select("id"), "copies")
    sizes = settle(members.groupBy("k1", "k2").agg(F.min("class").alias("class"), F.count(F.lit(1)).alias("size")), "sizes") if count else None
    links = link_classes(_among(given.filter("id IS NOT NULL"), copies, "left_anti"), width, percent, sizes)
    own = members.filter("id <> class").select(F.col("id").alias("a"), F.col("class").alias("b"))
    found = components(links.filter("a IS NOT NULL").select("a", "b").unionByName(own))
    shown = [F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")]
    if not count:
        return keyed.join(found, "id", "left").select(*shown)
    copied = sizes.filter("size > 1").select("k1", "k2", (F.col("size") - 1).alias("links"))
    per_set = settle(links.filter("a IS NULL").select("k1", "k2", F.col("n").alias("links")).unionByName(copied).groupBy(
        "k1", "k2").agg(F.sum("links").alias("links")), "counts")
    number = F.when(F.col("id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0)
    return keyed.join(found, "id", "left").join(per_set, ["k1", "k2"], "left").select(*shown, number.alias("n_links"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of all documents that links connect, one, in the columns of the input.

    Rows are told apart by a key of their own, not by the id: rows with equal ids and unrelated texts all stay. Of connected rows
    the one with the smallest id stays, of equal ids any one; a row without an id stays only if no connected row has one. A row
    without words stays.
    """
    kept = settle(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    rows = kept.select("row", F.col(f"doc.`{doc_id}`").alias("given"), F.col(f"doc.`{text}`").alias("text"))
    found = settle(similar(rows, width, percent, "row", "text", count=False).filter("component_id <> row").select(
        "row", F.col("component_id").alias("component")), "linked")
    linked = found.unionByName(found.select(F.col("component").alias("row"), "component").distinct())
    ranked = linked.join(rows.select("row", "given"), "row").groupBy("component").agg(
        F.min(F.struct(F.col("given").isNull(), "given", "row")).alias("first")).select(F.col("first.row").alias("row"))
    gone = settle(linked.select("row").join(ranked, "row", "left_anti"), "gone")
    few = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return kept.join(few, "row", "left_anti").select("doc.*")


@query("op7_ngram_jaccard")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return similar(table(spark, folder, "documents"), width=3, percent=90)
