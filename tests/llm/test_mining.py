"""Source divergence, hard negatives and the kernel quality classifier on awkward rows, against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from millrace.llm import divergence, kernel_quality, negatives

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string"


def chunky(seed, n, langs=("en", "de"), sources=("a", "b", "ü", None)):
    rng, vocabulary = random.Random(seed), ["The", "the,", "the", "naïve", "NAÏVE", "x1y", "a-b", "été;été", "(of)", "Of", "zz", "日本", " ", "1", "--"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(langs), rng.choice(sources)
        words = [rng.choice(vocabulary[: 4 + len(source or "") * 3 + i % 9]) for _ in range(rng.randrange(0, 30))]
        rows.append((i // 2 if i % 7 else None, rng.choice([" ", "\n", "\t "]).join(words) or None, lang, source, "x", "y"))
    return rows


def plain_audit(rows, least, top):
    docs = [(r[2] or "", r[3] or "", Counter(re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(divergence.TERM, r[1] or ""))) for r in rows]
    holders = Counter((lang, t) for lang, _, c in docs for t in c)
    kept = defaultdict(list)
    for (lang, t), k in sorted(holders.items()):
        if k >= least:
            kept[lang].append(t)
    counts = defaultdict(Counter)
    for lang, source, c in docs:
        counts[lang, source].update({t: k for t, k in c.items() if t in kept[lang]})
    share = lambda c, total, v: 1 + 10**9 * (c + 5) // (total + 5 * v)
    out = []
    for lang, source in counts:
        v, mine = len(kept[lang]), counts[lang, source]
        p = {t: share(mine[t], sum(mine.values()), v) for t in kept[lang]}
        whole = sum((counts[k] for k in counts if k[0] == lang), Counter())
        pairs = []
        for other in (s for k, s in counts if k == lang and s != source):
            his = counts[lang, other]
            pairs.append((sum(abs(p[t] - share(his[t], sum(his.values()), v)) for t in kept[lang]), other))
        marks = [(p[t] - share(whole[t], sum(whole.values()), v), t) for t in kept[lang] if mine[t]]
        for part, found, most in (("pair", pairs, None), ("term", [m for m in marks if m[0] > 0], top)):
            for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("blocks", [(24_000_000, 256, 4096), (400, 2, 3)])
@pytest.mark.parametrize("least", [5, 1000])
def test_divergence(spark, monkeypatch, blocks, least):
    """Nulls, repeated ids, chunks of several terms, clashing columns; one block or many of each kind; no kept term at all."""
    for name, value in zip(("BLOCK_BYTES", "SOURCES", "TERMS"), blocks, strict=True):
        monkeypatch.setattr(divergence, name, value)
    rows = chunky(3, 240) + [(900, "word " * 20_000 + "the" * 30_000, "en", "b", None, None), (901, "", "fr", None, None, None)]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(5), least=least, top=4)
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, least, 4)


def test_blocks_close_by_size(monkeypatch):
    """Rows of several blocks hold all chunks of all documents."""
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(divergence, "TaskContext", Task)
    rows = chunky(5, 60)
    frame = pd.DataFrame([(r[2], r[3] or "", r[1] or "") for r in rows], columns=["lang", "source", "text"])
    out = pd.concat(divergence._encode(3, 300)(iter([frame[:20], frame[20:]])), ignore_index=True)
    assert out["block"].nunique() > 5 and out["block"].min() == 3 << 32 and set(out["slice"].dropna()) == {0, 1, 2}
    chunks = {}
    for r in out[out["slice"].notna()].itertuples():
        chunks |= {(r.block, i): c.decode() for i, c in zip(divergence._unpacked(r.ids), divergence.zstandard.decompress(r.chunks).split(b"\n"), strict=True)}
    seen = Counter()
    for r in out[out["slice"].isna()].itertuples():
        for i, n in zip(divergence._unpacked(r.ids), divergence._unpacked(r.counts), strict=True):
            seen[chunks[r.block, i]] += int(n)
    assert seen == Counter(w for r in rows for w in re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))


def test_divergence_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, q string, row string"


def plain_mine(rows, every, low=50, high=95):
    known = []
    for vec_id, x, label, *_ in rows:
        if vec_id is None or x is None or label is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        known.append((vec_id, label, [int(np.floor(256 * float(np.float32(v)))) for v in x]))
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (vec_id, label, q) in enumerate(known):
        if vec_id % every:
            continue
        first = lambda found, k: sorted(found, key=lambda x: (-x[0], x[1]))[:k]
        others = [(product(q, o), v, k) for j, (v, k, o) in enumerate(known) if j != i]
        for s, v, _ in first([o for o in others if o[2] == label], 5):
            hard = first([o for o in others if o[2] != label and low * s <= 100 * o[0] <= high * s], 3)
            out += [(vec_id, v, rank, n, s, t) for rank, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("tiles", [(1024, 16_384), (4, 20)])
def test_negatives(spark, monkeypatch, tiles):
    """Null, non-finite and short vectors, ties, repeated ids, a label of one row, large components, clashing columns."""
    monkeypatch.setattr(negatives, "ANCHORS", tiles[0])
    monkeypatch.setattr(negatives, "CANDIDATES", tiles[1])
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.integers(-3, 9, 11) / 16], int(rng.integers(0, 4)), "x", "y") for i in range(300)]
    rows += [(i, [0.5, 0.25], i % 3, None, None) for i in range(300, 340)] + [(340, [0.5, None], 1, None, None), (341, None, 1, None, None),
             (342, [float("nan")], 1, None, None), (343, [float("inf")], 1, None, None), (350, [1.0], None, None, None), (None, [1.0], 1, None, None),
             (0, [0.5] * 11, 2, None, None), (0, [0.5] * 11, 2, None, None), (360, [], 1, None, None), (370, [900.5, -1e6], 77, None, None)]
    got = negatives.mine(negatives.whole(spark.createDataFrame(rows, VECTORS).repartition(4)), every=10)
    assert sorted(map(tuple, got.collect())) == plain_mine(rows, 10)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert negatives.mine(negatives.whole(none)).count() == 0
    huge = spark.createDataFrame([(0, [1e30], 1, None, None)], VECTORS)
    with pytest.raises(ValueError, match="beyond a long"):
        negatives.mine(negatives.whole(huge))


@pytest.mark.parametrize("kind", [np.int32, np.int64])
def test_lookups_are_inner_products(kind):
    rng = np.random.default_rng(2)
    a, c = rng.integers(-257, 257, (9, 24)), rng.integers(-257, 257, (13, 24))
    packed = negatives.planes(c, 10)
    assert packed.shape == (13, 10, 3)
    assert (negatives.scores(negatives.subset_sums(a).astype(kind), packed) == c @ a.T).all()


GOOD, BAD = "Of the reth ing than and eder, atnd the. Onreed is the hend on stre.", ("And&&& a$$$ of%%% the&&& erhe.###", "THE!! OF!! ER!! ON!! THE!! OF!!", "aa aa aa aa aa aa")


def labelled(n, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = rng.random() < 0.25
        words = (rng.choice(BAD) if bad else GOOD).split()
        rng.shuffle(words)
        rows.append((i, " ".join(words * rng.randrange(1, 9)), "quality", 0 if bad else 1))
    return rows


def test_quality_learns_and_does_not_depend_on_the_order(spark):
    rows = labelled(900)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows[:500]], "doc_id long, quality int")
    results = []
    for parts in (1, 23):
        measured = kernel_quality.measure(docs.repartition(parts))
        model = kernel_quality.train(measured, labels)
        results.append({r[0]: r[1] for r in measured.select("doc_id", kernel_quality.score(F.col("stats"), model)).collect()})
    assert results[0] == results[1]
    right = [(results[0][i] >= 0.5) == bool(y) for i, _, _, y in rows[500:]]
    assert all(0 <= s <= 1 for s in results[0].values()) and np.mean(right) > 0.97


def test_partial_sums_are_the_normal_equations(spark, monkeypatch):
    monkeypatch.setattr(kernel_quality, "LAST_SUMS", 2)
    rows = labelled(400)
    stats = np.array([kernel_quality.statistics_of(r[1]) for r in rows])
    mean, scale = stats.mean(0), stats.std(0) + 10
    frame = spark.createDataFrame([(r[0] % 3, s.tolist(), r[3]) for r, s in zip(rows, stats, strict=True)], "fold int, stats array<int>, label int")
    sums = kernel_quality._normal_equations(frame.repartition(13), mean, scale)
    z = np.c_[kernel_quality.cosines(stats.astype(float), mean, scale), [r[3] for r in rows]]
    for fold in range(3):
        part = z[[r[0] % 3 == fold for r in rows]]
        assert (sums[fold] == (part.T @ part).astype(np.int64)).all()


def test_kernel_is_approximated():
    stats = np.random.default_rng(7).normal(size=(40, 19)) * 0.5
    z = kernel_quality.cosines(stats, np.zeros(19), np.ones(19))[:, :-1] / kernel_quality.GRID
    width = kernel_quality.WIDTH * np.sqrt(19)
    exact = np.exp(-((stats[:, None] - stats[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(2 * (z @ z.T) / kernel_quality.FEATURES - exact).max() < 0.3


def test_isotonic_is_the_best_rising_curve():
    rng = random.Random(3)
    bins = [(i, n := rng.randrange(1, 6), rng.randrange(0, n + 1)) for i in range(12)]
    place, share = kernel_quality.isotonic(bins)
    assert (np.diff(place) > 0).all() and (np.diff(share) >= 0).all()
    # Min-max formula of the isotonic regression, with the half rows of each step.
    best = [max(min(sum(b[2] for b in bins[j:k + 1]) / sum(b[1] for b in bins[j:k + 1]) for k in range(i, 12)) for j in range(i + 1)) for i in range(12)]
    assert len(set(np.round(best, 12))) == len(place)


def test_quality_edges(spark):
    """Null and empty texts, null ids, repeated rows, odd and clashing labels, one class, no rows."""
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "x " * 200_000, "c"), (2, "x " * 200_000, "c"), (3, " \n ", "d")],
                                 "doc_id long, text string, stats string")
    measured = kernel_quality.measure(docs)
    rows = {tuple(r["stats"]) for r in measured.collect()}
    assert measured.count() == 5 and len(rows) == 2 and (0,) * kernel_quality.STATISTICS in rows
    label = lambda found: spark.createDataFrame(found, "doc_id long, quality int")
    for found, prior in (([], 0.5), ([(1, 1), (2, 1), (2, 0), (None, 0), (3, None), (3, 7)], 1.0)):
        model = kernel_quality.train(measured, label(found))
        assert model.weights is None and {r[0] for r in measured.select(kernel_quality.score(F.col("stats"), model)).collect()} == {prior}
    none = kernel_quality.measure(docs.limit(0))
    assert none.select(kernel_quality.score(F.col("stats"), kernel_quality.train(none, label([])))).count() == 0


def test_quality_query_on_held_out_documents(spark, data):
    found = {r["doc_id"]: r for r in entry_points.queries()["op11_kernel_quality"](spark, data).collect()}
    labels = [r for r in spark.read.parquet(f"{data}/labels.parquet").collect() if found[r["doc_id"]]["held_out"]]
    assert np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) > 0.9
