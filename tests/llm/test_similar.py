"""Joins, alignments, suffixes and scores against brute force."""

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from millrace.llm import components, decontaminate, jaccard, lines, suffixes, toxicity
from millrace.llm.shingles import Words, shingle_hashes, word_hashes

SCHEMA = "doc_id long, text string, id string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], SCHEMA).repartition(4)


def sentence(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def edited(rnd, ws, share):
    return [w if rnd.random() > share else f"x{rnd.randrange(10**6)}" for w in ws]


@pytest.fixture(scope="module")
def families():
    """Documents, exact copies, families of near copies at many distances, short texts, nulls, a long text and repeats."""
    rnd = random.Random(5)
    rows, i = [], 0
    common = sentence(rnd, 60)
    for _ in range(25):
        base = sentence(rnd, rnd.choice([3, 9, 12, 40, 150]))
        for share in (0, 0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1):
            ws = edited(rnd, base, share)
            if rnd.random() < 0.3:
                ws = ws + common
            rows.append((i, " ".join(ws)))
            i += 1
    hub = sentence(rnd, 120)
    rows += [(1000 + k, " ".join(edited(rnd, hub, 0.01))) for k in range(80)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "One  two"), (2004, "one\ttwo"), (2005, "one"), (2006, " ".join(common * 200)),
             (None, rows[0][1]), (0, rows[0][1]), (2007, "É a"), (2008, "é a")]
    return rows


def shingles(text, width):
    ws = [w.decode() for w in (text or "").encode().lower().split()]
    return {tuple(ws[k:k + width]) for k in range(len(ws) - width + 1)} if len(ws) >= width else ({tuple(ws)} if ws else set())


def brute_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, families, width, percent):
    want, sizes = brute_components(families, width, percent)
    got = jaccard.similar(table(spark, families), width, percent).collect()
    assert len(got) == len(families)
    for r in got:
        assert r["component_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else None)
        if r["doc_id"] is not None:
            assert r["n_shingles"] == sizes[r["doc_id"]]


def test_jaccard_blocks_of_a_large_family(spark, families, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_DOCS", 3)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    want, _ = brute_components(families, 3, 90)
    got = jaccard.similar(table(spark, families), 3, 90).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want


@pytest.mark.parametrize(("width", "percent", "block_tokens"), [(3, 90, 1_000_000), (5, 80, 500)])
def test_jaccard_counts_every_link(spark, families, monkeypatch, width, percent, block_tokens):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", block_tokens)
    given = [(i, t) for i, t in families[:-4] if i is not None] + [(3000 + k, families[k][1]) for k in range(0, 60, 7)]
    sets = {i: shingles(t, width) for i, t in given}
    want = {}
    for i, a in sets.items():
        want[i] = sum(1 for j, b in sets.items() if i != j and a and b and 100 * len(a & b) >= percent * len(a | b))
    got = jaccard.similar(table(spark, [*given, (None, given[0][1])]), width, percent).collect()
    assert {r["doc_id"]: r["n_links"] for r in got if r["doc_id"] is not None} == want
    assert [r["n_links"] for r in got if r["doc_id"] is None] == [0]
    assert max(want.values()) > 20


def test_jaccard_without_broadcasts(spark, families, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", -1)
    want, _ = brute_components(families, 3, 90)
    got = jaccard.similar(table(spark, families), 3, 90).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want


def test_keep_one(spark, families):
    """The smallest id of each component stays; rows without an id are decided by their text like any other."""
    want, _ = brute_components([(i, t) for i, t in families if i is not None], 5, 80)
    out = jaccard.keep_one(table(spark, families))
    assert out.columns == ["doc_id", "text", "id", "n"]
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert set(ids) == {i for i, c in want.items() if i == c}


def test_keep_one_decides_by_row(spark):
    """Equal ids with unrelated texts, copies without an id, and a column id that clashes."""
    rnd = random.Random(8)
    a, b, c = (" ".join(sentence(rnd, 40)) for _ in range(3))
    near = a + " more"
    rows = [(1, a, "X1", 7), (1, b, "X2", 7), (5, near, "X3", 7), (None, near, "X4", None), (None, c, "X5", None), (None, c, "X6", None),
            (7, None, "X7", 7), (8, "", "X8", 7), (9, c + " tail", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, n long")
    kept = sorted(map(tuple, jaccard.keep_one(docs.repartition(3)).collect()), key=repr)
    assert kept == sorted([rows[0], rows[1], rows[6], rows[7], rows[8]], key=repr)
    alone = jaccard.keep_one(docs.filter("doc_id IS NULL")).collect()
    assert sorted(r["text"] for r in alone) == sorted([near, c])


def test_nothing_to_compare(spark):
    none = table(spark, [])
    assert jaccard.similar(none).count() == 0 and jaccard.keep_one(none).count() == 0
    assert jaccard.keep_one(none).columns == ["doc_id", "text", "id", "n"]


def test_edges_of_blocks_connect_what_one_block_connects():
    """Blocks of a list, each pair on its own, connect the same documents as the whole list, with few edges between blocks."""
    rnd = np.random.default_rng(6)
    for _ in range(20):
        sets = []
        for _ in range(4):
            base = rnd.integers(0, 2**63, int(rnd.integers(20, 60))).astype(np.uint64)
            sets += [np.unique(base[: len(base) - int(rnd.integers(0, 8))]) for _ in range(10)]
        sizes, counts = np.array([len(x) for x in sets]), [jaccard.slots(x) for x in sets]
        block = rnd.integers(0, 3, len(sets))
        every = np.arange(len(sets))

        def closure(edges):
            label = list(every)
            for a, b in edges:
                x, y = label[a], label[b]
                label = [x if v == y else v for v in label]
            return [label.index(v) for v in label]

        whole = jaccard.block_edges(sizes, counts, every, every, 80)
        parts = [jaccard.block_edges(sizes, counts, every[block == i], every[block == j], 80) for i in range(3) for j in range(i, 3)]
        assert closure(whole) == closure([e for p in parts for e in p])
        assert len(whole) < len(sets) and sum(map(len, parts)) <= len(sets) + 9 * 4


def test_slot_counts_of_a_very_long_text_do_not_wrap():
    long = np.full(1024, 60_000, np.uint16)
    assert (jaccard.folded(long, 16) == 60_000 * 64).all()


def test_lists_of_the_same_documents_are_compared_once(spark):
    """Many signatures, one list: the rows that are compared grow with the members, not with what they share."""
    rnd = random.Random(2)
    text = " ".join(sentence(rnd, 300))
    docs = table(spark, [(i, f"{text} {i}") for i in range(30)])
    seen = []
    real = jaccard._met
    try:
        jaccard._met = lambda rows, key, tasks: (seen.append((key, rows.count(), rows.select(key).distinct().count())), real(rows, key, tasks))[1]
        assert {r["component_id"] for r in jaccard.similar(docs).collect()} == {0}
    finally:
        jaccard._met = real
    (_, rows, lists), _ = seen
    assert rows <= 30 * lists and lists < 60


@pytest.mark.parametrize("width", [1, 3, 5])
def test_sets_of_many_texts_are_those_of_each_text(width, monkeypatch):
    """Texts hashed together give no shingle across their borders; short, empty and null texts and borders of a run count."""
    monkeypatch.setattr(jaccard, "RUN_WORDS", 7)
    texts = pd.Series(["a b c d e f", "g", None, "", "h i", "a b c a b c a b c", "x y z", "É é", "a b c d e f g h i j"], dtype=object)
    got = list(jaccard._sets(texts, width, Words()))
    for text, tokens in zip(texts, got, strict=True):
        words = (text or "").encode().lower().split()
        want = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        assert tokens.tolist() == sorted(set(shingle_hashes(hashes, width).tolist())) and len(tokens) == len(want)


def test_word_hashes_keep_nothing():
    """Millions of different words leave no table behind in a task."""
    known = Words()
    tracemalloc.start()
    for at in range(0, 200_000, 1000):
        assert len(word_hashes(" ".join(f"w{i}" for i in range(at, at + 1000)), known)) == 1000
    left = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert left < 1e6


def test_parts_guarantee_a_common_signature():
    rnd = np.random.default_rng(2)
    for percent in (80, 90):
        parts = jaccard.Parts(percent)
        for n in [*range(1, 40), 100, 333, 1000]:
            a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
            for drop in range(0, n + 1):
                b = a[drop:]
                if len(b) and 100 * len(b) >= percent * len(a):
                    assert set(parts.of(a)) & set(parts.of(b))


def test_union_bound_opens_every_group_with_a_link():
    rnd = random.Random(3)
    base = np.unique(np.array([rnd.getrandbits(63) for _ in range(60)], np.uint64))
    sets = [np.sort(np.r_[base[k:], np.array([rnd.getrandbits(63) for _ in range(k)], np.uint64)]) for k in range(12)] * 4
    links = jaccard.link_blocks(list(range(48)), list(range(48)), sets, np.arange(48), np.arange(48), 90)
    parent = list(range(48))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both)
        parent[find(a)] = find(b)
    for a in range(48):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert find(a) == find(b) or 100 * both < 90 * (len(sets[a]) + len(sets[b]) - both)


def test_components_of_paths_hubs_and_nothing(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (None, 3), (300, 200), (300, 250)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(50)} | {300: 200, 250: 200, 200: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def weighted(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_decontamination_finds_what_the_windows_hold(spark):
    rnd = random.Random(8)
    items = [(k, " ".join(sentence(rnd, rnd.choice([2, 4, 13, 30, 60]), 3000))) for k in range(40)] + [(90, None), (91, ""), (None, "a b c d e f g")]
    rows = []
    for k in range(120):
        body = sentence(rnd, 80, 3000)
        if k % 3 == 0:
            body += edited(rnd, items[k % 40][1].split(), 0.01 if k % 2 else 0)
        rows.append((k, " ".join(body + sentence(rnd, 20, 3000)).upper() if k % 5 == 0 else " ".join(body)))
    rows += [(200, None), (201, ""), (202, items[3][1]), (202, items[3][1]), (None, items[4][1]), (203, " ".join(sentence(rnd, 30_000)) + " " + items[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(table(spark, rows), benchmark).collect()
    found = Counter((r["doc_id"], r["item_id"]) for r in got)
    known, want = Words(), Counter()
    for d, t in rows:
        ws = word_hashes(t, known, True)
        for i, u in items:
            vs = word_hashes(u, known, True)
            if not len(ws) or not len(vs):
                continue
            width = min(5, len(vs))
            b, runs = Counter(shingle_hashes(vs, width).tolist()), shingle_hashes(ws, width).tolist()
            n = max(1, len(vs) - width + 1)
            if not set(runs) & set(b):
                continue
            best = max(weighted(Counter(runs[s:s + n]), b) for s in range(max(1, len(runs) - n + 1)))
            want[(d, i)] += best >= 0.8
    assert found == +want
    by_block = decontaminate.contaminated(table(spark, rows), benchmark, block=7).collect()
    assert Counter(map(tuple, by_block)) == Counter(map(tuple, got))
    left = decontaminate.remove_contaminated(table(spark, rows), benchmark)
    assert left.columns == ["doc_id", "text", "id", "n"]
    gone = {r["doc_id"] for r in decontaminate.contaminated(table(spark, [(k, t) for k, (_, t) in enumerate(rows)]), benchmark).collect()}
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(r for k, r in enumerate(rows) if k not in gone)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(table(spark, rows), nothing).count() == 0
    assert decontaminate.contaminated(table(spark, []), benchmark).count() == 0


def test_blocks_hold_every_fingerprint_within_the_radius():
    rnd = random.Random(1)
    items = decontaminate.Items([(k, " ".join(sentence(rnd, 30))) for k in range(200)], 5, radius=6)
    for k in range(200):
        mark = int(items.prints[k])
        for bit in rnd.sample(range(64), rnd.randrange(7)):
            mark ^= 1 << bit
        near = set(items.near(np.uint64(mark)).tolist())
        assert near == {j for j in range(200) if (int(items.prints[j]) ^ mark).bit_count() <= 6}


def brute_repeats(rows, length=suffixes.LENGTH):
    raws = [(t or "").encode() for _, t in rows]
    counts = Counter(r[s:s + length] for r in raws for s in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if counts[r[s:s + length]] > 1:
                gone[s:s + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(r), int(gone.sum()), spans, np.frombuffer(r, np.uint8)[~gone].tobytes()))
    return Counter(out)


@pytest.fixture(scope="module")
def passages():
    rnd = random.Random(11)
    shared = [" ".join(sentence(rnd, n)) for n in (60, 90, 130, 200)]
    rows = [(k, " ".join([*sentence(rnd, rnd.randrange(0, 90)), rnd.choice(shared), *sentence(rnd, rnd.randrange(0, 60)), rnd.choice(shared)[:450]]))
            for k in range(60)]
    base = " ".join(sentence(rnd, 500))
    rows += [(100 + k, base[:k * 37] + "é😀" + base[k * 37 + 3:]) for k in range(25)]
    rows += [(200, None), (201, ""), (202, "ab" * 900), (203, "x" * 1500), (204, "x" * 399), (205, "x" * 400), (206, base), (206, base),
             (None, base), (207, "y" * 400 + "z"), (208, "\n" * 3000), (209, " ".join(sentence(rnd, 9000)))]
    return rows


@pytest.mark.parametrize("bucket", [100_000, 3])
def test_repeated_strings(spark, passages, bucket, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    got = suffixes.remove_repeats(table(spark, passages)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == brute_repeats(passages)
    raws = {(i, len((t or "").encode())): (t or "").encode() for i, t in passages}
    for r in got:
        raw, spans = raws[r["doc_id"], r["n_bytes"]], [tuple(map(int, x.split(":"))) for x in r["removed"].split(",") if x]
        assert len(spans) == r["n_spans"] and sum(b - a for a, b in spans) == r["n_removed"]
        gone = {k for a, b in spans for k in range(a, b)}
        assert bytes(c for k, c in enumerate(raw) if k not in gone) == bytes(r["kept"])


def test_repeated_strings_without_broadcasts(spark, passages, monkeypatch):
    monkeypatch.setattr(suffixes, "BROADCAST_TEXTS", -1)
    got = suffixes.remove_repeats(table(spark, passages)).collect()
    assert sum(r["n_removed"] for r in got) == sum(x[2] * n for x, n in brute_repeats(passages).items())
    assert suffixes.remove_repeats(table(spark, [])).count() == 0


def test_multikey_order():
    rnd = np.random.default_rng(4)
    rows = rnd.integers(0, 2, (500, 24)).astype(np.uint8)
    group = np.sort(rnd.integers(0, 9, 500))
    order = suffixes.multikey_order(rows, group)
    keys = [(int(group[i]), rows[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(500))


def test_align_is_a_common_subsequence_and_finds_moved_context():
    rnd = random.Random(2)
    for _ in range(200):
        one = [rnd.randrange(8) for _ in range(rnd.randrange(15))]
        two = [rnd.randrange(8) for _ in range(rnd.randrange(15))]
        pairs = lines.align(one, two)
        assert all(one[i] == two[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    assert lines.align([1, 2, 3, 9, 4], [1, 2, 7, 3, 4]) == [(0, 0), (1, 1), (2, 3), (4, 4)]
    assert len(lines.align(list(range(5000)), list(range(5000)))) == 5000


def test_repeated_lines(spark):
    rnd = random.Random(6)
    pool = [" ".join(sentence(rnd, 8)) for _ in range(40)]
    rows = [(k, "\n".join(rnd.choice(pool) if rnd.random() < 0.4 else " ".join(sentence(rnd, 6)) for _ in range(rnd.randrange(1, 12)))) for k in range(80)]
    rows += [(k, rows[3][1] + "\nown line %d here" % k) for k in range(100, 130)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, rows[0][1]), (203, "\n".join(pool * 50)), (300, "a b\n\nc d"), (301, "a b\n\nc d")]
    text = {i: (t or "").split("\n") for i, t in rows if i is not None}
    count = {i: [len(x.split()) for x in v] for i, v in text.items()}
    holders = defaultdict(set)
    for i, v in text.items():
        for x, w in zip(v, count[i], strict=True):
            if w:
                holders[x].add(i)
    want = {}
    for i, v in text.items():
        shared = defaultdict(list)
        for x in {x for x, w in zip(v, count[i], strict=True) if w}:
            if min(holders[x]) != i:
                shared[min(holders[x])].append(len(holders[x]))
        gone = set()
        for e, ns in shared.items():
            if min(ns) <= 20 or len(ns) > 1:
                gone |= set(lines._blocks(v, count[i], text[e], 4))
        if gone:
            want[i] = sorted(gone)
    docs = table(spark, rows)
    removed = lines.repeated_lines(docs, rare=20, least=4)
    assert {r["id"]: r["removed"] for r in removed.collect()} == want
    cleaned = lines.remove_lines(docs, removed)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        if r["doc_id"] is None or r["doc_id"] not in want:
            assert (r["doc_id"], r["text"]) in rows
        else:
            gone = set(want[r["doc_id"]])
            assert r["text"] == "\n".join(x for k, x in enumerate(text[r["doc_id"]]) if k not in gone)
    assert lines.repeated_lines(table(spark, [])).count() == 0
    assert lines.repeated_lines(table(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")])).collect()[0]["removed"] == [0]


def first_holder_blocks(rows, least):
    """Lines to delete by alignment with the first holder of each line, whatever the number of holders."""
    text = {i: t.split("\n") for i, t in rows}
    count = {i: [len(x.split()) for x in v] for i, v in text.items()}
    first = {}
    for i in sorted(text):
        for x in text[i]:
            first.setdefault(x, i)
    want = {i: sorted({k for e in {first[x] for x in v if x.split()} - {i} for k in lines._blocks(v, count[i], text[e], least)})
            for i, v in text.items()}
    return {i: v for i, v in want.items() if v}


def test_lines_of_many_documents_are_removed(spark):
    rnd = random.Random(16)
    notice = "all rights reserved by the holders"
    rows = [(k, "\n".join([" ".join(sentence(rnd, 6)), notice, " ".join(sentence(rnd, 6))])) for k in range(150)]
    rows += [(1000 + k, "a single line that is copied everywhere") for k in range(130)]
    got = {r["id"]: r["removed"] for r in lines.repeated_lines(table(spark, rows)).collect()}
    assert got == first_holder_blocks(rows, lines.BLOCK_WORDS)
    assert all(got[k] == [1] for k in range(1, 150)) and all(got[1000 + k] == [0] for k in range(1, 130))
    assert 0 not in got and 1000 not in got


def test_blocks_whose_lines_have_other_first_holders(spark):
    rows = [(1, "so it is\nx1 x2 x3 x4 x5 x6"), (2, "y1 y2 y3 y4 y5 y6\nand so on"), (3, "q1 q2\nso it is\n\nand so on\nz1"),
            (4, "r1\nso it is\n\nand so on\nr2 r3 r4 r5 r6"),
            (10, "one two three four five\nsix seven eight nine ten"), (11, "six seven eight nine ten\nk1\none two three four five"),
            (5, "six seven eight nine ten\nk2\none two three four five")]
    got = {r["id"]: r["removed"] for r in lines.repeated_lines(table(spark, rows)).collect()}
    assert got[4] == [1, 3] and 3 not in got
    assert len(got[10]) == 1 and got[11]


def test_runs_cover_every_common_block():
    rnd = random.Random(17)
    for _ in range(300):
        words = [rnd.randrange(4) for _ in range(rnd.randrange(2, 9))]
        block = [rnd.randrange(1, 10**9) if w else 7 for w in words]
        if sum(words) < 5:
            continue
        one, two = ([rnd.randrange(10**9, 10**10) for _ in range(3)] for _ in range(2))
        left, right = lines._runs(one + block, [2] * 3 + words, 5), lines._runs(block + two, words + [2] * 3, 5)
        assert max(words) >= 5 or left & right
    short = lines._runs([1, 2, 3, 4], [1, 2, 3, 4], 5)
    assert short == {hash((1, 2)), hash((2, 3)), hash((3, 4)), hash((1, 2, 3))}


@pytest.fixture(scope="module")
def labelled():
    rnd = random.Random(9)
    bad, rows, labels = ["vlorky", "skrimbash", "dworfen"], [], []
    for k in range(900):
        ws = sentence(rnd, rnd.randrange(20, 120), 300)
        toxic = k % 4 == 0
        if toxic:
            for _ in range(max(3, len(ws) // 12)):
                ws[rnd.randrange(len(ws))] = rnd.choice(bad)
        rows.append((k, " ".join(ws)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark, labelled):
    rows, labels = labelled
    docs = table(spark, rows + [(5000, None), (5001, ""), (None, "w1 w2"), (5002, "w1 " * 40_000)])
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.train(docs, known.filter(~toxicity.held_out(F.col("doc_id"))))
    got = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), toxicity.score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in got) and len(got) == len(rows) + 4
    truth = dict(labels)
    held = [(truth[r["doc_id"]], r["s"]) for r in got if r["h"] and r["doc_id"] in truth]
    assert len(held) > 100
    assert sum((s >= 0.5) == bool(y) for y, s in held) / len(held) > 0.95


def test_toxicity_without_labels(spark, labelled):
    docs = table(spark, labelled[0][:20])
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["s"] for r in docs.select(toxicity.score(F.col("text"), toxicity.train(docs, empty)).alias("s")).collect()} == {0.5}
    one = spark.createDataFrame([(k, 0) for k in range(20)], "doc_id long, toxic int")
    assert {r["s"] for r in docs.select(toxicity.score(F.col("text"), toxicity.train(docs, one)).alias("s")).collect()} == {0.0}
    assert table(spark, []).select(toxicity.score(F.col("text"), toxicity.train(table(spark, []), empty))).count() == 0
