"""The corpus pipeline, stage by stage against plain Python, and the registered queries."""

import re
import zlib
from collections import Counter

import pytest
from test_similar import brute_components, weighted
from test_simple import plain_jump, targets, words

import __spark_entry__ as entry_points
import corpus_pipeline
from millrace.llm.shingles import Words, shingle_hashes, word_hashes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, data):
    """Input and output of every stage on the small tables."""
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.settle(stage(spark, docs, data), name)
        out[name] = docs, after
        docs = after
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    for name, (_, after) in stages.items():
        assert after.columns[:5] == COLUMNS
        assert name == "sharding" or after.columns == COLUMNS


def test_toxicity_stage_keeps_clean_documents(spark, data, stages):
    before, after = stages["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    kept = {i for i, _ in pairs(after)}
    assert kept <= {i for i, _ in pairs(before)}
    clean = [i for i, _ in pairs(before) if labels.get(i) == 0]
    assert sum(i in kept for i in clean) >= 0.9 * len(clean)


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    component, _ = brute_components(pairs(before), 5, 80)
    assert sorted(i for i, _ in pairs(after)) == sorted({i for i, c in component.items() if i == c})


def test_decontamination_stage(spark, data, stages):
    before, after = stages["decontamination"]
    items, known = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()], Words()
    sets = [Counter(shingle_hashes(word_hashes(t, known, True), 5).tolist()) for _, t in items]
    want = set()
    for i, text in pairs(before):
        runs = shingle_hashes(word_hashes(text, known, True), 5).tolist()
        here = set(runs)
        holds = False
        for s in sets:
            if here & set(s):
                n = sum(s.values())
                holds |= max(weighted(Counter(runs[k:k + n]), s) for k in range(max(1, len(runs) - n + 1))) >= 0.8
        if not holds:
            want.add(i)
    assert {i for i, _ in pairs(after)} == want


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    sizes, source = Counter(), {}
    for r in before.collect():
        sizes[r["source"]] += len(words(r["text"]))
        source[r["doc_id"]] = r["source"]
    want = targets(sizes)
    copies = Counter(i for i, _ in pairs(after))
    for i, s in source.items():
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert int(rate) <= copies[i] <= int(rate) + 1 <= 3 and copies[i] <= 2


def test_sharding_stage(stages):
    import hashlib

    before, after = stages["sharding"]
    assert Counter(pairs(after)) == Counter(pairs(before))
    for r in after.collect():
        key = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert (r["shard"], r["grown_shard"]) == (plain_jump(key, 40), plain_jump(key, 41))
        assert r["text_crc32"] == zlib.crc32(r["text"].encode())


def test_run_is_the_chain_of_its_stages_and_reruns_agree(spark, data, stages):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(corpus_pipeline.run(spark, data)) == rows(stages["sharding"][1])


def test_one_query_per_operator():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()
