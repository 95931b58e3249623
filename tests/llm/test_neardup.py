import random
import re

import numpy as np
import pytest
from compare import same

from foliant.llm import neardup
from foliant.llm.queries import SQL, op8_neardup

S = neardup.Similarity(3, 85, 100)


def plain_sets(texts, n):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        k = min(n, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def plain_classes(texts, s):
    sets = plain_sets(texts, s.words)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and s.linked(len(a & b), len(a | b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(x) for x in sets]


def corpus(seed, copies):
    """Near copies of few originals at similarities around the threshold, exact copies, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(6):
        base = [rng.choice(words) for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    texts += [None, "", " \n", "one", "One", "one two", "one two", "one two three", "one  two\tthree"]
    rng.shuffle(texts)
    return texts


def test_query_matches_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        assert same(spark, f"/root/testdata/{sf}", op8_neardup, SQL["op8_neardup"]) > 1


@pytest.mark.parametrize("similarity,block", [(S, 2048), (neardup.Similarity(), 2048), (S, 8)])
def test_classes_agree_with_brute_force(spark, monkeypatch, similarity, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SET_BLOCK", block // 2)
    texts = corpus(5, 25)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    want, sizes = plain_classes(texts, similarity)
    got = {r["doc_id"]: r for r in neardup.classes(df, similarity).collect()}
    assert len(got) == len(texts)
    for i in range(len(texts)):
        assert (got[i]["component_id"], got[i]["n_shingles"], got[i]["kept"]) == (want[i], sizes[i], want[i] == i)
    assert len(set(want)) < len(texts) - 60


def test_a_large_bucket_spreads_over_tasks(spark, monkeypatch):
    """Near copies of one text, far more than a block has, in buckets that the sort cuts; one link at a time joins some of them."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SET_BLOCK", 16)
    rng = random.Random(9)
    words = [f"v{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(150)]
    texts, chain = [], list(base)
    for k in range(260):
        t = list(base)
        for _ in range(rng.randint(1, 4)):
            t[rng.randrange(len(t))] = f"x{rng.random()}"
        if k % 4 == 0:  # each a little further from the first
            chain[rng.randrange(len(chain))] = f"y{k}"
            t = chain
        texts.append(" ".join(t))
    want, _ = plain_classes(texts, S)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["doc_id"]: r["component_id"] for r in neardup.classes(df, S).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [got[i] for i in range(len(texts))] == want


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "k", "s", 1), (2, "a b c d e f", "k", "s", 2)], "doc_id long, text string, key string, short string, n_shingles int")
    out = neardup.deduplicate(df).collect()
    assert [tuple(r) for r in out] == [(1, "a b c d e f", "k", "s", 1)]


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(3, text), (3, text), (None, text), (5, text), (None, "q r s t u v"), (None, None), (9, None), (9, None)], "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.classes(df).collect()]
    assert sorted(got, key=str) == sorted([(3, 3, True), (3, 3, True), (None, 3, False), (5, 3, False), (None, None, True), (None, None, True), (9, 9, True), (9, 9, True)], key=str)
    kept = neardup.deduplicate(df.withColumnRenamed("doc_id", "doc_id")).collect()
    assert sorted([tuple(r) for r in kept], key=str) == sorted([(3, text), (None, "q r s t u v"), (None, None), (9, None)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.classes(df).count() == 0 and neardup.deduplicate(df).count() == 0


def test_bands_miss_no_more_than_allowed():
    for s in (S, neardup.Similarity()):
        assert (1 - s.threshold**s.rows) ** (neardup.HASHES // s.rows) <= neardup.MISS


def test_estimates_are_close():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:850], rng.integers(0, 2**63, 0, dtype=np.uint64)])
    agree = (neardup.signature(a) == neardup.signature(b)).mean()
    assert abs(agree - 0.85) < 0.08


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in neardup.components(df).collect()}
    assert {found[i] for i in range(201)} == {0} and found[1000] == found[1001] == 1000 and len(found) == 203
