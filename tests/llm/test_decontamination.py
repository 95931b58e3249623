import random
import re

import numpy as np
import pytest
from compare import same

from foliant.llm import decontamination as dc
from foliant.llm.queries import SQL, op9_decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        n = min(window, len(v))
        wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_query_matches_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        assert same(spark, f"/root/testdata/{sf}", op9_decontamination, SQL["op9_decontamination"]) > 1


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 16)))) for i in range(30)]
    items += [(90, None), (91, ""), (92, items[3][1]), (93, "w1")] if seed % 2 else [(90, None)]
    docs = []
    for _ in range(80):
        t = [rng.choice([*vocabulary, "other"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            at = rng.randrange(len(t) + 1)
            t[at:at] = words(rng.choice(items)[1])
        docs.append(" ".join(t))
    return [*docs, None, "", "!!"], items


@pytest.mark.parametrize("seed,block", [(1, 10**9), (2, 10**9), (3, 60), (4, 60)])
def test_agrees_with_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(dc, "BLOCK_CHARS", block)
    docs, items = corpus(seed)
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(docs)], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in dc.contamination(df, bench).collect()}
    for i, t in enumerate(docs):
        n, hit, found = plain(t, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["match_items"], r["contaminated"]) == (n, hit, found, hit > 0)
        assert r["items_sha256"] == dc.sha256_of_items(found) and r["n_items"] == len(found)
    clean = {r["doc_id"] for r in dc.decontaminate(df, bench).collect()}
    assert clean == {i for i in got if not got[i]["contaminated"]}
    assert dc.decontaminate(df, bench).columns == df.columns


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50, 300):
        w = rng.integers(0, 4, n)
        assert dc.suffix_array(w).tolist() == sorted(range(n), key=lambda i: [*w[i:].tolist()])


def test_longest_match_and_ranges(spark):
    item = " ".join(f"i{k}" for k in range(20))
    df = spark.createDataFrame([(1, "x " + " ".join(f"i{k}" for k in range(2, 17)) + " y"), (2, item.upper() + " " + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    a, b = dc.find_matches(df, bench).orderBy("doc_id").collect()
    assert (a["longest_match"], [tuple(r) for r in a["match_ranges"]]) == (15, [(1, 16)])
    assert (b["longest_match"], [tuple(r) for r in b["match_ranges"]]) == (20, [(0, 40)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    r = dc.contamination(docs, none).first()
    assert (r["n_words"], r["n_hit"], r["contaminated"]) == (2, 0, False)
    assert dc.decontaminate(docs, none).count() == 1
    assert dc.contamination(docs.limit(0), none).count() == 0
