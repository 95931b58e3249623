import random
import re
import time

import pytest

from foliant.llm import licenses
from foliant.llm.common import table
from foliant.llm.queries import op7_licenses

RULES = licenses.parse_rules()
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    s = " " + " ".join(words) + " "
    hits = []
    for q in RULES:
        for m in re.finditer(q["pattern"], s):
            a = s[: m.start()].count(" ") - 1
            hits.append((a, a + m[0].count(" ") + 1, q))
    rank = lambda h: (h[2]["priority"], h[1] - h[0], -h[2]["id"])
    base = [h for h in hits if h[2]["base"]]
    kept = [h for h in hits if h[2]["base"] or not any(not g[2]["base"] and rank(g) > rank(h) and g[0] <= h[0] and g[1] >= h[1] for g in hits)]
    label = lambda x: ",".join(sorted({h[2]["label"] for h in x}))
    return len(words), len(base), min((h[0] for h in base), default=None), max((h[0] for h in base), default=None), label(base), label(kept), max((h[2]["priority"] for h in kept), default=0) / 9


def test_rules_hold_their_keywords():
    assert len(RULES) > 200
    for r in RULES:
        re.compile(r["pattern"])
        assert r["keyword"] in r["pattern"].replace("licen[cs]e", "license")


def test_query_agrees_with_a_plain_version(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").collect()}
    rows = op7_licenses(spark, d).collect()
    assert len(rows) == len(texts) and any(r["labels"] for r in rows)
    for r in rows:
        assert tuple(r)[1:7] == plain(texts[r["doc_id"]])[:6]
        assert r["score"] == pytest.approx(plain(texts[r["doc_id"]])[6])


TEXTS = {
    None: "", "": "", " ,.; ": "",
    "MIT License, mit-license. MIT LICENSE": "mit",
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache,apache-2.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "GNU Lesser General Public License v3": "gpl,lgpl-3.0",
    "permit license amit licenses": "",
    "the mité license": "",
    "SPDX-License-Identifier: MIT-0": "mit-0",
    "All rights reserved. " * 500: "proprietary",
    "x " * 200_000 + "MIT license": "mit",
}


def test_odd_texts(spark):
    rows = [(i, t, 5, [1]) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([*rows, (0, None, 5, [1]), (None, "MIT License", 5, [1])], "doc_id int, text string, n_words int, hits array<int>")
    found = {}
    for r in licenses.digest(licenses.scan(df)).collect():
        found.setdefault(r["doc_id"], r)
    for i, (t, labels) in enumerate(TEXTS.items()):
        r = found[i]
        assert r["labels"] == labels, t
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == plain(t)[:6]
    assert found[None]["labels"] == "mit"
    assert licenses.digest(licenses.scan(df.limit(0))).count() == 0


RNG = random.Random(5)
PHRASES = ["MIT License", "the Apache License, Version 2.0", "GNU General Public License v3", "licensed under the MIT license", "some words", "a", "BSD 3-clause license", "SPDX-License-Identifier: MIT"]


def test_overlaps_agree_with_the_plain_version(spark):
    """Random texts full of detections, more of them than are judged in one run."""
    texts = [" ".join(RNG.choice(PHRASES) for _ in range(RNG.choice([1, 3, 10, 40]))) for _ in range(60)] + [" ".join(RNG.choice(PHRASES) for _ in range(700))]
    found = licenses.digest(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))).collect()
    for r in found:
        expected = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == expected[:6]
        assert r["score"] == pytest.approx(expected[6])


def test_work_is_linear_in_matches(spark):
    """50,000 places in one document; the second call is timed, after the first has planned and compiled."""
    text = "MIT license, apache license; general public license and more. " * 16_700
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    for _ in range(2):
        began = time.time()
        r = licenses.digest(licenses.scan(df)).first()
        took = time.time() - began
    assert r["n_base"] == 50_100 and r["labels"] == "apache,gpl,mit" and took < 20


def test_names_that_clash(spark):
    df = spark.createDataFrame([("mit license", "w", 1, "k")], "text string, words string, words_ int, kept string")
    r = licenses.scan(df).first()
    assert (r["words"], r["words_"], r["n_words"], len(r["kept"])) == ("w", 1, 2, 2)


def test_rules_may_have_any_ids(spark):
    rules = [dict(id=70, label="x", priority=4, keyword="foo", pattern="(?<= )(?:foo bar)(?= )", base=False), dict(id=3, label="y", priority=4, keyword="bar", pattern="(?<= )(?:bar)(?= )", base=False)]
    r = licenses.scan(spark.createDataFrame([("Foo bar foo bar bar",)], "text string"), rules).first()
    assert [(h["start"], h["end"], h["id"]) for h in r["hits"]] == [(0, 2, 70), (2, 4, 70), (1, 2, 3), (3, 4, 3), (4, 5, 3)]
    assert [(h["start"], h["id"]) for h in r["kept"]] == [(0, 70), (2, 70), (4, 3)]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op7_licenses(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
