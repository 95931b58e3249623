import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import langid
from foliant.llm.common import crc_mod, table
from foliant.llm.queries import op1_langid


def grams(text):
    out = set()
    letters = [c.lower()[0] if c.isalpha() else "\0" for c in text]
    for n in (1, 2, 3):
        out |= {(n, *letters[i : i + n]) for i in range(len(letters) - n + 1)}
    return out


@pytest.mark.parametrize("text", ["", "a", "Été, 12 ab ab", "x" * 50, "über die Brücke 😀 中文"])
def test_distinct_grams_agree_with_sets(text):
    spectrum = langid.Spectrum()
    spectrum.add("something before")
    size, letter, mark = spectrum.add(text)
    assert size == len(grams(text)) and len(spectrum.ids(mark)) == size
    assert letter == any(c.isalpha() for c in text)


def test_pieces_of_long_texts_agree_with_the_whole(monkeypatch):
    text = "the quick brown fox " * 50 + "jumps"
    whole = langid.Spectrum().add(text)[0]
    monkeypatch.setattr(langid, "PIECE", 64)
    assert langid.Spectrum().add(text)[0] == whole


def test_kernel_product_agrees_with_sets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, per_lang=8, landmarks_per_lang=3)
    text = docs.first()["text"]
    spectrum = langid.Spectrum()
    size, _, mark = spectrum.add(text)
    own = set(spectrum.ids(mark).tolist())
    kernel = []
    for j in range(model.landmarks.shape[1]):
        ids = set(model.grams[model.landmarks[:, j] > 0].tolist())
        kernel.append(len(own & ids) / (size * len(ids)) ** 0.5)
    want = np.array(kernel) @ model.weights[:-1] + model.weights[-1]
    assert np.allclose(model.margins([text], spectrum)[0][0], want, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    rows = op1_langid(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts(spark, sf_dir):
    model = langid.fit(table(spark, sf_dir, "documents"))
    rows = [(None, None, 1), (1, None, 2), (2, "", 3), (3, "12 + 3", 4), (4, "the of and", 5), (4, "the of and", 6), (5, "é" * 300_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    out = {}
    for r in langid.predict(df, model).collect():
        out.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert [out[k][0] for k in (None, 1, 2, 3)] == [("und", 0.0)] * 4
    assert len(out[4]) == 2 and out[4][0] == out[4][1] and out[4][0][0] == "en"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([(1, None, "en"), (2, "!", "en"), (3, "words", None)], "doc_id long, text string, lang string")
    assert langid.fit(empty) is None
    assert {r["lang_pred"] for r in langid.predict(empty, None).collect()} == {"und"}
    assert langid.predict(empty.limit(0), None).count() == 0


def test_nothing_but_training_rows_is_learned_from(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    train = docs.where(crc_mod("doc_id", 5) != 0)
    a = langid.fit(train)
    b = langid.fit(train.withColumnRenamed("source", "other"))
    assert np.array_equal(a.weights, b.weights)


def plain_grams(text):
    """Distinct character 1- to 3-grams; whatever is no letter is one separator."""
    c = [x.lower()[0] if x.isalpha() else "" for x in text or ""]
    return {tuple(c[i : i + n]) for n in (1, 2, 3) for i in range(len(c) - n + 1)}


def test_query_agrees_with_a_plain_kernel(spark, sf_dir):
    """Landmarks, kernel and one-versus-rest ridge regression over sets of grams, without hashing."""
    rows = table(spark, sf_dir, "documents").withColumn("h", F.xxhash64("doc_id")).collect()
    crc = lambda i: zlib.crc32(str(i).encode()) % 5
    known = [r for r in rows if r["lang"] is not None and crc(r["doc_id"]) and any(c.isalpha() for c in r["text"] or "")]
    langs = sorted({r["lang"] for r in known})
    buckets, first = min(256, 1024 // len(langs)), {}
    for r in sorted(known, key=lambda r: r["h"]):
        first.setdefault((r["lang"], r["h"] % buckets), r)
    sample = sorted(first.values(), key=lambda r: (r["lang"], r["h"]))
    sets = [plain_grams(r["text"]) for r in sample]
    per, marks = min(32, 256 // len(langs)), []
    for name in langs:
        marks += sorted((i for i, r in enumerate(sample) if r["lang"] == name), key=lambda i: -min(len(sets[i]), 2000))[:per]
    kernel = lambda a: [len(a & sets[m]) / (len(a) * len(sets[m])) ** 0.5 for m in marks]
    k = np.array([kernel(a) for a in sets])
    values, vectors = np.linalg.eigh(k[marks] + 1e-6 * np.eye(len(marks)))
    half = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    x = np.hstack([k @ half, np.ones((len(k), 1))])
    y = np.array([[1.0 if r["lang"] == name else -1.0 for name in langs] for r in sample])
    share = Counter(r["lang"] for r in sample)
    w = np.array([len(sample) / len(langs) / share[r["lang"]] for r in sample])[:, None]
    solved = np.linalg.solve(x.T @ (w * x) + 1e-2 * np.eye(x.shape[1]), x.T @ (w * y))
    got = {r["doc_id"]: r for r in op1_langid(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert g["held_out"] == (crc(r["doc_id"]) == 0)
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (g["lang_pred"], g["score"]) == ("und", 0.0)
            continue
        margins = np.array(kernel(plain_grams(r["text"]))) @ half @ solved[:-1] + solved[-1]
        order = np.argsort(-margins)
        assert g["score"] == pytest.approx(min(1, max(0, (1 + margins[order[0]]) / 2)), abs=0.05)
        if margins[order[0]] - margins[order[1]] > 0.1:
            assert g["lang_pred"] == langs[order[0]]


def test_ties_go_to_the_first_language(spark):
    """Two languages learned from the same texts have equal outputs."""
    rows = [(i, f"some text {i // 2} of both", "ba"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, key=F.lit(1) * F.col("doc_id"))
    model.weights[:, 1] = model.weights[:, 0]
    assert {r["lang_pred"] for r in langid.predict(df, model).collect()} == {"a"}


def test_small_presence_matrices_give_the_same(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    texts = [r["text"] or "" for r in docs.limit(9).collect()]
    whole, _ = model.margins(texts, langid.Spectrum())
    parts = np.concatenate([model.margins(texts[k : k + 2], langid.Spectrum())[0] for k in range(0, 9, 2)])
    assert np.allclose(whole, parts, atol=1e-9)
