import math
import random
import re
import zlib
from collections import Counter

import pytest

from foliant.llm import quality
from foliant.llm.common import table
from foliant.llm.queries import op2_quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


CASES = [None, "", " \n\t", "one", "a b c a b c", "x\nx\n\n x\nx", "é#é $   |<>", "a b c d\n" * 30, "the same\x85word \x1cthe same\x85word \x1cend"]


@pytest.mark.parametrize("text", CASES)
def test_base_statistics(text):
    assert quality.judge(text, quality.ratios(*[quality.np.zeros(quality.BUCKETS)] * 2), {}, 0.0)[:5] == plain(text)


def test_query_agrees_with_a_plain_version(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    rows = op2_quality(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r["base_failed"] and r["kept"])


def test_counts_and_ratio_agree_with_a_plain_version(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0}
    raw, target = quality.np.zeros(quality.BUCKETS), quality.np.zeros(quality.BUCKETS)
    rows = docs.collect()
    for r in rows:
        b = quality.gram_buckets(quality._word_hashes(r["text"].encode().translate(quality.LOWER).split(), {}))
        quality.np.add.at(raw, b, 1)
        if r["doc_id"] in good:
            quality.np.add.at(target, b, 1)
    assert quality.np.array_equal(quality.bucket_counts(docs), raw)
    assert quality.np.array_equal(quality.bucket_counts(quality.trusted_docs(docs, labels)), target)


def plain_buckets(text):
    """Buckets of unigrams, then of bigrams, with Python's integers."""
    h = [zlib.crc32(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
    cut = lambda x: x % 2**32
    return [cut(a * 2654435761) >> 14 for a in h], [cut(cut(cut(a * 2246822519) ^ b) * 3266489917) >> 14 for a, b in zip(h, h[1:], strict=False)]


def test_ratio_and_verdict_agree_with_a_plain_version(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    good = {r["doc_id"] for r in table(spark, sf_dir, "labels").collect() if r["quality"] == 1 and r["toxic"] == 0}
    target = {texts[i] for i in good if i in texts}
    grams = {t: plain_buckets(t) for t in set(texts.values())}
    raw_n, target_n = (Counter(b for t in some for part in grams[t] for b in part) for some in (grams, target))
    n_raw, n_target = sum(raw_n.values()), sum(target_n.values())

    def means(text):
        own = Counter(b for part in grams[text] for b in part)
        inside, size = text in target, sum(own.values())
        t_sum, r_sum, s, total = n_target - size * inside, n_raw - size, quality.PSEUDO, quality.BUCKETS * quality.PSEUDO
        p = lambda b: (target_n[b] - own[b] * inside + s) / (t_sum + total)
        q = lambda b: ((raw_n[b] - own[b]) * t_sum / r_sum + s) / (t_sum + total)
        one, two = ([math.log(p(b) / q(b)) for b in part] for part in grams[text])
        return (sum(one) + sum(two)) / max(1, size), sum(one) / max(1, len(one)), sum(two) / max(1, len(two))

    found = {t: means(t) for t in grams}
    least = [sorted(found[t][k] for t in target if len(grams[t][0]) >= 50)[max(0, math.ceil(quality.LOSS * sum(len(grams[t][0]) >= 50 for t in target)) - 1)] for k in (1, 2)]
    rows = op2_quality(spark, sf_dir).collect()
    assert 0.2 * len(rows) < sum(r["kept"] for r in rows) < len(rows)
    for r in rows:
        all_, one, two = found[texts[r["doc_id"]]]
        assert r["llr"] == pytest.approx(all_, abs=1e-9)
        if min(abs(all_ - quality.THRESHOLD), abs(one - least[0]), abs(two - least[1])) > 1e-9 or texts[r["doc_id"]] in target:
            assert r["kept"] == (not r["base_failed"] and all_ >= quality.THRESHOLD and one >= least[0] - 1e-12 and two >= least[1] - 1e-12)


def test_both_multinomials_sum_to_one():
    rng = quality.np.random.default_rng(1)
    raw, target = rng.integers(0, 9, (2, quality.BUCKETS)).astype(float)
    w = quality.ratios(raw + target, target)
    total = w.n_target + quality.BUCKETS * quality.PSEUDO
    assert ((w.target + quality.PSEUDO) / total).sum() == pytest.approx(1)
    assert ((w.raw * (w.n_target / w.n_raw) + quality.PSEUDO) / total).sum() == pytest.approx(1)


def test_junk_goes_and_clean_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    rows = op2_quality(spark, d).join(table(spark, d, "labels"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert good and all(good) and bad and sum(bad) <= 0.1 * len(bad)


def test_ids_that_labels_disagree_on_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 0), (None, 1, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(r["doc_id"] for r in quality.trusted_ids(labels).collect()) == [1, 5]


def test_odd_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(None, None, 1), (1, "w " * 60, 2), (1, "w " * 60, 3), (2, "a b c d e f g h i j " * 5, 4)], "doc_id long, text string, kept int")
    out = quality.keep_flags(docs, labels).collect()
    assert len(out) == 4 and all(r["llr"] == 0 for r in out)
    kept = quality.keep(docs.withColumnRenamed("kept", "n_words"), labels)
    assert kept.columns == ["doc_id", "text", "n_words"] and kept.count() == sum(r["kept"] for r in out)
    assert quality.keep_flags(docs.limit(0), labels).count() == 0


def copied(copies, seed=9):
    """Clean prose with labels for most, and one clean unlabelled text many times."""
    rng = random.Random(seed)
    prose = lambda: " ".join(f"word{min(rng.randrange(300), rng.randrange(300))}" for _ in range(120))
    rows = [(i, prose()) for i in range(200)]
    labels = [(i, 1, 0) for i in range(120)]
    text = prose()
    return rows + [(1000 + i, text) for i in range(copies)], labels


def test_copies_without_labels_are_judged_like_one(spark):
    got = {}
    for copies in (1, 1000):
        rows, labels = copied(copies)
        docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        found = [r for r in quality.keep_flags(docs, marks).collect() if r["doc_id"] >= 1000]
        assert len(found) == copies and all(r["kept"] for r in found)
        got[copies] = {round(r["llr"], 9) for r in found}
        assert quality.keep(docs, marks).where("doc_id >= 1000").count() == copies
    assert got[1] == got[1000] and len(got[1]) == 1


def test_own_counts_are_left_out(spark):
    rows, labels = copied(3)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["llr"] for r in quality.keep_flags(docs, marks).collect()}
    grams = lambda t: quality.gram_buckets(quality._word_hashes(t.encode().translate(quality.LOWER).split(), {}))
    texts, good = dict(rows), {i for i, _, _ in labels}
    for own in (5, 150, 1001):
        raw, target = quality.np.zeros(quality.BUCKETS), quality.np.zeros(quality.BUCKETS)
        for text in set(texts.values()) - {texts[own]}:
            quality.np.add.at(raw, grams(text), 1)
        for i in good - {own}:
            quality.np.add.at(target, grams(texts[i]), 1)
        w = quality.np.log((target + quality.PSEUDO) / (raw * (target.sum() / raw.sum()) + quality.PSEUDO))
        assert found[own] == pytest.approx(w[grams(texts[own])].mean())


def test_toxic_prose_goes_by_its_words(spark):
    """Clean prose with a few words that the target avoids: like clean prose over all n-grams, but not over unigrams."""
    rng = random.Random(5)
    prose = lambda: [f"word{min(rng.randrange(300), rng.randrange(300))}" for _ in range(120)]
    rows, labels = [], []
    for i in range(400):
        words = prose()
        if i % 10 == 0:
            for at in range(0, 120, 15):
                words[at] = f"toxic{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
        if i % 10 == 0 or i % 4 == 1:
            labels.append((i, 1, int(i % 10 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.keep_flags(docs, marks).collect()}
    toxic, clean = [found[i] for i in range(0, 400, 10)], [r for i, r in found.items() if i % 10]
    assert all(r["llr"] >= quality.THRESHOLD for r in toxic) and not any(r["kept"] for r in toxic)
    assert sum(r["kept"] for r in clean) >= 0.95 * len(clean)
    assert all(found[i]["kept"] for i in range(400) if i % 4 == 1)
