import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliant.llm import packing, privacy, quality, tokens
from foliant.llm.common import table


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    k = min(n, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def test_stages_agree_with_plain_versions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bench = [alnum(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    windows = {tuple(w[i : i + 10]) for w in bench for i in range(len(w) - 9)}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near-duplicates", "decontamination", "personal data", "packing"]

    kept = stages["quality rules"](spark, docs, sf_dir).cache()
    flags = {r["doc_id"]: r["kept"] for r in quality.keep_flags(docs, table(spark, sf_dir, "labels")).collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in flags.items() if k}

    one = stages["near-duplicates"](spark, kept, sf_dir).cache()
    sets = {r["doc_id"]: shingles(r["text"]) for r in kept.collect()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == {i for i in root if root[i] == i}

    clean = stages["decontamination"](spark, one, sf_dir).cache()
    hit = lambda t: any(tuple(w[i : i + 10]) in windows for w in [alnum(t)] for i in range(len(w) - 9))
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect() if not hit(r["text"])}

    safe = stages["personal data"](spark, clean, sf_dir).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in safe.collect():
        assert not privacy.entities(r["text"])
        assert r["text"] == before[r["doc_id"]] or privacy.entities(before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])

    packed = stages["packing"](spark, safe, sf_dir).collect()
    v = tokens.vocabulary(tokens.vocabulary_path())
    assert sum(r["length"] for r in packed) == sum(len(v.encode(r["text"])) // 4 + 1 for r in safe.collect())
    assert sorted(tuple(r)[:5] for r in packed) == sorted(tuple(r)[:5] for r in packing.pack(safe, tokens.vocabulary_path()).collect())

    whole = corpus_pipeline.run(spark, sf_dir).agg(F.sum("length")).first()[0]
    assert whole == sum(r["length"] for r in packed)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)]])
def test_empty_and_null_tables(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, table(spark, sf_dir, "documents").schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_repeated_rows_and_very_long_texts(spark, sf_dir):
    """Copies go with the near-duplicates, long texts go through whole."""
    docs = table(spark, sf_dir, "documents")
    some = docs.orderBy("doc_id").limit(30)
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("w"), (i * 7919 % 30_011).cast("string"))), " ")
    long = docs.orderBy("doc_id").limit(1).select(F.lit(10**6).cast("long").alias("doc_id"), text.alias("text"), "lang", "source", "n_chars")
    left = docs.unionByName(some).unionByName(long).unionByName(long)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        left = stage(spark, left, sf_dir).cache()
        assert left.columns == docs.columns, name
    rows = left.collect()
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) and 10**6 in ids and len({r["text"] for r in rows}) == len(rows)
    assert next(r for r in rows if r["doc_id"] == 10**6)["text"].count(" ") == 59_999
    packed = corpus_pipeline.STAGES[-1][1](spark, left, sf_dir).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert len(packed) == len(rows) and all(r["n"] == r["m"] for r in packed)
