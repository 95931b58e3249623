import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import packing, tokens
from foliant.llm.common import table
from foliant.llm.queries import op4_packing, op6_token_counts

V = tokens.vocabulary(tokens.vocabulary_path())
BITS = ["a", "b", "'s", "'ll", "'l", "'re", "'", "  ", " ", "\n", "\n\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "é", "ß", "½", "²", "中文", "😀", "<|endoftext|>", "<|endo", "|>", "12", "_", "#", "!!", "--", "the", " the", "    ", "…", " "]


def library(text):
    return V.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=10).map("".join) | st.text(max_size=30))
def test_ids_and_every_prefix_agree_with_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(V.encode(text), "<u4").tolist() == library(text)
    counts = [0, *np.cumsum(V.prefix_deltas(text), dtype=np.int64).tolist()]
    assert counts == [len(library(text[:i])) for i in range(len(text) + 1)]


def test_documents_agree_with_the_library(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").collect()}
    rows = op6_token_counts(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        n = len(library(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
        assert len(library(text[: r["chars_in_limit"]])) <= 1024


def test_prefix_questions():
    d = V.prefix_deltas("the quick brown fox")
    assert [tokens.count_at(d.tobytes(), k) for k in (0, 3, 9, 19)] == [0, 1, 2, 4]
    assert tokens.longest_prefix(d, 2) == len("the quick")
    assert tokens.longest_prefix(d, 0) == 0


def test_caches_may_overflow(monkeypatch):
    v = tokens.Vocabulary(tokens.vocabulary_path())
    monkeypatch.setattr(tokens, "CACHE", 3)
    for text in ("one two three four", "five six seven eight nine", "one nine"):
        assert int(v.prefix_deltas(text).sum()) == len(library(text))


def test_long_runs():
    for text in ("x" * 50_000, " " * 20_000 + "x", "a1" * 20_000):
        assert np.frombuffer(V.encode(text), "<u4").tolist() == library(text)
    assert int(V.prefix_deltas("ab" * 5_000).sum(dtype=np.int64)) == len(library("ab" * 5_000))


def test_counts_of_odd_tables(spark):
    rows = [(None, "a word", 1), (1, None, 2), (1, "", 3), (2, "same  text\n", 4), (2, "same  text\n", 5), (3, "é<|endoftext|>" * 900, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.prefix_counts(df, tokens.vocabulary_path()).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(library(t or ""))) for i, t, _ in rows), key=str)
    assert tokens.prefix_counts(df.limit(0), tokens.vocabulary_path()).count() == 0


def test_packing_of_repeated_rows_and_null_ids(spark):
    """Rows of one id are documents of their own: their pieces hold all ids as often as they come."""
    texts = [(None, "one two three"), (None, "one two three"), (7, "four five"), (7, "four five"), (7, "six")]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), tokens.vocabulary_path(), with_ids=True).collect()
    want = sorted(((i, [*library(t), 0]) for i, t in texts), key=str)
    whole = sorted(((r["doc_id"], r["ids"]) for r in rows if r["length"] == r["doc_tokens"]), key=str)
    assert sum(r["length"] for r in rows) == sum(len(x) for _, x in want)
    assert whole == want or all(r["doc_id"] in (None, 7) for r in rows)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    for a, b in zip(places, places[1:], strict=False):
        assert b[1] == a[1] + a[2] if a[0] == b[0] else b[1] == 0


def check_packing(rows, ids, size=1024):
    """Every id once, offsets gapless, nothing too long; returns the padding."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc, want in ids.items():
        at = 0
        for r in sorted(docs[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want) and r["length"] > 0
            assert r["ids_crc32"] == packing.crc32(np.array(want[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(want)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing_is_whole(spark, sf_dir):
    ids = {r["doc_id"]: [*library(r["text"]), 0] for r in table(spark, sf_dir, "documents").collect()}
    assert check_packing(op4_packing(spark, sf_dir).collect(), ids) == 0


def test_packing_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "word " * 3000, 9), (4, "<|endoftext|>", 9)], "doc_id long, text string, start int")
    rows = packing.pack(df, tokens.vocabulary_path(), with_ids=True).collect()
    ids = {r["doc_id"]: [*library(r["text"] or ""), 0] for r in df.collect()}
    check_packing(rows, ids)
    for r in rows:
        assert r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
    assert packing.pack(df.limit(0), tokens.vocabulary_path()).count() == 0


def test_best_fit_keeps_short_documents_whole():
    p = packing.Packer(100, 4)
    rng = random.Random(3)
    sizes = [rng.randint(1, 60) for _ in range(500)]
    for i, n in enumerate(sizes):
        p.add(i, b"\1\0\0\0" * n)
        assert len(p.windows) <= 4
    p.finish()
    pieces = [x for _, s in p.done for x in s]
    assert sum(len(x[2]) // 4 for x in pieces) == sum(sizes)
    assert len(pieces) - len(sizes) < 0.35 * len(sizes)  # documents cut
