import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliant.llm import lm
from foliant.llm.common import table
from foliant.llm.queries import op5_lm_score


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def net(n=40, seed=0):
    out = lm.new_network(np.arange(n, 0, -1.0), seed)
    rng = np.random.default_rng(seed)
    out.outputs[:, :-1] = rng.normal(0, 0.3, (n, lm.HIDDEN))
    out.classes[:-1] = rng.normal(0, 0.3, (lm.HIDDEN, out.classes.shape[1]))
    return out


def plain_step(n, h, symbol):
    """The gated unit, written out; for one document, in double precision."""
    sums = h @ n.recurrent.astype(float)
    x = n.inputs[symbol].astype(float)
    H = lm.HIDDEN
    r, z = (1 / (1 + np.exp(-(x[k : k + H] + sums[k : k + H]))) for k in (0, H))
    c = np.tanh(x[2 * H :] + r * sums[2 * H :])
    return (1 - z) * c + z * h


def plain_log_prob(n, h, y):
    state = np.append(h, 1.0)
    classes = np.exp(state @ n.classes.astype(float))
    c = max(k for k in range(len(classes)) if n.starts[k] <= y)
    inside = np.exp(n.outputs[n.starts[c] : n.starts[c + 1]].astype(float) @ state)
    return math.log(classes[c] / classes.sum() * inside[y - n.starts[c]] / inside.sum())


def plain_score(n, doc):
    h, total = np.zeros(lm.HIDDEN), 0.0
    for t, y in enumerate(doc):
        if t:
            h = plain_step(n, h, doc[t - 1])
        total += plain_log_prob(n, h, y)
    return total


def test_side_by_side_scores_agree_with_one_by_one(monkeypatch):
    monkeypatch.setattr(lm, "BUFFER", 16)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 40, n) for n in (1, 7, 30, 2, 30, 5)]
    n = net()
    assert np.allclose(lm.score_documents(n, docs), [plain_score(n, d) for d in docs], rtol=1e-4)
    assert len(lm.score_documents(n, [])) == 0


def test_probabilities_sum_to_one():
    n = net()
    h = np.random.default_rng(2).normal(0, 1, (3, lm.HIDDEN + 1)).astype(np.float32)
    h[:, -1] = 1
    total = sum(np.exp(lm.log_probs(n, h, np.full(3, y))) for y in range(40))
    assert np.allclose(total, 1, atol=1e-4)


def test_back_propagation_through_time_agrees_with_differences():
    """All weights' gradients over a window, with a reset in one stream and the end of the other's tokens."""
    rng = np.random.default_rng(3)
    n = net(12)
    n.recurrent[...] = rng.normal(0, 0.4, n.recurrent.shape)
    n.inputs[...] = rng.normal(0, 0.4, n.inputs.shape)
    h = rng.normal(0, 0.5, (2, lm.HIDDEN)).astype(np.float32)
    tokens = rng.integers(0, 12, (7, 2))
    inputs, targets = tokens[:-1], tokens[1:]
    live, real = np.ones((6, 2), bool), np.ones((6, 2), bool)
    live[2, 0] = False
    real[4:, 1] = False

    def loss():
        total = 0.0
        for k in range(2):
            state = h[k].astype(float)
            for t in range(6):
                state = plain_step(n, state, inputs[t, k]) if live[t, k] else np.zeros(lm.HIDDEN)
                total -= plain_log_prob(n, state, targets[t, k]) if real[t, k] else 0.0
        return total

    _, grads = lm.window_gradients(n, h, inputs, live, targets, real)
    checked = 0
    for array, grad in zip(n.learned(), grads, strict=True):
        for _ in range(12):
            at = tuple(int(rng.integers(0, k)) for k in array.shape)
            keep = array[at]
            found = []
            for step in (1e-2, -1e-2):
                array[at] = keep + step
                found.append((loss(), float(array[at])))
            array[at] = keep
            assert grad[at] == pytest.approx((found[0][0] - found[1][0]) / (found[0][1] - found[1][1]), abs=2e-3)
            checked += grad[at] != 0
    assert checked > 24


def test_training_learns_a_pattern():
    docs = [np.array(([1, 2, 3, 4] * 10)[k : k + 33] + [0]) for k in range(4)] * 12
    n = lm.new_network(np.bincount(np.concatenate(docs), minlength=6).astype(float))
    before = lm.score_documents(n, docs).sum()
    trainer = lm.Trainer(n, 64, 0.1)
    flat, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
    for _ in range(6):
        assert trainer.learn(flat, sizes) == len(flat)
    assert lm.score_documents(n, docs).sum() > 0.5 * before
    assert trainer.learn(flat[:0], sizes[:0]) == 0
    assert lm.Trainer(n, 64, 0.1).learn(flat[:97], np.array([34, 34, 29])) == 97


def agree_with_a_plain_count(rows, texts, held):
    """Base columns of all rows, copies and all; returns rows of documents that weren't learned."""
    c = Counter()
    for i, t in texts:
        if not held(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    found = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows)
    plain = []
    for i, t in texts:
        tokens = [*words(t), None]
        plain.append((i, len(tokens), sum(c[t] > 0 for t in tokens), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens), 4)))
    assert found == sorted(plain)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query_agrees_with_a_plain_count_and_beats_the_base(spark):
    d = "/root/testdata/sf0.01"
    texts = [(r["doc_id"], r["text"]) for r in table(spark, d, "documents").collect()]
    rows = op5_lm_score(spark, d).collect()
    agree_with_a_plain_count(rows, texts, held_out)
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["score"] < 0 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.94 * sum(r["base_score"] for r in out)
    assert sum(r["score"] > r["base_score"] for r in out) > 0.9 * len(out)


def test_scores_are_the_networks_with_the_shares_of_endings(spark, tmp_path, monkeypatch):
    """score of each document, worked out word by word from the model's weights."""
    kept = []
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda *a: kept.append(fit(*a)) or kept[-1])
    texts = [(i, f"alpha beta gamma{i % 7} delta{i} {'omega ' * (i % 5)}") for i in range(60)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(path)
    monkeypatch.setattr(lm, "FREQUENT", 5)
    rows = {r["doc_id"]: r["score"] for r in lm.score(spark.read.parquet(path), F.col("doc_id") % 7 != 2).collect()}
    m = kept[0][0]
    c = Counter(w for i, t in texts if i % 7 != 2 for w in [*words(t), None])
    hashes = {w: lm.END if w is None else lm._hash(w.encode()) for w in {x for _, t in texts for x in [*words(t), None]}}
    own = {w for w, h in hashes.items() if h in set(m.frequent.tolist())}
    assert len(own) == 5 and min(c[w] for w in own) >= max(c[w] for w in c if w not in own)
    ending = {w: None if w is None else lm._ending(w.encode()) for w in hashes}
    tokens, kinds = Counter(), Counter()
    for w in c:
        if w not in own:
            tokens[ending[w]] += c[w]
            kinds[ending[w]] += 1
    symbol = {w: int(m.symbols[m.frequent.tolist().index(hashes[w])] if w in own else m.ending_symbols[ending[w]]) for w in hashes}
    for i, t in texts[:20]:
        doc = [*words(t), None]
        extra = sum(math.log10((c[w] + 1) / (tokens[ending[w]] + kinds[ending[w]] + 1)) for w in doc if w not in own)
        assert rows[i] == pytest.approx(plain_score(m.net, [symbol[w] for w in doc]) / math.log(10) + extra, rel=1e-4)


@pytest.mark.parametrize("size", ["64k", "1m"])
def test_batches_cut_by_bytes_change_nothing(spark, tmp_path, size):
    """Arrow batches cut by bytes, texts of up to 200 KB, copies, ids of a wide type, and groups of few words."""
    rows = [(r["doc_id"], r["text"] * (60 if r["doc_id"] % 50 == 0 else 1 + r["doc_id"] % 4)) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()] * 2
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.format_string("%040d", "doc_id")).coalesce(1).write.parquet(path)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, size)
    before = lm.GROUP, lm.VOCABULARY_ROW, lm.CHUNK_CHARS
    lm.GROUP, lm.VOCABULARY_ROW, lm.CHUNK_CHARS = 5000, 700, 300_000
    try:
        got = lm.score(spark.read.parquet(path), F.col("doc_id").cast("long") % 3 != 0).collect()
    finally:
        spark.conf.unset(key)
        lm.GROUP, lm.VOCABULARY_ROW, lm.CHUNK_CHARS = before
    agree_with_a_plain_count(got, [(f"{i:040d}", t) for i, t in rows], lambda i: int(i) % 3 == 0)


def test_odd_tables(spark, tmp_path):
    rows = [(None, None, 1), (1, "", 2), (2, "A a b", 3), (2, "A a b", 4), (3, "long " * 30_000, 5)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, score int").write.parquet(path)
    df = spark.read.parquet(path)
    got = {r["doc_id"]: r for r in lm.score(df, F.col("doc_id") == 2).collect()}
    assert len(got) == 4 and {k: r["n_tokens"] for k, r in got.items()} == {None: 1, 1: 1, 2: 4, 3: 30_001}
    assert got[2]["train_tokens"] == 8 and got[2]["n_known"] == 4 and got[3]["n_known"] == 1
    assert got[1]["base_score"] == pytest.approx(math.log10(3 / (8 + 3 + 1)))
    none = lm.score(df, F.lit(False)).collect()
    assert len(none) == 5 and all(r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in none)
    assert lm.score(spark.read.parquet(path).limit(0), F.lit(True)).count() == 0


def test_every_training_document_trains_the_network(spark, tmp_path, monkeypatch):
    """The networks' weights are the tokens learned from: over the rounds all those of the training documents, copies and long ones too."""
    path = str(tmp_path / "docs")
    texts = [(i, f"some words of text {i} " * (13 if i % 40 else 5000)) for i in range(128)] + [(200 + i, "one text " * 50) for i in range(50)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(path)
    kept = []

    def seen(df, name, parts=0, write=lm.written):
        out = write(df, name, parts)
        if name == "lm-nets":
            kept.append(sum(r["weight"] for r in out.select("weight").collect()))
        return out

    monkeypatch.setattr(lm, "written", seen)
    lm.fit(spark.read.parquet(path), F.col("doc_id") >= 64)
    assert sum(kept) == sum(len(words(t)) + 1 for i, t in texts if i >= 64) and len(kept) == len(lm.ROUNDS)


def test_a_broken_vocabulary_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "a b c")], "doc_id long, text string").write.parquet(path)
    counted = lm._counted

    def lossy(tokens):
        counts, total = counted(tokens)
        return counts.where("chunk is null"), total

    monkeypatch.setattr(lm, "_counted", lossy)
    monkeypatch.setattr(lm, "discard", lambda *a: None)
    with pytest.raises(Exception, match="isn't whole"):
        lm.score(spark.read.parquet(path), F.lit(True)).collect()


def test_base_counts_ask_no_network(spark, monkeypatch):
    """The columns that follow from counts are those of `score`, and cost no training."""
    from foliant.llm.queries import lm_base

    d = "/root/testdata/sf0.001"
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    whole = op5_lm_score(spark, d).select(*names[:-1], F.round("base_score", 4).alias("base_score"))
    expected = sorted(map(tuple, whole.collect()), key=str)
    monkeypatch.setattr(lm, "_train", lambda *_: pytest.fail("a network was trained"))
    monkeypatch.setattr(lm, "score_documents", lambda *_: pytest.fail("a network was asked"))
    found = lm_base(spark, d)
    assert found.columns == names and sorted(map(tuple, found.collect()), key=str) == expected


def fresh_memory(work):
    """Bytes that work holds at once, of Python and numpy, beyond what it finds."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_windows_of_training_take_no_fresh_arrays():
    """A window's arrays are used again: fresh ones of this size are paid for by a page fault for every 4 KB."""
    rng = np.random.default_rng(4)
    flat, sizes = rng.integers(0, 2048, 256 * lm.WINDOW * 2), np.full(32, 16 * lm.WINDOW)
    trainer = lm.Trainer(lm.new_network(np.arange(2048, 0, -1.0)), 256, 0.2)
    trainer.learn(flat, sizes)
    assert fresh_memory(lambda: trainer.learn(flat, sizes)) < 6_000_000


def test_words_are_counted_without_an_object_for_each(monkeypatch):
    """A chunk's hashes and endings are those of its distinct words, and no word of the text becomes an object of its own."""
    hashed = []
    real = lm.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(lm.xxhash, "xxh3_64_intdigest", lambda w: hashed.append(w) or real(w))
    texts = pa.array([" ".join(f"Word{k % 500}" for k in range(200_000))] * 2)
    assert fresh_memory(lambda: lm._numbered(texts)) < 12_000_000
    assert len(hashed) == 500


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_numbered_words_agree_with_a_plain_split(kind):
    """Every kind of white space, letters and marks at the ends, control characters, nulls, empty texts, and a slice of a column."""
    rng = np.random.default_rng(6)
    marks = list(" \t\n\r\x0b\x0caAbBzZ.,;:!?\u00e9\u00c9\u65e5\u3000 \x85\x1c\x1f0\x00")
    texts = ["dropped", "", None, " ", "\x0b", "  a B ", "A b c\u3000", "!!! ?? .", "ab, abc; \u65e5\u672c.", *("".join(rng.choice(marks, int(n))) for n in rng.integers(0, 40, 600))]
    for some in (texts[1:], [], [None], [" "]):
        tokens, sizes, hashes, endings = lm._numbered(pa.array(["before", *some], kind).slice(1))
        plain = [words(t) for t in some]
        assert sizes.tolist() == [len(w) + 1 for w in plain]
        flat = [w for ws in plain for w in [*ws, None]]
        assert hashes[tokens].tolist() == [lm.END if w is None else lm._hash(w.encode()) for w in flat]
        assert endings[tokens].tolist() == [0 if w is None else lm._ending(w.encode()) for w in flat]
        assert len(hashes) == len(endings) == len({*flat, None}) and (np.diff(hashes) > 0).all()


def test_gradients_are_the_same_in_used_room():
    """Windows of different shapes and with steps that don't count leave nothing behind, and large logits overflow nowhere."""
    rng = np.random.default_rng(5)
    n, room = net(), lm._Room()
    for steps, side, share, scale in ((6, 4, 1, 1), (6, 4, 0.5, 1), (6, 4, 0, 1), (3, 2, 1, 40), (6, 4, 1, 1)):
        n.outputs[:, :-1] *= scale
        n.classes[:-1] *= scale
        h = rng.normal(0, 0.5, (side, lm.HIDDEN)).astype(np.float32)
        window = h, rng.integers(0, 40, (steps, side)), rng.random((steps, side)) > 0.2, rng.integers(0, 40, (steps, side)), rng.random((steps, side)) < share
        (a, fresh), (b, used) = lm.window_gradients(n, *window), lm.window_gradients(n, *window, room)
        assert np.array_equal(a, b) and all(np.isfinite(x).all() and np.array_equal(x, y) for x, y in zip(fresh, used, strict=True))
        state = np.append(h, np.ones((side, 1), np.float32), 1)
        assert lm.log_probs(n, state, window[3][0]) == pytest.approx([plain_log_prob(n, h[k], y) for k, y in enumerate(window[3][0])], rel=1e-4, abs=1e-4)
        n.outputs[:, :-1] /= scale
        n.classes[:-1] /= scale
