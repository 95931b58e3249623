"""Quality rules: a base filter and a hashed n-gram log-likelihood ratio.

Two multinomials over 2^18 hashed word uni- and bigrams are counted, one over the trusted target
texts and one over all texts of the raw corpus, each distinct text once however often it is copied.
A document's score is the mean, over its n-grams, of log(p(bucket) / q(bucket)). Both are smoothed and
sum to one: p = (t + s) / (T + B s) and q = (e + s) / (T + B s), where t is the bucket's target count, T the
sum of these, B the number of buckets, e the raw count scaled so that all sum to T as well, and s a
pseudo-count, which draws thin buckets to 0. So the ratio is (t + s) / (e + s). The scored text's own n-grams are left out of all
counts, so a score says what other texts say. The means over unigrams and over bigrams are also
judged apart: words that the target avoids (toxic ones) show in the unigrams only. Their thresholds
are what all but a small share of the target's texts reach, each scored without its own counts; that
over all n-grams is fixed. Every document is kept or rejected by these; nothing is drawn at random.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, column, discard, extend, fresh, map_rows, slices, utf8, written

BUCKETS = 1 << 18
PSEUDO = 2.0
#: Mean log-likelihood ratio over all n-grams below which a document is rejected.
THRESHOLD = -0.2
#: Share of the target's texts that may lie below the threshold of unigrams, and below that of bigrams.
LOSS = 0.003
#: Words below which a text is rejected.
LEAST_WORDS = 50
SYMBOLS = b"#*$%&|<>"


def _word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """32-bit hashes of words; `known` remembers the distinct words of a slice."""
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = crc32(w)
        out.append(h)
    return np.array(out, np.uint32)


def gram_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of all uni- and bigrams."""
    one = (hashes * np.uint32(2654435761)) >> np.uint32(14)
    two = ((hashes[:-1] * np.uint32(2246822519)) ^ hashes[1:]) * np.uint32(3266489917) >> np.uint32(14)
    return np.concatenate([one, two])


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Bucket counts over all n-grams of the documents.

    Each task sums its documents into an array of fixed size and emits the buckets it met, so
    what is shuffled is bounded by tasks x buckets and what reaches the driver by buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                known: dict[bytes, int] = {}
                found = [gram_buckets(_word_hashes(utf8(t).translate(LOWER).split(), known)) for t in part.column(0).to_pylist()]
                total += np.bincount(np.concatenate(found), minlength=BUCKETS)
        met = np.flatnonzero(total)
        for at in range(0, len(met), 65536):
            b = met[at : at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(total[b], pa.int64())], ["bucket", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[found["bucket"]] = found["n"]
    return out


Means = tuple[float, float, float]  # over all n-grams, unigrams, bigrams


@dataclass
class Ratios:
    """Bucket counts of the raw corpus and of the target with their sums, and the thresholds of unigrams and bigrams."""

    raw: np.ndarray
    target: np.ndarray
    n_raw: float
    n_target: float
    least: tuple[float, float] = (-np.inf, -np.inf)

    def means(self, buckets: np.ndarray) -> tuple[Means, Means]:
        """Mean shrunk log ratios of a text's n-grams without its own counts: if the text isn't in the target, and if it is.

        0 where nothing else is left in the corpus or in the target, and where there is no n-gram.
        """
        if not len(buckets):
            return (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)
        words = (len(buckets) + 1) // 2  # unigrams come first, and there is one more of them
        met, at, n = np.unique(buckets, return_inverse=True, return_counts=True)
        raw, n_raw = self.raw[met] - n, self.n_raw - len(buckets)

        def mean(target: np.ndarray, n_target: float) -> Means:
            if n_raw <= 0 or n_target <= 0:
                return 0.0, 0.0, 0.0
            each = np.log((target + PSEUDO) / (raw * (n_target / n_raw) + PSEUDO))[at]
            one, two = float(each[:words].sum()), float(each[words:].sum())
            return (one + two) / len(buckets), one / words, two / max(1, len(buckets) - words)

        target = self.target[met]
        return mean(target, self.n_target), mean(np.maximum(target - n, 0), self.n_target - len(buckets))


def ratios(raw: np.ndarray, target: np.ndarray) -> Ratios:
    return Ratios(raw, target, float(raw.sum()), float(target.sum()))


def thresholds(weights: Ratios, target: DataFrame, loss: float = LOSS) -> tuple[float, float]:
    """Means over unigrams and bigrams that all but a share `loss` of the target's texts of enough words reach, at that text itself."""
    shared = target.sparkSession.sparkContext.broadcast(weights)

    def run(batch) -> dict:
        known: dict[bytes, int] = {}
        words = [utf8(t).translate(LOWER).split() for t in batch.column(0).to_pylist()]
        found = [shared.value.means(gram_buckets(_word_hashes(w, known)))[1][1:] for w in words if len(w) >= LEAST_WORDS]
        return {"one": [x for x, _ in found], "two": [x for _, x in found]}

    rows = map_rows(target.select("text"), "one double, two double", run)
    least = rows.agg(*(F.percentile_approx(c, loss, 100_000) for c in ("one", "two"))).first()
    return tuple(-np.inf if x is None else x for x in least)


def base_stats(text: str | None, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words."""
    data = utf8(text)
    # every byte but UTF-8 continuation bytes and the six spaces counts as one character of a word
    chars = len((text or "")) - (len(data) - len(data.translate(None, b" \t\n\x0b\x0c\r")))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(b" \t\n\x0b\x0c\r"):
            seen.add(line)
    repeated = 0
    if len(words) >= 4:
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
        v = len(ids)
        pairs = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1]
        _, at, n = np.unique(pairs[:-1] * v + w[2:], return_inverse=True, return_counts=True)
        twice = n[at] > 1
        if twice.any():
            hit = np.zeros(len(words), bool)
            for k in range(3):
                hit[k : k + len(twice)] |= twice
            repeated = int(hit.sum())
    return chars, symbols, dup, repeated


def judge(text: str | None, weights: Ratios, known: dict[bytes, int], threshold: float) -> tuple:
    """n_words, the base statistics and base_failed of one text; then llr and kept if it isn't in the target, and if it is."""
    words = utf8(text).split()
    stats = base_stats(text, words)
    lower = utf8(text).translate(LOWER).split()
    failed = len(words) < LEAST_WORDS or 100 * stats[3] > 50 * len(words)
    found = weights.means(gram_buckets(_word_hashes(lower, known)) if words else np.zeros(0, np.uint32))
    one, two = weights.least
    return len(words), *stats, failed, *(x for m in found for x in (m[0], not failed and m[0] >= threshold and m[1] >= one and m[2] >= two))


def score(docs: DataFrame, weights: Ratios, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document of the corpus that was fitted: base statistics, base_failed, llr and kept.

    A null or empty text has no words, llr 0 and fails the base filter. A document of one word
    has one n-gram. Ties with the thresholds are kept. Repeated rows and ids are judged one by
    one; other columns are ignored. Texts are judged for either case of being in the target, so
    that only the narrow results are joined with the table of trusted texts.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr_out", "kept_out", "llr_in", "kept_in")

    def run(batch) -> dict:
        known: dict[bytes, int] = {}
        rows = [judge(t, shared.value, known, threshold) for t in batch.column(1).to_pylist()]
        return dict(zip(names, zip(*rows, strict=True), strict=True)) | {id_col: batch.column(0), "h": batch.column(2)}

    schema = f"{id_col} {kind}, h long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr_out double, kept_out boolean, llr_in double, kept_in boolean"
    judged = map_rows(docs.select(F.col(id_col), F.col(text).alias("text"), F.xxhash64(text).alias("h")), schema, run)
    chosen = [F.when(F.col("inside"), F.col(f"{c}_in")).otherwise(F.col(f"{c}_out")).alias(c) for c in ("llr", "kept")]
    return judged.join(trusted.withColumn("inside", F.lit(True)), "h", "left").select(id_col, *names[:6], *chosen)


def keep_flags(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on all documents, with those labelled good and not toxic as the target, and score all."""
    trusted = trusted_hashes(docs, labels)
    return score(docs, fit(docs, trusted), trusted, threshold)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that some label calls good and none calls bad or toxic; each once."""
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return judged.where("q = 1 and t = 0").select("doc_id")


def trusted_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of trusted ids. Only texts that may be trusted are shuffled.

    A table of hashed trusted ids, of at most 2^20 rows whatever the input, is broadcast and
    drops nearly all other documents before the exact join.
    """
    ids = trusted_ids(labels)
    short = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 20)).cast("int")
    maybe = docs.select("doc_id", "text", short("doc_id").alias("h")).join(F.broadcast(ids.select(short("doc_id").alias("h")).distinct()), "h", "left_semi")
    return maybe.join(ids.hint("merge"), "doc_id", "left_semi")


def trusted_hashes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Hashes (h) of the texts that some trusted id has; each once. No text is shuffled."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"))
    return written(rows.join(trusted_ids(labels).hint("merge"), "doc_id", "left_semi").select("h").distinct(), "quality-trusted")


def _short(h: str):
    return F.pmod(F.col(h), F.lit(1 << 20)).cast("int")


def _may_be_in(rows: DataFrame, hashes: DataFrame, how: str) -> DataFrame:
    """Rows whose shortened hash is (left_semi) or isn't (left_anti) among those of `hashes`, of which at most 2^20 are broadcast."""
    return rows.withColumn("s", _short("h")).join(F.broadcast(hashes.select(_short("h").alias("s")).distinct()), "s", how).drop("s")


def copied_texts(docs: DataFrame) -> DataFrame:
    """Hashes (h) of texts that several rows have, written."""
    return written(docs.select(F.xxhash64("text").alias("h")).groupBy("h").count().where("count > 1").select("h"), "quality-copied")


def distinct_texts(docs: DataFrame, copied: DataFrame) -> DataFrame:
    """Each text of the documents once. Only texts that may be copies are shuffled, one of each a task."""
    rows = docs.select("text", F.xxhash64("text").alias("h"))
    once, again = _may_be_in(rows, copied, "left_anti"), _may_be_in(rows, copied, "left_semi")
    return once.union(again.dropDuplicates(["h"])).select("text")


def target_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Each trusted text once. The join isn't a semi-join, which the optimizer would move before the copies are dropped."""
    rows = docs.select("text", F.xxhash64("text").alias("h"))
    return _may_be_in(rows, trusted, "left_semi").dropDuplicates(["h"]).join(trusted.hint("merge"), "h").select("text")


def fit(docs: DataFrame, trusted: DataFrame) -> Ratios:
    target = target_texts(docs, trusted)
    copied = copied_texts(docs)
    weights = ratios(bucket_counts(distinct_texts(docs, copied)), bucket_counts(target))
    discard(copied)
    weights.least = thresholds(weights, target)
    return weights


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with their own columns; judged as in `score`, row by row.

    Texts are shuffled only where it makes a difference whether they are in the target.
    """
    trusted = trusted_hashes(docs, labels)
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, trusted))

    h, out, inside, trust = fresh(docs, "h", "kept_out", "kept_in", "trusted")

    def run(batch) -> dict:
        known: dict[bytes, int] = {}
        found = [judge(t, weights.value, known, threshold) for t in column(batch, "text")]
        return {out: [x[-3] for x in found], inside: [x[-1] for x in found]}

    judged = extend(docs.withColumn(h, F.xxhash64("text")), f"{out} boolean, {inside} boolean", run)
    same = judged.where(F.col(out) & F.col(inside))
    either = judged.where(F.col(out) != F.col(inside)).join(trusted.select(F.col("h").alias(h), F.lit(True).alias(trust)).hint("merge"), h, "left")
    return same.select(*docs.columns).union(either.where(F.when(F.col(trust), F.col(inside)).otherwise(F.col(out))).select(*docs.columns))
