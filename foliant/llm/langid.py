"""Language identification with a blended-spectrum string kernel.

A text's feature set is the presence of its character n-grams of orders 1 to 3 (letters
lower-cased, every other character one separator symbol), hashed to 2^20 ids. The kernel of
two texts is |A & B| / sqrt(|A| |B|). Nystroem landmarks turn it into finite features, and one
ridge regression per language (one-versus-rest, targets +1/-1) is fitted in that space.
Prediction is two matrix products a batch: presence x landmark presence, kernel x weights.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

IDS = 1 << 20
#: Code points hashed at once; longer texts go through in pieces that overlap by two.
PIECE = 1 << 20
#: Cells of the presence matrix of a batch.
PRESENCE = 16_000_000


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, 0 for whatever is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            out[cp] = ord(c.lower()[0])
    return out


def _points(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _gram_ids(points: np.ndarray) -> np.ndarray:
    """Hashed ids of all 1-, 2- and 3-grams, with repetition."""
    one = points * np.uint32(2654435761) + np.uint32(97)
    two = (one[:-1] ^ (points[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two[:-1] ^ (points[2:] * np.uint32(668265263))) * np.uint32(374761393)
    return np.concatenate([one >> np.uint32(12), two >> np.uint32(12), three >> np.uint32(12)])


class Spectrum:
    """Distinct gram ids of one text after another, on one scratch array."""

    def __init__(self) -> None:
        self.seen = np.full(IDS, -1, np.int64)
        self.base = 0

    def add(self, text: str) -> tuple[int, bool, int]:
        """Mark a text's grams. Returns its number of distinct grams, whether it has a letter, and the mark."""
        mark, distinct, letter = self.base, 0, False
        points = _points(text)
        for at in range(0, max(len(points), 1), PIECE):
            piece = points[at : at + PIECE + 2]
            letter = letter or bool(piece.any())
            ids = _gram_ids(piece) if len(piece) else np.zeros(0, np.uint32)
            ids = ids[self.seen[ids] < mark]
            order = np.arange(self.base, self.base + len(ids))
            self.seen[ids] = order
            distinct += int(np.count_nonzero(self.seen[ids] == order))
            self.base += len(ids) + 1
        return distinct, letter, mark

    def ids(self, mark: int) -> np.ndarray:
        return np.flatnonzero(self.seen >= mark).astype(np.int32)


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # ids that occur in a landmark
    landmarks: np.ndarray  # len(grams) x m, 0/1: products are whole numbers, the same in batches of any size
    roots: np.ndarray  # m, one over the root of the landmark's size
    weights: np.ndarray  # (m + 1) x len(langs), the last row a bias

    def margins(self, texts: list[str], spectrum: Spectrum) -> tuple[np.ndarray, np.ndarray]:
        """One-versus-rest outputs and whether each text has a letter."""
        present = np.zeros((len(texts), len(self.grams)), np.float32)
        norm, letters = np.ones(len(texts)), np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            distinct, letters[i], mark = spectrum.add(text)
            present[i] = spectrum.seen[self.grams] >= mark
            norm[i] = max(distinct, 1) ** -0.5
        kernel = (present @ self.landmarks) * norm[:, None] * self.roots
        return kernel @ self.weights[:-1] + self.weights[-1], letters


def sample(docs: DataFrame, lang: str, text: str, key: Column, per_lang: int, max_rows: int, max_chars: int) -> list:
    """A bounded labelled sample: for each language one row per hash bucket of the key, at most max_rows in all."""
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) <= max_chars) & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_rows).collect()
    if not counts:
        return []
    buckets = max(1, min(per_lang, max_rows // len(counts)))
    picked = rows.groupBy("lang", F.pmod("h", F.lit(buckets)).alias("b")).agg(F.min("h").alias("h")).select("lang", "h").limit(max_rows)
    # at most max_rows rows of two small columns: the size is bounded, so a broadcast is safe
    chosen = rows.join(F.broadcast(picked), ["lang", "h"])
    sets = map_rows(chosen, "lang string, h long, size int, ids binary", _sets)
    return sets.groupBy("lang", "h").agg(F.min_by(F.struct("size", "ids"), "size").alias("s")).select("lang", "h", "s.size", "s.ids").orderBy("lang", "h").collect()


def _sets(batch) -> dict:
    out, seen = {"lang": [], "h": [], "size": [], "ids": []}, set()
    spectrum = Spectrum()
    for lang, h, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "h", "text")), strict=True):
        if (lang, h) in seen:
            continue
        seen.add((lang, h))
        size, letter, mark = spectrum.add(text)
        if letter:
            for c, v in zip(out, (lang, h, size, spectrum.ids(mark).tobytes()), strict=True):
                out[c].append(v)
    return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: Column | None = None, per_lang: int = 256, landmarks_per_lang: int = 32, max_landmarks: int = 256, max_rows: int = 1024, max_chars: int = 200_000, ridge: float = 1e-2) -> Model | None:
    """Fit on a bounded sample (at most max_rows labelled rows of at most max_chars characters each).

    Rows whose language or text is null, or whose text has no letter, are never learned from.
    Returns None where nothing can be learned. The sample is picked by hash of `key` (doc_id by
    default), so equal input gives an equal model.
    """
    rows = sample(docs, lang, text, F.col("doc_id") if key is None else key, per_lang, max_rows, max_chars)
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    per = max(1, min(landmarks_per_lang, max_landmarks // len(langs)))
    sets = [np.frombuffer(r["ids"], np.int32) for r in rows]
    chosen: list[int] = []
    for name in langs:
        chosen += sorted((i for i, r in enumerate(rows) if r["lang"] == name), key=lambda i: -min(len(sets[i]), 2000))[:per]
    grams = np.unique(np.concatenate([sets[i] for i in chosen]))
    marks = np.zeros((len(grams), len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        marks[np.searchsorted(grams, sets[i]), j] = 1
    roots = np.array([len(sets[i]) for i in chosen]) ** -0.5
    kernel = np.zeros((len(rows), len(chosen)))
    for i, ids in enumerate(sets):
        at = np.searchsorted(grams, ids)
        at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == ids)]
        kernel[i] = marks[at].sum(0, dtype=np.float64) * roots * len(ids) ** -0.5
    values, vectors = np.linalg.eigh(kernel[chosen] + 1e-6 * np.eye(len(chosen)))
    half = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    features = np.hstack([kernel @ half, np.ones((len(rows), 1))])
    targets = np.array([[1.0 if r["lang"] == name else -1.0 for name in langs] for r in rows])
    share = {name: sum(r["lang"] == name for r in rows) for name in langs}
    weight = np.array([1.0 / share[r["lang"]] for r in rows])[:, None] * len(rows) / len(langs)
    solved = np.linalg.solve(features.T @ (weight * features) + ridge * np.eye(features.shape[1]), features.T @ (weight * targets))
    return Model(langs, grams, marks, roots, np.vstack([half @ solved[:-1], solved[-1:]]))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score, margin over the runner-up.

    `und` with score 0 for a null text, a text without a letter, or where no model could be
    learned. Ties go to the alphabetically first language. Repeated rows and repeated ids are
    scored one by one; other columns are ignored, so clashing names do no harm.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch) -> dict:
        ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        m: Model | None = shared.value
        if m is None:
            return {id_col: ids, "lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts), "margin": [0.0] * len(texts)}
        at = max(1, PRESENCE // len(m.grams))
        parts = [m.margins(texts[k : k + at], _spectrum()) for k in range(0, len(texts), at)] or [m.margins([], _spectrum())]
        out, letters = (np.concatenate(x) for x in zip(*parts, strict=True))
        best = out.argmax(1)
        top = out[np.arange(len(texts)), best]
        out[np.arange(len(texts)), best] = -np.inf
        second = out.max(1) if len(m.langs) > 1 else np.full(len(texts), -1.0)
        return {
            id_col: ids,
            "lang_pred": [m.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)],
            "score": np.where(letters, np.clip((1 + top) / 2, 0, 1), 0.0).astype(float),
            "margin": np.where(letters, top - second, 0.0).astype(float),
        }

    return map_rows(docs.select(F.col(id_col), F.col(text).alias("text")), f"{id_col} {kind}, lang_pred string, score double, margin double", run)


@lru_cache(1)
def _spectrum() -> Spectrum:
    return Spectrum()
