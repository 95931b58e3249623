"""Seams for models and recognisers: images in, scores, boxes and tokens out.

Models are made once a worker by a function that the caller gives. Decoding and preprocessing of
images is here; weights, layout models and recognisers are not.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.match import normalise_term
from ..functions.text import ocr_tokens
from ..vocab import Vocabulary

# Side of an image, channel means and deviations of the classifier's input, weights of luma in 65536ths.
SIDE = 224
MEAN, DEVIATION = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
LUMA = (19595, 38470, 7471)
#: Images scored at a time.
BATCH = 64

Predict = Callable[[np.ndarray], np.ndarray]  # n x 3 x side x side -> n x 2 outputs before the softmax


def read_png(data: bytes) -> np.ndarray:
    """Height x width x 3 bytes of a PNG of 8 bits a channel, not interlaced; transparency is ignored. ValueError for anything else."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, packed, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
    if head is None or head[2] != 8 or head[6] or head[3] not in (0, 2, 3, 4, 6):
        raise ValueError("a PNG of another kind")
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[head[3]]
    try:
        rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * channels)
    except zlib.error as e:
        raise ValueError("a broken PNG") from e
    out = np.zeros((height, width, channels), np.uint8)
    above = np.zeros((width, channels), np.int32)
    for y in range(height):
        above = _unfiltered(int(rows[y, 0]), rows[y, 1:].reshape(width, channels).astype(np.int32), above)
        out[y] = above
    if palette is not None and head[3] == 3:
        return palette[out[:, :, 0]]
    return out[:, :, :3] if channels > 2 else np.repeat(out[:, :, :1], 3, 2)


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray) -> np.ndarray:
    """A line without its filter, by the PNG specification: none, left, above, mean of both, or the nearest of three."""
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line, 0) & 255
    if kind == 2:
        return (line + above) & 255
    out, left, corner = np.empty_like(line), np.zeros(line.shape[1], np.int32), np.zeros(line.shape[1], np.int32)
    for x in range(len(line)):
        if kind == 3:
            guess = (left + above[x]) // 2
        else:
            p = left + above[x] - corner
            near = np.abs(np.stack([p - left, p - above[x], p - corner])).argmin(0)
            guess = np.choose(near, [left, above[x], corner])
        left, corner = (line[x] + guess) & 255, above[x]
        out[x] = left
    return out


def _weights(n: int, side: int) -> np.ndarray:
    """Triangle filter from n samples to `side`, wide enough to take all samples in when it shrinks."""
    scale = n / side
    reach = max(scale, 1.0)
    centre = (np.arange(side)[:, None] + 0.5) * scale
    w = np.maximum(0, 1 - np.abs(np.arange(n)[None, :] + 0.5 - centre) / reach)
    return w / w.sum(1, keepdims=True)


def preprocessed(image: np.ndarray, side: int = SIDE) -> np.ndarray:
    """3 x side x side: resized, grey, scaled to 0-1 and normalised."""
    small = np.einsum("yh,hwc,xw->yxc", _weights(image.shape[0], side), image.astype(float), _weights(image.shape[1], side), optimize=True)
    grey = (np.rint(small).astype(np.int64) @ np.array(LUMA) + 32768 >> 16) / 255
    return ((grey[None] - np.array(MEAN)[:, None, None]) / np.array(DEVIATION)[:, None, None]).astype(np.float32)


def find_model(given: str | None, places: list[str], name: str = "model.pth") -> str | None:
    """Path of the weights: the given one if it is there, else the first of the places that has them."""
    return next((p for p in [given, *(os.path.join(d, name) for d in places)] if p and os.path.exists(p)), None)


def classified(figures: DataFrame, make: Callable[[], Predict], image: str = "image", side: int = SIDE) -> DataFrame:
    """With circuit_prob and non_circuit_prob; null where an image can't be read or scored. `make` loads the model, once a worker."""

    @F.pandas_udf("circuit_prob double, non_circuit_prob double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = make()
        for images in batches:
            out = np.full((len(images), 2), np.nan)
            for a in range(0, len(images), BATCH):
                at, ready = [], []
                for i, data in enumerate(images.iloc[a : a + BATCH], a):
                    try:
                        ready.append(preprocessed(read_png(bytes(data)), side))
                        at.append(i)
                    except (ValueError, TypeError):  # null, or no image that can be read: an error row
                        continue
                if at:
                    logits = np.asarray(predict(np.stack(ready)), float)
                    e = np.exp(logits - logits.max(1, keepdims=True))
                    out[at] = e / e.sum(1, keepdims=True)
            yield pd.DataFrame({"circuit_prob": out[:, 0], "non_circuit_prob": out[:, 1]}).astype(object).where(lambda x: x.notna(), None).astype("Float64")

    return figures.withColumn("__p", score(image)).select(*figures.columns, "__p.*")


def analysis(circuit: Column, non_circuit: Column, threshold: float = 0.5) -> Column:
    """(score, reason, features) of a classifier's probabilities; an error scores 0."""
    a, b = F.coalesce(circuit, F.lit(0.0)), F.coalesce(non_circuit, F.lit(0.0))
    found = a >= threshold
    label = F.when(circuit.isNull(), "error").when(found, "circuit").otherwise("non_circuit")
    confidence = F.when(found, a).otherwise(b)
    reason = F.concat(F.when(found, "CNN: Circuit detected").otherwise("CNN: Non-circuit"), F.format_string(" (confidence: %.2f%%)", confidence * 100))
    features = F.struct(found.alias("is_circuit"), a.alias("circuit_probability"), b.alias("non_circuit_probability"), label.alias("class_label"))
    return F.struct(a.alias("score"), reason.alias("reason"), features.alias("features"))


def recognised(figures: DataFrame, make: Callable[[], Callable[[bytes, int | None], str]], gates: Vocabulary, image: str = "image", mode: int = 11) -> DataFrame:
    """With raw_ocr_text, gate_counts and visual_gates (sorted).

    `make` gives a recogniser of (image, page segmentation mode). Sparse text (mode 11) is asked for first; if that
    fails, the recogniser's default (None); if that fails too, or the image is null, the text is ''.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        recognise = make()

        def of(data: bytes | None) -> str:
            for m in (mode, None) if data is not None else ():
                try:
                    return recognise(bytes(data), m)
                except Exception:  # noqa: BLE001, S112  (whatever a recogniser raises, the next way is tried)
                    continue
            return ""

        for images in batches:
            yield images.map(of, na_action=None)

    names = F.filter(F.transform(ocr_tokens(F.col("raw_ocr_text")), lambda w: normalise_term(w, gates)), lambda g: g.isNotNull())
    out = figures.withColumn("raw_ocr_text", text(image)).withColumn("visual_gates", names)
    kinds = F.array_sort(F.array_distinct("visual_gates"))
    counts = F.map_from_arrays(kinds, F.transform(kinds, lambda k: F.size(F.filter("visual_gates", lambda x: x == k))))
    return out.withColumn("gate_counts", counts).withColumn("visual_gates", kinds)


def per_worker(df: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame] | None], schema: str) -> DataFrame:
    """Rendering, layout detection or image extraction: `make` is called once a worker; where it gives nothing the method is skipped.

    A batch that fails gives no rows.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = make()
        for pdf in batches if step else ():
            try:
                yield step(pdf)[names]
            except Exception:  # noqa: BLE001, S112  (a page that can't be worked on has no figures)
                continue

    return df.mapInPandas(run, schema)
