import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import scorers as SC
from foliant.vocab import gates


def png(image, kind=2, filters=(0,), palette=None):
    """A PNG of an array height x width x channels, lines filtered in turn."""
    height, width, channels = image.shape
    above, lines = np.zeros((width, channels), int), []
    for y in range(height):
        line, f = image[y].astype(int), filters[y % len(filters)]
        left = np.vstack([np.zeros((1, channels), int), line[:-1]])
        corner = np.vstack([np.zeros((1, channels), int), above[:-1]])
        p = left + above - corner
        near = np.abs(np.stack([p - left, p - above, p - corner])).argmin(0)
        guess = [0, left, above, (left + above) // 2, np.choose(near, [left, above, corner])][f]
        lines.append(bytes([f]) + ((line - guess) & 255).astype(np.uint8).tobytes())
        above = line
    chunk = lambda k, b: struct.pack(">I4s", len(b), k) + b + struct.pack(">I", zlib.crc32(k + b))
    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + (chunk(b"PLTE", palette) if palette else b"") + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind,channels", [(0, 1), (2, 3), (4, 2), (6, 4)])
def test_png_round_trip(kind, channels):
    image = np.random.default_rng(kind).integers(0, 256, (11, 7, channels), np.uint8)
    want = image[:, :, :3] if channels > 2 else np.repeat(image[:, :, :1], 3, 2)
    assert np.array_equal(SC.read_png(png(image, kind, (0, 1, 2, 3, 4))), want)


def test_palettes_and_what_is_no_png():
    image = np.array([[[0], [1]], [[1], [0]]], np.uint8)
    assert SC.read_png(png(image, 3, palette=bytes([1, 2, 3, 9, 8, 7])))[0].tolist() == [[1, 2, 3], [9, 8, 7]]
    for data in (b"", b"GIF89a", png(image, 0)[:-30]):
        with pytest.raises(ValueError):
            SC.read_png(data)


def test_preprocessing():
    x = SC.preprocessed(np.full((10, 30, 3), 255, np.uint8), 8)
    assert x.shape == (3, 8, 8) and np.allclose(x[:, 0, 0], [(1 - m) / d for m, d in zip(SC.MEAN, SC.DEVIATION, strict=True)], atol=1e-6)
    ramp = np.repeat(np.arange(0, 256, 2, dtype=np.uint8)[None, :, None], 3, 2).repeat(4, 0)
    assert np.all(np.diff(SC.preprocessed(ramp, 8)[0, 0]) > 0)
    assert np.allclose(SC._weights(100, 7).sum(1), 1)


def test_classification_and_analysis(spark):
    white, black = (png(np.full((20, 20, 3), v, np.uint8)) for v in (255, 0))
    df = spark.createDataFrame([("a", white), ("b", black), ("c", b"broken"), ("d", None)], "filename string, image binary")

    def make():
        return lambda x: np.stack([x.mean((1, 2, 3)), -x.mean((1, 2, 3))], 1)

    rows = SC.classified(df, make, side=16).withColumn("x", SC.analysis(F.col("circuit_prob"), F.col("non_circuit_prob"))).orderBy("filename").collect()
    assert [r["x"]["features"]["class_label"] for r in rows] == ["circuit", "non_circuit", "error", "error"]
    assert rows[0]["circuit_prob"] + rows[0]["non_circuit_prob"] == pytest.approx(1) and rows[2]["circuit_prob"] is None
    assert rows[0]["x"]["reason"] == f"CNN: Circuit detected (confidence: {rows[0]['circuit_prob']:.2%})"
    assert rows[2]["x"]["reason"] == "CNN: Non-circuit (confidence: 0.00%)" and rows[2]["x"]["score"] == 0


def test_recognition_falls_back(spark):
    df = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("c", b"3"), ("d", None)], "filename string, image binary")

    def make():
        def recognise(data, mode):
            if data == b"3" or data == b"2" and mode == 11:
                raise RuntimeError
            return "H | cx -- h" if mode == 11 else "Rz foo"

        return recognise

    rows = SC.recognised(df, make, gates()).orderBy("filename").collect()
    assert [r["visual_gates"] for r in rows] == [["CNOT", "H"], ["RZ"], [], []]
    assert rows[0]["gate_counts"] == {"CNOT": 1, "H": 2} and [r["raw_ocr_text"] for r in rows[2:]] == ["", ""]


def test_pluggable_stages(spark, tmp_path):
    df = spark.range(4).withColumn("page", F.lit(1))
    assert SC.per_worker(df, lambda: None, "id long, n int").count() == 0
    assert SC.per_worker(df, lambda: lambda pdf: pdf.assign(n=2), "id long, n int").count() == 4
    assert SC.per_worker(df, lambda: lambda pdf: 1 / 0, "id long, n int").count() == 0
    (tmp_path / "model.pth").write_bytes(b"x")
    assert SC.find_model(None, ["/nowhere", str(tmp_path)]) == str(tmp_path / "model.pth")
    assert SC.find_model(str(tmp_path / "model.pth"), []) and SC.find_model("/no", ["/nowhere"]) is None
