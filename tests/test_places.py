"""Offsets and markers of long texts."""

import time

import pyarrow as pa
from pyspark.sql import functions as F

from foliant.functions import text as T


def test_markers_are_found_once_a_text(spark):
    """1,500 pages with a reference each; the second call is timed, after the first has planned and compiled."""
    text = "".join(f"[PAGE {i}] as shown in Figure {i} of this text.\n" for i in range(1, 1501))
    df = spark.createDataFrame([(text,)], "t string")
    for _ in range(2):
        began = time.time()
        found = df.select(F.explode(T.references(F.col("t"))).alias("r")).select("r.figure_number", "r.page").collect()
        took = time.time() - began
    # a marker counts for what starts up to 50 characters before its end
    assert len(found) == 4500 and all(r["page"] in (r["figure_number"], r["figure_number"] + 1) for r in found) and took < 15


def test_places_of_a_batch_stay_in_arrow():
    got = T._found_in_order.func(pa.array(["ab ab c", None, "x"]), pa.array([["ab", "ab", "z", None], ["q"], None], pa.list_(pa.string())))
    assert isinstance(got, pa.ListArray) and got.to_pylist() == [[0, 3, 5, 6], [0], []]
