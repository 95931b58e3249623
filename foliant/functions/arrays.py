"""Array functions whose work grows in proportion to their arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of a run. Arrays that grow by one element are copied each time, so they stay this short.
RUN = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def runs(values: Column, size: int = RUN) -> Column:
    """The array cut into arrays of `size` elements; none for an empty one."""
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.slice(values, k * size + 1, size))


def sums_before(values: Column) -> Column:
    """For each number of an int array the sum of those before it; none for an empty or null array."""
    none = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    add = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out"))

    def joined(parts: Column) -> Column:
        before = F.aggregate(parts, none, lambda s, p: add(s, p["sum"]), lambda s: s["out"])
        return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), before.alias("before")), lambda z: F.transform(z["part"]["out"], lambda x: x + z["before"])))

    return let(values, lambda v: let(F.transform(runs(v), lambda part: F.aggregate(part, none, add)), joined))


def first_of_equal(rows: Column, key: Callable[[Column], Column]) -> Column:
    """Of elements with equal keys the first, in order."""
    keyed = lambda r: let(F.transform(r, key), lambda keys: F.filter(r, lambda x, i: F.array_position(keys, key(x)) == i + 1))
    return let(rows, keyed)
