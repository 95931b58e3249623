"""Terms looked up by the words of a text, so that work grows with the words that are there and not with the terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let


def keyed(words: dict[int, tuple[str, ...]]) -> dict[str, list[int]]:
    """Numbers of terms by the longest of their words."""
    out: dict[str, list[int]] = {}
    for i, w in words.items():
        out.setdefault(max(w, key=len), []).append(i)
    return out


def candidates(low: Column, keys: dict[str, list[int]]) -> Column:
    """Numbers whose key is a whole word of the text, ascending, each once."""
    if not keys:
        return F.array().cast("array<int>")
    names = F.array(*(F.lit(k) for k in keys))
    numbers = F.array(*(F.array(*(F.lit(i) for i in v)) for v in keys.values()))
    there = F.filter(F.regexp_extract_all(low, F.lit(r"(?U)\w+"), F.lit(0)), lambda w: w.isin(*keys))
    none = F.array().cast("array<int>")
    return let(there, lambda t: F.when(F.size(t) > 0, F.array_sort(F.array_distinct(F.flatten(F.transform(t, lambda w: F.element_at(numbers, F.array_position(names, w).cast("int"))))))).otherwise(none))
