"""Patterns tried only on texts that hold a literal string which any match must hold."""

from __future__ import annotations

from functools import reduce
from re import _parser as parser

from pyspark.sql import Column
from pyspark.sql import functions as F


def _of(parts: parser.SubPattern | list) -> list[str]:
    found, run = [], ""
    for op, arg in parts:
        if op is parser.LITERAL:
            run += chr(arg)
            continue
        inner: list[str] = []
        if op is parser.SUBPATTERN:
            inner = _of(arg[3])
        elif op is parser.BRANCH:
            each = [_of(b) for b in arg[1]]
            inner = [x for b in each for x in b] if all(each) else []
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and arg[0] > 0:
            inner = _of(arg[2])
        found += [x for x in ([run] if run else [], inner) if x]
        run = ""
    return max([*found, *([[run]] if run else [])], key=lambda c: (min(map(len, c)), -len(c)), default=[])


def needed(pattern: str) -> tuple[str, ...]:
    """Strings of which every match holds at least one; none if that can't be told."""
    return tuple(dict.fromkeys(_of(parser.parse(pattern))))


def matching(text: Column, flags: str, patterns: dict[str, str], low: Column | None = None) -> Column:
    """The values of the patterns that match somewhere in a text, in order. `low` is the text as the flags compare it, if they ignore case."""

    def check(p: str) -> Column:
        strings = needed(p)
        match = text.rlike(flags + p)
        return reduce(lambda a, b: a | b, (F.contains(text if low is None else low, F.lit(x)) for x in strings)) & match if strings else match

    return F.filter(F.array(*(F.when(check(p), F.lit(v)) for p, v in patterns.items())), lambda x: x.isNotNull())
