"""Licence scans with ordered signature rules; built-in expressions only.

A text is normalised to lower-case words with single spaces. Keywords gate the rules twice: a
document without any keyword is never matched, and in the others only rules whose keyword occurs
are. Each rule is an expression of its own with a literal pattern, so that patterns are compiled once
a task. Each match becomes an interval of words; a detection is dropped if its interval lies within
that of a detection of higher rank (priority, then words, then earlier rule). Base phrases are exempt.

Work grows in proportion to the words and matches of a document, but for the sort of its detections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import BASE, RULES

_HIT = "array<struct<start:int,end:int,id:int,label:string,priority:int,base:boolean>>"
#: Stand before and after a match; words have no control characters.
_OPEN, _CLOSE = "\x01", "\x02"
#: Detections whose flags are put together at a time.
_RUN = 512


def parse_rules(base: str = BASE, rules: str = RULES) -> list[dict]:
    out = []
    for text, is_base in ((base, True), (rules, False)):
        for line in text.strip().splitlines():
            label, priority, keyword, pattern = line.split(" | ", 3)
            out.append({"id": len(out), "label": label, "priority": int(priority), "keyword": keyword, "pattern": f"(?<= )(?:{pattern})(?= )", "base": is_base})
    return out


def normalised(text: str) -> Column:
    """Words with one space before, between and after; a single space if there are none.

    lower() also folds letters beyond A-Z, which moves no word boundary and makes no ASCII word
    of the base phrases.
    """
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _marked(words: Column, rules: list[dict]) -> Column:
    """(rule, text with marks) of each rule that matches; rules are looked at only where their keyword occurs."""
    by_keyword: dict[str, list[tuple[int, dict]]] = {}
    for i, r in enumerate(rules):
        by_keyword.setdefault(r["keyword"], []).append((i, r))
    none = F.array().cast("array<struct<rule:int,text:string>>")
    groups = []
    for keyword, those in by_keyword.items():
        marks = [F.when(words.rlike(r["pattern"]), F.struct(F.lit(i).alias("rule"), F.regexp_replace(words, r["pattern"], f"{_OPEN}$0{_CLOSE}").alias("text"))) for i, r in those]
        groups.append(F.when(words.contains(keyword), F.array(*marks)).otherwise(none))
    return F.filter(F.flatten(F.array(*groups)), lambda m: m.isNotNull()) if groups else none


def _hits(marked: Column, rules: list[dict]) -> Column:
    """Detections of each rule, as intervals of words: where the marks stand among the words."""
    meta = F.array(*(F.struct(F.lit(r["id"]).alias("id"), F.lit(r["label"]).alias("label"), F.lit(r["priority"]).alias("priority"), F.lit(r["base"]).alias("base")) for r in rules))
    places = lambda words, there, shift: F.filter(F.transform(words, lambda w, i: F.when(there(w), i + shift)), lambda i: i.isNotNull())

    def of_rule(m: Column) -> Column:
        words = F.split(m["text"], " ", -1)  # an empty one comes first
        pairs = F.arrays_zip(places(words, lambda w: w.startswith(_OPEN), -1).alias("start"), places(words, lambda w: w.endswith(_CLOSE), 0).alias("end"))
        rule = F.element_at(meta, m["rule"] + 1)
        return F.transform(pairs, lambda p: F.struct(p["start"], p["end"], rule["id"].alias("id"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["base"].alias("base")))

    return F.flatten(F.transform(marked, of_rule)).cast(_HIT)


def _kept(hits: Column, rules: list[dict]) -> Column:
    """Detections that aren't within one of higher rank, by start, then the longer, the higher priority and the earlier rule.

    In that order whatever outranks a detection and holds it comes before it. So one pass suffices
    that carries, for each priority, the furthest end of a detection of that priority or a higher one.
    """
    levels = sorted({r["priority"] for r in rules if not r["base"]})

    def step(state: Column, h: Column) -> Column:
        hidden = reduce(lambda a, p: F.when(h["priority"] == p, state[f"p{p}"] >= h["end"]).otherwise(a), levels, F.lit(False))
        ends = [F.when(~h["base"] & (h["priority"] >= p), F.greatest(state[f"p{p}"], h["end"])).otherwise(state[f"p{p}"]).alias(f"p{p}") for p in levels]
        return F.struct(*ends, F.concat(state["flags"], F.when(h["base"] | ~hidden, F.lit("1")).otherwise(F.lit("0"))).alias("flags"))

    def run(state: Column, part: Column) -> Column:
        start = F.struct(*(state[f"p{p}"] for p in levels), F.lit("").alias("flags"))
        done = F.aggregate(part, start, step)
        # one array of one element: the inner pass is worked out once
        return F.transform(F.array(done), lambda d: F.struct(*(d[f"p{p}"] for p in levels), F.concat(state["flags"], d["flags"]).alias("flags")))[0]

    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"], (-h["end"]).alias("e"), (-h["priority"]).alias("p"), h["id"], h["label"], h["base"])))
    ordered = F.transform(ordered, lambda h: F.struct(h["start"], (-h["e"]).alias("end"), h["id"], h["label"], (-h["p"]).alias("priority"), h["base"])).cast(_HIT)
    size = F.greatest(F.size(hits), F.lit(1))
    none = F.struct(*(F.lit(-1).alias(f"p{p}") for p in levels), F.lit("").alias("flags"))

    def pick(found: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / _RUN).cast("int")), lambda k: F.slice(found, k * _RUN + 1, _RUN))
        flags = F.aggregate(parts, none, run, lambda s: F.split(s["flags"], "", -1))
        return F.transform(F.filter(F.arrays_zip(found.alias("h"), flags.alias("f")), lambda z: z["f"] == "1"), lambda z: z["h"])

    return F.transform(F.array(ordered), pick)[0]


def scan(docs: DataFrame, rules: list[dict] | None = None, text: str = "text") -> DataFrame:
    """The documents with n_words, hits and kept added.

    hits are all detections, kept those that survive suppression (base ones always do), both as
    (start, end, id, label, priority, base) with words counted from 0 and ends exclusive. Null
    and empty texts have no words and no hits. Repeated rows are scanned one by one. Input columns
    stay, except that columns named n_words, hits or kept are replaced.
    """
    rules = parse_rules() if rules is None else rules
    old = [c for c in docs.columns if c not in ("n_words", "hits", "kept")]
    name = next(n for n in ("words" + "_" * k for k in range(1, len(docs.columns) + 2)) if n not in docs.columns)
    words = F.col(name)
    keywords = sorted({r["keyword"] for r in rules})
    gate = reduce(lambda a, b: a | b, (words.contains(k) for k in keywords)) if keywords else F.lit(False)
    out = docs.withColumn(name, normalised(text))
    n_words = (F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) - 1).cast("long")
    nothing = F.array().cast(_HIT)
    # each step needs what the one before found more than once, and so is a projection of its own
    out = out.select(*old, n_words.alias("n_words"), F.when(gate, _marked(words, rules)).alias(name))
    out = out.select(*old, "n_words", F.when(F.size(name) > 0, _hits(F.col(name), rules)).otherwise(nothing).alias("hits"))
    return out.withColumn("kept", F.when(F.size("hits") > 1, _kept(F.col("hits"), rules)).otherwise(F.col("hits")))


def _labels(hits: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")


def digest(found: DataFrame) -> DataFrame:
    """n_base, first_word, last_word, base_labels, labels and score, from scan's rows.

    score is the highest priority of a kept detection over the highest there is; 0 without one.
    """
    base = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base, lambda h: h["start"].cast("long"))
    return found.withColumns({
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(starts),
        "last_word": F.array_max(starts),
        "base_labels": _labels(base),
        "labels": _labels(F.col("kept")),
        "score": F.coalesce(F.array_max(F.transform("kept", lambda h: h["priority"])) / 9.0, F.lit(0.0)),
    })
