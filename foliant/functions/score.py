"""Relevance scores of captions and contexts from weighted keywords and patterns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import Keywords
from .arrays import let
from .literals import matching
from .lookup import candidates, keyed

# Patterns for and against, and words that go with "circuit".
FOR = (
    r"(?:quantum\s+)?circuit\s+(?:for|implementing|that|to|used)",
    r"(?:the\s+)?circuit\s+(?:is\s+)?(?:shown|depicted|illustrated)",
    r"(?:shows?|depicts?|illustrates?)\s+(?:the\s+)?(?:a\s+)?(?:quantum\s+)?circuit",
    r"circuit\s+diagram",
    r"gate\s+(?:sequence|decomposition)",
    r"(?:\d+|one|two|three|four|five|n)\s*-?\s*qubit\s+circuit",
    r"(?:cnot|hadamard|toffoli|swap|cz|cx)\s+gate\s+(?:circuit|diagram|sequence)",
    r"(?:controlled|control)\s+(?:gate|not|z|phase)",
    r"(?:grover|shor|vqe|qaoa|qft|qpe|teleportation|bell)\s*['s]*\s*(?:circuit|algorithm)",
    r"variational\s+(?:circuit|ansatz)",
    r"parameterized\s+(?:circuit|quantum)",
)
AGAINST = (
    r"(?:real|imaginary)\s+parts?\s+of",
    r"eigenvalue",
    r"result(?:s)?\s+(?:of|from|for|showing)",
    r"performance\s+of",
    r"comparison\s+(?:of|between)",
    r"(?:plot|graph)\s+(?:of|showing)",
    r"experimental\s+(?:data|results|setup)",
    r"error\s+(?:rate|bar)",
    r"fidelity\s+(?:vs|versus|against|as)",
    r"success\s+(?:probability|rate)",
    r"(?:energy|phase)\s+(?:landscape|spectrum|diagram)",
    r"histogram|bar\s+chart",
    r"convergence",
    r"(?:training|learning)\s+curve",
    r"matrix\s+element",
    r"(?:density|choi|pauli)\s+matrix",
    r"calibration",
    r"coefficient",
    r"(?:real|imaginary)\s+(?:part|component)",
    r"overlap|scalar\s+product",
    r"(?:schematic|diagram)\s+of\s+(?:the\s+)?(?:experiment|setup|device|chip)",
    r"(?:superconducting|transmon)\s+(?:qubit|device|chip)",
)
DESCRIBES = (
    r"(?:shows?|presents?|depicts?|illustrates?)\s+(?:the\s+)?(?:quantum\s+)?circuit",
    r"circuit\s+(?:consists?|contains?|comprises?)",
    r"(?:apply|applying|applied)\s+(?:the\s+)?(?:\w+\s+)?gate",
    r"(?:first|then|next|finally)\s+(?:we\s+)?apply",
    r"qubits?\s+(?:are|is)\s+(?:initialized|prepared|measured)",
    r"gate\s+sequence",
    r"unitary\s+(?:is|are)\s+(?:applied|implemented)",
    r"(?:in|from)\s+(?:fig|figure)\s*\.?\s*\d+",
    r"(?:cnot|hadamard|toffoli|pauli|swap)\s+(?:gate|operation)",
    r"qubit\s+\d+",
    r"(?:single|two|multi)\s*-?\s*qubit",
    r"(?:control|target)\s+qubit",
    r"(?:input|output)\s+(?:state|qubit)",
    r"(?:initial|final)\s+state",
    r"measurement\s+(?:of|on)",
    r"(?:variational|parameterized)\s+(?:circuit|ansatz)",
    r"(?:grover|shor|vqe|qaoa|qft)\s*['s]*",
)
BOOSTING = ("hadamard", "cnot", "toffoli", "pauli", "swap", "cx", "cz", "rotation", "phase gate", "controlled")


@dataclass(frozen=True)
class Weights:
    """Of keywords by kind, of patterns, and thresholds."""

    primary: float = 3.0
    secondary: float = 1.0
    entity: float = 1.5
    negative: float = -2.0
    scale: float = 15.0
    for_pattern: float = 0.35
    against_pattern: float = -0.5
    boost: float = 0.3
    describes: float = 0.15
    caption_threshold: float = 0.35
    context_threshold: float = 0.3


def _parts(text: Column, parts: tuple[str, ...]) -> Column:
    """Those that occur as substrings, in order."""
    return F.filter(F.array(*(F.lit(p) for p in parts)), lambda p: F.contains(text, p))


def _words(text: Column, words: tuple[str, ...]) -> Column:
    """Those that stand in a lower-cased text as whole words, in order.

    Words of letters, digits and underscores only are looked up among the text's words; of the others
    only those that have a word there and occur as substrings are searched with their boundaries.
    """
    simple = re.compile(r"\w+")
    keys = keyed({i: tuple(simple.findall(w)) for i, w in enumerate(words)})
    table = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(None if simple.fullmatch(w) else rf"(?U)\b{re.escape(w)}\b").alias("pattern")) for w in words))
    stands = lambda e: e["pattern"].isNull() | (F.contains(text, e["word"]) & F.regexp_like(text, e["pattern"]))
    return F.transform(F.filter(F.transform(candidates(text, keys), lambda i: F.element_at(table, i + 1)), stands), lambda e: e["word"])


def _matching(text: Column, patterns: tuple[str, ...]) -> Column:
    """The patterns that match somewhere, in order; \\s and \\w as Unicode has them."""
    return matching(text, "(?U)", {p: p for p in patterns})


def keyword_matches(text: Column, k: Keywords) -> Column:
    """Keywords that occur, by kind: primary and negative as substrings, the others as words."""
    return let(F.lower(F.coalesce(text, F.lit(""))), lambda low: _keywords_in(low, k))


def _keywords_in(low: Column, k: Keywords) -> Column:
    return F.struct(_parts(low, k.primary).alias("primary"), _words(low, k.secondary).alias("secondary"), _words(low, k.entities).alias("gates"), _parts(low, k.negative).alias("negative"))


def keyword_score(matches: Column, w: Weights = Weights()) -> Column:
    """Score of keyword_matches, between 0 and 1; each keyword counts once."""
    raw = F.size(matches["primary"]) * F.lit(w.primary) + F.size(matches["secondary"]) * F.lit(w.secondary) + F.size(matches["gates"]) * F.lit(w.entity) + F.size(matches["negative"]) * F.lit(w.negative)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw / F.lit(w.scale)))


def quick_indicator(text: Column, k: Keywords) -> Column:
    """Whether a primary keyword, or one of two words, occurs at all."""
    there = lambda low: F.exists(F.array(*(F.lit(p) for p in k.primary)), lambda p: F.contains(low, p)) | low.rlike(r"(?U)\bcircuit\b") | low.rlike(r"(?U)\bgate\b")
    return let(F.lower(F.coalesce(text, F.lit(""))), there)


def caption_analysis(caption: Column, k: Keywords, w: Weights = Weights()) -> Column:
    """(is_circuit, confidence, keyword_score, pattern_score, evidence) of a caption; all 0 if it is null or empty."""
    low = F.lower(F.coalesce(caption, F.lit("")))

    def seen(t: Column) -> Column:
        boosting = F.when(t.contains("circuit"), F.size(_parts(t, BOOSTING))).otherwise(0)
        return F.struct(_keywords_in(t, k).alias("m"), _matching(t, FOR).alias("good"), _matching(t, AGAINST).alias("bad"), boosting.alias("boosting"))

    marked = lambda names, mark, most=None: F.transform(names, lambda x: F.concat(F.lit(mark), F.substring(x, 1, most), F.lit("...")) if most else F.concat(F.lit(mark), x))

    def scored(s: Column) -> Column:
        good, bad, boosted = F.size(s["good"]), F.size(s["bad"]), s["boosting"] > 0
        raw = good * F.lit(w.for_pattern) + bad * F.lit(w.against_pattern) + F.when(boosted, F.lit(w.boost)).otherwise(0.0)
        raw = F.when((bad > 0) & (good == 0), F.least(raw, F.lit(-0.2))).otherwise(raw)
        pattern = F.greatest(F.lit(-0.5), F.least(F.lit(1.0), raw + F.lit(0.3)))
        both = F.when(boosted, F.array(F.concat(F.lit("gate+circuit:"), s["boosting"].cast("string")))).otherwise(F.array().cast("array<string>"))
        evidence = F.concat(marked(s["m"]["primary"], "primary:"), marked(F.slice(s["m"]["gates"], 1, 3), "gate:"), marked(s["good"], "pattern:", 30), marked(s["bad"], "negative:", 20), both)
        return F.struct(keyword_score(s["m"], w).alias("score"), pattern.alias("pattern"), evidence.alias("evidence"))

    def judged(r: Column) -> Column:
        total = F.lit(0.4) * r["score"] + F.lit(0.6) * r["pattern"]
        return F.struct((total >= w.caption_threshold).alias("is_circuit"), total.alias("confidence"), r["score"].alias("keyword_score"), r["pattern"].alias("pattern_score"), r["evidence"].alias("evidence"))

    kind = "struct<is_circuit:boolean,confidence:double,keyword_score:double,pattern_score:double,evidence:array<string>>"
    none = F.struct(F.lit(False), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.array().cast("array<string>")).cast(kind)
    return F.when(low == "", none).otherwise(let(let(let(low, seen), scored), judged))


def context_analysis(contexts: Column, k: Keywords, w: Weights = Weights()) -> Column:
    """(is_circuit, confidence, context_count, evidence) of contexts: the mean of their scores, at most 1; 0 without contexts."""
    texts = F.coalesce(contexts, F.array().cast("array<string>"))

    def one(c: Column) -> Column:
        return let(F.lower(F.coalesce(c, F.lit(""))), lambda low: let(_keywords_in(low, k), lambda m: F.struct((keyword_score(m, w) + F.size(_matching(low, DESCRIBES)) * F.lit(w.describes)).alias("score"), F.slice(m["primary"], 1, 2).alias("evidence"))))

    def judged(rows: Column) -> Column:
        mean = F.aggregate(rows, F.lit(0.0), lambda s, r: s + r["score"]) / F.greatest(F.size(rows), F.lit(1))
        confidence = F.least(F.lit(1.0), mean)
        return F.struct((confidence >= w.context_threshold).alias("is_circuit"), confidence.alias("confidence"), F.size(rows).alias("context_count"), F.slice(F.flatten(F.transform(rows, lambda r: r["evidence"])), 1, 10).alias("evidence"))

    return let(F.transform(texts, one), judged)


def detection(caption: Column, contexts: Column, k: Keywords, threshold: float = 0.35, w: Weights = Weights()) -> Column:
    """(is_circuit, confidence, caption_score, context_score): both weighted 0.6 and 0.4, or the one there is."""
    has_caption = F.coalesce(F.length(caption), F.lit(0)) > 0
    has_contexts = F.size(F.coalesce(contexts, F.array().cast("array<string>"))) > 0

    def combined(s: Column) -> Column:
        a, b = s["a"]["confidence"], s["b"]["confidence"]
        total = F.when(has_caption & has_contexts, F.lit(0.6) * a + F.lit(0.4) * b).when(has_caption, a).when(has_contexts, b).otherwise(0.0)
        return F.struct((total >= threshold).alias("is_circuit"), total.alias("confidence"), a.alias("caption_score"), b.alias("context_score"))

    return let(F.struct(caption_analysis(caption, k, w).alias("a"), context_analysis(contexts, k, w).alias("b")), combined)
