"""Topic identification from section title, caption and contexts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import Vocabulary, generic_patterns, inferences
from .arrays import let
from .literals import matching
from .match import find_terms, folded

UNKNOWN = "Unspecified quantum circuit"
_RESULT = "struct<algorithm:string,confidence:double,alternatives:array<string>,source:string,evidence:array<string>>"


def _candidates(names: Column, confidence: float, source: str) -> Column:
    return F.transform(names, lambda n: F.struct((-F.lit(confidence)).alias("c"), (-F.length(n)).alias("l"), n.alias("name"), F.lit(source).alias("source")))


def infer_topic(text: Column) -> Column:
    """Labels of which a keyword occurs in the lower-cased text, in order."""
    found = lambda low: F.filter(F.array(*(F.when(reduce(lambda a, b: a | b, (low.contains(t) for t in terms)), F.lit(n)) for n, terms in inferences().entries)), lambda x: x.isNotNull())
    return let(F.lower(F.coalesce(text, F.lit(""))), found)


def identify_topic(caption: Column, contexts: Column, vocabulary: Vocabulary, section: Column | None = None) -> Column:
    """(algorithm, confidence, alternatives, source, evidence).

    Candidates: section title 1.0, caption 0.9, a generic pattern of the caption 0.7, a context
    0.6. The most confident wins, then the longest name, then the first by alphabet; the next three,
    each once, are the alternatives; the first five places are the evidence, generic patterns not
    counted. Without candidates a keyword decides (0.7), else the topic is unknown (0.1).
    """
    caption = F.coalesce(caption, F.lit(""))
    contexts = F.coalesce(contexts, F.array().cast("array<string>"))
    said = lambda t, mark, most, end: F.concat(F.lit(mark), F.substring(t, 1, most), F.lit(end))
    named = [(section, 1.0, "section_title", "Section: ")] if section is not None else []
    named.append((caption, 0.9, "caption", "Caption: "))
    # terms are found once a text, for the candidates and for the places
    seen = F.struct(
        *(find_terms(t, vocabulary).alias(source) for t, _, source, _ in named),
        let(folded(caption), lambda low: matching(caption, "(?iuU)", dict(generic_patterns()), low)).alias("caption_generic"),
        F.transform(contexts, lambda c: F.struct(find_terms(c, vocabulary).alias("names"), said(c, "Context: ", 40, "...").alias("place"))).alias("context"),
        infer_topic(F.concat_ws(" ", caption, F.concat_ws(" ", contexts))).alias("inferred"),
    )

    def gathered(s: Column) -> Column:
        parts = [_candidates(s[source], confidence, source) for _, confidence, source, _ in named]
        parts += [_candidates(s["caption_generic"], 0.7, "caption_generic"), _candidates(F.flatten(F.transform(s["context"], lambda c: c["names"])), 0.6, "context")]
        places = [F.array_repeat(said(t, mark, 50, ""), F.size(s[source])) for t, _, source, mark in named]
        places.append(F.flatten(F.transform(s["context"], lambda c: F.array_repeat(c["place"], F.size(c["names"])))))
        return F.struct(F.array_sort(F.concat(*parts)).alias("found"), s["inferred"].alias("inferred"), F.concat(*places).alias("places"))

    def choose(s: Column) -> Column:
        found, guess = s["found"], s["inferred"]
        first = F.try_element_at(found, F.lit(1))
        best = F.struct(first["name"], -first["c"], F.array_distinct(F.transform(F.slice(found, 2, 3), lambda c: c["name"])), first["source"], F.slice(s["places"], 1, 5)).cast(_RESULT)
        guessed = F.struct(F.try_element_at(guess, F.lit(1)), F.lit(0.7), F.slice(guess, 2, 100), F.lit("inference"), F.array(F.concat(F.lit("Inferred from text patterns: "), F.array_join(guess, ", ")))).cast(_RESULT)
        unknown = F.struct(F.lit(UNKNOWN), F.lit(0.1), F.array().cast("array<string>"), F.lit("fallback"), F.array().cast("array<string>")).cast(_RESULT)
        return F.when(F.size(found) > 0, best).when(F.size(guess) > 0, guessed).otherwise(unknown)

    return let(let(seen, gathered), choose)
