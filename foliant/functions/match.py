"""Vocabulary matching: find, locate, normalise and clean terms, and the confidence of what was found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import Vocabulary
from .arrays import let
from .lookup import candidates, keyed
from .text import spans, strip

#: Flags of every pattern: ignore case, and letters, digits and boundaries as Unicode has them.
FLAGS = "(?iuU)"

# The most common entities.
COMMON = ("H", "CNOT", "X", "Z", "RX", "RY", "RZ", "CZ", "MEASURE")


#: Letters whose upper case has several characters, of which patterns know only the letters themselves, and a caseless letter that stands for them.
_WIDE, _CASELESS = "".join(c for c in map(chr, range(0x80, 0x10000)) if len(c.upper()) > 1), "\u01bb"


def folded(text: Column) -> Column:
    """A text as patterns compare it that ignore case: each letter as the lower case of its upper case."""
    # the optimiser takes an upper() right inside of lower() away
    upper = F.translate(F.upper(F.translate(text, _WIDE, _CASELESS * len(_WIDE))), "\u0130", "I")
    plain = F.translate(F.lower(upper), "\u03c2", "\u03c3")
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(plain)


def _there(text: Column, vocabulary: Vocabulary) -> Column:
    """Numbers of the terms that occur in a text, ascending.

    A term's words are looked up first, then its characters, and its pattern is the last to be
    tried; one that is a single word needs no more than the first.
    """
    terms = vocabulary.terms()
    words = {i: vocabulary.words_of(t) for i, (_, t) in enumerate(terms)}
    keys = keyed({i: w for i, w in words.items() if w})
    rest = [F.when(text.rlike(FLAGS + vocabulary.pattern(terms[i][1])), F.lit(i)) for i, w in words.items() if not w]
    table = F.array(*(F.struct(F.lit("" if words[i] == (t.lower(),) else t.lower()).alias("low"), F.lit(FLAGS + vocabulary.pattern(t)).alias("pattern")) for i, (_, t) in enumerate(terms)))
    sure = lambda low: lambda i: let(F.element_at(table, i + 1), lambda e: (e["low"] == "") | (F.contains(low, e["low"]) & F.rlike(text, e["pattern"])))
    found = let(folded(text), lambda low: F.filter(candidates(low, keys), sure(low)))
    return F.array_sort(F.concat(found, F.filter(F.array(*rest), lambda i: i.isNotNull()))) if rest else found


def find_terms(text: Column, vocabulary: Vocabulary) -> Column:
    """Canonical names that occur in a text, sorted, each once. Null text: none. Terms aren't kept from overlapping."""
    names = F.array(*(F.lit(c) for c, _ in vocabulary.terms()))
    return let(F.coalesce(text, F.lit("")), lambda t: F.array_sort(F.array_distinct(F.transform(_there(t, vocabulary), lambda i: F.element_at(names, i + 1)))))


def locate_terms(text: Column, vocabulary: Vocabulary) -> Column:
    """Every match of every term as (start, end, text, canonical), by start, then vocabulary order.

    Which terms occur is found out as in find_terms; only these are located.
    """
    terms = vocabulary.terms()
    table = F.array(*(F.struct(F.lit(FLAGS + vocabulary.pattern(t)).alias("pattern"), F.lit(c).alias("canonical")) for c, t in terms))

    def places(t: Column) -> Column:
        def of(i: Column) -> Column:
            return let(F.element_at(table, i + 1), lambda e: F.transform(spans(t, e["pattern"]), lambda m: F.struct(m["start"], i.alias("ord"), m["end"], m["text"], e["canonical"])))

        return F.transform(F.array_sort(F.flatten(F.transform(_there(t, vocabulary), of))), lambda m: F.struct(m["start"], m["end"], m["text"], m["canonical"]))

    return let(F.coalesce(text, F.lit("")), places)


def raw_matches(caption: Column, contexts: Column, extra: Column, vocabulary: Vocabulary) -> Column:
    """The texts of all matches as they stand, of the caption, then the contexts, then further text; each text's by place."""
    sources = F.concat(F.array(caption), F.coalesce(contexts, F.array().cast("array<string>")), F.array(extra))
    return F.flatten(F.transform(sources, lambda t: F.transform(locate_terms(t, vocabulary), lambda m: m["text"])))


def _map(vocabulary: Vocabulary) -> Column:
    return F.create_map(*(F.lit(x) for pair in vocabulary.lookup().items() for x in pair))


def normalise_term(term: Column, vocabulary: Vocabulary) -> Column:
    """Canonical name of a term or alias, else null. A trailing "gate" goes; hyphens and underscores may stand for spaces."""
    cleaned = F.regexp_replace(F.regexp_replace(strip(F.lower(term)), r"(?U)\s+gate$", ""), r"(?U)\s+", " ")
    table = _map(vocabulary)
    return F.coalesce(F.try_element_at(table, cleaned), F.try_element_at(table, F.translate(cleaned, "-_", "  ")))


def clean_terms(terms: Column, vocabulary: Vocabulary) -> Column:
    """Normalised names, or the upper-cased term if that is a canonical name; sorted, each once."""
    names = F.array(*(F.lit(n) for n in vocabulary.names()))
    fixed = F.transform(terms, lambda t: F.coalesce(normalise_term(t, vocabulary), F.when(F.array_contains(names, F.upper(t)), F.upper(t))))
    return F.array_sort(F.array_distinct(F.filter(fixed, lambda t: t.isNotNull())))


def is_term(term: Column, vocabulary: Vocabulary) -> Column:
    return normalise_term(term, vocabulary).isNotNull()


def find_in_sources(caption: Column, contexts: Column, extra: Column, vocabulary: Vocabulary) -> Column:
    """Entities of a caption, contexts and further text: (names, counts, from_caption, from_context).

    counts has one for each source text that holds the name, not for each mention.
    """
    found = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) > 0, find_terms(c, vocabulary)).otherwise(F.array().cast("array<string>"))
    of_contexts = F.flatten(F.transform(F.coalesce(contexts, F.array().cast("array<string>")), found))
    # no plain struct, whose fields the optimiser would work out again wherever they are named
    return let(F.struct(found(caption).alias("from_caption"), of_contexts.alias("from_context"), found(extra).alias("from_extra")), lambda s: s)


def counted(sources: Column) -> Column:
    """name -> number of source texts, from find_in_sources."""
    every = F.concat(sources["from_caption"], sources["from_context"], sources["from_extra"])
    number = lambda e: let(F.array_sort(F.array_distinct(e)), lambda names: F.map_from_arrays(names, F.transform(names, lambda n: F.size(F.filter(e, lambda x: x == n)))))
    return let(every, number)


def confidence(sources: Column) -> Column:
    """Confidence of find_in_sources: 0 without names; else from their number, where they stand and how common they are."""
    every = F.array_distinct(F.concat(sources["from_caption"], sources["from_context"], sources["from_extra"]))

    def total(names: Column) -> Column:
        common = F.size(F.array_intersect(names, F.array(*(F.lit(c) for c in COMMON))))
        points = (
            F.least(F.lit(0.3), F.size(names) * F.lit(0.05))
            + F.when(F.size(sources["from_caption"]) > 0, 0.3).otherwise(0.0)
            + F.when(F.size(sources["from_context"]) > 0, 0.2).otherwise(0.0)
            + F.least(F.lit(0.2), common * F.lit(0.05))
        )
        return F.when(F.size(names) == 0, 0.0).otherwise(F.least(F.lit(1.0), points))

    return let(every, total)
