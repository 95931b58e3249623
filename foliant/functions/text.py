"""Text functions: cleaning, offsets, page markers, captions, references, paragraphs, sections."""

from __future__ import annotations

from array import array
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .arrays import first_of_equal, let, sums_before

#: White space at either end, Unicode-aware.
_ENDS = r"(?U)^\s+|\s+$"
PAGE_MARKER = r"\[PAGE (\d+)\]"

# Caption, reference and section patterns, and words of section titles.
CAPTIONS = (
    r"(?iuU)Figure\s+(\d+)[.:]\s*[^\n]+(?:\n(?![A-Z])[^\n]+)*",
    r"(?iuU)Fig\.?\s+(\d+)[.:]\s*[^\n]+(?:\n(?![A-Z])[^\n]+)*",
)
REFERENCES = (
    r"(?U)(?:[Ss]ee\s+)?[Ff]ig(?:ure)?\.?\s*(\d+)",
    r"(?U)[Ff]ig(?:ure)?\.?\s*(\d+)\s+shows",
    r"(?U)[Aa]s\s+shown\s+in\s+[Ff]ig(?:ure)?\.?\s*(\d+)",
    r"(?U)[Ii]n\s+[Ff]ig(?:ure)?\.?\s*(\d+)",
    r"(?U)\([Ff]ig(?:ure)?\.?\s*(\d+)\)",
)
SECTIONS = (
    r"(?mdU)^\d+\.?\s+[A-Z][^.\n]{5,50}$",
    r"(?mdU)^[IVXLC]+\.?\s+[A-Z][^.\n]{5,50}$",
    r"(?mdU)^[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}$",
)
TITLE_WORDS = ("introduction", "method", "result", "conclusion", "abstract", "reference", "background", "discussion", "related work")


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, _ENDS, "")


def collapse(c: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def strip_version(paper_id: Column) -> Column:
    return F.regexp_replace(paper_id, r"v\d+$", "")


def clean_description(c: Column) -> Column:
    """Page markers go first, then white space collapses."""
    return strip(collapse(F.regexp_replace(c, r"\[PAGE \d+\]", "")))


def clean_text(c: Column) -> Column:
    """White space collapses first, then page markers go: may leave two spaces. Null and empty give ''."""
    return F.coalesce(strip(F.regexp_replace(collapse(c), r"\[PAGE \d+\]", "")), F.lit(""))


def spans(text: Column, pattern: str | Column) -> Column:
    """All matches as (start, end, text), offsets in code points, ends exclusive.

    The offsets follow from the sizes of the matches and of the pieces between them, so no
    function with positions is needed. The pattern must not match the empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, 0).alias("hit"))
    sized = F.transform(pairs, lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.coalesce(F.length(p["hit"]), F.lit(0)).alias("size"), p["hit"].alias("text")))

    def placed(rows: Column) -> Column:
        before = sums_before(F.transform(rows, lambda r: r["gap"] + r["size"]))
        every = F.transform(F.arrays_zip(rows.alias("r"), before.alias("at")), lambda z: F.struct((z["at"] + z["r"]["gap"]).alias("start"), (z["at"] + z["r"]["gap"] + z["r"]["size"]).alias("end"), z["r"]["text"].alias("text")))
        return F.filter(every, lambda m: m["text"].isNotNull())

    kind = "array<struct<start:int,end:int,text:string>>"
    return F.coalesce(let(sized, placed), F.array().cast(kind))


def page_markers(text: Column) -> Column:
    """Page markers as (start, end, page)."""
    return F.transform(spans(text, r"\[PAGE \d+\]"), lambda m: F.struct(m["start"], m["end"], F.regexp_extract(m["text"], r"\d+", 0).cast("int").alias("page")))


def page_at(markers: Column, position: Column, slack: int = 50) -> Column:
    """Page of the last marker that ends by position + slack; 1 without one."""
    return F.coalesce(F.try_element_at(F.filter(markers, lambda m: m["end"] <= position + slack), F.lit(-1))["page"], F.lit(1))


def section_at(sections: Column, position: Column) -> Column:
    """Title of the last section (start, title) that starts at or before the position; else null."""
    return F.try_element_at(F.filter(sections, lambda s: s["start"] <= position), F.lit(-1))["title"]


def captions(text: Column) -> Column:
    """Captions as (figure_number, caption_text, start, end, page), each number and page once.

    Order is that of the patterns, then of the text.
    """
    number = lambda m: F.regexp_extract(m["text"], r"\d+", 0).cast("int")
    found = F.concat(*(spans(text, p) for p in CAPTIONS))
    row = lambda m, markers: F.struct(number(m).alias("figure_number"), strip(m["text"]).alias("caption_text"), m["start"].alias("start"), m["end"].alias("end"), page_at(markers, m["start"]).alias("page"))
    rows = let(page_markers(text), lambda markers: F.transform(found, lambda m: row(m, markers)))
    return first_of_equal(rows, lambda r: F.struct(r["figure_number"], r["page"]))


def references(text: Column, before: int = 100, after: int = 200) -> Column:
    """References to figures as (figure_number, context, start, end, page); patterns overlap, and each match counts."""
    found = F.concat(*(spans(text, p) for p in REFERENCES))

    def row(m: Column, markers: Column) -> Column:
        low = F.greatest(F.lit(0), m["start"] - before)
        high = F.least(F.length(text), m["end"] + after)
        context = collapse(strip(F.substring(text, low + 1, high - low)))
        number = F.regexp_extract(m["text"], r"\d+", 0).cast("int")
        return F.struct(number.alias("figure_number"), context.alias("context"), m["start"].alias("start"), m["end"].alias("end"), page_at(markers, m["start"]).alias("page"))

    # the markers are found once a text, not again for each match
    return let(page_markers(text), lambda markers: F.transform(found, lambda m: row(m, markers)))


def sections(text: Column) -> Column:
    """Section titles as (start, title) by position; a line may match more than one pattern. 3 < length < 100."""
    found = F.concat(*(spans(text, p) for p in SECTIONS))
    rows = F.transform(found, lambda m: F.struct(m["start"].alias("start"), strip(m["text"]).alias("title")))
    kept = F.filter(rows, lambda r: (F.length(r["title"]) > 3) & (F.length(r["title"]) < 100))
    return F.array_sort(kept, lambda a, b: (a["start"] - b["start"]).cast("int"))


def paragraph_type(text: Column) -> Column:
    """caption, section_title, abstract or paragraph, in this order of precedence."""
    low = strip(F.lower(text))
    title = reduce(lambda a, b: a | b, (low.contains(w) for w in TITLE_WORDS))
    return (
        F.when(low.rlike(r"^(figure|fig\.?)\s*\d+"), "caption")
        .when((F.length(text) < 100) & text.rlike(r"^(\d+\.?\s+)?[A-Z]") & title, "section_title")
        .when(F.substring(low, 1, 20).contains("abstract"), "abstract")
        .otherwise("paragraph")
    )


@F.arrow_udf(ArrayType(IntegerType()))
def _found_in_order(full: pa.Array, bodies: pa.Array) -> pa.Array:
    """Where each text stands, searched from the end of the one before; a running position isn't an expression of linear cost.

    A batch stays as Arrow has it; one row at a time becomes Python's, and places are plain integers.
    """
    starts, ends = array("i"), array("i", [0])
    for text, parts in zip(full, bodies, strict=True):
        text, at = text.as_py() or "", 0
        for body in parts.as_py() or ():
            found = text.find(body or "", at)
            starts.append(at if found < 0 else found)
            at = starts[-1] + len(body or "")
        ends.append(len(starts))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(starts, pa.int32()))


def track_offsets(full: str, blocks: str) -> Column:
    """Paragraphs of the text column `full` from the array column `blocks` of (page, text), as (text, page, start, end, type).

    Each block is searched from the end of the one before; one that isn't found keeps the running
    position. Blocks are stripped; blank ones are skipped. Cost is linear in the text.
    """

    def paragraphs(rows: Column) -> Column:
        starts = _found_in_order(F.col(full), F.transform(rows, lambda b: b["body"]))
        row = lambda z: F.struct(z["b"]["body"].alias("text"), z["b"]["page"].alias("page"), z["at"].alias("start"), (z["at"] + F.length(z["b"]["body"])).alias("end"), paragraph_type(z["b"]["body"]).alias("type"))
        return F.transform(F.arrays_zip(rows.alias("b"), starts.alias("at")), row)

    stripped = F.transform(blocks, lambda b: F.struct(strip(b["text"]).alias("body"), b["page"].alias("page")))
    return paragraphs(F.filter(stripped, lambda b: F.length(b["body"]) > 0))


def find(full: Column, part: Column) -> Column:
    """(start, end) of the first exact occurrence, else null."""
    at = F.instr(full, part)
    return F.when(at > 0, F.struct((at - 1).alias("start"), (at - 1 + F.length(part)).alias("end")))


def ocr_tokens(raw: Column) -> Column:
    """Tokens of recognised text without those that are only strokes and dots."""
    return F.filter(F.split(strip(raw), r"(?U)\s+"), lambda w: (F.length(w) > 0) & ~w.rlike(r"^[\s|\-_1lI.,:;]+$"))
