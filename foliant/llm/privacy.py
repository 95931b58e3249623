"""Personal data: detection and information-theoretic sanitisation.

Base entities (mail, IP, card, phone) and keys (long hexadecimal strings) are found by pattern. How
strongly a term reveals an entity kind e is estimated from the whole corpus: over word
positions, P(e) is the share that lies within REACH words of an entity of the kind, P(e|t)
the same share among the positions of term t. The term's disclosure is pointwise mutual information
over the entity's information content, log(P(e|t) / P(e)) / -log P(e), which is 1 if the
term occurs near such entities only. Terms are generalised to the class of what they reveal most, wherever
they stand, near an entity or not, where their disclosure reaches one threshold, and removed where
it reaches a higher one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Held, alnum_words, arrow_schema, column, discard, ends, extend, slices, written

#: Kinds of spans, in order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "key", "term")
BASE = 4
#: Words on either side of an entity that count as its neighbourhood.
REACH = 5
#: Places near entities of a kind, of one value or of several, that a term must have before it can count as revealing.
SUPPORT = 3
#: Disclosure from which a term is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Size of the bitmap of candidate terms.
BITS = 1 << 20
#: Terms whose counts a task holds before it passes them on.
TERMS_HELD = 500_000
#: Terms in a file of the table of revealing ones.
ROWS_A_FILE = 500_000
#: Revealing terms handled in one pass over the documents.
BLOCK_TERMS = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive, and only from the start of a run of digits: the same matches, in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_KEY = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{32,}+(?![0-9A-Za-z])")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_DIGIT = re.compile("[0-9]")
_UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from the @ outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def entities(text: str | None) -> list[Span]:
    """All base entities and keys of a text, by start, then kind."""
    out: list[Span] = []
    if not text:
        return out
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
        out += [(m.start(), 4, m.end()) for m in _KEY.finditer(text) if any("0" <= c <= "9" for c in m[0])]
    return sorted(out)


def _uncovered(text: str, spans: list[Span]) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text (start, end), their starts and ends as arrays, and which of them touch a span."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text.translate(_UPPER))]
    starts = np.array([a for a, _ in words], np.int64)
    covered = np.zeros(len(words), bool)
    ends = np.array([b for _, b in words], np.int64)
    for a, _, b in spans:
        covered[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = True
    return words, starts, ends, covered


Revealed = tuple[float, str]  # disclosure, kind


def occurrences(text: str, spans: list[Span], terms: dict[bytes, Revealed]) -> Iterator[tuple[int, int, Revealed]]:
    """All places of the given terms in a text: start, end, what they reveal most. Words that touch an entity are no terms."""
    if terms.keys().isdisjoint(alnum_words(text)):
        return
    words, _, _, covered = _uncovered(text, spans)
    for (a, b), hidden in zip(words, covered, strict=True):
        d = None if hidden else terms.get(text[a:b].translate(_UPPER).encode("utf-8", "replace"))
        if d is not None:
            yield a, b, d


def neighbours(text: str, spans: list[Span]) -> Iterator[tuple[str, int, int, Span]]:
    """Terms within REACH words of each span: term, start, end, span. Words that touch an entity or have a digit are no terms."""
    words, starts, ends, covered = _uncovered(text, spans)
    for span in spans:
        first, last = int(np.searchsorted(ends, span[0], "right")), int(np.searchsorted(starts, span[2], "left"))
        for i in [*range(max(0, first - REACH), first), *range(last, min(len(words), last + REACH))]:
            if not covered[i]:
                a, b = words[i]
                term = text[a:b].translate(_UPPER)
                if not _DIGIT.search(term):
                    yield term, a, b, span


def _near(docs: DataFrame, text: str) -> DataFrame:
    """term, kind, n: positions of a term near an entity of a kind."""
    out = arrow_schema("term string, kind int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found: Counter = Counter()
                for t in part.column(0).to_pylist():
                    spans = entities(t)
                    if spans:
                        once = {(a, span[1]): term for term, a, _, span in neighbours(t, spans)}
                        for (_, kind), term in once.items():
                            found[term, kind] += 1
                rows = list(zip(*((*k, n) for k, n in found.items()), strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, out, strict=True)], schema=out)

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "term string, kind int, n long")
    return found.groupBy("term", "kind").agg(F.sum("n").alias("n"))


def _occurrences(docs: DataFrame, bitmap: np.ndarray, text: str) -> DataFrame:
    """term, n over the whole corpus for terms in the bitmap, and the number of all words as term ''."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        total, kept = 0, Counter()

        def rows() -> pa.RecordBatch:
            out = [(w.decode("utf-8", "replace"), n) for w, n in kept.items()]
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], ["term", "n"])

        for batch in batches:
            for part in slices(batch):
                words: Counter = Counter()
                for t in part.column(0).to_pylist():
                    words.update(alnum_words(t))
                total += sum(words.values())
                for w, n in words.items():
                    if bits[crc32(w) % BITS]:
                        kept[w] += n
                if len(kept) > TERMS_HELD:
                    yield rows()
        kept[b""] = total
        yield rows()

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n"))


@dataclass
class Disclosure:
    """Revealing terms: a table (term, kind, disclosure) and its number of rows."""

    terms: DataFrame
    rows: int

    def blocks(self) -> Iterator[dict[str, dict[int, float]]]:
        """term -> kind -> disclosure, in blocks of bounded size."""
        block: dict[str, dict[int, float]] = {}
        for r in self.terms.orderBy("term", "kind").toLocalIterator() if self.rows else ():
            if r["term"] not in block and len(block) >= BLOCK_TERMS:
                yield block
                block = {}
            block.setdefault(r["term"], {})[r["kind"]] = r["disclosure"]
        yield block


def fit(docs: DataFrame, text: str = "text", threshold: float = GENERALISE, support: int = SUPPORT) -> Disclosure:
    """Estimate disclosures from all documents; terms below `threshold` or `support` are left out."""
    held = Held()
    try:
        near = held(_near(docs, text))
        parts = near.count() // ROWS_A_FILE + 1
        kinds = {r["kind"]: r["n"] for r in near.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
        terms = near.withColumnRenamed("n", "near").where(F.col("near") >= support)
        marked = [r["b"] for r in terms.select((F.crc32(F.col("term").cast("binary")) % BITS).cast("int").alias("b")).distinct().collect()]  # BITS at most
        bitmap = np.zeros(BITS, bool)
        bitmap[marked] = True
        counts = held(_occurrences(docs, bitmap, text))
        total = counts.where("term = ''").agg(F.sum("n")).first()[0] or 0
        if not kinds or not total:
            return Disclosure(docs.sparkSession.createDataFrame([], "term string, kind int, disclosure double"), 0)
        prior = F.create_map(*(F.lit(x) for k, n in kinds.items() for x in (k, min(n / total, 0.5))))
        share = F.least(F.col("near") / F.col("n"), F.lit(1.0))
        scored = terms.hint("merge").join(counts, "term").select("term", "kind", (F.log(share / prior[F.col("kind")]) / -F.log(prior[F.col("kind")])).alias("disclosure"))
        # dealt anew: coalesced, a few tasks would do the whole join, with the sorts of all partitions one after the other
        kept = written(scored.where(F.col("disclosure") >= threshold).repartition(parts), "pii-disclosure")
        return Disclosure(kept, kept.count())
    finally:
        held.release()


def detect(docs: DataFrame, disclosure: Disclosure, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with `pii` added: an array of (kind, start, end, disclosure, reveals) by start, then kind.

    Offsets are code points, ends exclusive. disclosure is 1 for entities, and a term's highest
    over the kinds; reveals is an entity's kind, and the one that a term reveals most. Every occurrence of a revealing term is marked, in every document. A null or empty text
    has no spans. Repeated documents are treated one by one. Input columns are kept, except that a
    column named pii is replaced and the texts go if they aren't wanted any more.
    """
    fields = "pii array<struct<kind:string,start:long,end:long,disclosure:double,reveals:string>>"

    def add(df: DataFrame, shared, first: bool, last: bool) -> DataFrame:
        def run(batch) -> dict:
            out, terms = [], shared.value
            before = [()] * batch.num_rows if first else column(batch, "pii")
            for t, old in zip(column(batch, text), before, strict=True):
                spans = entities(t)
                found = {(a, k, b): (1.0, KINDS[k]) for a, k, b in spans} | {(x["start"], KINDS.index(x["kind"]), x["end"]): (x["disclosure"], x["reveals"]) for x in old}
                for a, b, d in occurrences(t, spans, terms) if t and terms else ():
                    found[a, 5, b] = d
                out.append([{"kind": KINDS[k], "start": a, "end": b, "disclosure": d, "reveals": r} for (a, k, b), (d, r) in sorted(found.items())])
            return {"pii": out}

        return extend(df, fields, run, text, drop=() if keep_text or not last else (text,))

    out = None
    for block, last in ends(disclosure.blocks()):
        # the kind of highest disclosure; of equal ones the first
        terms = {t.encode("utf-8", "replace"): max((d, -k) for k, d in kinds.items()) for t, kinds in block.items()}
        shared = docs.sparkSession.sparkContext.broadcast({t: (d, KINDS[-k]) for t, (d, k) in terms.items()})
        before, out = out, add(docs if out is None else out, shared, out is None, last)
        if not last:  # one block at a time is broadcast, and the documents are a table between passes
            out = written(out, "pii-spans")
            shared.unpersist()
            if before is not None:
                discard(before)
    return out


def _marks(kinds):
    return F.array_join(F.transform(F.filter("pii", lambda s: s["kind"].isin(*kinds)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """n_email, n_ip, n_card, n_phone, base_sha256 and spans, from detect's rows."""
    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{k}": count(k) for k in KINDS[:BASE]}
    return found.withColumns(counts | {"base_sha256": F.sha2(_marks(KINDS[:BASE]).cast("binary"), 256), "spans": _marks(KINDS)})


def _replaced(text: str | None, spans: list[dict]) -> str | None:
    """Entities become [KIND], generalised terms the class of what they reveal, [KIND TERM]; terms of the highest disclosure go. Overlapping spans become one, named by the first."""
    if not spans:
        return text
    out, at = [], 0
    i = 0
    while i < len(spans):
        first, end = spans[i], spans[i]["end"]
        i += 1
        while i < len(spans) and spans[i]["start"] < end:
            end = max(end, spans[i]["end"])
            i += 1
        term = first["kind"] == "term"
        out += [text[at : first["start"]], "" if term and first["disclosure"] >= REMOVE else f"[{first['reveals'].upper()}{' TERM' * term}]"]
        at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their own columns, spans replaced in the text (and n_chars, if there, brought up to date).

    Null texts stay null. Disclosures are estimated from these documents.
    """
    found = detect(docs, fit(docs, text), text)

    def run(batch) -> dict:
        return {text: [_replaced(t, s) for t, s in zip(column(batch, text), column(batch, "pii"), strict=True)]}

    out = extend(found, f"{text} string", run, text)
    if "n_chars" in docs.columns:
        touched = F.size("pii") > 0
        out = out.withColumn("n_chars", F.when(touched, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
