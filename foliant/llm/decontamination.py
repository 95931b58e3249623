"""Benchmark decontamination with suffix arrays over the training documents.

Every shard (a bounded slice of documents) gets a suffix array of its words; every suffix of
every benchmark item is looked up in it by binary search, all suffixes at a time. A range of the
array whose suffixes begin with the item's window gives all locations of that window in the
shard; from there a match is extended to its full length.

Words that no benchmark item contains can't be part of a match; they only separate the stretches
that the suffix array holds. Items come in blocks of bounded size, one pass over the documents for
each, so the benchmark may be larger than a worker's memory; between passes the documents are a
written table, so that one block at a time is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, column, discard, ends, extend, fresh, written

#: Characters of benchmark text handled in one pass.
BLOCK_CHARS = 4_000_000
#: Documents in a shard, at most; each shard looks up all windows of a block.
SHARD_ROWS = 10_000
#: Words a window has.
WINDOW = 10


@dataclass
class Block:
    """Benchmark items as word ids: one array, items separated by 0."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of each distinct window
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    items: list[tuple[str, ...]] = field(default_factory=list)  # that have the window


def make_block(items: list[tuple[object, str | None]], window: int = WINDOW) -> Block:
    block = Block(window)
    flat: list[int] = [0]
    found: dict[tuple[int, ...], tuple[int, set[str]]] = {}
    for item, text in items:
        ids = [block.vocabulary.setdefault(w, len(block.vocabulary) + 1) for w in alnum_words(text)]
        n = min(window, len(ids))
        for i in range(len(ids) - n + 1 if n else 0):
            found.setdefault(tuple(ids[i : i + n]), (len(flat) + i, set()))[1].add("null" if item is None else str(item))
        flat += [*ids, 0]
    block.words = np.array(flat + [0] * window, np.int32)
    block.starts = np.array([at for at, _ in found.values()], np.int64)
    block.lengths = np.array([len(k) for k in found], np.int64)
    block.items = [tuple(sorted(s)) for _, s in found.values()]
    return block


def blocks(benchmark: DataFrame, id_col: str, text: str, window: int) -> Iterator[Block]:
    part: list[tuple[object, str | None]] = []
    size = 0
    for row in benchmark.select(F.col(id_col).alias("i"), F.col(text).alias("t")).toLocalIterator():
        if part and size + len(row["t"] or "") > BLOCK_CHARS:
            yield make_block(part, window)
            part, size = [], 0
        part.append((row["i"], row["t"]))
        size += len(row["t"] or "")
    if part:
        yield make_block(part, window)


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; by prefix doubling."""
    n = len(words)
    rank = words.astype(np.int64)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (max(int(rank.max()), int(ahead.max())) + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = new, 2 * step
        if step >= n or rank.max() == n - 1:
            return order


def _below(shard: np.ndarray, at: np.ndarray, block: Block, which: np.ndarray, equal: bool) -> np.ndarray:
    """Whether each shard suffix sorts before its window (equal: before or beginning with it)."""
    out = np.zeros(len(at), bool)
    open_ = np.arange(len(at))
    for k in range(block.window):
        ended = block.lengths[which[open_]] == k
        out[open_[ended]] = equal
        open_ = open_[~ended]
        if not len(open_):
            return out
        a, b = shard[at[open_] + k], block.words[block.starts[which[open_]] + k]
        out[open_[a < b]] = True
        open_ = open_[a == b]
    out[open_] = equal
    return out


def _bound(shard: np.ndarray, order: np.ndarray, block: Block, which: np.ndarray, equal: bool) -> np.ndarray:
    low, high = np.zeros(len(which), np.int64), np.full(len(which), len(order), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        below = _below(shard, order[mid], block, which[open_], equal)
        low[open_] = np.where(below, mid + 1, low[open_])
        high[open_] = np.where(below, high[open_], mid)


def search(docs: list[list[bytes]], block: Block) -> tuple[list[list[tuple[int, int]]], list[set[str]], list[int]]:
    """For each document: merged ranges of hit words, ids of items found, words of the longest match."""
    ranges: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[set[str]] = [set() for _ in docs]
    longest = [0] * len(docs)
    if not len(block.starts):
        return ranges, items, longest
    get = block.vocabulary.get
    first = np.zeros(len(docs) + 1, np.int64)  # of each document in the shard; a 0 follows each
    parts = []
    for i, words in enumerate(docs):
        ids = np.array([get(w, 0) for w in words], np.int32)
        parts += [ids, np.zeros(1, np.int32)]
        first[i + 1] = first[i] + len(ids) + 1
    whole = np.concatenate([*parts, np.zeros(block.window + 1, np.int32)])
    # stretches of known words that are long enough for the shortest window
    edge = np.diff(np.concatenate([[0], (whole > 0).astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - begins >= block.lengths.min()
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return ranges, items, longest
    spans = ends - begins + 1  # with a 0 after each
    offset = np.concatenate([[0], np.cumsum(spans)])
    place = np.arange(offset[-1]) - np.repeat(offset[:-1], spans) + np.repeat(begins, spans)
    shard = np.concatenate([whole[place], np.zeros(block.window + 1, np.int32)])
    order = suffix_array(shard[: len(place)])
    which = np.arange(len(block.starts))
    low, high = _bound(shard, order, block, which, False), _bound(shard, order, block, which, True)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return ranges, items, longest
    counts = (high - low)[hit]
    source = np.repeat(hit, counts)
    at = order[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[hit], counts)]
    start = place[at]
    cover = np.zeros(len(whole) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + block.lengths[source], -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]]))
    owner = np.searchsorted(first, start, "right") - 1
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        i = int(np.searchsorted(first, a, "right")) - 1
        ranges[i].append((a - int(first[i]), b - int(first[i])))
    for code in np.unique(source * len(docs) + owner).tolist():
        items[code % len(docs)].update(block.items[code // len(docs)])
    # extend the matches that begin here, not one word earlier
    test = block.starts[source]
    fresh = (at == 0) | (shard[at - 1] != block.words[test - 1]) | (shard[at - 1] == 0)
    at, test, owner = at[fresh], test[fresh], owner[fresh]
    size, open_ = block.lengths[source][fresh].copy(), np.arange(len(at))
    while len(open_):
        i, j = at[open_] + size[open_], test[open_] + size[open_]
        same = (i < len(place)) & (shard[np.minimum(i, len(shard) - 1)] == block.words[j]) & (block.words[j] != 0)
        open_ = open_[same]
        size[open_] += 1
    for i, n in zip(owner.tolist(), size.tolist(), strict=True):
        longest[i] = max(longest[i], n)
    return ranges, items, longest


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted([*a, *b]):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with n_words, match_ranges, match_items and longest_match added.

    match_ranges are word ranges (end exclusive) covered by occurrences of windows of `window`
    consecutive words of an item; an item of fewer words, but not none, is one window.
    match_items are the ids of the items found, as strings, each once, in order. longest_match is
    the number of words of the longest verbatim match with an item that holds the window.
    Null and empty texts have no words and no match; so do null items. Repeated documents are
    searched one by one; repeated items count once. An empty benchmark matches nothing.
    Input columns are kept, except that new columns take the place of old ones of their name, and
    the texts if they aren't wanted any more.
    """
    fields = "n_words long, match_ranges array<struct<start:int,end:int>>, match_items array<string>, longest_match int"

    def add(df: DataFrame, shared, first: bool, last: bool) -> DataFrame:

        def run(batch) -> dict:
            words = [alnum_words(t) for t in column(batch, text)]
            ranges, items, longest = search(words, shared.value)
            if not first:
                ranges = [_merged(r, [(x["start"], x["end"]) for x in old]) for r, old in zip(ranges, column(batch, "match_ranges"), strict=True)]
                items = [s | set(old) for s, old in zip(items, column(batch, "match_items"), strict=True)]
                longest = [max(pair) for pair in zip(longest, column(batch, "longest_match"), strict=True)]
            return {
                "n_words": [len(w) for w in words],
                "match_ranges": [[{"start": a, "end": b} for a, b in r] for r in ranges],
                "match_items": [sorted(s) for s in items],
                "longest_match": longest,
            }

        return extend(df, fields, run, text, drop=() if keep_text or not last else (text,), rows=SHARD_ROWS)

    context, before = docs.sparkSession.sparkContext, None
    for block, last in ends(blocks(benchmark, item_col, text, window)):
        shared = context.broadcast(block)
        out = add(docs if before is None else before, shared, before is None, last)
        if last:
            return out
        before = _passed(out, before, shared)
    return add(docs, context.broadcast(Block(window)), True, True)


def _passed(out: DataFrame, before: DataFrame | None, shared) -> DataFrame:
    """A pass that isn't the last, as a table; what it needed goes."""
    done = written(out, "matches")
    shared.unpersist()
    if before is not None:
        discard(before)
    return done


def sha256_of_items(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """find_matches without the texts, with its digest: n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("match_ranges", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["start"]).cast("long"))
    out = find_matches(docs, benchmark, window, keep_text=False).withColumns({"n_hit": n_hit, "n_items": F.size("match_items").cast("long"), "items_sha256": F.sha2(F.array_join("match_items", ",").cast("binary"), 256)})
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text: str = "text") -> DataFrame:
    """The documents that hold no window of any item, with their own columns; null and empty texts stay."""
    context, before = docs.sparkSession.sparkContext, None
    (clean,) = fresh(docs, "clean")
    for block, last in ends(blocks(benchmark, item_col, text, window)):
        shared = context.broadcast(block)

        def run(batch, shared=shared) -> dict:
            return {clean: [not r for r in search([alnum_words(t) for t in column(batch, text)], shared.value)[0]]}

        out = extend(docs if before is None else before, f"{clean} boolean", run, text, rows=SHARD_ROWS).where(F.col(clean)).drop(clean)
        if last:
            return out
        before = _passed(out, before, shared)
    return docs
