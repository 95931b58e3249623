"""Document scoring with a gated recurrent language model.

Tokens are lower-cased words and one end a document. The most frequent tokens are symbols of
their own; every other word is the symbol of its ending (a hash of its last letters). A
document's probability is a product over its tokens of P(symbol | state), from the network, and,
for words without a symbol of their own, of the word's add-one share among the words of its ending.
The network is a gated recurrent unit whose output is a softmax over classes and one within the
class. It is trained with truncated back-propagation, and its state runs on from window to
window, so that scores are of whole documents.

1. Texts are split into words once. Chunks (bounded slices of documents) are written as numbers
   into the chunk's own vocabulary, together with that vocabulary as sorted hashes.
2. The vocabularies are cut by hash into groups of bounded size, which sum each word's training
   occurrences over the corpus and send them back to the chunks. What is shuffled follows distinct
   words a chunk, in arrays, not words.
3. Each chunk becomes a table of symbols and of base scores.
4. The network is trained on every training document, in rounds: all tasks side by side, each on
   its own documents; the networks are averaged by tokens after each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, column, discard, written

#: Characters in a chunk, one longer document excepted.
CHUNK_CHARS = 6_000_000
#: Distinct words of one chunk in a row of its vocabulary; and of all chunks in a group that sums counts.
VOCABULARY_ROW, GROUP = 65_536, 1_000_000
#: Endings; every ending and every frequent token is a symbol.
ENDINGS = 256
#: Tokens with symbols of their own, at most.
FREQUENT = 1792
CLASSES = 48
HIDDEN = 24
#: Tokens that a window of training has.
WINDOW = 32
#: Rounds of training: sixteenths of the training documents, streams side by side, rate.
ROUNDS = ((1, 64, 0.2), (1, 64, 0.2), (2, 128, 0.2), (4, 256, 0.2), (8, 256, 0.15))
#: Tokens that a task trains on at a time, and that it scores side by side; states kept before the outputs are evaluated.
TRAIN_TOKENS, SCORE_TOKENS, BUFFER = 1_000_000, 4_000_000, 16_384
#: Documents scored side by side; their states stay in the processor's cache.
SIDE = 1024
#: Stands for the hash of the end token; words' hashes are positive.
END = 0


def _hash(word: bytes) -> int:
    return (xxhash.xxh3_64_intdigest(word) >> 1) or 1


def _ending(word: bytes) -> int:
    return crc32(word.rstrip(b".,;:!?")[-3:]) % ENDINGS


# -- counts


def _chunked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A task's documents, cut into pieces of `size` bytes and the document that exceeds them."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // size, prepend=0)).tolist()
        for a, b in zip([0, *cut], [*cut, len(sizes)], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _endings(words: pa.Array) -> np.ndarray:
    """_ending of each word; worked out once for all words with the same last letters."""
    bare = pa.compute.ascii_rtrim(words, ".,;:!?")
    _, offsets, data = bare.buffers()
    edges = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(bare.type) else np.int32, len(bare) + 1, bare.offset * (8 if pa.types.is_large_string(bare.type) else 4))
    letters = np.append(np.zeros(3, np.uint8), np.frombuffer(data or b"", np.uint8))  # so that no place is negative
    sizes = np.minimum(np.diff(edges), 3)
    code = sizes.astype(np.int64)
    for k in (3, 2, 1):
        code = code << 8 | np.where(sizes >= k, letters[edges[1:] + (3 - k)], 0)
    kinds, kind = np.unique(code, return_inverse=True)
    return np.array([crc32(int(x).to_bytes(4)[4 - (int(x) >> 24) :]) % ENDINGS for x in kinds], np.uint8)[kind]


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a chunk as numbers of its sorted vocabulary, tokens a document, and the vocabulary's hashes and endings; 0 is the end."""
    pieces = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.compute.fill_null(texts, "")))
    words = pieces.flatten()
    full = pa.compute.not_equal(pa.compute.binary_length(words), 0)  # white space at either end makes an empty piece
    before = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    offsets = pieces.offsets.to_numpy()
    sizes = np.diff(before[offsets - offsets[0]]) + 1
    encoded = words.filter(full).dictionary_encode()
    vocabulary = encoded.dictionary
    binary = vocabulary.cast(pa.large_binary() if pa.types.is_large_string(vocabulary.type) else pa.binary())
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, binary.to_pylist()), np.uint64, len(binary)) >> 1
    hashes = np.maximum(hashes, 1).astype(np.int64)
    endings = _endings(vocabulary)
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(1, len(order) + 1)
    tokens = np.zeros(sizes.sum(), np.int32)
    last = np.zeros(len(tokens), bool)
    last[np.cumsum(sizes) - 1] = True
    tokens[~last] = rank[encoded.indices.to_numpy()]
    return tokens, sizes, np.append(END, hashes[order]), np.append(np.uint8(0), endings[order])


def _tokens(marked: DataFrame, kind: str) -> DataFrame:
    """Rows of documents (chunk, id, learn, round, n_tokens, tokens) and of vocabularies (chunk, start, words, hashes, endings, n), written.

    n are a word's occurrences in training documents of the chunk.
    """
    schema = f"chunk long, id {kind}, learn boolean, round int, n_tokens int, tokens binary, start int, words int, hashes binary, endings binary, n binary"
    out = arrow_schema(schema)
    chars, row = CHUNK_CHARS, VOCABULARY_ROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(n: int, /, **found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([found[f.name].cast(f.type) if isinstance(found.get(f.name), pa.Array) else pa.array(found.get(f.name, [None] * n), f.type) for f in out], schema=out)

        number = TaskContext.get().partitionId() << 32
        for part in _chunked(batches, chars):
            learn = part.column(1)
            tokens, sizes, hashes, endings = _numbered(part.column(part.schema.get_field_index("text")))
            edges = np.append(0, np.cumsum(sizes))
            n = np.bincount(tokens[np.repeat(learn.to_numpy(zero_copy_only=False), sizes)], minlength=len(hashes)).astype(np.int32)
            whole = tokens.tobytes()
            cut = [whole[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield rows(len(cut), chunk=[number] * len(cut), id=part.column(0), learn=learn, round=part.column(2), n_tokens=sizes.tolist(), tokens=cut)
            at = list(range(0, len(hashes), row))
            pieces = lambda x: [x[a : a + row].tobytes() for a in at]  # noqa: E731, B023
            yield rows(len(at), chunk=[number] * len(at), start=at, words=[min(row, len(hashes) - a) for a in at], hashes=pieces(hashes), endings=pieces(endings), n=pieces(n))
            number += 1

    return written(marked.select("id", "learn", "round", "text").mapInArrow(run, schema), "lm-tokens")


def _by_hash(vocabularies: DataFrame, groups: int) -> DataFrame:
    """The vocabularies cut into `groups` ranges of the hash: (part, chunk, start, hashes, endings, n)."""
    schema = "part int, chunk long, start int, hashes binary, endings binary, n binary"
    out = arrow_schema(schema)
    bounds = np.linspace(0, 2.0**63, groups + 1)[1:-1].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, start, h, e, n in zip(*(column(batch, c) for c in ("chunk", "start", "hashes", "endings", "n")), strict=True):
                cut = [0, *np.searchsorted(np.frombuffer(h, np.int64), bounds).tolist(), len(e)]
                found = [(p, chunk, start + a, h[8 * a : 8 * b], e[a:b], n[4 * a : 4 * b]) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), out, strict=True)], schema=out)

    return vocabularies.select("chunk", "start", "hashes", "endings", "n").mapInArrow(run, schema)


def _counted(tokens: DataFrame) -> tuple[DataFrame, int]:
    """Corpus counts, written, and the number of training tokens.

    Rows of three sorts: (chunk, start, c, endings, fat, fat_hashes), the counts of a range of a chunk's vocabulary, with the
    places and hashes of those tokens that may have a symbol of their own; (ending, n, types), training tokens and their types;
    (hash, ending, n), a token that may have a symbol.
    """
    total, pairs = tokens.agg(F.coalesce(F.sum(F.when(F.col("learn"), F.col("n_tokens"))), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    schema = "chunk long, start int, c binary, endings binary, fat binary, fat_hashes binary, hash long, ending int, n long, types long"
    out = arrow_schema(schema)

    def rows(found: list[tuple], names: tuple) -> pa.Table:
        columns = dict(zip(names, zip(*found, strict=True), strict=True)) if found else {}
        return pa.Table.from_arrays([pa.array(columns.get(f.name, [None] * len(found)), f.type) for f in out], schema=out)

    def run(part: pa.Table) -> pa.Table:
        blobs = [column(part, c) for c in ("hashes", "endings", "n")]
        hashes, endings, n = (np.frombuffer(b"".join(x), t) for x, t in zip(blobs, (np.int64, np.uint8, np.int32), strict=True))
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(hashes[order]) != 0))
        sums = np.add.reduceat(n[order].astype(np.int64), first)
        c = np.empty(len(hashes), np.int64)
        c[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
        # a share of one in a million or more: a million tokens at most, however many there are
        fat = (c > 0) & (c * 1_000_000 >= total)
        edges = np.cumsum([0, *map(len, blobs[1])]).tolist()
        chunks = []
        for chunk, start, e, a, b in zip(column(part, "chunk"), column(part, "start"), blobs[1], edges[:-1], edges[1:], strict=True):
            at = np.flatnonzero(fat[a:b])
            chunks.append((chunk, start, c[a:b].tobytes(), e, at.astype(np.int32).tobytes(), hashes[a:b][at].tobytes()))
        word, ending = hashes[order][first], endings[order][first].astype(np.int64)
        ending[word == END] = -1
        known = np.flatnonzero(sums > 0)
        tokens, kinds = np.bincount(ending[known] + 1, sums[known], ENDINGS + 1), np.bincount(ending[known] + 1, minlength=ENDINGS + 1)
        by_ending = [(e - 1, int(tokens[e]), int(kinds[e])) for e in np.flatnonzero(kinds).tolist()]
        top = known[sums[known] * 1_000_000 >= total]
        top = top[np.lexsort((word[top], -sums[top]))][:FREQUENT]
        frequent = list(zip(word[top].tolist(), ending[top].tolist(), sums[top].tolist(), strict=True))
        return pa.concat_tables([
            rows(chunks, ("chunk", "start", "c", "endings", "fat", "fat_hashes")),
            rows(by_ending, ("ending", "n", "types")),
            rows(frequent, ("hash", "ending", "n")),
        ])

    by_hash = _by_hash(tokens.where("words is not null"), pairs // GROUP + 1)
    return written(by_hash.groupBy("part").applyInArrow(run, schema), "lm-counts"), total


# -- network


@dataclass
class Network:
    """Weights. Symbols are numbered so that a class is a range of numbers."""

    inputs: np.ndarray  # symbols x 3H: a symbol's share of the reset, update and candidate sums
    recurrent: np.ndarray  # H x 3H
    classes: np.ndarray  # (H + 1) x classes
    outputs: np.ndarray  # symbols x (H + 1)
    starts: np.ndarray  # first symbol of each class, and the number of symbols

    def learned(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.classes, self.outputs]

    def copy(self) -> Network:
        return Network(*(a.copy() for a in self.learned()), self.starts)

    def packed(self) -> bytes:
        return b"".join(a.astype("<f4").tobytes() for a in self.learned())

    def unpack(self, data: bytes) -> None:
        at = 0
        for a in self.learned():
            a[...] = np.frombuffer(data, "<f4", a.size, at).reshape(a.shape)
            at += 4 * a.size


def new_network(counts: np.ndarray, seed: int = 7) -> Network:
    """Random states, and outputs that start as the symbols' unigram shares."""
    rng = np.random.Generator(np.random.PCG64(seed))
    n = len(counts)
    classes = min(CLASSES, n)
    starts = np.linspace(0, n, classes + 1).astype(np.int64)
    share = (counts + 0.5) / (counts + 0.5).sum()
    of_class = np.add.reduceat(share, starts[:-1])
    small = lambda *s: rng.uniform(-0.15, 0.15, s).astype(np.float32)
    out = Network(small(n, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN), np.zeros((HIDDEN + 1, classes), np.float32), np.zeros((n, HIDDEN + 1), np.float32), starts)
    out.classes[HIDDEN] = np.log(of_class)
    out.outputs[:, HIDDEN] = np.log(share / np.repeat(of_class, np.diff(starts)))
    return out


class _Room(dict):
    """Arrays that are used again in every window: fresh ones of this size cost a page fault for every 4 KB."""

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        if name not in self or self[name].shape != shape:
            self[name] = np.empty(shape, np.float32)
        return self[name]


def _gates(weights: np.ndarray, room: _Room, name: str) -> np.ndarray:
    """n x 3H weights as 3 x n x H, those of reset and update halved: their logistic function is (1 + tanh(x / 2)) / 2."""
    out = room(name, 3, len(weights), HIDDEN)
    out[...] = weights.reshape(len(weights), 3, HIDDEN).swapaxes(0, 1)
    out[:2] *= np.float32(0.5)
    return out


def _step(recurrent: np.ndarray, h: np.ndarray, x: np.ndarray, sums: np.ndarray, new: np.ndarray) -> None:
    """Sets the next state. x, the inputs' shares, becomes reset, update and candidate; sums[2] is the candidate's recurrent sum."""
    np.matmul(h, recurrent, out=sums)
    gates, c, scratch = x[:2], x[2], sums[0]
    gates += sums[:2]
    np.tanh(gates, out=gates)
    gates *= np.float32(0.5)
    gates += np.float32(0.5)
    np.multiply(x[0], sums[2], out=scratch)
    c += scratch
    np.tanh(c, out=c)
    np.subtract(h, c, out=new)
    new *= x[1]
    new += c


def _by_class(net: Network, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[slice, int, int]]]:
    """The order that sorts the targets, the targets in that order, and for each class that occurs: its rows, first and end symbol."""
    order = np.argsort(targets.astype(np.uint16), kind="stable")
    y = targets[order]
    edges = np.searchsorted(y, net.starts).tolist()
    starts = net.starts.tolist()
    return order, y, [(slice(edges[c], edges[c + 1]), starts[c], starts[c + 1]) for c in range(len(starts) - 1) if edges[c + 1] > edges[c]]


def _small(states: np.ndarray, *weights: np.ndarray) -> bool:
    """Whether no logit of these states (rows) and weights (rows, too) can be too large for the exponential function."""
    most = max(np.abs(w).sum(1).max() for w in weights)
    return bool(max(states.max(initial=0), -states.min(initial=0)) * most < 60)


def _exponentials(logits: np.ndarray, small: bool) -> np.ndarray:
    """In place."""
    if not small:
        logits -= logits.max(1, keepdims=True)
    return np.exp(logits, out=logits)


def _soften(logits: np.ndarray, at: np.ndarray, small: bool) -> np.ndarray:
    """Log probabilities of the places `at`; the logits become what they are in proportion to."""
    if not small:
        logits -= logits.max(1, keepdims=True)
    width = logits.shape[1]
    picked = logits.reshape(-1).take(np.arange(0, logits.size, width) + at).astype(np.float64)
    return picked - np.log(np.exp(logits, out=logits) @ np.ones(width, np.float32))


def log_probs(net: Network, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target symbol given the state before it (with a last column of ones)."""
    order, y, groups = _by_class(net, targets)
    s = states.take(order, 0)
    small = _small(s, net.classes.T, net.outputs)
    cls = np.searchsorted(net.starts, y, "right") - 1
    found = _soften(s @ net.classes, cls, small)
    for i, a, b in groups:
        found[i] += _soften(s[i] @ net.outputs[a:b].T, y[i] - a, small)
    out = np.empty(len(targets))
    out[order] = found
    return out


def _output_gradients(net: Network, states: np.ndarray, targets: np.ndarray, grads: list[np.ndarray], room: _Room) -> np.ndarray:
    """Sets the gradients of the output weights; returns those of the states. Of the negated sum of log probabilities.

    The gradient of a logit is its probability, less 1 for the target. What the probabilities
    make is taken from exponentials, whose sum comes with the same product; what the targets make
    are sums over the rows of each symbol or class, which are neighbours.
    """
    order, y, groups = _by_class(net, targets)
    n, wide = len(y), HIDDEN + 1
    s = np.take(states, order, 0, room("sorted", n, wide), "clip")
    small = _small(s, net.classes.T, net.outputs)
    with_sum = np.ones((len(net.outputs), wide), np.float32)  # a row's share of the state's gradient, and 1
    with_sum[:, :HIDDEN] = net.outputs[:, :HIDDEN]
    of_classes = np.ones((net.classes.shape[1], wide), np.float32)
    of_classes[:, :HIDDEN] = net.classes[:HIDDEN].T
    inner = room("inner", n, wide)
    scaled = room("scaled", n, wide)
    grads[3][...] = 0
    for i, a, b in groups:
        e = _exponentials(s[i] @ net.outputs[a:b].T, small)
        np.matmul(e, with_sum[a:b], out=inner[i])
        np.divide(s[i], inner[i, HIDDEN:], out=scaled[i])
        np.matmul(e.T, scaled[i], out=grads[3][a:b])
    first = np.flatnonzero(np.diff(y, prepend=-1))
    grads[3][y[first]] -= np.add.reduceat(s, first, axis=0)
    e = _exponentials(np.matmul(s, net.classes, out=room("classes", n, net.classes.shape[1])), small)
    outer = np.matmul(e, of_classes, out=room("outer", n, wide))
    np.matmul(np.divide(s, outer[:, HIDDEN:], out=scaled).T, e, out=grads[2])
    at = np.searchsorted(net.starts, [a for _, a, _ in groups])
    grads[2][:, at] -= np.add.reduceat(s, [i.start for i, _, _ in groups], axis=0).T
    inner /= inner[:, HIDDEN:].copy()
    outer /= outer[:, HIDDEN:].copy()
    inner += outer
    inner -= with_sum.take(y, 0)
    inner -= of_classes.take(at.repeat([i.stop - i.start for i, _, _ in groups]), 0)
    out = room("back", n, wide)
    out[order] = inner
    return out[:, :HIDDEN]


def window_gradients(net: Network, h: np.ndarray, inputs: np.ndarray, live: np.ndarray, targets: np.ndarray, real: np.ndarray, room: _Room | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The state after a window, and the gradients of its negated log probability.

    All but h are steps x streams: the symbols before the targets, whether the state goes on from
    there (else it is reset), the targets, and whether they count. Given room, the gradients are
    kept there, until the next call with it.
    """
    room = _Room() if room is None else room
    steps, side = targets.shape
    shares, recurrent = _gates(net.inputs, room, "shares"), _gates(net.recurrent, room, "recurrent")
    h_before, to_r, to_z, to_c = (room(k, steps, side, HIDDEN) for k in ("h", "to_r", "to_z", "to_c"))
    x, sums, one = room("x", steps, 3, side, HIDDEN), room("sums", 3, side, HIDDEN), np.float32(1)
    states = room("states", steps, side, HIDDEN + 1)
    states[:, :, HIDDEN] = 1
    on, going = live.astype(np.float32)[:, :, None], live.all(1).tolist()
    h = np.array(h, np.float32)
    for k in range(steps):
        h_before[k] = h
        np.take(shares, inputs[k], 1, x[k], "clip")
        _step(recurrent, h_before[k], x[k], sums, h)
        r, z, c = x[k]
        # what a state's gradient becomes at each gate
        f = np.subtract(one, z, out=to_c[k])
        np.subtract(h_before[k], c, out=to_z[k])
        to_z[k] *= z
        to_z[k] *= f
        np.multiply(c, c, out=c)
        np.subtract(one, c, out=c)
        f *= c
        np.subtract(one, r, out=to_r[k])
        to_r[k] *= r
        to_r[k] *= sums[2]
        if not going[k]:
            h *= on[k]
        states[k, :, :HIDDEN] = h
    grads = [room(f"gradient {i}", *a.shape) for i, a in enumerate(net.learned())]
    flat = states.reshape(-1, HIDDEN + 1)
    if real.all():
        d_state = _output_gradients(net, flat, targets.reshape(-1), grads, room)
    else:
        d_state = np.zeros((len(flat), HIDDEN), np.float32)
        for g in grads:
            g[...] = 0
        if real.any():
            at = np.flatnonzero(real)
            d_state[at] = _output_gradients(net, flat[at], targets.reshape(-1)[at], grads, room)
    d_state = d_state.reshape(steps, side, HIDDEN)
    d_sums = room("d_sums", 3, steps, side, HIDDEN)
    back = np.ascontiguousarray(net.recurrent.reshape(HIDDEN, 3, HIDDEN).transpose(1, 2, 0))
    d_h, d, shares_back = np.zeros((side, HIDDEN), np.float32), np.empty((side, HIDDEN), np.float32), sums
    for k in reversed(range(steps)):
        np.add(d_state[k], d_h, out=d)
        if not going[k]:
            d *= on[k]
        dg, (r, z, dc) = d_sums[:, k], x[k]
        np.multiply(d, to_c[k], out=dc)  # of the candidate, which isn't needed any more
        np.multiply(dc, to_r[k], out=dg[0])
        np.multiply(d, to_z[k], out=dg[1])
        np.multiply(dc, r, out=dg[2])
        np.matmul(dg, back, out=shares_back)
        np.multiply(d, z, out=d_h)
        for part in shares_back:
            d_h += part
    d_sums = d_sums.reshape(3, -1, HIDDEN)
    grads[1].reshape(HIDDEN, 3, HIDDEN)[...] = np.matmul(h_before.reshape(-1, HIDDEN).T, d_sums).swapaxes(0, 1)
    d_sums[2].reshape(steps, side, HIDDEN)[...] = x[:, 2]
    order = np.argsort(inputs.reshape(-1).astype(np.uint16), kind="stable")
    symbols = inputs.reshape(-1)[order]
    first = np.flatnonzero(np.diff(symbols, prepend=-1))
    grads[0][...] = 0
    by_symbol = np.add.reduceat(np.take(d_sums, order, 1, x.reshape(3, -1, HIDDEN), "clip"), first, axis=1)
    grads[0].reshape(-1, 3, HIDDEN)[symbols[first]] = by_symbol.swapaxes(0, 1)
    return h, grads


class Trainer:
    """Truncated back-propagation with Adagrad steps over documents laid end to end in `side` streams.

    The state is carried from window to window and reset where a document begins; gradients stop
    at a window's start.
    """

    def __init__(self, net: Network, side: int, rate: float) -> None:
        self.net, self.side, self.rate = net, side, np.float32(rate)
        self.squares = [np.full(a.shape, 1e-3, np.float32) for a in net.learned()]
        self.room = _Room()

    def learn(self, flat: np.ndarray, sizes: np.ndarray) -> int:
        """Train on documents given as their symbols, end to end, and their sizes; returns the tokens learned from: all of them."""
        if not len(flat):
            return 0
        first = np.zeros(len(flat), bool)
        first[np.cumsum(sizes) - sizes] = True
        side = max(1, min(self.side, len(flat) // WINDOW))
        length = -(-len(flat) // side)
        pad = lambda x, value: np.concatenate([x, np.full(side * length - len(x), value, x.dtype)]).reshape(side, length).T
        targets, begins, real = pad(flat, 0), pad(first, True), pad(np.ones(len(flat), bool), False)
        begins[0] = True
        inputs = np.concatenate([np.zeros((1, side), targets.dtype), targets[:-1]])
        h, room = np.zeros((side, HIDDEN), np.float32), self.room
        for at in range(0, length, WINDOW):
            part = slice(at, at + WINDOW)
            h, grads = window_gradients(self.net, h, inputs[part], ~begins[part], targets[part], real[part], room)
            scale = np.float32(max(1, real[part].sum()) ** -0.5)
            for i, (a, g, q) in enumerate(zip(self.net.learned(), grads, self.squares, strict=True)):
                root = room(f"root {i}", *g.shape)
                g *= scale
                np.clip(g, -1, 1, out=g)
                q += np.multiply(g, g, out=root)
                g /= np.sqrt(q, out=root)
                g *= self.rate
                a -= g
        return len(flat)


def score_documents(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Sum of natural log probabilities of each document's symbols.

    Documents of like lengths run side by side, the longest first, so that those that go on are
    always the first rows; outputs are evaluated whenever enough states have come together.
    """
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    total, room = np.empty(len(docs)), _Room()
    shares, recurrent = _gates(net.inputs, room, "shares"), _gates(net.recurrent, room, "recurrent")
    for at in range(0, len(order), SIDE):
        part = order[at : at + SIDE]
        total[part] = _score_side(net, shares, recurrent, [docs[i] for i in part], room)
    return total


def _score_side(net: Network, shares: np.ndarray, recurrent: np.ndarray, docs: list[np.ndarray], room: _Room) -> np.ndarray:
    """score_documents of some documents, the longest first; shares and recurrent are the weights as `_gates` gives them."""
    sizes = np.array([len(d) for d in docs])
    flat = np.concatenate(docs).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    going = len(docs) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")  # documents longer than t
    totals = np.zeros(len(docs))
    h = np.zeros((len(docs), HIDDEN), np.float32)
    x, sums = (room(k, 3 * len(docs), HIDDEN) for k in ("x", "sums"))
    states = room("states", BUFFER + len(docs), HIDDEN + 1)
    states[:, HIDDEN] = 1
    symbol = flat[begin]
    targets: list[np.ndarray] = []
    held = 0
    for t, n in enumerate(going.tolist()):
        if t:
            h = h[:n]
            gates, scratch = x[: 3 * n].reshape(3, n, HIDDEN), sums[: 3 * n].reshape(3, n, HIDDEN)
            np.take(shares, symbol[:n], 1, gates, "clip")
            _step(recurrent, h, gates, scratch, h)
            symbol = flat[begin[:n] + t]
        states[held : held + n, :HIDDEN] = h
        targets.append(symbol)
        held += n
        if held >= BUFFER or t + 1 == len(going):
            found = log_probs(net, states[:held], np.concatenate(targets))
            at = 0
            for y in targets:
                totals[: len(y)] += found[at : at + len(y)]
                at += len(y)
            targets, held = [], 0
    return totals


# -- model


@dataclass
class Model:
    frequent: np.ndarray  # sorted hashes of the tokens with symbols of their own
    symbols: np.ndarray  # theirs
    ending_symbols: np.ndarray  # symbol of each ending
    ending_tokens: np.ndarray  # training occurrences of the words of each ending that have no symbol
    ending_types: np.ndarray  # and how many such words there are
    train_tokens: int  # N
    train_types: int  # V
    net: Network

    def symbol_of(self, endings: np.ndarray, fat: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a vocabulary, and whether they are the tokens' own; `fat` are places of tokens that may have one, with their hashes."""
        symbols, own = self.ending_symbols[endings], np.zeros(len(endings), bool)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            found = self.frequent[at] == hashes
            symbols[fat[found]], own[fat[found]] = self.symbols[at[found]], True
        return symbols, own


def _model(counts: DataFrame, total: int) -> Model:
    """Symbols, and a network that isn't trained yet."""
    top = counts.where("hash is not null").orderBy(F.desc("n"), "hash").select("hash", "ending", "n").limit(FREQUENT).collect()
    ending_tokens, ending_types = np.zeros(ENDINGS), np.zeros(ENDINGS)
    kinds = 0
    for r in counts.where("types is not null").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect():
        kinds += r["types"]
        if r["ending"] >= 0:
            ending_tokens[r["ending"]], ending_types[r["ending"]] = r["n"], r["types"]
    for r in top:
        if r["ending"] >= 0:
            ending_tokens[r["ending"]] -= r["n"]
            ending_types[r["ending"]] -= 1
    n = np.append(ending_tokens, [r["n"] for r in top])
    rank = np.argsort(-n, kind="stable")  # frequent symbols share classes with frequent ones
    number = np.empty(len(n), np.int64)
    number[rank] = np.arange(len(n))
    hashes = np.array([r["hash"] for r in top], np.int64)
    order = np.argsort(hashes)
    return Model(hashes[order], number[ENDINGS:][order], number[:ENDINGS], ending_tokens, ending_types, int(total), int(kinds), new_network(n[rank]))


def _encoded(tokens: DataFrame, counts: DataFrame, model: Model, kind: str) -> DataFrame:
    """One row per document, written: id, learn, round, n_tokens, n_known, base and extra (log10, of the words within their endings), symbols."""
    schema = f"id {kind}, learn boolean, round int, n_tokens long, n_known long, base double, extra double, symbols binary"
    out = arrow_schema(schema)
    shared = tokens.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.Table, words: pa.Table) -> pa.Table:
        m: Model = shared.value
        if not part.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in out], schema=out)
        if not words.num_rows:
            raise ValueError("a chunk's vocabulary isn't whole")
        words = words.sort_by("start")
        joined = lambda name, t: np.frombuffer(b"".join(column(words, name)), t)
        c, endings, hashes = joined("c", np.int64), joined("endings", np.uint8), joined("fat_hashes", np.int64)
        fat = np.concatenate([np.frombuffer(x, np.int32) + start for x, start in zip(column(words, "fat"), column(words, "start"), strict=True)])
        flat, sizes = np.frombuffer(b"".join(column(part, "tokens")), np.int32), np.array(column(part, "n_tokens"), np.int64)
        if len(endings) != len(c) or flat.max() >= len(c):
            raise ValueError("a chunk's vocabulary isn't whole")
        symbols, own = m.symbol_of(endings, fat, hashes)
        base = np.log10((c + 1) / (m.train_tokens + m.train_types + 1))
        extra = np.log10((c + 1) / (m.ending_tokens[endings] + m.ending_types[endings] + 1))
        extra[own] = 0.0
        extra[0] = 0.0
        first = np.cumsum(sizes) - sizes
        coded = symbols.astype("<u2")[flat].tobytes()
        cut = [coded[2 * a : 2 * (a + n)] for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]
        columns = {
            "id": part.column("id").combine_chunks(), "learn": part.column("learn").combine_chunks(), "round": part.column("round").combine_chunks(),
            "n_tokens": sizes, "n_known": np.add.reduceat((c > 0)[flat].astype(np.int64), first),
            "base": np.add.reduceat(base[flat], first), "extra": np.add.reduceat(extra[flat], first), "symbols": cut,
        }
        return pa.Table.from_arrays([columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in out], schema=out)

    docs = tokens.where("tokens is not null").select("chunk", "id", "learn", "round", "n_tokens", "tokens")
    of_chunks = counts.where("chunk is not null").select("chunk", "start", "c", "endings", "fat", "fat_hashes")
    return written(docs.groupBy("chunk").cogroup(of_chunks.groupBy("chunk")).applyInArrow(run, schema), "lm-encoded")


def _symbol_pieces(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in pieces of about so many tokens, with their symbols end to end and their sizes."""
    for batch in batches:
        at = batch.schema.get_field_index("symbols")
        sizes = pa.compute.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // tokens, prepend=0)).tolist()
        for a, b in zip([0, *cut], [*cut, len(sizes)], strict=True):
            if b > a:
                part = batch.slice(a, b - a)
                yield part, np.frombuffer(b"".join(part.column(at).to_pylist()), "<u2").astype(np.int64), sizes[a:b]


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = None, 0.0
    for batch in batches:
        for w, data in zip(column(batch, "weight"), column(batch, "net"), strict=True):
            x = np.frombuffer(data, "<f4") * np.float64(w)
            total, weight = (x if total is None else total + x), weight + w
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / weight).astype("<f4").tobytes()], pa.binary())], ["weight", "net"])


def _train(encoded: DataFrame, model: Model) -> None:
    """Train on all documents of `learn`, each in one round and whole."""
    schema = "weight double, net binary"
    for number, (_, side, rate) in enumerate(ROUNDS):
        shared = encoded.sparkSession.sparkContext.broadcast(model.net)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, side=side, rate=rate) -> Iterator[pa.RecordBatch]:
            net, weight = shared.value.copy(), 0
            trainer = Trainer(net, side, rate)
            for _, flat, sizes in _symbol_pieces(batches, TRAIN_TOKENS):
                weight += trainer.learn(flat, sizes)
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([float(weight)]), pa.array([net.packed()], pa.binary())], ["weight", "net"])

        nets = written(encoded.where((F.col("round") == number) & F.col("learn")).select("symbols").mapInArrow(run, schema), "lm-nets")
        n = nets.count()
        while n > 1:  # about sixteen networks at a time in each task
            n = -(-n // 16)
            before, nets = nets, written(nets.repartition(n).mapInArrow(_average, schema), "lm-nets")
            discard(before)
        for r in nets.collect():  # one, or none without a document
            model.net.unpack(r["net"])
        discard(nets)


def encode(docs: DataFrame, learn: Column, text: str = "text", id_col: str = "doc_id") -> tuple[Model, DataFrame]:
    """The model with a network that isn't trained yet, and all documents as symbols with their counts and base scores.

    Counts, N, V and the shares of endings come from all rows of `learn`, whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    share = F.pmod(F.xxhash64(id_col, text), F.lit(sum(n for n, _, _ in ROUNDS)))
    number = sum((share >= sum(n for n, _, _ in ROUNDS[:k])).cast("int") for k in range(1, len(ROUNDS)))
    marked = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), number.alias("round"), F.col(text).alias("text"))
    tokens = _tokens(marked, kind)
    counts, total = _counted(tokens)
    model = _model(counts, total)
    encoded = _encoded(tokens, counts, model, kind)
    discard(tokens, counts)
    return model, encoded


def fit(docs: DataFrame, learn: Column, text: str = "text", id_col: str = "doc_id") -> tuple[Model, DataFrame]:
    """The trained model, and all documents as `encode` gives them; the network, too, learns from all rows of `learn`, whole."""
    model, encoded = encode(docs, learn, text, id_col)
    _train(encoded, model)
    return model, encoded


def base(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of `score` that follow from counts, by the same steps, without the network: all but `score`."""
    model, encoded = encode(docs, learn, text, id_col)
    return encoded.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"))


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    A null or empty text is its end token alone. Without any training document every token is
    unknown. Repeated rows and ids are scored one by one; other columns are ignored.
    """
    model, encoded = fit(docs, learn, text, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model.net)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = arrow_schema(schema)
    train_tokens = model.train_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, sizes in _symbol_pieces(batches, SCORE_TOKENS):
            net = score_documents(shared.value, np.split(flat, np.cumsum(sizes)[:-1])) / np.log(10)
            scores = net + part.column("extra").to_numpy(zero_copy_only=False)
            columns = [part.column("id"), part.column("n_tokens"), part.column("n_known"), pa.array([train_tokens] * part.num_rows, pa.int64()), part.column("base"), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return encoded.select("id", "n_tokens", "n_known", "base", "extra", "symbols").mapInArrow(run, schema)
