"""Exact token ids and prefix token counts of a byte-level BPE vocabulary.

Ids are those of the `tokenizers` library for a vocabulary file. Prefix counts are made per
pre-token (the pieces the vocabulary's split pattern makes), remembering each distinct piece in a
bounded cache. They come from a dynamic programme: the encoding of bytes[:i] ends in the one token t
with bytes[:i] ending in t and (last token of bytes[:i-len(t)], t) an adjacent pair that BPE
leaves as it is; then count[i] = count[i - len(t)] + 1. Token counts of every prefix of the
text follow by running sums, which answer truncation and budget questions without encoding again.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, utf8

#: Distinct pre-tokens whose counts a worker remembers; beyond that the cache starts anew.
CACHE = 750_000
#: The vocabulary's split pattern, for texts of PLAIN characters, on which `re` and the library agree.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_RUN = re.compile(r"\s{10000}")
_NOT_PLAIN = re.compile("[^\t\n\r -~¡-±´-¸º»¿-ɏ–-…]")
#: Unicode white space, twice or more.
_RUNS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE file of the tokenizers library, as bytes, with merge ranks."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        byte = _byte_of_char()
        raw = lambda s: bytes(byte[c] for c in s)
        special = set(self.special)
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[raw(a), raw(b)] = rank
        self.bytes = {i: b for b, i in self.ids.items()}
        #: Finds all tokens that end at each byte, the longest first; bytes go in as Latin-1.
        self.endings = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.endings.add_word(b.decode("latin-1"), (len(b), i))
        self.endings.make_automaton()
        self.any_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.pairs: dict[int, bool] = {}
        self.deltas: dict[str, bytes] = {}
        # a merged token's id follows from its merge's rank, so ids can stand for ranks
        assert all(self.ids[a + b] == rank + 256 for (a, b), rank in self.ranks.items()), "ids don't follow the ranks"
        self.fast = tiktoken.Encoding("same", pat_str=_PATTERN, mergeable_ranks=self.ids, special_tokens={})

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings, in order; together they are the text."""
        if _NOT_PLAIN.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def segments(self, text: str) -> list[tuple[str, str]]:
        """Stretches without special strings, each with the special string that follows it ('' at the end)."""
        if self.any_special is None or not any(s in text for s in self.special):
            return [(text, "")]
        out, at = [], 0
        for m in self.any_special.finditer(text):
            out.append((text[at : m.start()], m[0]))
            at = m.end()
        return [*out, (text[at:], "")]

    # -- ids

    def encode(self, text: str) -> bytes:
        """The library's ids of a text as little-endian unsigned 32-bit integers.

        Plain texts go through `tiktoken`, built from this very vocabulary, which gives the same
        ids several times faster; all others through the library itself.
        """
        if _NOT_PLAIN.search(text) or _LONG_RUN.search(text):
            return _ids(self.library.encode(text, add_special_tokens=False).ids)
        segments = self.segments(text)
        if len(segments) == 1:
            return _ids(self.fast.encode_ordinary(text))
        return b"".join(_ids(self.fast.encode_ordinary(plain) + ([self.library.token_to_id(special)] if special else [])) for plain, special in segments)

    # -- prefix counts

    def _stays(self, a: int, b: int) -> bool:
        """Whether BPE encodes the bytes of token a and token b as these two."""
        if len(self.pairs) > CACHE:
            self.pairs = {}
        x, y = self.bytes[a], self.bytes[b]
        found = self.pairs[a << 32 | b] = self._merge(x + y) == [x, y]
        return found

    def _merge(self, data: bytes) -> list[bytes]:
        """Plain BPE: join the pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((x, y), 1 << 60), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))  # noqa: B905
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def prefix_programme(self, data: bytes) -> list[int]:
        """Token count of data[:i] for i = 0 .. len(data)."""
        count, last, pairs, done = [0] * (len(data) + 1), [0] * (len(data) + 1), self.pairs, 0
        for at, (length, token) in self.endings.iter(data.decode("latin-1")):
            end = at + 1
            if end == done:
                continue
            start = end - length
            if start:
                stays = pairs.get(last[start] << 32 | token)
                if stays is None:
                    stays = self._stays(last[start], token)
                    pairs = self.pairs
                if not stays:
                    continue
            count[end], last[end], done = count[start] + 1, token, end
        return count

    def _delta(self, piece: str) -> bytes:
        """Changes of the count from code point to code point of a pre-token, one signed byte each."""
        data = piece.encode("utf-8", "replace")
        at = self.prefix_programme(data)
        if piece in ("'re", "'ve", "'ll"):  # a shorter prefix of these is two pre-tokens
            at[1:3] = 1, 2
        if len(data) != len(piece):
            at = [c for c, b in zip(at, data, strict=False) if b & 0xC0 != 0x80] + at[-1:]
        steps = [b - a for a, b in zip(at, at[1:])]  # noqa: B905
        if steps and not -100 < min(steps) <= max(steps) < 100:
            raise OverflowError("a code point changes the token count by more than a signed byte holds")
        return bytes([d & 0xFF for d in steps])

    def _deltas_of(self, pieces: list[str]) -> bytes:
        try:
            return b"".join(map(self.deltas.__getitem__, pieces))
        except KeyError:
            missing = [p for p in set(pieces) if p not in self.deltas]
            if len(self.deltas) + len(missing) > CACHE:
                self.deltas = {}
                missing = set(pieces)
            for p in missing:
                self.deltas[p] = self._delta(p)
            return b"".join(map(self.deltas.__getitem__, pieces))

    def _plain_deltas(self, text: str) -> np.ndarray:
        out = np.frombuffer(self._deltas_of(self.split(text)), np.int8)
        fixed = None
        for m in _RUNS.finditer(text):
            if m.end() == len(text):
                break
            # while a prefix ends inside a run of white space, the run is one pre-token up to there;
            # only with the next character does its last space go to what follows
            fixed = out.copy() if fixed is None else fixed
            run, p = m[0], m.end() - 1
            inside = np.frombuffer(self._deltas_of([run]), np.int8)[-1]
            fixed[p + 1] += fixed[p] - inside
            fixed[p] = inside
        return out if fixed is None else fixed

    def prefix_deltas(self, text: str) -> np.ndarray:
        """int8 d with d[:i].sum() the token count of text[:i], for every i."""
        segments = self.segments(text)
        if len(segments) == 1:
            return self._plain_deltas(text)
        out = []
        for plain, special in segments:
            alone = self._plain_deltas(plain)
            if special:
                began = self._plain_deltas(plain + special[:-1])
                closing = int(alone.sum(dtype=np.int64)) + 1 - int(began.sum(dtype=np.int64))
                out += [began, np.array([closing], np.int8)]
            else:
                out.append(alone)
        return np.concatenate(out)


def _ids(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def prefix_counts(docs: DataFrame, vocabulary_file: str, limit: int = 1024, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: n_bytes, n_tokens, chars_in_limit, prefix_deltas.

    prefix_deltas holds one signed byte a code point; the sum of its first i bytes is the exact
    token count of the first i code points (see `count_at` and `longest_prefix`).
    chars_in_limit is the length of the longest prefix of at most `limit` tokens. A null text
    counts as empty: 0 bytes, 0 tokens. Special strings in texts count as the library counts
    them by default. Repeated rows and ids are counted one by one; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch) -> dict:
        v = vocabulary(vocabulary_file)
        out: dict = {"n_bytes": [], "n_tokens": [], "chars_in_limit": [], "prefix_deltas": []}
        for t in batch.column(1).to_pylist():
            t = t or ""
            d = v.prefix_deltas(t)
            total = int(d.sum(dtype=np.int64))
            out["n_bytes"].append(len(t) if t.isascii() else len(utf8(t)))
            out["n_tokens"].append(total)
            out["chars_in_limit"].append(len(t) if total <= limit and len(t) <= limit else longest_prefix(d, limit))
            out["prefix_deltas"].append(d.tobytes())
        return out | {id_col: batch.column(0)}

    return map_rows(docs.select(F.col(id_col), F.col(text).alias("text")), f"{id_col} {kind}, n_bytes long, n_tokens long, chars_in_limit long, prefix_deltas binary", run)


def count_at(deltas: bytes | np.ndarray, chars: int) -> int:
    """Token count of the first `chars` code points."""
    d = np.frombuffer(deltas, np.int8) if isinstance(deltas, bytes) else deltas
    return int(d[:chars].sum(dtype=np.int64))


def longest_prefix(deltas: bytes | np.ndarray, limit: int) -> int:
    """Code points of the longest prefix that has at most `limit` tokens."""
    d = np.frombuffer(deltas, np.int8) if isinstance(deltas, bytes) else deltas
    fits = np.flatnonzero(np.cumsum(d, dtype=np.int64) <= limit)
    return int(fits[-1]) + 1 if len(fits) else 0
