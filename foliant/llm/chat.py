"""Chat formatting: a finite-state machine over roles and a declarative template.

The turns of a conversation stream, in order, through the machine. Each turn becomes three
segments (opening mark with role, text, closing mark) with a loss flag each. Control strings inside
roles and texts are escaped reversibly, so the formatted text parses back into exactly its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, column


@dataclass(frozen=True)
class Template:
    """Marks, loss roles, machine and control strings.

    `moves` maps (state, role) to the next state; what isn't listed is out of order. After such a
    turn the machine goes on from the state of that role, or from `start` if no move leads there.
    A conversation is complete if it ends in an accepting state.
    """

    opening: str = "<|turn|>"
    after_role: str = "\n"
    closing: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
        ("assistant", "tool", "tool"),
        ("tool", "assistant", "assistant"),
    )
    accepting: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    rules: dict = field(init=False, repr=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.rules.update({(a, r): b for a, r, b in self.moves})
        # a backslash or the first character of a control string
        self.rules["escape"] = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.control))
        self.rules["turn"] = re.compile(re.escape(self.opening) + "(.*?)" + re.escape(self.after_role) + "(.*?)" + re.escape(self.closing), re.DOTALL)

    def next_state(self, state: str, role: str) -> tuple[str, bool]:
        to = self.rules.get((state, role))
        if to is not None:
            return to, True
        return next((b for _, r, b in self.moves if r == role), self.start), False

    def escape(self, text: str) -> str:
        return self.rules["escape"].sub(lambda m: f"\\{ord(m[0]):x};", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace("\n", "\\a;")

    def unescape(self, text: str) -> str:
        return re.sub(r"\\([0-9a-f]+);", lambda m: chr(int(m[1], 16)), text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.opening + self.escape_role(role) + self.after_role, False), (self.escape(text), role in self.loss_roles), (self.closing, False)]

    def first_turns(self, formatted: str) -> tuple[list[tuple[str, str]], str]:
        """The (role, text) turns that a formatted text begins with, and what follows the last whole one."""
        out, at = [], 0
        while m := self.rules["turn"].match(formatted, at):
            out.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        return out, formatted[at:]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted text."""
        out, rest = self.first_turns(formatted)
        if rest:
            raise ValueError(f"no turn at {len(formatted) - len(rest)}")
        return out


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per segment, in order: conv_id, turn, n (turn's number from 0), segment, text, loss, in_order, complete.

    Rows are ordered by turn, then role, then text, so ties and repeated rows have a defined order;
    each row is a turn. A null text or role counts as empty; an unknown or empty role is out of
    order but formatted. Rows with a null conv_id form one conversation. `complete` is given on the
    closing segment of each turn: whether the conversation could end there. Other columns are
    ignored. Turns stream through sorted partitions, so a conversation may be of any length.
    """
    t = template or Template()
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, n long, segment int, text string, loss boolean, in_order boolean, complete boolean"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, began, n, state = None, False, 0, t.start
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                columns: list[list] = [[] for _ in out]
                for conv, turn, role, text in zip(*(column(part, c) for c in ("conv_id", "turn", "role", "text")), strict=True):
                    if not began or conv != current:
                        current, began, n, state = conv, True, 0, t.start
                    role, text = role or "", text or ""
                    state, good = t.next_state(state, role)
                    for k, (piece, loss) in enumerate(t.segments(role, text)):
                        for c, v in zip(columns, (conv, turn, n, k, piece, loss, good, state in t.accepting if k == 2 else None), strict=True):
                            c.append(v)
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(run, schema)


class _Digest:
    """Reads one conversation back from the stream of its segments' texts, and digests turns as they are whole.

    Where a turn begins and ends is read from the text alone.
    """

    def __init__(self, template: Template) -> None:
        self.t = template
        self.turns = self.loss_chars = self.chars = 0
        self.sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()
        self.ordered, self.complete = True, False
        self.open: list[str] = []
        self.tail = ""

    def add(self, text: str, loss: bool, good: bool, complete: bool | None) -> None:
        self.chars += len(text)
        self.ordered &= good
        self.open.append(text)
        if loss:
            plain = self.t.unescape(text)
            self.loss_chars += len(plain)
            self.loss_sha.update(plain.encode("utf-8", "surrogatepass"))
        seen = self.tail + text
        self.tail = seen[-len(self.t.closing) :]
        if self.t.closing in seen:
            turns, rest = self.t.first_turns("".join(self.open))
            self.open = [rest]
            for role, body in turns:
                self.turns += 1
                self.sha.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
        if complete is not None:
            self.complete = complete

    def row(self) -> tuple:
        if any(self.open):
            raise ValueError("the text ends inside a turn")
        return self.turns, self.sha.hexdigest(), self.loss_chars, self.loss_sha.hexdigest(), self.chars, self.ordered and self.complete


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, from format_turns' rows in their order: digests of turns and loss text.

    valid says whether all turns are in order and the conversation ends in an accepting state.
    """
    t = template or Template()
    schema = f"conv_id {segments.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            columns: list[list] = [[] for _ in out]

            def close() -> None:
                if digest is not None:
                    for c, v in zip(columns, (current, *digest.row()), strict=True):  # noqa: B023
                        c.append(v)

            for conv, n, segment, text, loss, good, complete in zip(*(column(batch, c) for c in ("conv_id", "n", "segment", "text", "loss", "in_order", "complete")), strict=True):
                if segment == 0 and n == 0:
                    close()
                    current, digest = conv, _Digest(t)
                digest.add(text, loss, good, complete)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((current, *digest.row()), out, strict=True)], schema=out)

    return segments.mapInArrow(run, schema)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one of id -1 whose texts are made of control strings; turns that have this id already are turns of the same conversation."""
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    own = conversations.select("conv_id", "turn", "role", "text")
    return own.unionByName(probe.select(*(F.col(c).cast(own.schema[c].dataType) for c in own.columns)))
