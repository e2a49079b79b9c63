"""Chat formatting by a role machine and a declarative template.

A template lists, for each role, the strings that open and close a turn and whether the turn's text
counts for the loss; roles it does not list use a general form that carries the role's name. A
finite-state machine over roles checks the order of turns. Control strings inside texts and role
names are escaped reversibly: a backslash before a control string or a backslash stands for the
character behind it.

The output is one row per segment (control string or text) with a loss flag, so a conversation of
any length is never held as a whole; joining its segments gives the formatted text.

Cases: null texts and null roles count as empty; null turn numbers come first, turns with equal
numbers are ordered by role and text, and repeated rows are turns like any other; a null conv_id
is a conversation of its own; wrong orders are formatted too and reported; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import record, slices


@dataclass(frozen=True)
class Template:
    """Opening and closing strings by role, the roles that are learned, and the role order."""

    turns: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s>", "</s>")})
    other: tuple = ("[ROLE=", "]", "[/ROLE]")
    learned: tuple = ("assistant",)
    #: state -> role -> next state; a role without an arrow is out of order
    order: dict = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"},
        "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})
    final: tuple = ("answered",)

    def controls(self) -> list[str]:
        """All control strings without the blanks around them, longest first."""
        found = {s.strip() for pair in self.turns.values() for s in pair}
        return sorted(found | {s.strip() for s in self.other}, key=lambda s: (-len(s), s))


class Formatter:
    """A compiled template: turns to segments, and segments back to turns."""

    def __init__(self, template: Template):
        self.template = template
        controls = "|".join(map(re.escape, template.controls()))
        self._escape = re.compile(rf"\\|{controls}")
        self._unescape = re.compile(r"\\(.)", re.DOTALL)
        self._opening = {a: role for role, (a, _) in template.turns.items()}

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(r"\1", text)

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The machine's next state and whether the role was in order; it goes on after errors."""
        order = self.template.order
        if role in order.get(state, {}):
            return order[state][role], True
        return next((a[role] for a in order.values() if role in a), state), False

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(segment, loss) of one turn: opening, text, closing."""
        pair = self.template.turns.get(role)
        if pair:
            return [(pair[0], False), (self.escape(text), role in self.template.learned),
                    (pair[1], False)]
        opening, middle, closing = self.template.other
        return [(opening + self.escape(role) + middle, False), (self.escape(text), False),
                (closing, False)]

    def read_back(self, opening: str, text: str) -> tuple[str, str]:
        """(role, text) of a formatted turn from its opening and text segments."""
        role = self._opening.get(opening)
        if role is None:
            head, tail, _ = self.template.other
            role = self.unescape(opening[len(head):-len(tail)])
        return role, self.unescape(text)


SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()),
                      ("segment", pa.string()), ("loss", pa.bool_()), ("in_order", pa.bool_())])
SEGMENTS_DDL = ("conv_id long, turn long, part int, segment string, loss boolean, "
                "in_order boolean")


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turn (0, 1, ... in order), part, segment, loss, in_order: in order by partition.

    Rows of a conversation are sorted within one task and streamed, so memory does not grow with
    its length.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fmt = Formatter(template)
        now, turn, state = object(), 0, "start"
        for batch in slices(batches, 1024):
            rows = []
            for conv, role, text in zip(*(batch.column(c).to_pylist()
                                          for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, turn, state = conv, 0, "start"
                state, good = fmt.step(state, role)
                rows += [(conv, turn, part, segment, loss, good)
                         for part, (segment, loss) in enumerate(fmt.segments(role, text))]
                turn += 1
            yield record(SEGMENTS, [list(c) for c in zip(*rows)])

    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(work, SEGMENTS_DDL))


def read_formatted(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from its segments in order: counts, digests and order of what they say.

    Reads rows as ``format_conversations`` leaves them, without another shuffle. Digests are fed
    turn by turn, so memory does not grow with a conversation's length.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ("in_order", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fmt = Formatter(template)
        now, begun, done = None, False, []
        for batch in slices(batches, 4096):
            for conv, part, segment, loss, good in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "part", "segment", "loss", "in_order"))):
                if not begun or conv != now:
                    if begun:
                        done.append((now, n, turns.hexdigest(), loss_chars, learned.hexdigest(),
                                     chars, ordered and state in template.final))
                    now, begun, n, chars, loss_chars, ordered = conv, True, 0, 0, 0, True
                    turns, learned, state = hashlib.sha256(), hashlib.sha256(), "start"
                chars += len(segment)
                if loss:
                    text = fmt.unescape(segment)
                    loss_chars += len(text)
                    learned.update(text.encode())
                if part == 0:
                    opening = segment
                elif part == 1:
                    role, text = fmt.read_back(opening, segment)
                    turns.update(f"{role}\n{text}\n".encode())
                    state = fmt.step(state, role)[0]
                    n, ordered = n + 1, ordered and good
            if done:
                yield record(schema, [list(c) for c in zip(*done)])
                done = []
        if begun:
            yield record(schema, [[now], [n], [turns.hexdigest()], [loss_chars],
                                  [learned.hexdigest()], [chars],
                                  [ordered and state in template.final]])

    return formatted.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars "
                                      "long, loss_sha256 string, formatted_chars long, "
                                      "in_order boolean")


def parse_formatted(text: str, template: Template = Template()) -> list[tuple[str, str]]:
    """(role, text) of every turn of one formatted string, found by its control strings alone."""
    fmt = Formatter(template)
    openings = sorted([*fmt._opening, template.other[0]], key=len, reverse=True)
    out, at = [], 0

    def until(closing: str, begin: int) -> int:
        while not text.startswith(closing, begin):
            begin += 2 if text[begin] == "\\" else 1
        return begin

    while at < len(text):
        opening = next(o for o in openings if text.startswith(o, at))
        at += len(opening)
        if opening == template.other[0]:
            end = until(template.other[1], at)
            opening += text[at:end] + template.other[1]
            at, closing = end + len(template.other[1]), template.other[2]
        else:
            closing = template.turns[fmt._opening[opening]][1]
        end = until(closing, at)
        out.append(fmt.read_back(opening, text[at:end]))
        at = end + len(closing)
    return out
