r"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\ntext<|im_end|>\n``; a conversation is its turns, one after the other. Every
rendered turn is parsed again by the deterministic parser and compared with its source; where the two differ, the
conflicting content is escaped and the turn is rendered again, until both are identical. Escaping adds one backslash
behind the ``<`` of everything that looks like a control string (``<|im_end|>`` becomes ``<\|im_end|>``, that becomes
``<\\|im_end|>``), reading takes one away, so each level of escapes survives. A line feed in a role becomes
``<|nl|>``.

The loss mask covers the texts of assistant turns.

Defined cases: NULL role or text is empty; turns of a conversation follow (turn, role, text), NULL first; repeated rows
are turns of their own; rows with a NULL conversation id are one conversation; an empty table gives an empty result;
further columns do not matter. Rendering and the round trip run on each row where it is. Only the digest of a whole
conversation reads its turns in order: the rows are dealt by conversation, sorted by Spark (which spills) and streamed
through one parser, which holds one turn. A hash over a conversation is sequential by nature, so a conversation is one
task's stream, however long, but never in its memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, text_or_empty, written

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: A control string, or one behind some level of escapes.
CONTROL = r"<(\\*)\|(im_start|im_end|nl)\|>"
ASSISTANT = "assistant"

_control = re.compile(CONTROL)


class FormatError(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str) -> str:
    return _control.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _control.sub(lambda m: f"<{m[1][1:]}|{m[2]}|>", text)


def unescape_role(text: str) -> str:
    return _control.sub(lambda m: "\n" if m[0] == BREAK else f"<{m[1][1:]}|{m[2]}|>", text)


class TurnParser:
    """Reads formatted text in pieces cut anywhere; ``feed`` returns the turns (role, text) that a piece completes.
    Held in memory: the turn that is not complete yet."""

    def __init__(self) -> None:
        self.rest, self.seen = "", 0

    def feed(self, piece: str) -> list[tuple[str, str]]:
        text = self.rest + piece if self.rest else piece
        turns, at, look = [], 0, self.seen
        while (stop := text.find(END, max(at, look))) >= 0:
            after = stop + len(END)
            if after == len(text):
                break  # the line feed that closes the turn is still to come
            turns.append(self._turn(text[at:stop], text[after]))
            at = look = after + 1
        self.rest = text[at:]
        self.seen = max(0, len(self.rest) - len(END) - 1)
        return turns

    def close(self) -> None:
        if self.rest:
            raise FormatError("the text ends within a turn")

    @staticmethod
    def _turn(body: str, closing: str) -> tuple[str, str]:
        if closing != "\n" or not body.startswith(START) or body.find(START, 1) >= 0:
            raise FormatError("not a turn")
        role, line, text = body[len(START):].partition("\n")
        if not line:
            raise FormatError("a turn without a role line")
        return unescape_role(role), unescape(text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a whole formatted text."""
    p = TurnParser()
    turns = p.feed(formatted)
    p.close()
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the place of its text in it; escaped until the parser gives (role, text) back."""
    shown_role, shown_text = role, text
    for _ in range(3):
        head = f"{START}{shown_role}\n"
        formatted = f"{head}{shown_text}{END}\n"
        try:
            same = parse(formatted) == [(role, text)]
        except FormatError:
            same = False
        if same:
            return formatted, len(head), len(head) + len(shown_text)
        shown_role, shown_text = escape(role).replace("\n", BREAK), escape(text)
    raise FormatError("escaping did not restore the turn")


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, formatted, mask_start, mask_end: one row a turn. A conversation's formatted text is the
    concatenation of ``formatted`` by (turn, role, formatted); the mask is in code points of ``formatted``, end
    exclusive, NULL where the turn bears no loss."""
    ship_code(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        text_or_empty(role_col).alias("role"), text_or_empty(text_col).alias("text"))
    types = dict(rows.dtypes)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = b.column("role").to_pylist()
            out = [render_turn(r, t) for r, t in zip(roles, b.column("text").to_pylist())]
            on = [r == ASSISTANT for r in roles]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), b.column("role"), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] if y else None for o, y in zip(out, on)], pa.int64()),
                 pa.array([o[2] if y else None for o, y in zip(out, on)], pa.int64())],
                names=["conv_id", "turn", "role", "formatted", "mask_start", "mask_end"])

    return rows.mapInArrow(render, f"conv_id {types['conv_id']}, turn {types['turn']}, role string, formatted string, mask_start bigint, mask_end bigint")


class _Digest:
    """What one conversation's formatted text says, read piece by piece."""

    def __init__(self) -> None:
        self.parser, self.turns, self.loss = TurnParser(), hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        self.chars += len(formatted)
        if start is not None:
            text = unescape(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        for role, text in self.parser.feed(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())

    def row(self) -> tuple:
        self.parser.close()
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the output of ``format_turns``:
    the formatted text of each conversation is parsed as one stream, the loss text is what lies under the mask."""
    ship_code(formatted.sparkSession)
    kind = dict(formatted.dtypes)["conv_id"]
    rows = (formatted.select("conv_id", "turn", "role", "formatted", "mask_start", "mask_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
            .select("conv_id", "formatted", "mask_start", "mask_end"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, done = None, None, []

        def batch(kind_of: pa.DataType) -> pa.RecordBatch:
            ids, rest = [d[0] for d in done], list(zip(*[d[1] for d in done]))
            done.clear()
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind_of)] + [pa.array(c, t) for c, t in zip(rest, types)], names=names)

        of = None
        for b in batches:
            of = b.column("conv_id").type
            for conv, *turn in zip(*[b.column(c).to_pylist() for c in ("conv_id", "formatted", "mask_start", "mask_end")]):
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, now.row()))
                    key, now = conv, _Digest()
                now.add(*turn)
            if done:
                yield batch(of)
        if now is not None:
            done.append((key, now.row()))
            yield batch(of)

    return rows.mapInArrow(digest, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def round_trip(turns: DataFrame) -> DataFrame:
    """Format, write, read back."""
    return read_back(written(format_turns(turns), "chat"))
