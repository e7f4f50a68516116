"""Chat formatting that is checked by reading it back.

Grammar of the formatted text, read by one deterministic pass from left to right:

    user       [INST] text [/INST]
    assistant  a blank, text, </s>
    system     [SYS]text[/SYS]
    any other  [ROLE:name]text[/ROLE]

A backslash before a backslash, ``[`` or ``<`` is an escape; any other is itself. A text ends at the
first control string that is not escaped, and that has to be the end mark of its turn. A turn is
first rendered as it stands and parsed; if what comes back differs, its control strings and the
backslashes that would be misread are escaped, and if it still differs, every ``\\``, ``[`` and
``<``. Since each rendered turn is consumed whole, so is any series of turns.

Conversations are range-partitioned by (conv_id, turn), so the turns of one that holds a large part
of all rows are rendered in many tasks, into pieces of bounded size. Only its digest, which is
sequential by nature, runs through one task: as a stream of pieces, of which one is held at a time.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the template.
CONTROL = re.compile(r"</?s>|\[/?INST\]|\[/?SYS\]|\[ROLE:|\[/ROLE\]")
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "system": ("[SYS]", "[/SYS]")}
TOKENS = re.compile(r"\\[\\\[<]|" + CONTROL.pattern)
ESCAPED = re.compile(r"\\([\\\[<])")
NAME = re.compile(r"(?:[^\\\]]|\\.)*", re.DOTALL)

#: Characters of formatted text after which a piece ends.
PIECE_CHARS = 1 << 16


class FormatError(ValueError):
    """Formatted text that the grammar does not give."""


def escape(text: str, level: int) -> str:
    """``text`` as it stands (0), with what would be misread escaped (1), or all specials (2)."""
    if level == 0:
        return text
    if level == 1:
        text = re.sub(r"\\(?=[\\\[<]|$(?!\n))", r"\\\\", text)
        return CONTROL.sub(lambda m: "\\" + m[0], text)
    return re.sub(r"[\\\[<]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text is in it; escaped until it parses to the source."""
    if role in MARKS:
        begin, end = MARKS[role]
    else:
        begin, end = "[ROLE:" + re.sub(r"[\\\]]", lambda m: "\\" + m[0], role) + "]", "[/ROLE]"
    for level in (0, 1, 2):
        body = escape(text, level)
        shown = begin + body + end
        try:
            turns = list(parse(shown))
        except FormatError:
            continue
        if [(r, t) for r, t, *_ in turns] == [(role, text)]:
            return shown, len(begin), len(begin) + len(body)
    raise FormatError(f"a turn of role {role!r} does not come back")


def parse(shown: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text and the span of the text of each turn."""
    at = 0
    while at < len(shown):
        for role, (begin, end) in MARKS.items():
            if shown.startswith(begin, at):
                break
        else:
            if not shown.startswith("[ROLE:", at):
                raise FormatError(f"no turn starts at {at}")
            name = NAME.match(shown, at + 6)[0]
            begin, end = f"[ROLE:{name}]", "[/ROLE]"
            if not shown.startswith(begin, at):
                raise FormatError("a role does not end")
            role = re.sub(r"\\(.)", r"\1", name, flags=re.DOTALL)
        first = at + len(begin)
        mark = next((m for m in TOKENS.finditer(shown, first) if m[0][0] != "\\"), None)
        if mark is None or mark[0] != end.strip():
            raise FormatError(f"the turn at {at} does not end in {end.strip()}")
        last = mark.start() - (len(end) - len(end.lstrip()))
        if last < first or shown[last : mark.end()] != end:
            raise FormatError(f"the turn at {at} lacks its end mark")
        yield role, unescape(shown[first:last]), first, last
        at = mark.end()


def _render(piece_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conv, shown, size, spans = None, [], 0, []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if shown and (row["conv_id"] != conv or size >= piece_chars):
                    out.append((conv, part, number, "".join(shown), spans))
                    shown, size, spans, number = [], 0, [], number + 1
                conv, role = row["conv_id"], row["role"] or ""
                turn, begin, end = render_turn(role, row["text"] or "")
                if role == "assistant":
                    spans.append([size + begin, size + end])
                shown.append(turn)
                size += len(turn)
            yield _pieces(out)
        yield _pieces([(conv, part, number, "".join(shown), spans)] if shown else [])

    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, number, shown, spans = zip(*rows) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [
            pa.array(conv, pa.int64()),
            pa.array(part, pa.int64()),
            pa.array(number, pa.int64()),
            pa.array(shown, pa.string()),
            pa.array(spans, pa.list_(pa.list_(pa.int32()))),
        ],
        names=["conv_id", "part", "number", "formatted", "loss_spans"],
    )


def formatted(turns: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as formatted text.

    One or more pieces per conversation, in the order of (part, number); ``loss_spans`` are the
    assistant texts in ``formatted``, by characters.
    """
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    return (
        turns.select("conv_id", "turn", "role", "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _render(piece_chars),
            "conv_id long, part long, number long, formatted string, loss_spans array<array<int>>",
        )
    )


class _Conversation:
    """Running digests of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, shown: str, spans: list[list[int]]) -> None:
        found = []
        for role, text, begin, end in parse(shown):
            self.turns += 1
            self.turns_sha.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                found.append([begin, end])
        if found != spans:
            raise FormatError("the loss mask is not on the assistant texts")
        for begin, end in spans:
            text = unescape(shown[begin:end])
            self.loss += len(text)
            self.loss_sha.update(text.encode())
        self.chars += len(shown)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.turns_sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.chars
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv_id:
                if now:
                    done.append(now.row())
                now = _Conversation(row["conv_id"])
            now.add(row["formatted"], row["loss_spans"])
        yield _digests(done)
    yield _digests([now.row()] if now else [])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows) if rows else ([],) * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def digests(pieces: DataFrame) -> DataFrame:
    """Turns, loss text and lengths of each conversation, parsed from ``formatted`` pieces."""
    return (
        pieces.repartition("conv_id")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "number")
        .select("conv_id", "formatted", "loss_spans")
        .mapInArrow(
            _digest,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long",
        )
    )


def round_trip(turns: DataFrame) -> DataFrame:
    """Format ``turns`` (conv_id, turn, role, text), write the text, read it back and digest it.

    Null texts and roles are empty; turns are in the order of turn, then role, then text, nulls
    first, so ties and repeated rows have a fixed order and all stay. Rows with a null conv_id are
    one conversation. Texts of any length pass in pieces; other columns are left out, whatever their
    names. An empty table gives no rows.
    """
    return digests(staged(formatted(turns), "chat"))
