"""Chat formatting that reads back exactly.

A turn is `<|im_start|>role`, a line end, its text, `<|im_end|>` and a line end; neither mark may stand in a role or a
text.  A turn is first rendered as it is and parsed again; where that does not give back role and text, each `<|` in its
text, with or without backslashes between, gets one more backslash there, which the parser takes off (in roles line ends,
`<` and backslashes are escaped), and the check is repeated.

The output has a row for each part of a conversation: PART_CHARS code points at most, but for a single longer turn; nearly
every conversation is one part.  Rows are streamed in order, so no conversation is held in memory.

Cases: null role or text counts as empty; null turns come first; turns with equal numbers are ordered by role, then text;
repeated rows are repeated turns; null conversation ids are one conversation; an empty table has no parts.  Only the four
named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1 << 20
MARK = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
ROLE_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

def escape(text: str) -> str:
    return MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")


def unescape_role(role: str) -> str:
    return ROLE_ESCAPED.sub(lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role) if "\\" in role else role


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a formatted text: role, text, and where the text as written starts and ends."""
    at = 0
    while at < len(rendered):
        line = rendered.find("\n", at)
        end = rendered.find(END, line + 1)
        role = rendered[at + len(START) : line]
        after = end + len(END)
        if line < 0 or end < 0 or not rendered.startswith(START, at) or rendered[after : after + 1] != "\n" or START in role or END in role or rendered.find(START, line, end) >= 0:
            raise ValueError(f"no turn at {at}")
        yield unescape_role(role), unescape(rendered[line + 1 : end]), line + 1, end
        at = after + 1


def reads_as(rendered: str, role: str, text: str) -> bool:
    try:
        return [t[:2] for t in parse(rendered)] == [(role, text)]
    except ValueError:
        return False


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn as written, and where its text starts and ends in it."""
    shown_role, shown = role, text
    for attempt in range(3):
        out = f"{START}{shown_role}\n{shown}{END}\n"
        if reads_as(out, role, text):
            start = len(START) + len(shown_role) + 1
            return out, start, start + len(shown)
        shown = escape(text) if attempt == 0 else shown
        shown_role = escape_role(role) if attempt else shown_role
    raise ValueError("a turn does not read back")


PARTS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
PARTS_DDL = "conv_id bigint, part int, last boolean, formatted string, loss array<struct<start:bigint,end:bigint>>"


def _formatted(batches: Iterator[pa.RecordBatch], trained: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    now, begun, part, texts, size, loss, rows, held = None, False, 0, [], 0, [], [], 0

    def close(last: bool) -> None:
        nonlocal part, texts, size, loss, held
        rows.append({"conv_id": now, "part": part, "last": last, "formatted": "".join(texts), "loss": loss})
        held += size
        part, texts, size, loss = part + 1, [], 0, []

    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if not begun or conv != now:
                if begun:
                    close(True)
                now, begun, part = conv, True, 0
            out, a, b = render(role or "", text or "")
            if texts and size + len(out) > PART_CHARS:
                close(False)
            if role in trained:
                loss.append({"start": size + a, "end": size + b})
            texts.append(out)
            size += len(out)
            if held > 4 * PART_CHARS or len(rows) >= 1024:
                yield pa.RecordBatch.from_pylist(rows, PARTS)
                rows, held = [], 0
    if begun:
        close(True)
    if rows:
        yield pa.RecordBatch.from_pylist(rows, PARTS)


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Parts of formatted conversations, in order within a partition, with the loss mask as code point ranges."""
    turns = df.select(F.col(conv_id).cast("bigint").alias("c"), F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("x"))
    ordered = turns.repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    return ordered.mapInArrow(lambda b: _formatted(b, trained), PARTS_DDL)


READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
READ_DDL = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turns, under, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    for batch in batches:
        rows = []
        for p in batch.to_pylist():
            text = p["formatted"]
            for role, said, _, _ in parse(text):
                turns.update(f"{role}\n{said}\n".encode())
                n += 1
            for s in p["loss"]:
                masked = unescape(text[s["start"] : s["end"]])
                under.update(masked.encode())
                chars += len(masked)
            size += len(text)
            if p["last"]:
                rows.append({"conv_id": p["conv_id"], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": under.hexdigest(), "formatted_chars": size})
                turns, under, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        yield pa.RecordBatch.from_pylist(rows, READ)


def read_back(parts: DataFrame) -> DataFrame:
    """One row for each conversation, from its formatted parts in the order they were made."""
    return parts.mapInArrow(_read, READ_DDL)
