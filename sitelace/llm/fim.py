"""Fill in the middle: documents cut in three by seeded ranks of their units, and rearranged around sentinels.

Method: big integers as bit vectors, a bit for each byte of the text.  `bytes.translate` turns the text into the mask of a
class of bytes, shifted boolean operations on masks mark where units begin, `bit_count` gives their number n, and the byte
at which the k-th unit begins is found by halving: the lower half's count says which half holds the rank.

Units are code points, words (runs of bytes other than blanks, with the blanks behind them; blanks at the start belong to
the first) or lines (with their line feed).  A null text counts as empty.  Ranks, form and arrangement come from the seed
and the row's id alone, so a retried task gives the same rows, and rows with the same id and text (or a null id, written
as nothing) give the same output.  Of an empty text, and of one that holds a sentinel, the form is plain and the output is
the text.  Long texts are cut whole: time is linear, memory some thirty times the longest text of a worker.  Columns of the input stay; new ones whose
names are taken get underscores.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_or_empty, worker_cache

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
UNITS = ("code point", "word", "line")


@dataclass(frozen=True)
class FimConfig:
    """fim_percent: documents that are rearranged; spm_percent: those of them whose suffix comes first; unit: what ranks
    count; seed: goes before the id in the digest that all draws come from."""

    fim_percent: int = 90
    spm_percent: int = 20
    unit: str = "code point"
    seed: str = "1"


def _class_mask(members: bytes) -> bytes:
    """A table for `bytes.translate`: the digit 1 for the class, 0 for all other bytes."""
    return bytes(0x31 if b in members else 0x30 for b in range(256))


CONTINUATION = _class_mask(bytes(range(0x80, 0xC0)))
BLANK = _class_mask(b" \t\n\x0b\x0c\r")
LINE_FEED = _class_mask(b"\n")


def mask(raw: bytes, table: bytes) -> int:
    """Bit i says whether byte i belongs to the class."""
    return int(raw.translate(table)[::-1], 2) if raw else 0


def starts(raw: bytes, unit: str = "code point") -> int:
    """Bit i says whether a unit begins at byte i."""
    if not raw:
        return 0
    every = (1 << len(raw)) - 1
    if unit == "code point":
        return every & ~mask(raw, CONTINUATION) | 1
    if unit == "line":
        return (mask(raw, LINE_FEED) << 1 | 1) & every
    if unit == "word":
        blank = mask(raw, BLANK)
        begin = (blank << 1 | 1) & ~blank & every  # a byte that is no blank, behind a blank or at the start
        first = begin & -begin
        return begin ^ first | 1
    raise ValueError(f"no unit {unit}; there are {UNITS}")


def select(bits: int, rank: int, width: int) -> int:
    """The place of the set bit of this rank, from 0; `width` if there are no more than `rank`."""
    if rank >= bits.bit_count():
        return width
    at = 0
    while width > 1:
        half = width >> 1
        low = bits & ((1 << half) - 1)
        below = low.bit_count()
        if rank < below:
            bits, width = low, half
        else:
            bits, width, rank, at = bits >> half, width - half, rank - below, at + half
    return at


def draws(seed: str, doc_id: int | None) -> tuple[int, int, int, int]:
    """h1 to h4: the first four groups of eight digits of the digest."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transform(raw: bytes, h: tuple[int, int, int, int], config: FimConfig) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, units of the prefix, units of the middle, output)."""
    bits = starts(raw, config.unit)
    n = bits.bit_count()
    if not raw or any(s.encode() in raw for s in SENTINELS) or h[2] % 100 >= config.fim_percent:
        return n, "plain", None, None, raw
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = select(bits, first, len(raw)), select(bits, last, len(raw))
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = (x.encode() for x in SENTINELS)
    if h[3] % 100 < config.spm_percent:
        return n, "spm", first, last - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, last - first, b"".join((p, prefix, s, suffix, m, middle))


TYPE = "struct<n:bigint,form:string,prefix_units:bigint,middle_units:bigint,output:string>"
_ARROW = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_units", pa.int64()), ("middle_units", pa.int64()), ("output", pa.string())])


def rearranged(doc_id: Column, text: Column, config: FimConfig = FimConfig()) -> Column:
    """struct(n, form, prefix_units, middle_units, output) of each row; the two lengths are null where the form is plain."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        worker_cache("fim")
        for ids, texts in batches:
            rows = [transform(t.as_py() or b"", draws(config.seed, i), config) for i, t in zip(ids.to_pylist(), texts, strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            output = pa.array(columns[4], pa.binary()).cast(pa.string())
            made = [pa.array(c, f.type) for c, f in zip(columns[:4], _ARROW, strict=False)]
            yield pa.StructArray.from_arrays([*made, output], fields=list(_ARROW))

    return F.arrow_udf(run, TYPE)(doc_id, text.cast("binary"))


def restored(form: Column, output: Column) -> Column:
    """The text, from output and form.  No sentinel can arise where a piece meets one, as only its first character is `<`."""
    # With the limit given, empty pieces at the end stay.
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, config: FimConfig = FimConfig(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with `fim_n`, `fim_form`, `fim_prefix_units`, `fim_middle_units` and `fim_output`."""
    cell = fresh("fim_cell", *docs.columns)
    out = docs.withColumn(cell, rearranged(F.col(doc_id), text_or_empty(text), config))
    for part in ("n", "form", "prefix_units", "middle_units", "output"):
        out = out.withColumn(fresh(f"fim_{part}", *docs.columns), F.col(cell)[part])
    return out.drop(cell)
