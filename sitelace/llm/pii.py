"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

A span is (kind, start, end, score) in code points, end exclusive.  Kinds `email ip card phone` always stay when their
pattern and check hold, whatever their score; `iban` (mod-97), `national_phone` and `ssn` are added only with a score of
`ADDED_SCORE` or more, which the last two reach by a context word alone.  Order: kind as in KINDS, then start.

Cases: a null or empty text has no spans and is redacted to itself.  Spans of one kind do not overlap; spans of several
kinds may, and redaction then replaces their union once, named after the first.  Time is linear in a text's length, however
long its runs of digits, letters or signs are.  Repeated rows give equal spans; an empty table gives an empty result; other
columns are untouched, as both operators are column expressions over the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import worker_cache

KINDS = ("email", "ip", "card", "phone", "iban", "national_phone", "ssn")
BASE = 4
ADDED_SCORE = 0.6
NEAR = 40

#: A match can only begin where a run of digits does, as it would have to take the rest of the run anyway.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
SSN = re.compile(r"(?<![\w.-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])")
DIGIT = re.compile(r"[0-9]")
#: kind: score of pattern and check alone, words that raise it.
SCORES = {
    "email": (0.9, r"e-?mail|contact|write|address|courriel|correo"),
    "ip": (0.6, r"\bip\b|address|host|server|login"),
    "card": (0.8, r"card|visa|master|amex|credit|debit|carte|tarjeta|karte"),
    "phone": (0.7, r"phone|tel|call|mobile|fax|whatsapp"),
    "iban": (0.9, r"iban|bank|account|konto|compte|cuenta"),
    "national_phone": (0.3, r"phone|tel\b|call|mobile|fax|whatsapp"),
    "ssn": (0.3, r"ssn|social security|tax id"),
}
CONTEXT = {k: re.compile(w, re.IGNORECASE) for k, (_, w) in SCORES.items()}
RAISE = 0.35
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    d = [ord(c) - 48 for c in reversed(digits)]
    return (sum(d[::2]) + sum(_DOUBLED[x] for x in d[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part and domain, found from the sign between them in linear time."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest match that holds mod-97, else the longest of its prefixes before a blank that does; then on from its end."""
    at = 0
    while m := IBAN.search(text, at):
        start, end = m.span()
        ends = [end, *(i for i in range(end - 1, start, -1) if text[i] == " ")]
        held = next((e for e in ends if mod97(text[start:e])), None)
        if held:
            yield start, held
        # A match that fails may hide one that begins at a later word.
        at = held or next((i + 1 for i in range(start, end) if text[i] == " "), end)


def proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", *m.span()
    for start, end in ibans(text):
        yield "iban", start, end
    for m in NATIONAL.finditer(text):
        yield "national_phone", *m.span()
    for m in SSN.finditer(text):
        yield "ssn", *m.span()


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    found = []
    for kind, a, b in proposed(text or ""):
        score = SCORES[kind][0]
        if CONTEXT[kind].search(text, max(0, a - NEAR), a) or CONTEXT[kind].search(text, b, b + NEAR):
            score = min(1.0, score + RAISE)
        if kind in KINDS[:BASE] or score >= ADDED_SCORE:
            found.append((kind, a, b, round(score, 2)))
    return found


def redacted(text: str | None) -> str | None:
    """Each span, or run of spans that overlap, gives way to the first one's kind in brackets."""
    if not text or not (found := spans(text)):
        return text
    out, end, rank = [], 0, {k: i for i, k in enumerate(KINDS)}
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], rank[s[0]])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    worker_cache("pii")
    for texts in batches:
        yield pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t.as_py())] for t in texts], _ARROW)


def _redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    worker_cache("pii")
    for texts in batches:
        yield pa.array([redacted(t.as_py()) for t in texts], pa.string())


def pii_spans(text: Column) -> Column:
    return F.arrow_udf(_spans, TYPE)(text)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their personal data replaced; `n_chars` follows where the table has it."""
    out = df.withColumn(text, F.arrow_udf(_redacted, "string")(F.col(text)))
    return out.withColumn("n_chars", F.coalesce(F.length(text), F.lit(0)).cast("bigint")) if "n_chars" in df.columns else out
