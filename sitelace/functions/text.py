"""Names to canonical keys, in column expressions (STR-01 to STR-21)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, numerals, aliases and words that decide whether two names get one key.
PUNCTUATION = r"[^0-9a-zA-ZñÑáéíóúÁÉÍÓÚäëïöüÄËÏÖÜ\s]+"
VOLTAGE = r"\b\d{1,3}(?:\.\d+)?\s*[-/]?\s*k\s*?v\b"
PARENTHESES = r"\([^)]*\)"
ADMIN_TAIL = r"[\s]*[-–—,]\s*[A-Za-zÁÉÍÓÚÜÑáéíóúüñ\s]+$"
SEPARATORS = r"[/_\-–—]{2,}"
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv")
STOPWORDS = ("subestacion", "subestación", "sub", "se", "estacion", "estación", "de", "del", "la", "el", "los", "las", "y", "the")
ALIASES = {
    "sta": "santa", "sta.": "santa", "sto": "san", "sto.": "san", "sn": "san", "snta": "santa", "nte": "n", "norte": "n",
    "sur": "s", "occidente": "o", "oriente": "e", "este": "e", "oeste": "o",
}
NO_NAMES = ("", "nan", "none", "null", "(sin nombre)", "sin nombre")
NO_VALUES = ("", "nan", "none")


def folded(s: str) -> str:
    """A string's letters without their marks; compatibility forms become what they stand for."""
    return "".join(filterfalse(unicodedata.combining, unicodedata.normalize("NFKD", s)))


#: Blocks whose letters fold by rule or not at all: unified ideographs, Hangul syllables, surrogates and private use.
_SKIPPED = ((0x3400, 0xA000), (0xAC00, 0xD7A4), (0xD800, 0xF900), (0x20000, 0x2F800))
_LAST = 0x2FA20
_HANGUL = ("가", "힣")


@dataclass(frozen=True)
class _Folds:
    """From the Unicode decomposition: letters that fold to one (`source`, `target`; marks go, so source is longer), those that
    fold to several, near (Latin and its like) and far, and the classes of the latter."""

    source: str
    target: str
    near: dict[str, str]
    far: dict[str, str]
    near_class: str
    far_class: str


def _class(letters: Iterable[str]) -> str:
    """A character class of runs of neighbours."""
    runs: list[list[int]] = []
    for cp in sorted(map(ord, letters)):
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in runs) + "]"


@cache
def _folds() -> _Folds:
    """Folding a text folds each of its letters: decomposing reorders marks only, and marks go."""
    one, marks, near, far = {}, [], {}, {}
    for cp in range(0xA0, _LAST):
        if any(low <= cp < high for low, high in _SKIPPED):
            continue
        c = chr(cp)
        plain = folded(c)
        if plain == c:
            continue
        if not plain:
            marks.append(c)
        elif len(plain) == 1:
            one[c] = plain
        elif cp < 0x250 or 0xFB00 <= cp < 0xFB07 or c in "…№™℡":
            near[c] = plain
        else:
            far[c] = plain
    return _Folds("".join(one) + "".join(marks), "".join(one.values()), near, far, _class(near), _class([*far, *map(chr, range(ord(_HANGUL[0]), ord(_HANGUL[1]) + 1))]))


def _syllable(c: Column) -> Column:
    """A Hangul syllable to its two or three letters, by the arithmetic of their block."""
    place = F.ascii(c) - ord(_HANGUL[0])
    final = place % 28
    letter = lambda first, n, at: F.substring(F.lit("".join(chr(first + i) for i in range(n))), at + 1, F.lit(1))
    return F.concat(letter(0x1100, 19, (place / 588).cast("int")), letter(0x1161, 21, (place % 588 / 28).cast("int")), F.when(final == 0, "").otherwise(letter(0x11A8, 27, final - 1)))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def collapse_ws(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def strip_accents(s: Column) -> Column:
    """Folds by table, all of Unicode; null gives the empty string.  ASCII texts pass as they are, and letters that fold to
    several are looked for only in texts that have one."""
    folds = _folds()
    text = F.coalesce(s, F.lit(""))
    near = text
    for c, plain in folds.near.items():
        near = F.replace(near, F.lit(c), F.lit(plain))
    near = F.when(text.rlike(folds.near_class), near).otherwise(text)
    several = F.map_from_arrays(*(F.split(F.lit("\n".join(part)), "\n") for part in (folds.far, folds.far.values())))  # two literals, folded once

    def letter(c: Column) -> Column:
        return F.when(c < "\u0250", c).when(c.between(*_HANGUL), _syllable(c)).otherwise(F.coalesce(several[c], c))

    whole = F.when(text.rlike(folds.far_class), F.array_join(F.transform(F.split(near, ""), letter), "")).otherwise(near)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(whole, folds.source, folds.target))


def strip_accents_exact(s: Column) -> Column:
    """The same by Python's own tables, in Arrow batches; what tests hold the other form against."""

    def fold(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([folded(x.as_py() or "") for x in texts], pa.string())

    return F.arrow_udf(fold, "string")(s)


def normalize_core(s: Column) -> Column:
    return collapse_ws(F.regexp_replace(F.lower(strip_accents(s)), "(?U)" + PUNCTUATION, " "))


def strip_voltage(s: Column) -> Column:
    return collapse_ws(F.regexp_replace(F.coalesce(s, F.lit("")), "(?U)(?i)" + VOLTAGE, " "))


def heavy_clean(s: Column) -> Column:
    """Voltage, parentheses, trailing region and separators go, in this order."""
    out = strip_voltage(s)
    for pattern in (PARENTHESES, ADMIN_TAIL, SEPARATORS):
        out = F.regexp_replace(out, "(?U)" + pattern, " ")
    return normalize_core(F.translate(out, "-–—/", "    "))


def roman_to_arabic(token: Column) -> Column:
    return F.coalesce(_map({r: str(i) for i, r in enumerate(ROMAN, 1)})[F.lower(token)], token)


def arabic_to_roman(token: Column) -> Column:
    number = F.regexp_replace(F.trim(token), r"^\+?0*(?=\d)", "")
    return F.coalesce(_map({str(i): r.upper() for i, r in enumerate(ROMAN, 1)})[number], token)


def alias(token: Column) -> Column:
    return F.coalesce(_map(ALIASES)[token], token)


def is_stopword(token: Column) -> Column:
    return token.isin(*STOPWORDS)


def tokenize(s: Column) -> Column:
    """Numerals and aliases first, stopwords last: what becomes a stopword goes too."""
    parts = F.filter(F.split(normalize_core(s), " "), lambda t: t != "")
    return F.filter(F.transform(parts, lambda t: alias(roman_to_arabic(t))), lambda t: ~is_stopword(t))


def collapse_repeats(tokens: Column) -> Column:
    """Neighbours that are equal become one; later repeats stay."""
    return F.get(F.transform(F.array(tokens), lambda a: F.filter(a, lambda t, i: (i == 0) | (t != F.coalesce(F.get(a, i - 1), F.lit(""))))), F.lit(0))


def key_strict(s: Column) -> Column:
    return F.array_join(collapse_repeats(tokenize(s)), " ")


def key_relaxed(s: Column) -> Column:
    return normalize_core(s)


def key_station(s: Column) -> Column:
    return key_strict(normalize_core(s))


def key_station_plus(s: Column) -> Column:
    return key_strict(heavy_clean(s))


def norm_space(s: Column) -> Column:
    """Blanks but line ends become one space; ends are trimmed of all white space."""
    inner = F.regexp_replace(F.coalesce(s, F.lit("")), r"[ \t\r\f\x0B]+", " ")
    return F.regexp_replace(inner, r"(?U)^\s+|\s+$", "")


def clean_name(s: Column) -> Column:
    """A display name, or the empty string for placeholders and names without a word character."""
    out = F.regexp_replace(F.coalesce(s, F.lit("")), r"[​-‍﻿\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    out = norm_space(out)
    return F.when(F.lower(out).isin(*NO_NAMES) | ~out.rlike(r"(?U)[\wÀ-ÿ]"), "").otherwise(out)


def safe_value(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull() | F.lower(F.trim(text)).isin(*NO_VALUES), "n/a").otherwise(text)


def format_coordinate(c: Column, sep: str = ",", places: int = 6) -> Column:
    """Decimal text for a CSV dialect: a decimal comma where the separator is a semicolon; null and NaN give the empty string."""
    number = F.expr("try_cast(null as double)") if c is None else c.try_cast("double")
    text = F.format_string(f"%.{places}f", number)
    text = F.replace(text, F.lit("."), F.lit(",")) if sep == ";" else text
    return F.when(c.isNull() | F.isnan(number), "").when(number.isNull(), c.cast("string")).otherwise(text)


def distinct_joined(c: Column, sep: str = "; ") -> Column:
    """Aggregate: distinct non-empty values, trimmed, sorted and joined; the empty string if there are none."""
    value = F.trim(c.cast("string"))
    return F.array_join(F.array_sort(F.collect_set(F.when(value != "", value))), sep)


def popup(fields: dict[str, Column]) -> Column:
    """Lines of `<b>label:</b> value`."""
    return F.concat_ws("<br>", *(F.concat(F.lit(f"<b>{label}:</b> "), safe_value(c)) for label, c in fields.items()))
