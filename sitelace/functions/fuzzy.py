"""Name similarity, 0 to 100 (FUZ-01 to 05), and what a search needs to know of a scorer (EXT-01).

The score is a weighted mean of token-set, token-sort and partial ratios, the Jaccard index of the tokens, Jaro-Winkler
similarity and a ratio without spaces, on relaxed keys.  Backend "difflib" has one ratio (on sorted distinct tokens) for
the first three and none for Jaro-Winkler, so 90 is its most; backend "indel" has all, as published: ratio = 2 LCS / total
length, partial = best ratio of the shorter text in windows of the longer.  Order of arguments matters to "difflib".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The weights.
W_SET, W_SORT, W_PARTIAL, W_JACCARD, W_JARO, W_PLAIN = 0.30, 0.22, 0.13, 0.15, 0.10, 0.10


def token_jaccard(a: Column, b: Column) -> Column:
    """100 times shared over all distinct tokens of two keys; 0 if both are empty."""
    x, y = (F.filter(F.array_distinct(F.split(k, " ")), lambda t: t != "") for k in (a, b))
    both = F.size(F.array_union(x, y))
    return F.when(both > 0, 100.0 * F.size(F.array_intersect(x, y)) / both).otherwise(0.0)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each letter of `a`."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for c in b:
        hit = rows & where.get(c, 0)
        rows = (rows + hit | rows - hit) & full
    return (full & ~rows).bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n, letters = len(short), set(short)
    best = 0.0
    for start in range(1 - n, len(long)):
        window = long[max(0, start) : start + n]
        # A best window ends (or, at the start, begins) with a letter of the shorter text.
        if (window[-1] if start <= 0 else window[0]) in letters or window[-1] in letters:
            best = max(best, ratio(short, window))
            if best == 100.0:
                break
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if shared and (not left or not right):
        return 100.0
    first, second = f"{shared} {left}".strip(), f"{shared} {right}".strip()
    return max([ratio(first, second)] + ([ratio(shared, first), ratio(shared, second)] if shared else []))


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    theirs = [c for c, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    m = len(mine)
    return (m / len(a) + m / len(b) + (m - swapped) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    score = jaro(a, b)
    if score > 0.7:
        prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
        score += 0.1 * prefix * (1 - score)
    return score


def score_keys(a: str, b: str, backend: str = "difflib", floor: float = 0.0) -> float:
    """The composite of two relaxed keys; one below the floor may come out as any lower number."""
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    jaccard = 100.0 * len(x & y) / len(x | y)
    plain_a, plain_b = a.replace(" ", ""), b.replace(" ", "")
    if backend == "difflib":
        # Matching blocks make up a common subsequence, so that bounds them at a tenth of the cost.
        p, q = " ".join(sorted(x)), " ".join(sorted(y))
        if floor > 0 and W_JACCARD * jaccard + 100 * W_PLAIN + (W_SET + W_SORT + W_PARTIAL) * ratio(p, q) < floor - 1e-9:
            return 0.0
        one = 100.0 * SequenceMatcher(None, p, q).ratio()
        if floor > 0 and W_JACCARD * jaccard + 100 * W_PLAIN + (W_SET + W_SORT + W_PARTIAL) * one < floor - 1e-9:
            return 0.0
        parts = (one, one, one, jaccard, 0.0, 100.0 * SequenceMatcher(None, plain_a, plain_b).ratio())
    elif backend == "indel":
        parts = (token_set_ratio(a, b), token_sort_ratio(a, b), partial_ratio(a, b), jaccard, 100.0 * jaro_winkler(a, b), ratio(plain_a, plain_b))
    else:
        raise ValueError(f"no backend {backend}")
    return sum(w * p for w, p in zip((W_SET, W_SORT, W_PARTIAL, W_JACCARD, W_JARO, W_PLAIN), parts, strict=True))


def fuzzy_score(a: Column, b: Column, backend: str = "difflib", floor: Column | None = None) -> Column:
    """Of two columns of relaxed keys, in Arrow batches.  Scores below the floor may come out as any lower number."""

    def score(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = lru_cache(maxsize=65_536)(lambda x, y, f: score_keys(x, y, backend, f))
        for left, right, floors in batches:
            yield pa.array([known(x or "", y or "", f or 0.0) for x, y, f in zip(left.to_pylist(), right.to_pylist(), floors.to_pylist(), strict=True)], pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()(a, b, F.lit(0.0) if floor is None else floor.cast("double"))


# --- what two names have in common -------------------------------------------------------------------------------------

#: What is counted letter by letter; all other characters of a key but spaces count as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
LETTER = {c: i for i, c in enumerate(ALPHABET)}
OTHER = len(ALPHABET)
#: The first so many of each letter have a bit; those beyond are only counted.
OCCURRENCES, WORDS = 5, 3


def distinct_text(key: str) -> str:
    """The distinct tokens of a key in order, which is what "difflib" compares."""
    return " ".join(sorted(set(key.split())))


def bag(text: str) -> list[tuple[int, int]]:
    """The letters of a text with their occurrence, from 1; spaces count like letters, as class -1."""
    held: dict[int, int] = {}
    out = []
    for c in text:
        k = -1 if c == " " else LETTER.get(c, OTHER)
        held[k] = held.get(k, 0) + 1
        out.append((k, held[k]))
    return out


def letter_bits(text: str) -> list[int]:
    """WORDS longs with a bit for each letter and early occurrence, then how many letters are beyond, and spaces."""
    bits = beyond = spaces = 0
    for k, n in bag(text):
        if k < 0:
            spaces += 1
        elif n <= OCCURRENCES:
            bits |= 1 << (k * OCCURRENCES + n - 1)
        else:
            beyond += 1
    return [*_longs(bits), beyond, spaces]


def _longs(bits: int) -> list[int]:
    words = [(bits >> (64 * i)) & ((1 << 64) - 1) for i in range(WORDS)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def token_bits(tokens: set[str]) -> list[int]:
    """WORDS longs with a bit for each token's hash."""
    bits = 0
    for t in tokens:
        bits |= 1 << crc32(t.encode()) % (64 * WORDS)
    return _longs(bits)


_FIELDS = ["n_tokens", *(f"t{i}" for i in range(WORDS)), *(f"{p}{f}" for p in "ad" for f in (*range(WORDS), "_beyond", "_spaces", "_size"))]
FEATURES = "struct<" + ",".join(f"{f}:bigint" for f in _FIELDS) + ">"


def features(key: Column) -> Column:
    """Of one key, once for each name: its letters and length, as they stand (a) and of its distinct tokens (d), and a bit
    for each token (t).  All are numbers, so bounds of pairs are arithmetic."""
    kind = pa.struct([(f, pa.int64()) for f in _FIELDS])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            rows = []
            for k in keys.to_pylist():
                k = k or ""
                plain, tokens = distinct_text(k), set(k.split())
                rows.append([len(tokens), *token_bits(tokens), *letter_bits(k), len(k), *letter_bits(plain), len(plain)])
            columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(kind))

    return F.arrow_udf(run, FEATURES)(key)


@dataclass(frozen=True)
class Common:
    """What two `features` have in common, as columns: letters (at most so many) and lengths of the keys (`all`), of them
    without spaces (`plain`), of their distinct tokens in order (`distinct`); tokens shared (at most so many) and in either."""

    all: Column
    all_x: Column
    all_y: Column
    plain: Column
    plain_x: Column
    plain_y: Column
    distinct: Column
    distinct_x: Column
    distinct_y: Column
    shared: Column
    either: Column


def common(x: Column, y: Column) -> Common:
    def bits(p: str) -> Column:
        out = F.bit_count(x[f"{p}0"].bitwiseAND(y[f"{p}0"]))
        for i in range(1, WORDS):
            out = out + F.bit_count(x[f"{p}{i}"].bitwiseAND(y[f"{p}{i}"]))
        return out

    letters = lambda p: bits(p) + F.least(x[f"{p}_beyond"], y[f"{p}_beyond"])
    spaces = lambda p: F.least(x[f"{p}_spaces"], y[f"{p}_spaces"])
    plain = letters("a")
    # Of tokens that share a bit within a name, all but one are beyond what bits can tell.
    held = lambda f: sum((F.bit_count(f[f"t{i}"]) for i in range(1, WORDS)), F.bit_count(f["t0"]))
    hidden = F.least(x["n_tokens"] - held(x), y["n_tokens"] - held(y))
    shared = F.least(bits("t") + hidden, x["n_tokens"], y["n_tokens"])
    return Common(
        plain + spaces("a"), x["a_size"], y["a_size"],
        plain, x["a_size"] - x["a_spaces"], y["a_size"] - y["a_spaces"],
        letters("d") + spaces("d"), x["d_size"], y["d_size"],
        shared, x["n_tokens"] + y["n_tokens"] - shared,
    )


def dice(shared: Column, n: Column, m: Column) -> Column:
    """Twice what is shared over both lengths: no ratio of matching letters is higher."""
    return F.when(n + m > 0, 2.0 * shared / (n + m)).otherwise(1.0)


# --- scorers -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scorer:
    """A similarity of relaxed keys from 0 to 100, and what lets a search skip pairs.

    score: of two columns of keys, and a column with the score below which any lower number will do.  bound: from what two names have in common; no pair scores higher.
    least_dice: (threshold, Jaccard index of the tokens) -> of pairs that reach the threshold while their tokens' index is
    at most the given one, no pair has fewer letters in common, as twice that number over both lengths; 0 if nothing is known.
    It must not rise with the index.  on_distinct: those letters are of the distinct tokens in order, else of the keys.
    top: the score of equal keys, if no two different keys reach it.
    parts: weights of three parts that no score exceeds the sum of: the longest common subsequence of the distinct tokens in order, as twice its
    length over both lengths, the Jaccard index of the tokens, and letters in common without spaces, likewise; `one` is then the score of two keys in Python.
    """

    name: str
    score: Callable[[Column, Column, Column], Column]
    bound: Callable[[Common], Column]
    least_dice: Callable[[float, float], float]
    on_distinct: bool = True
    top: float | None = None
    parts: tuple[float, float, float] | None = None
    one: Callable[[str, str, float], float] | None = None


def _bound_difflib(c: Common) -> Column:
    jaccard = F.when(c.either > 0, c.shared / c.either).otherwise(0.0)
    return 100 * ((W_SET + W_SORT + W_PARTIAL) * dice(c.distinct, c.distinct_x, c.distinct_y) + W_JACCARD * jaccard + W_PLAIN * dice(c.plain, c.plain_x, c.plain_y))


def _bound_indel(c: Common) -> Column:
    jaccard = F.when(c.either > 0, c.shared / c.either).otherwise(0.0)
    by_set = F.when(c.shared > 0, 1.0).otherwise(dice(c.distinct, c.distinct_x, c.distinct_y))
    short = F.least(c.all_x, c.all_y)
    by_part = F.when(short > 0, 2.0 * c.all / (short + c.all)).otherwise(1.0)  # a window may be as short as what it shares
    match = F.when(short > 0, F.least(F.lit(1.0), (c.all / c.all_x + c.all / c.all_y + 1) / 3)).otherwise(1.0)
    by_jaro = F.when(c.all == 0, 0.0).otherwise(match + 0.4 * (1 - match))
    by_plain = dice(c.plain, c.plain_x, c.plain_y)
    return 100 * (W_SET * by_set + W_SORT * dice(c.all, c.all_x, c.all_y) + W_PARTIAL * by_part + W_JACCARD * jaccard + W_JARO * by_jaro + W_PLAIN * by_plain)


def _need_difflib(threshold: float, jaccard: float) -> float:
    return (threshold / 100 - W_JACCARD * jaccard - W_PLAIN) / (W_SET + W_SORT + W_PARTIAL)


def _need_indel(threshold: float, jaccard: float) -> float:
    """Letters of keys: the sorted ratio rests on them alone; any shared token may give the set ratio all."""
    if jaccard > 0:
        return (threshold / 100 - W_SET - W_JACCARD * jaccard - W_PARTIAL - W_JARO - W_PLAIN) / W_SORT
    return (threshold / 100 - W_SET - W_PARTIAL - W_JARO - W_PLAIN) / W_SORT


def _bound_edits(c: Common) -> Column:
    longest = F.greatest(c.all_x, c.all_y)
    return F.when(longest > 0, 100.0 * c.all / longest).otherwise(100.0)


def _edits(a: Column, b: Column, floor: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 100.0 * (longest - F.levenshtein(a, b)) / longest).otherwise(100.0)


DIFFLIB = Scorer(
    "difflib", lambda a, b, floor: fuzzy_score(a, b, "difflib", floor), _bound_difflib, _need_difflib, top=100.0 * (W_SET + W_SORT + W_PARTIAL + W_JACCARD + W_PLAIN),
    parts=(W_SET + W_SORT + W_PARTIAL, W_JACCARD, W_PLAIN), one=lambda a, b, floor: score_keys(a, b, "difflib", floor),
)
INDEL = Scorer("indel", lambda a, b, floor: fuzzy_score(a, b, "indel", floor), _bound_indel, _need_indel, on_distinct=False, top=100.0)
#: Share of the longer key that stays, by single edits; all of it runs in the JVM.
EDITS = Scorer("edits", _edits, _bound_edits, lambda threshold, jaccard: threshold / 100, on_distinct=False, top=100.0)
SCORERS = {s.name: s for s in (DIFFLIB, INDEL, EDITS)}


def scorer(given: str | Scorer) -> Scorer:
    if isinstance(given, Scorer):
        return given
    if given not in SCORERS:
        raise ValueError(f"no scorer {given}; there are {sorted(SCORERS)}")
    return SCORERS[given]


def upper_bound(x: Column, y: Column, backend: str | Scorer = "difflib") -> Column:
    """Of two `features`: the backend scores no higher."""
    return scorer(backend).bound(common(x, y))
