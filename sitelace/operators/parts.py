"""Best names by parts of both sides: every pair of two parts meets its bounds in numpy, and few are scored.

For scorers that rest on a common subsequence (`Scorer.parts`).  Each part of one side meets each of the other in a task of its
own, of about LEFT by RIGHT names, so memory doesn't grow with the tables.  Of a name and all of the other part, first letters
and tokens in common are counted by bits (one long each), then the longest common subsequence bounds what is left, all pairs at
once; the rest is scored from the highest bound down, until none can be better than the best so far.  A bound is never below a score, so
nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import Scorer, bag, distinct_text
from ..session import written

#: Names of a part at most, about.
LEFT, RIGHT = 32_768, 65_536
#: Names that are compared at once, so that they stay near the processor.  Pairs of a task at least, if there are so many.
AT_ONCE, TASK = 16_384, 50_000_000
#: Letters of a name that have a bit; longer ones are bounded by their bags alone.
LONGEST = 64
#: Shares of the scorer's top down to which names meet by their tokens; token keys at most for a number of tokens, unless single ones give more.
LEVELS, COMBINATIONS = (0.9,), 64
#: Names of more tokens are not looked up by two of them.
FEW = 8
#: Pairs whose subsequences are found at once.
PAIRS = 100_000
SLACK = 1e-9

#: Letters with a bit, (letter, occurrence); what is beyond is only counted, so which ones they are is a matter of cost alone.
_BITS = {e: i for i, e in enumerate(
    [(k, 1) for k in range(26)] + [(k, 2) for k in (0, 2, 3, 4, 6, 7, 8, 11, 12, 13, 14, 17, 18, 19, 20, 22)]
    + [(k, 3) for k in (0, 2, 4, 7, 8, 13, 14, 17, 18, 19, 20)] + [(k, 4) for k in (4, 13, 19)]
)}
#: Of what has no bit of its own, and of spaces, the first so many have one each, so that the bits in common count the lesser number.
_OTHERS, _SPACES = 5, 3
assert len(_BITS) + _OTHERS + _SPACES <= 64
#: marks: bits of letters and spaces; tokens: bits; beyond, tokens_beyond: what has none; plain: letters of the key without spaces, 0 if
#: a token repeats (then its letters are others than the distinct tokens').
_FIELDS = {"marks": pa.int64(), "tokens": pa.int64(), "beyond": pa.int32(), "tokens_beyond": pa.int32(), "spaces": pa.int32(), "size": pa.int32(), "n_tokens": pa.int32(), "plain": pa.int32()}
_KIND = pa.struct(list(_FIELDS.items()))
_DDL = "struct<" + ",".join(f"{f}:{'bigint' if t == pa.int64() else 'int'}" for f, t in _FIELDS.items()) + ">"


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def of_key(key: str) -> list[int]:
    tokens, text = key.split(), distinct_text(key)
    marks = others = words = 0
    for e in bag(text):
        if e in _BITS:
            marks |= 1 << _BITS[e]
        elif e[0] != -1:
            others += 1
    different = set(tokens)
    for t in different:
        words |= 1 << crc32(t.encode()) % 64
    spaces = max(len(different) - 1, 0)
    marks |= ((1 << min(others, _OTHERS)) - 1 | (1 << min(spaces, _SPACES)) - 1 << _OTHERS) << len(_BITS)
    beyond = max(others - _OTHERS, 0) + max(spaces - _SPACES, 0)
    return [_signed(marks), _signed(words), beyond, len(different) - words.bit_count(), spaces, len(text), len(different), len(text) - spaces if len(different) == len(tokens) else 0]


def _numbered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for keys in batches:
        rows = [of_key(k) for k in keys.to_pylist()]
        columns = list(zip(*rows, strict=True)) or [()] * len(_KIND)
        yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, _FIELDS.values(), strict=True)], fields=list(_KIND))


class Part:
    """Names of one side as arrays, by their length."""

    def __init__(self, table: pa.Table):
        held = {f: table.column(f).to_numpy() for f in _FIELDS}
        by = np.lexsort((held["n_tokens"], held["size"], held["n_tokens"] > FEW))
        for f, a in held.items():
            setattr(self, f, (a.astype(np.uint64, casting="unsafe") if f in ("marks", "tokens") else a.astype(np.int32))[by])
        keys = table.column("k").to_pylist()
        self.keys = [keys[i] for i in by]
        self.rid = table.column("r_rid").to_numpy()[by] if "r_rid" in table.column_names else None
        self.short = self.size <= LONGEST
        self.few = int((self.n_tokens <= FEW).sum())
        self._codes = None

    def twos(self) -> tuple[np.ndarray, np.ndarray]:
        """(two tokens as one number, name) of all names of few tokens, in order."""
        words = np.full((self.few, FEW), -1, np.int64)
        for i, key in enumerate(self.keys[: self.few]):
            some = sorted({crc32(t.encode()) for t in key.split()})
            words[i, : len(some)] = some
        out = []
        for a, b in combinations(range(FEW), 2):
            i = np.flatnonzero(words[:, b] >= 0)
            if len(i):
                out.append(((words[i, a] << 32 | words[i, b]), i))
        two, i = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 2
        by = np.argsort(two, kind="stable")
        return two[by], i[by]

    @property
    def codes(self) -> np.ndarray:
        """Characters of the short texts, a byte each, 0 beyond the end; those that fall together only raise a bound."""
        if self._codes is None:
            letters = np.array([distinct_text(k) for k in self.keys], f"U{LONGEST}").view(np.uint32).reshape(-1, LONGEST)
            self._codes = np.where(letters > 0, letters % 127 + 1, 0).astype(np.uint8)
        return self._codes


def subsequences(x: Part, y: Part, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the texts of pairs of short names."""
    who, at = np.unique(i, return_inverse=True)
    where = np.zeros((len(who), 128), np.uint64)
    mine = x.codes[who]
    for p in range(int(x.size[who].max(initial=0))):
        where[np.arange(len(who)), mine[:, p]] |= np.uint64(1 << p)
    where[:, 0] = 0
    where, base, letters = where.ravel(), at.astype(np.int64) * 128, np.ascontiguousarray(y.codes[j].T)
    rows = np.full(len(i), ~np.uint64(0))
    for p in range(int(y.size[j].max(initial=0))):
        hit = rows & where[base + letters[p]]
        rows = (rows + hit) | (rows - hit)
    return np.bitwise_count(~rows).astype(np.int32)


class Search:
    """The best of each name of x among the names of y, as far as it reaches the threshold: `best` and `rid`."""

    def __init__(self, x: Part, y: Part, threshold: float, of: Scorer):
        self.x, self.y, self.threshold, self.of = x, y, threshold, of
        self.best, self.rid = np.full(len(x.keys), float(threshold)), np.full(len(x.keys), -1, np.int64)
        self.met = self.bounded = self.scored = 0

    def bound(self, i: np.ndarray, j: np.ndarray, subsequence: np.ndarray | None = None) -> np.ndarray:
        """No pair scores higher."""
        x, y = self.x, self.y
        common = np.bitwise_count(x.marks[i] & y.marks[j]) + np.minimum(x.beyond[i], y.beyond[j])
        letters = common - np.minimum(x.spaces[i], y.spaces[j])
        shared = np.minimum(np.bitwise_count(x.tokens[i] & y.tokens[j]) + np.minimum(x.tokens_beyond[i], y.tokens_beyond[j]), np.minimum(x.n_tokens[i], y.n_tokens[j]))
        jaccard = shared / np.maximum(x.n_tokens[i] + y.n_tokens[j] - shared, 1)
        if subsequence is not None:
            common = np.minimum(common, subsequence)
        plain = np.where((x.plain[i] > 0) & (y.plain[j] > 0), 2.0 * letters / np.maximum(x.plain[i] + y.plain[j], 1), 1.0)
        ratio, by_jaccard, by_plain = self.of.parts
        return 100 * (ratio * 2.0 * common / np.maximum(x.size[i] + y.size[j], 1) + by_jaccard * jaccard + by_plain * np.minimum(plain, 1.0))

    def _least(self, size: int, n: int, once: bool, floor: float, tokens: int, sizes: np.ndarray, ns: np.ndarray, onces: np.ndarray) -> np.ndarray:
        """So many letters and spaces in common, and the shared tokens where up to all count (`tokens`), has any pair of these lengths,
        numbers of tokens and names without a repeated token that reaches the floor, if it shares at most so many tokens."""
        ratio, by_jaccard, by_plain = self.of.parts
        least, both, all_letters = np.full(len(sizes), np.inf), once & (onces > 0), np.maximum(size - n + 1 + sizes - ns + 1, 1)
        for shared in range(min(n, tokens) + 1):
            rest = floor / 100 - by_jaccard * shared / np.maximum(n + ns - shared, 1)
            need = (rest - by_plain) * (size + sizes) / (2 * ratio)
            # Letters without spaces are those in common less the spaces, so they give no more than that.
            by_both = (rest + by_plain * 2 * (np.minimum(n, ns) - 1) / all_letters) / (2 * ratio / (size + sizes) + 2 * by_plain / all_letters)
            need = np.where(both, np.maximum(need, by_both), need) + (shared if tokens > 1 else 0)
            least = np.where(shared <= ns, np.minimum(least, need), least)
        return np.clip(np.ceil(least - SLACK), 0, 255).astype(np.uint8)

    def _by_twos(self) -> None:
        """All pairs of names of few tokens that share two."""
        (mine, i), (theirs, j) = self.x.twos(), self.y.twos()
        start, end = np.searchsorted(theirs, mine), np.searchsorted(theirs, mine, "right")
        hit = np.flatnonzero(end > start)
        hit = hit[np.argsort(i[hit], kind="stable")]  # pairs of a name together, so that the best comes first
        i, start, n = i[hit], start[hit], (end - start)[hit]
        ends, at = np.cumsum(n), 0
        while at < len(n):
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)), at + 1)
            many = n[at:to]
            first = np.repeat(start[at:to] - (np.cumsum(many) - many), many)
            pairs = np.unique(np.repeat(i[at:to], many) * len(self.y.keys) + j[first + np.arange(len(first))])
            self._look(*np.divmod(pairs, len(self.y.keys)))
            at = to

    def run(self) -> None:
        self._by_twos()
        few = self.y.few
        for low, high in ((0, few), (few, len(self.y.keys))):
            for at in range(low, high, AT_ONCE):  # names of y in turn, so that they stay near the processor
                self._meet(at, min(at + AT_ONCE, high), self.x.few if low == 0 else 0)

    def _meet(self, at: int, end: int, few: int) -> None:
        """All x with some of y; the first of x and all of these have few tokens, and pairs that share two were seen."""
        x, some, n = self.x, slice(at, end), end - at
        bits, got, more, enough = (np.empty(n, t) for t in (np.uint64, np.uint8, np.uint8, bool))
        sizes, tokens, onces, far, hidden = (a.tolist() for a in (x.size, x.n_tokens, x.plain > 0, x.beyond, x.tokens_beyond))
        y = {f: getattr(self.y, f)[some] for f in _FIELDS}
        beyond, unmarked = (np.minimum(y[f], 255).astype(np.uint8) for f in ("beyond", "tokens_beyond"))
        kinds, which = np.unique(np.stack([y["size"], y["n_tokens"], y["plain"] > 0]), axis=1, return_inverse=True)
        high, known, pairs, held = int(y["size"].max()), {}, [], 0
        for i in range(len(sizes)):
            most = 1 if i < few else tokens[i]
            kind = (sizes[i], tokens[i], onces[i], max(self.threshold, math.floor(self.best[i])), most)
            if kind not in known:
                least = self._least(*kind, *kinds)
                # The shorter text has no more letters than it is long.
                known[kind] = least[which] if (least <= np.minimum(sizes[i], kinds[0]) + (most if most > 1 else 0)).any() else None
            least = known[kind]
            if least is None:
                continue
            self.met += n
            if sizes[i] > 100 or high > 100:  # a byte might not hold the sum
                j = np.arange(at, end)
            else:
                np.bitwise_count(np.bitwise_and(y["marks"], x.marks[i], out=bits), out=got)
                if far[i]:
                    np.add(got, np.minimum(beyond, np.uint8(far[i]), out=more), out=got)
                if most > 1:
                    np.add(got, np.bitwise_count(np.bitwise_and(y["tokens"], x.tokens[i], out=bits), out=more), out=got)
                    if hidden[i]:
                        np.add(got, np.minimum(unmarked, np.uint8(hidden[i]), out=more), out=got)
                j = np.flatnonzero(np.greater_equal(got, least, out=enough)) + at
            if len(j):
                pairs.append((i, j))
                held += len(j)
            if held >= PAIRS:
                self._look(np.repeat([i for i, _ in pairs], [len(j) for _, j in pairs]), np.concatenate([j for _, j in pairs]))
                pairs, held = [], 0
        if pairs:
            self._look(np.repeat([i for i, _ in pairs], [len(j) for _, j in pairs]), np.concatenate([j for _, j in pairs]))

    def _look(self, i: np.ndarray, j: np.ndarray) -> None:
        """Bounds of pairs, and the scores of those that may be better than the best so far."""
        keep = self.bound(i, j) >= self.best[i] - SLACK
        i, j = i[keep], j[keep]
        self.bounded += len(i)
        most, short = np.zeros(len(i)), self.x.short[i] & self.y.short[j]
        if short.any():
            most[short] = self.bound(i[short], j[short], subsequences(self.x, self.y, i[short], j[short]))
        if not short.all():
            most[~short] = self.bound(i[~short], j[~short])
        keep = most >= self.best[i] - SLACK
        i, j, most = i[keep], j[keep], most[keep]
        for k in np.lexsort((-most, i)):
            at, other = int(i[k]), int(j[k])
            if most[k] < self.best[at] - SLACK:
                continue
            self.scored += 1
            score, rid = self.of.one(self.x.keys[at], self.y.keys[other], self.best[at]), int(self.y.rid[other])
            if score > self.best[at] or (score == self.best[at] and (self.rid[at] < 0 or rid < self.rid[at])):
                self.best[at], self.rid[at] = score, rid


def _tokens_needed(of: Scorer, threshold: float, n: int, m: int) -> int:
    """So many tokens of n and m have any two names in common that reach the threshold."""
    ratio, by_jaccard, by_plain = of.parts
    jaccard = (threshold / 100 - ratio - by_plain) / by_jaccard
    return max(math.ceil(jaccard / (1 + jaccard) * (n + m) - SLACK), 0)


def token_keys(key: str, of: Scorer, threshold: float, others: list[int], left: bool) -> list[int]:
    """Names that have the tokens in common which the threshold asks for have one of these in common; `others` are numbers of tokens on the
    other side.  With the tokens in one order for all names, of `need` shared ones the first `q` are among the first of each name."""
    tokens = sorted((crc32(t.encode()), t) for t in set(key.split()))
    n, out = len(tokens), []
    for m in others:
        need = _tokens_needed(of, threshold, n, m)
        if 1 <= need <= min(n, m):
            q = max((q for q in range(2, min(3, need) + 1) if math.comb(max(n, m) - need + q, q) <= COMBINATIONS), default=1)
            pair = (n, m) if left else (m, n)
            out += [hash((*pair, *(crc for crc, _ in some))) for some in combinations(tokens[: n - need + q], q)]
    return out


def _reaches(threshold: float, of: Scorer) -> Column:
    """Of rows l_ and r_ of numbers: what `Search.bound` says, as a column."""
    l, r = ({f: F.col(f"{side}_{f}") for f in _FIELDS} for side in "lr")  # noqa: E741
    bits = lambda f, more: F.bit_count(l[f].bitwiseAND(r[f])) + F.least(l[more], r[more])
    common, shared = bits("marks", "beyond"), F.least(bits("tokens", "tokens_beyond"), l["n_tokens"], r["n_tokens"])
    plain = F.when((l["plain"] > 0) & (r["plain"] > 0), F.least(F.lit(1.0), 2.0 * (common - F.least(l["spaces"], r["spaces"])) / (l["plain"] + r["plain"]))).otherwise(1.0)
    ratio, by_jaccard, by_plain = of.parts
    return 100 * (ratio * 2.0 * common / (l["size"] + r["size"]) + by_jaccard * shared / (l["n_tokens"] + r["n_tokens"] - shared) + by_plain * plain) >= threshold - SLACK


def _best(scored: DataFrame) -> DataFrame:
    return scored.groupBy("x").agg(F.max(F.struct("score", (-F.col("r_rid")).alias("minus"))).alias("b"))


def _by_tokens(left: DataFrame, right: DataFrame, threshold: float, of: Scorer) -> DataFrame:
    """(x, b) down to a threshold that no pair reaches without tokens in common."""
    counts = [[r["n_tokens"] for r in df.select("n_tokens").distinct().collect()] for df in (left, right)]  # as many rows as there are numbers

    def keyed(df: DataFrame, side: str, others: list[int]) -> DataFrame:
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for keys in batches:
                yield pa.array([token_keys(k, of, threshold, others, side == "l") for k in keys.to_pylist()], pa.list_(pa.int64()))

        return df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns), F.explode(F.arrow_udf(run, "array<bigint>")("k")).alias(f"{side}_at"))

    l, r = keyed(left, "l", counts[1]), keyed(right, "r", counts[0])  # noqa: E741
    # Sizes are guessed from names, not from keys: without the hint a side might be sent to all machines.
    met = l.hint("merge").join(r, (F.col("l_at") == F.col("r_at")) & _reaches(threshold, of))
    pairs = met.select(F.col("l_k").alias("x"), F.col("r_k").alias("y"), F.col("r_r_rid").alias("r_rid")).distinct()
    scored = pairs.select("x", "r_rid", of.score(F.col("x"), F.col("y"), F.lit(float(threshold))).alias("score"))
    return _best(scored.where(F.col("score") >= threshold))


def _by_parts(left: DataFrame, right: DataFrame, threshold: float, of: Scorer) -> DataFrame:
    n, m, tasks = left.count(), right.count(), left.sparkSession.sparkContext.defaultParallelism
    rows = max(-(-n // LEFT), 1)
    columns = max(-(-m // RIGHT), min(-(-n * m // TASK), -(-3 * tasks // rows)), 1)
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dealt = lambda parts: F.pmod(F.xxhash64("k"), F.lit(parts)).cast("int")
    left = left.withColumn("column", every(columns)).withColumn("part", dealt(rows) * columns + F.col("column")).drop("column")
    right = right.withColumn("row", every(rows)).withColumn("part", F.col("row") * columns + dealt(columns)).drop("row")

    def search(xs: pa.Table, ys: pa.Table) -> pa.Table:
        found = []
        if xs.num_rows and ys.num_rows:
            made = Search(Part(xs), Part(ys), threshold, of)
            made.run()
            found = [row for row in zip(made.x.keys, made.best.tolist(), made.rid.tolist(), strict=True) if row[2] >= 0]
        return pa.table({c: pa.array([row[i] for row in found], t) for i, (c, t) in enumerate({"x": pa.string(), "score": pa.float64(), "r_rid": pa.int64()}.items())})

    # A number of partitions that is given is not made less, however few bytes they have.
    many = min(2 * rows * columns, 100_000)
    pairs = left.repartition(many, "part").groupBy("part").cogroup(right.repartition(many, "part").groupBy("part"))
    return _best(pairs.applyInArrow(search, "x string, score double, r_rid bigint"))


def best_by_parts(a: DataFrame, b: DataFrame, threshold: float, of: Scorer) -> DataFrame:
    """(x, b): the best of each name `x` among (y, r_rid) that reaches the threshold, as struct(score, minus the r_rid).

    Scores that ask for tokens in common are searched by these; names that found such a partner have their best and go no further."""
    # Names are few bytes and much work, so they are dealt to all cores.
    tasks = 2 * a.sparkSession.sparkContext.defaultParallelism
    fields = [F.col(f"f.{f}").alias(f) for f in _FIELDS]

    def numbered(df: DataFrame, k: str, *more: str) -> DataFrame:
        return written(df.repartition(tasks, k).select(F.col(k).alias("k"), *more, F.arrow_udf(_numbered, _DDL)(F.col(k)).alias("f")).select("k", *more, *fields), "numbered")

    waiting, right = numbered(a.select("x"), "x"), numbered(b.select("y", "r_rid"), "y", "r_rid")
    found = []
    for share in LEVELS:
        level = max(share * (of.top or 100.0), threshold)
        if _tokens_needed(of, level, 1, 1) < 1:
            break
        best = _by_tokens(waiting, right, level, of)
        if level == threshold:
            return reduce(DataFrame.unionByName, [*found, best])
        found.append(written(best, "found"))
        waiting = written(waiting.join(found[-1].select(F.col("x").alias("k")), "k", "left_anti"), "waiting")
    return reduce(DataFrame.unionByName, [*found, _by_parts(waiting, right, threshold, of)])
