"""Search for the most similar name, through an index of letters and tokens (JOIN-06, and the best names of DIA-01 to 04).

A pair of names that reaches a threshold has many letters in common: how many at least follows from the scorer
(`Scorer.least_dice`) and from the two lengths.  So, with the letters of all names sorted from rare to frequent, two such
names have some of their first letters in common.  Names meet only if they share an index key:

- letters: the lengths of both names (in classes) and a combination of rare letters; for pairs of any tokens, as far as
  they reach the threshold without a bonus for shared tokens;
- one token: the token, the lengths and one rare letter of the rest; for pairs that share exactly one;
- two tokens: the same with both, for pairs that share exactly two;
- three tokens: for pairs that share more.

What meets is dropped, in the JVM, if its bound is below the threshold; what remains is scored.  No pair that reaches
the threshold is lost, whatever the lengths or the number of names; how many letters a combination has only shifts work
from pairs to keys.  Where the threshold is so low that letters tell too little, names are dealt out in blocks instead and
meet their bound.

The best is searched with falling thresholds, down to the one that is given.  A name that has found a partner at some
threshold has found its best, since all that score as high were seen; the others go on, each round with what is left, and
names of lengths that none of them can match make no keys.  Without a threshold the last ones meet every name in blocks, and
only pairs whose bound is above a score already found are scored.

With a threshold and a scorer that rests on a common subsequence, the search is that of `parts` instead.

Keys are hashes: two that fall together cost a look, never a result.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import OCCURRENCES, WORDS, Scorer, bag, common, distinct_text, features, letter_bits, scorer
from ..functions.text import key_relaxed
from ..session import written
from .parts import best_by_parts

#: Keys of one class of lengths at most, unless single letters give more; letters of a combination at most.
COMBINATIONS, LETTERS = 64, 16
#: Below this share of common letters blocks are cheaper than keys.  A matter of cost alone.
INDEX_DICE = 0.8
#: Thresholds of a search above its own, as shares of the scorer's top.
FALLING = (0.95, 0.9, 0.8, 0.7)
#: Lengths up to this have classes of their own; beyond, a class is as wide as a factor.
SINGLE, FACTOR = 16, 1.06
BLOCKS = 16
#: Pairs that are scored to find the floor of a name.
SEEDS = 8
SLACK = 1e-9


def _class(size: int) -> int:
    return size if size <= SINGLE else SINGLE + int(math.log(size / SINGLE) / math.log(FACTOR) + SLACK)


@lru_cache(maxsize=4096)
def _limits(of: int) -> tuple[int, int]:
    """The least and greatest length of a class; (1, 0) if no length falls into it."""
    if of <= SINGLE:
        return of, of
    at = max(SINGLE, int(SINGLE * FACTOR ** (of - SINGLE)) - 2)
    while _class(at) < of:
        at += 1
    low = at
    while _class(at) == of:
        at += 1
    return (low, at - 1) if at > low else (1, 0)


def _whole(x: float) -> int:
    return math.ceil(x - SLACK)


def _key(kind: int, *parts: int) -> int:
    """A hash whose two lowest bits are the kind; of whole numbers it is the same in every process."""
    return hash((kind, *parts)) >> 2 << 2 | kind


class _Keys:
    """The index keys of names for one scorer and threshold.  `order` ranks (letter, occurrence), rare ones first; `classes`
    are those of the other side's lengths."""

    def __init__(self, of: Scorer, threshold: float, order: dict[tuple[int, int], int], classes: frozenset[int]):
        self.of, self.order, self.classes = of, order, classes
        self.need = lru_cache(maxsize=1024)(lambda jaccard: min(1.0, of.least_dice(threshold, jaccard)))
        self.tokens_help = self.need(1.0) < self.need(0.0) - SLACK
        self.size_of = lru_cache(maxsize=65_536)(self._size)

    def _ranked(self, letters: list[tuple[int, int]]) -> list[int]:
        """Numbers of the letters of a bag, rare ones first; the same letter has the same number in every name."""
        most = len(self.order)
        place = lambda e: (self.order.get((e[0], min(e[1], OCCURRENCES)), most), e[1], e[0])
        return [(k + 1) << 24 | n for k, n in sorted(letters, key=place)]

    def _partners(self, size: int, dice: float) -> Iterator[tuple[int, int]]:
        """(class of the partner's length, letters in common at least) for all lengths that can reach the share."""
        low, high = _whole(dice * size / (2 - dice)), math.floor(size * (2 - dice) / dice + SLACK)
        for c in range(_class(max(low, 1)), _class(max(high, 1)) + 1):
            least, most = _limits(c)
            if most >= least and most >= low and c in self.classes:
                yield c, _whole(dice * (size + max(least, low)) / 2)

    def _size(self, a: int, b: int, dice: float) -> int:
        """How many letters a combination has, from the classes of both lengths alone, so that both names say the same."""
        (low_a, high_a), (low_b, high_b) = _limits(a), _limits(b)
        least = _whole(dice * (low_a + low_b) / 2)
        spare, best = max(max(high_a, high_b) - least, 0), 1
        for n in range(2, min(LETTERS, least) + 1):
            if math.comb(spare + n, n) <= COMBINATIONS:
                best = n
        return best

    def of_name(self, key: str, left: bool) -> list[int]:
        text = distinct_text(key) if self.of.on_distinct else key
        out, size, mine = [], len(text), _class(len(text))
        pair = (lambda c: (mine, c)) if left else (lambda c: (c, mine))
        letters, dice = self._ranked(bag(text)), self.need(0.0)
        for c, least in self._partners(size, dice):
            n = self.size_of(min(mine, c), max(mine, c), dice)
            for some in combinations(letters[: max(0, size - least + n)], n):
                out.append(_key(0, *pair(c), *some))
        if not self.tokens_help:
            return out
        tokens = sorted(set(key.split()))
        number = {t: crc32(t.encode()) for t in tokens}
        free = self.need(1.0) <= 0  # then letters may tell nothing on one side, so they are in no key
        for n in (1, 2):
            dice = self.need(min(1.0, n / len(tokens)))
            for some in combinations(tokens, n):
                numbers = [number[t] for t in some]
                if free:
                    out.append(_key(n, *numbers))
                    continue
                rest = self._ranked(_without(text, some))
                for c, least in self._partners(size, dice):
                    least -= sum(len(t) + 1 for t in some)
                    if least <= 0:
                        out.append(_key(n, *pair(c), *numbers))
                    for letter in rest[: max(0, len(rest) - max(least, 1) + 1)]:
                        out.append(_key(n, *pair(c), *numbers, letter))
        out += [_key(3, *(number[t] for t in some)) for some in combinations(tokens, 3)]
        return out


def _without(text: str, tokens: tuple[str, ...]) -> list[tuple[int, int]]:
    """The bag of a text less some tokens and a space beside each."""
    left = Counter(text)
    for token in tokens:
        left.subtract(token)
        left.subtract(" ")
    return bag("".join(c * n for c, n in left.items()))


def _order(a: DataFrame, b: DataFrame, of: Scorer) -> tuple[dict[tuple[int, int], int], frozenset[int], frozenset[int]]:
    """(letter, occurrence) by how many names have it, and the classes of both sides' lengths: a row for each, so a few
    hundred."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, side in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = distinct_text(key) if of.on_distinct else key
                held.update((k, n) for k, n in bag(text) if n <= OCCURRENCES)
                held[side, _class(len(text))] += 1
        rows = sorted(held.items())
        yield pa.RecordBatch.from_arrays([pa.array([r[0][i] for r in rows], pa.int32()) for i in (0, 1)] + [pa.array([r[1] for r in rows], pa.int64())], ["k", "n", "names"])

    both = a.select("x", F.lit(-2)).union(b.select("y", F.lit(-3)))  # letters are from -1
    counted = both.mapInArrow(count, "k int, n int, names bigint").groupBy("k", "n").agg(F.sum("names").alias("names")).collect()
    letters = sorted((r for r in counted if r["k"] >= -1), key=lambda r: (r["names"], r["k"], r["n"]))
    classes = (frozenset(r["n"] for r in counted if r["k"] == side) for side in (-2, -3))
    return {(r["k"], r["n"]): i for i, r in enumerate(letters)}, *classes


_SMALL = pa.struct([("keys", pa.list_(pa.int64())), *((f"l{i}", pa.int64()) for i in range(WORDS)), ("beyond", pa.int64()), ("spaces", pa.int64()), ("size", pa.int64()), ("tokens", pa.int64())])
_SMALL_DDL = "struct<keys:array<bigint>," + ",".join(f"{f.name}:bigint" for f in list(_SMALL)[1:]) + ">"


def _indexed(names: DataFrame, column: str, side: str, of: Scorer, threshold: float, order: dict[tuple[int, int], int], classes: frozenset[int]) -> DataFrame:
    """A row for each index key `at` of each name: a hash of the name, and its letters in a few numbers.

    The two lowest bits of a key are its kind."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = _Keys(of, threshold, order, classes)
        for batch in batches:
            keys, ends, rows = array("q"), array("i", [0]), []
            for k in batch.to_pylist():
                text = distinct_text(k) if of.on_distinct else k
                keys.extend(made.of_name(k, side == "x"))
                ends.append(len(keys))
                rows.append([*letter_bits(text), len(text), len(set(k.split()))])
            columns = list(zip(*rows, strict=True)) or [()] * (len(_SMALL) - 1)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], fields=list(_SMALL))

    small = names.select(F.xxhash64(column).alias("id"), F.arrow_udf(run, _SMALL_DDL)(F.col(column)).alias("s"))
    held = [F.col(f"s.{f.name}").alias(f"{side}_{f.name}") for f in list(_SMALL)[1:]]
    return small.select(F.col("id").alias(f"{side}_id"), *held, F.explode("s.keys").alias(f"{side}_at"))


def met(a: DataFrame, b: DataFrame, threshold: float, of: Scorer) -> DataFrame:
    """(x_id, y_id), hashes of names that share an index key and enough letters; a pair may come several times."""
    # Names are few bytes and much work, so they are dealt to all cores.
    tasks = 2 * a.sparkSession.sparkContext.defaultParallelism
    a, b = a.repartition(tasks, "x"), b.repartition(tasks, "y")
    order, of_a, of_b = _order(a, b, of)
    x, y = _indexed(a, "x", "x", of, threshold, order, of_b), _indexed(b, "y", "y", of, threshold, order, of_a)
    need = lambda jaccard: float(min(1.0, of.least_dice(threshold, jaccard)))
    letters = F.least("x_beyond", "y_beyond") + F.least("x_spaces", "y_spaces")
    for i in range(WORDS):
        letters = letters + F.bit_count(F.col(f"x_l{i}").bitwiseAND(F.col(f"y_l{i}")))
    # With one or two tokens in common the index of the tokens is known from their number.
    by_union = lambda shared: F.get(F.array(*(F.lit(need(min(1.0, shared / n))) for n in range(1, 33))), F.least(F.col("x_tokens") + F.col("y_tokens") - shared - 1, F.lit(31)).cast("int"))
    kind = F.col("x_at").bitwiseAND(F.lit(3))
    least = F.when(kind == 0, need(0.0)).when(kind == 1, by_union(1)).when(kind == 2, F.coalesce(by_union(2), F.lit(need(1.0)))).otherwise(need(1.0))
    enough = 2.0 * letters >= least * (F.col("x_size") + F.col("y_size")) - SLACK
    # Sizes are guessed from names, not from keys: without the hint a side might be sent to all machines.
    return x.hint("merge").join(y, (F.col("x_at") == F.col("y_at")) & enough).select("x_id", "y_id")


def likely_pairs(a: DataFrame, b: DataFrame, threshold: float, backend: str | Scorer) -> DataFrame:
    """The pairs (x, y) whose bound reaches the threshold, each once, with the other columns of both sides."""
    of = scorer(backend)
    fa, fb = a.withColumn("fx", features(F.col("x"))), b.withColumn("fy", features(F.col("y")))
    if of.least_dice(threshold, 0.0) < INDEX_DICE:
        return _blocks(fa, fb, where=_reaches(of, threshold)).drop("fx", "fy")
    pairs = met(a.select("x"), b.select("y"), threshold, of).distinct()
    both = pairs.join(fa.withColumn("x_id", F.xxhash64("x")), "x_id").join(fb.withColumn("y_id", F.xxhash64("y")), "y_id")
    return both.where(_reaches(of, threshold)).drop("fx", "fy", "x_id", "y_id")


def _reaches(of: Scorer, threshold: Column | float) -> Column:
    return of.bound(common(F.col("fx"), F.col("fy"))) >= threshold - SLACK


def _blocks(a: DataFrame, b: DataFrame, blocks: int = BLOCKS, where: Column | None = None) -> DataFrame:
    """Each row of one side with each of the other, as far as a condition holds, by an equi-join on a square of blocks."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = a.withColumn("row", F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int")).withColumn("col", every)
    right = b.withColumn("col", F.pmod(F.xxhash64("y"), F.lit(blocks)).cast("int")).withColumn("row", every)
    right = right.withColumnsRenamed({"row": "row_", "col": "col_"})
    on = (F.col("row") == F.col("row_")) & (F.col("col") == F.col("col_"))
    return left.join(right, on if where is None else on & where).drop("row", "col", "row_", "col_")


def _best(scored: DataFrame) -> DataFrame:
    """(x, b): the highest score of each name, of equal ones the least r_rid."""
    return scored.groupBy("x").agg(F.max(F.struct("score", (-F.col("r_rid")).alias("minus"))).alias("b"))


def _at_least(a: DataFrame, b: DataFrame, threshold: float, of: Scorer) -> DataFrame:
    pairs = likely_pairs(a, b, threshold, of)
    scored = pairs.select("x", "r_rid", of.score(F.col("x"), F.col("y"), F.lit(float(threshold))).alias("score"))
    return _best(scored.where(F.col("score") >= threshold))


def _of_all(a: DataFrame, b: DataFrame, of: Scorer) -> DataFrame:
    """The best of each name without a threshold, for names that no index has helped.

    Of each of SEEDS shares of the other side the pair with the highest bound is scored; the best of these scores is the
    floor of its name, and only pairs whose bound is no lower than that are scored as well."""
    fa, fb = a.select("x").withColumn("fx", features(F.col("x"))), b.select("y", "r_rid").withColumn("fy", features(F.col("y")))
    fa, fb = written(fa, "features"), written(fb, "features")
    bound = of.bound(common(F.col("fx"), F.col("fy"))).cast("double")
    # Numbers alone are aggregated by hashing; texts would be sorted, all pairs of them.
    seeds = _blocks(fa, fb).groupBy("x", F.pmod("r_rid", F.lit(SEEDS)).alias("share")).agg(F.max_by("r_rid", bound).alias("r_rid"))
    scored = seeds.join(b.select("y", "r_rid"), "r_rid").select("x", of.score(F.col("x"), F.col("y"), F.lit(0.0)).alias("score"))
    floors = written(scored.groupBy("x").agg(F.max("score").alias("floor")), "floors")
    rest = _blocks(fa.join(floors, "x"), fb, where=_reaches(of, F.col("floor")))
    return _best(rest.select("x", "r_rid", of.score(F.col("x"), F.col("y"), F.col("floor")).alias("score")))


def best_names(a: DataFrame, b: DataFrame, threshold: float | None, of: Scorer) -> DataFrame:
    """(x, b) for distinct names `x` of one side and distinct names with their first rows (y, r_rid) of the other; b is
    struct(score, minus the r_rid)."""
    if of.top is None:
        equal, rest = None, a
    else:
        equal = a.join(b, F.col("x") == F.col("y")).select("x", F.struct(F.lit(of.top).alias("score"), (-F.col("r_rid")).alias("minus")).alias("b"))
        rest = a.join(b.select(F.col("y").alias("x")), "x", "left_anti")
        if threshold is not None and threshold > of.top:
            return equal.limit(0)
    found, waiting = [] if equal is None else [equal], written(rest, "waiting")
    if of.parts is not None and threshold is not None:
        return reduce(DataFrame.unionByName, [*found, best_by_parts(waiting, b, threshold, of)])
    for share in FALLING:
        level = share * (of.top or 100.0)
        if of.least_dice(level, 0.0) < INDEX_DICE or (threshold is not None and level <= threshold) or waiting.isEmpty():
            break
        found.append(written(_at_least(waiting, b, level, of), "found"))
        waiting = written(waiting.join(found[-1], "x", "left_anti"), "waiting")
    last = _of_all(waiting, b, of) if threshold is None else _at_least(waiting, b, threshold, of)
    return reduce(DataFrame.unionByName, [*found, last])


def fuzzy_best(left: DataFrame, right: DataFrame, name: str = "name", threshold: float | None = None, backend: str | Scorer = "difflib") -> DataFrame:
    """(l_rid, r_rid, score): the right row of the most similar name, of equally similar ones the first (JOIN-06).

    Distinct names are searched, not rows.  Names without a key match nothing."""
    # Keys are made once: the search reads them several times.
    keyed = lambda df: written(df.select("rid", key_relaxed(F.col(name)).alias("k")).where("k <> ''"), "keys")
    a, b = keyed(left), keyed(right)
    names = written(b.groupBy(F.col("k").alias("y")).agg(F.min("rid").alias("r_rid")), "names")
    best = best_names(a.select(F.col("k").alias("x")).distinct(), names, threshold, scorer(backend))
    return a.join(best, F.col("k") == F.col("x")).select(F.col("rid").alias("l_rid"), (-F.col("b.minus")).alias("r_rid"), F.col("b.score").alias("score"))
