"""The search by parts of both sides, and the openings that it is asked for."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitelace import catalog
from sitelace.functions import text
from sitelace.functions.fuzzy import DIFFLIB, score_keys
from sitelace.operators import alike, parts

SYLLABLES = ["san", "el", "rio", "ta", "lo", "th", "ion", "s", "9", "ka"]
ODD = ["a", "a a a", "b a b", "aaaaaaaaaaaaaaaa", "san", "san san", "b c d e f g h i j k", "b c d e f g h i j z", "9 9", "x" * 400, "x" * 90, "san " * 60 + "jo", "san " * 59 + "joe",
       "ñ ß 大", "q z q z j", "-3 _ %", " ".join("abcdefghijklmnop"), " ".join(f"rio{i}" for i in range(60)), " ".join(f"rio{i}" for i in range(1, 61))]


def names(r: random.Random, n: int) -> list[str]:
    word = lambda: "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3)))
    some = [" ".join(word() for _ in range(r.choice([1, 2, 3, 4, 4, 4, 5]))) for _ in range(n // 2)]
    return sorted({*some, *(x[:2] + x[3:] for x in some if len(x) > 3), *map(str.strip, ODD)})


def part(keys: list[str], rids: bool = False) -> parts.Part:
    rows = [parts.of_key(k) for k in keys]
    columns = {"k": keys} | {f: [r[i] for r in rows] for i, f in enumerate(parts._FIELDS)} | ({"r_rid": list(range(len(keys)))[::-1]} if rids else {})
    return parts.Part(pa.table(columns))


@pytest.mark.parametrize("threshold", [30.0, 65.0, 80.0])
def test_parts_lose_no_best(monkeypatch, threshold):
    """Scores and rows are those of every pair scored, also across batches."""
    monkeypatch.setattr(parts, "AT_ONCE", 50)
    monkeypatch.setattr(parts, "PAIRS", 64)
    r = random.Random(3)
    xs, ys = names(r, 160), names(r, 160) + [x + "q" for x in names(r, 20)[:5]]
    found = parts.Search(part(xs), part(ys, rids=True), threshold, DIFFLIB)
    found.run()
    got = {k: (s, rid) for k, s, rid in zip(found.x.keys, found.best, found.rid, strict=True) if rid >= 0}
    want = {}
    for x in xs:
        score, minus = max((score_keys(x, y), j - len(ys) + 1) for j, y in enumerate(ys))
        if score >= threshold:
            want[x] = (score, -minus)
    assert got == want
    assert found.scored < 0.5 * len(xs) * len(ys) or threshold < 65


def test_bounds_of_parts_hold():
    r = random.Random(4)
    xs, ys = part(names(r, 80)), part(names(r, 80), rids=True)
    i, j = (a.ravel() for a in np.meshgrid(np.flatnonzero(xs.short), np.flatnonzero(ys.short), indexing="ij"))
    search = parts.Search(xs, ys, 65.0, DIFFLIB)
    loose, close = search.bound(i, j), search.bound(i, j, parts.subsequences(xs, ys, i, j))
    scores = np.array([score_keys(xs.keys[a], ys.keys[b]) for a, b in zip(i, j, strict=True)])
    assert (scores <= close + 1e-9).all() and (close <= loose + 1e-9).all()


@pytest.mark.parametrize("level", [76.0, 81.0, 88.0])
def test_names_that_need_tokens_share_a_key(level):
    r = random.Random(5)
    xs, ys = names(r, 120), names(r, 120)
    counts = [sorted({len(set(k.split())) for k in side}) for side in (xs, ys)]
    left = {x: set(parts.token_keys(x, DIFFLIB, level, counts[1], True)) for x in xs}
    right = {y: set(parts.token_keys(y, DIFFLIB, level, counts[0], False)) for y in ys}
    pairs = [(x, y) for x in xs for y in ys if score_keys(x, y, floor=level) >= level]
    assert len(pairs) > 10 and all(left[x] & right[y] for x, y in pairs)
    assert max(map(len, left.values())) < 3000


@pytest.mark.parametrize("threshold", [65.0, 84.0])
def test_best_by_parts_on_spark(spark, monkeypatch, threshold):
    """The composite search makes no index of letters: of 20,000 names that took 520 keys a name; parts are of a bounded size."""
    monkeypatch.setattr(parts, "LEFT", 40)
    monkeypatch.setattr(parts, "RIGHT", 30)
    monkeypatch.setattr(alike, "met", lambda *_: pytest.fail("names met on letters"))
    r = random.Random(6)
    xs, ys = names(r, 120), names(r, 120)
    left = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "rid bigint, name string")
    right = spark.createDataFrame([(i, y) for i, y in enumerate(ys)] + [(990, ys[0])], "rid bigint, name string")
    keys = [{row["rid"]: row["k"] for row in df.select("rid", text.key_relaxed(F.col("name")).alias("k")).collect()} for df in (left, right)]
    got = {row["l_rid"]: (row["r_rid"], row["score"]) for row in alike.fuzzy_best(left, right, threshold=threshold).collect()}
    want = {}
    for i, x in keys[0].items():
        score, minus = max((score_keys(x, y), -j) for j, y in keys[1].items() if y) if x else (0.0, 0)
        if score >= threshold:
            want[i] = (-minus, pytest.approx(score, abs=1e-9))
    assert got == want


def test_first_words_are_those_of_the_whole_text(spark):
    """Also where words are longer than the head, or few, or marks and letters that fold to several stand at its end."""
    r = random.Random(7)
    pieces = ["a", "Éa", "é", "...", "ﬁ", "İx", "…", " ", "\n", "\t", " ", " ", "한", "大", "ß", "b1", "-", "word", "Σας", "™", "​", "", "x" * 70, "(c)"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 60))) for _ in range(400)] + [None, "", " " * 300 + "a b c d e f", "a " * 300, "x" * 500 + " b c d", "a b c d" + "e" * 300 + " f g", "a b c " + "d" * 193 + "́ e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.split(text.key_relaxed(F.coalesce("t", F.lit(""))), " ")
    for row in df.select("t", catalog.first_words(F.col("t")).alias("got"), F.trim(F.array_join(F.slice(words, 1, 4), " ")).alias("want")).collect():
        assert row["got"] == row["want"], row["t"]
