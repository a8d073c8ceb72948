"""Truth tables and plain models of column functions."""

import math
import functools
import random
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F
from sitelace.functions import fuzzy, geo, parse, text
from sitelace.operators import alike


def values(spark, f, xs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


KEYS = {
    "Subestación Santa Rosa II 115 kV": "santa rosa 2", "S/E SAN CARLOS - ANTIOQUIA": "s e san carlos", "Ocaña-Cuestecitas": "ocana",
    "Torca Norte (Bogotá) 34.5kV": "torca n", "LA LOMA 34,5 kV": "loma 34", "San San Juan San": "san juan san", "Sto. Domingo V": "san domingo 5",
    "Nueva--Esperanza 500 / kV": "nueva", "de la": "", "El Río, Córdoba": "rio", "1150 kV Alfa": "1150 kv alfa", None: "", "": "",
}


def test_station_keys(spark):
    assert values(spark, text.key_station_plus, list(KEYS)) == list(KEYS.values())


def test_keys_are_stable(spark):
    once = values(spark, text.key_relaxed, list(KEYS))
    assert values(spark, text.key_relaxed, once) == once


def test_voltage_is_stripped(spark):
    cases = {"Subestación Santa Rosa II 115 kV": "Subestación Santa Rosa II", "LA LOMA 34,5 kV": "LA LOMA 34,", "1150 kV Alfa": "1150 kV Alfa", "Nueva--Esperanza 500 / kV": "Nueva--Esperanza", None: ""}
    assert values(spark, text.strip_voltage, list(cases)) == list(cases.values())


def test_accents(spark):
    xs = ["Ñandú ÀÉÎõü ç", "ﬁn º½ ²", "é", "ŁØß", None, "ＡＢ"]
    assert values(spark, text.strip_accents, xs) == values(spark, text.strip_accents_exact, xs)


def test_strip_accents_on_every_code_point(spark):
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    xs = ["".join(points[i : i + 509]) for i in range(0, len(points), 509)] + [None, "", "한글 Ñandú ﬁn ㈱ x́", "é" * 50_000 + "각"]
    assert values(spark, text.strip_accents, xs) == [text.folded(x or "") for x in xs]


def test_names(spark):
    cases = {"  a​  b\x01 ": "a b", "NaN": "", "(Sin Nombre)": "", "--": "", "﻿X": "X", "é": "é", None: "", "a\nb": "a\nb"}
    assert values(spark, text.clean_name, list(cases)) == list(cases.values())


def test_numerals(spark):
    assert values(spark, text.roman_to_arabic, ["iv", "XV", "xvi", "a"]) == ["4", "15", "xvi", "a"]
    assert values(spark, text.arabic_to_roman, ["4", "15", "16", "a"]) == ["IV", "XV", "16", "a"]


def test_coordinates_as_text(spark):
    assert values(spark, lambda c: text.format_coordinate(c, ";"), [1.5, None, float("nan"), -74.0000004], "double") == ["1,500000", "", "", "-74,000000"]
    assert values(spark, text.format_coordinate, ["1.25", "abc", None]) == ["1.250000", "abc", ""]


def test_voltages(spark):
    cases = {"230": 230, "230000": 230, "110;220": 220, "500 kV": 500, "34.5": 34, "34,5": 34, "35.5": 36, "115000;34500": 115, "999": 999, "1000": 1, "-": None, None: None}
    assert values(spark, parse.parse_voltage, list(cases)) == list(cases.values())
    assert values(spark, parse.max_kv, ["115000;34500", "1;x", None, "230000"]) == [115.0, 0.0, 0.0, 230.0]


def test_floats(spark):
    assert values(spark, parse.robust_float, ["1,5", " 7.25° N", "", None, "x", "-3e2", "1_0"]) == [1.5, 7.25, None, None, None, -300.0, 1.0]


def test_blanks(spark):
    assert values(spark, parse.blank_to_null, [" ", " ", "a", "", None]) == [None, None, "a", None, None]


def test_distances(spark):
    r = random.Random(1)
    rows = [(r.uniform(-90, 90), r.uniform(-180, 180), r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(200)] + [(0.0, 0.0, 0.0, 180.0), (5.0, 5.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for row in df.select("*", geo.haversine_m(*map(F.col, "abcd")).alias("x"), geo.haversine_asin_m(*map(F.col, "abcd")).alias("y")).collect():
        p, q = math.radians(row.a), math.radians(row.c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(row.d - row.b) / 2) ** 2
        want = 2 * 6371000 * math.asin(min(1, math.sqrt(h)))
        assert abs(row.x - want) < 1 and abs(row.y - want) < 1


SCORES = {("San Carlos", "San Carlos"): 90.0, ("San Carlos", "Carlos San"): 86.6667, ("San Carlos", "San Marcos"): 64.7778, ("Nueva Esperanza", "NuevaEsperanza"): 50.3448, ("", "x"): 0.0}


def test_difflib_scores(spark):
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(SCORES)], "i int, a string, b string")
    got = [r["s"] for r in df.select("i", fuzzy.fuzzy_score(text.key_relaxed(F.col("a")), text.key_relaxed(F.col("b"))).alias("s")).orderBy("i").collect()]
    assert [round(x, 4) for x in got] == list(SCORES.values())


def words(r):
    return " ".join("".join(r.choice("abcd") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 4)))


def test_indel_ratio_is_lcs():
    r = random.Random(2)
    for _ in range(300):
        a, b = words(r), words(r)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert fuzzy.lcs(a, b) == best[-1][-1]
        short, long = sorted((a, b), key=len)
        windows = [long[max(0, s) : s + len(short)] for s in range(1 - len(short), len(long))]
        if len(a) != len(b):
            assert fuzzy.partial_ratio(a, b) == max(fuzzy.ratio(short, w) for w in windows)


def test_jaro_winkler_equals_sql():
    r, db = random.Random(3), duckdb.connect()
    for _ in range(200):
        a, b = words(r), words(r)
        assert fuzzy.jaro_winkler(a, b) == pytest.approx(db.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0], abs=1e-9)


def invented(r, n):
    syllables = ["to", "rca", "me", "llo", "ba", "rran", "gui", "lla", "san", "car", "los", "chi", "vor", "gua", "vio", "po", "pa", "yan"]
    return [" ".join("".join(r.choice(syllables) for _ in range(r.randint(2, 4))) for _ in range(r.randint(1, 3))) for _ in range(n)]


ODD_NAMES = ["a", "a a a", "aaaaaaaaaaaaaaaa", "san", "san san", "b c d e f g h", "9 9", "x" * 400, "san " * 60 + "jo", "san " * 59 + "joe"]
THIRD = fuzzy.Scorer("first_letter", lambda a, b, floor: F.when(a[0:1] == b[0:1], 70.0).otherwise(20.0), lambda c: F.lit(70.0), lambda threshold, jaccard: 0.0)


def brute_score(x, y, of):
    if of is fuzzy.EDITS:
        row = list(range(len(y) + 1))
        for i, c in enumerate(x):
            row = functools.reduce(lambda out, j: [*out, min(row[j] + 1, out[-1] + 1, row[j - 1] + (c != y[j - 1]))], range(1, len(y) + 1), [i + 1])
        return 100.0 * (max(len(x), len(y)) - row[-1]) / max(len(x), len(y))
    if of is THIRD:
        return 70.0 if x[0] == y[0] else 20.0
    return fuzzy.score_keys(x, y, of.name)


@pytest.mark.parametrize(("of", "threshold"), [(fuzzy.DIFFLIB, 65), (fuzzy.DIFFLIB, 80), (fuzzy.INDEL, 70), (fuzzy.INDEL, 85), (fuzzy.EDITS, 75), (fuzzy.EDITS, 85), (fuzzy.EDITS, 50)], ids=lambda v: getattr(v, "name", v))
def test_index_loses_no_pair(spark, of, threshold):
    """Of 200 x 200 invented names; none that scores enough is lost, and pairs come once."""
    r = random.Random(5)
    xs, ys = sorted({*invented(r, 190), *ODD_NAMES}), sorted({*invented(r, 190), *ODD_NAMES})
    ys += sorted({x[:-1] + "z" for x in xs[:9]} - set(ys))
    pairs = alike.likely_pairs(spark.createDataFrame([(x.strip(),) for x in xs], "x string"), spark.createDataFrame([(y.strip(),) for y in ys], "y string"), threshold, of)
    rows = [tuple(p) for p in pairs.select("x", "y").collect()]
    kept = set(rows)
    some = [*ODD_NAMES, *xs[::3]]
    assert len(kept) == len(rows)
    assert all((x.strip(), y.strip()) in kept for x in some for y in ys if brute_score(x.strip(), y.strip(), of) >= threshold)


@pytest.mark.parametrize("of", [fuzzy.DIFFLIB, fuzzy.EDITS, THIRD], ids=lambda s: s.name)
@pytest.mark.parametrize("threshold", [None, 65.0])
def test_best_names_equal_brute_force(spark, of, threshold):
    """Also for a scorer of one's own, of which nothing but the score is known."""
    r = random.Random(6)
    xs, ys = invented(r, 60) + ODD_NAMES[:7], invented(r, 60) + ODD_NAMES[2:9]
    left = spark.createDataFrame([(i, x) for i, x in enumerate(xs)] + [(900, None), (901, " ")], "rid bigint, name string")
    right = spark.createDataFrame([(i, y) for i, y in enumerate(ys)] + [(990, ys[0]), (991, None)], "rid bigint, name string")
    got = {row["l_rid"]: (row["r_rid"], round(row["score"], 6)) for row in alike.fuzzy_best(left, right, threshold=threshold, backend=of).collect()}
    want = {}
    for i, x in enumerate(xs):
        score, j = max((round(brute_score(x, y.strip(), of), 6), -j) for j, y in enumerate(ys))
        if threshold is None or score >= threshold:
            want[i] = (-j, score)
    assert got == want


def test_few_names_meet_and_fewer_are_scored(spark):
    """Of 3,000 by 3,000 names at the threshold of the first linking stage, without a cross product."""
    r = random.Random(7)
    xs, ys = sorted(set(invented(r, 3000))), sorted(set(invented(r, 3000)))
    a, b = spark.createDataFrame([(x,) for x in xs], "x string"), spark.createDataFrame([(y,) for y in ys], "y string")
    pairs = alike.likely_pairs(a, b, 65.0, "difflib")
    plan = pairs._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert pairs.count() < 0.01 * len(xs) * len(ys)
    assert alike.met(a, b, 65.0, fuzzy.DIFFLIB).distinct().count() < 0.02 * len(xs) * len(ys)


@pytest.mark.parametrize("backend", ["difflib", "indel", "edits"])
def test_bound_holds(spark, backend):
    r = random.Random(4)
    rows = [(words(r), words(r)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b string")
    for row in df.select("a", "b", fuzzy.upper_bound(fuzzy.features(F.col("a")), fuzzy.features(F.col("b")), backend).alias("u"), fuzzy.scorer(backend).score(F.col("a"), F.col("b"), F.lit(0.0)).alias("s")).collect():
        assert -1e-9 <= row.s <= min(100, row.u) + 1e-9
    if backend == "difflib":
        a, b = rows[0]
        one = 100 * SequenceMatcher(None, " ".join(sorted(set(a.split()))), " ".join(sorted(set(b.split())))).ratio()
        plain = 100 * SequenceMatcher(None, a.replace(" ", ""), b.replace(" ", "")).ratio()
        x, y = set(a.split()), set(b.split())
        assert fuzzy.score_keys(a, b) == pytest.approx(0.65 * one + 15 * len(x & y) / len(x | y) + 0.1 * plain)
