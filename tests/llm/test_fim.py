"""Fill in the middle against slicing of Python's own strings."""

import hashlib
import random
import re

import pytest
from cases import DOCS, documents, odd_texts
from oracle import compare, connect
from pyspark.sql import functions as F
from sitelace.llm import fim, queries

SF = "/root/testdata/sf0.001"


def sliced(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_op12_equals_slicing(spark, sf):
    more = [(1000 + i, t, "en", "s", 0, "x") for i, t in enumerate(["<P>", "a<S>b", "<<M", "<P", "é" * 9, "😀漢" * 50, "<", ">", "S>"] * 8)]
    rows = documents() + more
    got = queries.op12_fim(spark, sf(documents=(rows, DOCS))).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(i, *sliced(i, t)[:4], digest(sliced(i, t)[4]), digest(t or "")) for i, t, *_ in rows]
    key = lambda r: (str(r[0]), r[5])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_op12_equals_sql(spark):
    compare(queries.op12_fim(spark, SF), connect(SF), queries.OP12_SQL)


@pytest.mark.parametrize("unit", fim.UNITS)
def test_units_are_found_and_selected(unit):
    pattern = {"code point": "(?s).", "word": r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+[ \t\n\x0b\x0c\r]*|[ \t\n\x0b\x0c\r]+", "line": "[^\n]*\n|[^\n]+"}[unit]
    r = random.Random(3)
    for text in [*(t or "" for t in odd_texts()), *("".join(r.choice("aé😀 \n\t") for _ in range(r.randint(0, 60))) for _ in range(300))]:
        raw, at, want = text.encode(), 0, []
        for m in re.finditer(pattern, text):
            want.append(at)
            at += len(m[0].encode())
        if unit == "word" and want and len(want) > 1 and not text[: len(raw)].lstrip(" \t\n\x0b\x0c\r"):
            want = want[:1]
        bits = fim.starts(raw, unit)
        assert bits.bit_count() == len(want), text[:60]
        for k in {0, 1, len(want) // 2, len(want) - 1} & set(range(len(want))):
            assert fim.select(bits, k, len(raw)) == want[k]
        assert fim.select(bits, len(want), len(raw)) == len(raw)


def test_words_and_lines_are_cut_whole_and_restored(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts())], "doc_id bigint, text string")
    for unit in ("word", "line"):
        out = fim.fill_in_middle(docs, fim.FimConfig(unit=unit, spm_percent=50, seed="x"))
        back = out.select("text", fim.restored(F.col("fim_form"), F.col("fim_output")).alias("back")).collect()
        assert all((r["text"] or "") == r["back"] for r in back)


def test_clashing_columns_stay_and_empty_tables_are_empty(spark):
    docs = spark.createDataFrame([(1, "abc", "mine", 7)], "doc_id bigint, text string, FIM_output string, fim_n int")
    out = fim.fill_in_middle(docs).collect()[0]
    assert (out["FIM_output"], out["fim_n"], out["fim_n_"]) == ("mine", 7, 3) and "abc"[0] in out["fim_output_"]
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
