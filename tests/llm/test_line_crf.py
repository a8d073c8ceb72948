"""The line field against sums over all labellings, and on held-out documents."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from cases import DOCS, documents, odd_texts
from sitelace.llm import line_crf, queries

LABELS = "doc_id bigint, quality int, toxic int"


def labellings(u, pairs):
    """Each labelling of a chain and its weight."""
    for y in itertools.product((0, 1), repeat=len(u)):
        yield y, math.exp(sum(u[t] * y[t] for t in range(len(u))) + sum(pairs[a][b] for a, b in itertools.pairwise(y)))


def test_marginals_equal_sums_over_labellings():
    r = np.random.default_rng(2)
    n_lines = np.array([3, 1, 6, 2, 6])
    u, pairs = r.normal(0, 2, n_lines.sum()), r.normal(0, 1, (2, 2))
    p, log_z, counts = line_crf.forward_backward(u, n_lines, pairs)
    at = 0
    for i, n in enumerate(n_lines):
        every = list(labellings(u[at : at + n], pairs))
        z = sum(w for _, w in every)
        assert log_z[i] == pytest.approx(math.log(z))
        for t in range(n):
            assert p[at + t] == pytest.approx(sum(w for y, w in every if y[t]) / z)
        for a, b in itertools.product((0, 1), repeat=2):
            assert counts[i, a, b] == pytest.approx(sum(w * Counter(itertools.pairwise(y))[(a, b)] for y, w in every) / z)
        at += n


def test_loss_equals_its_definition_and_its_derivative():
    r = np.random.default_rng(3)
    n_lines, label = np.array([2, 4, 1, 3]), np.array([1, 0, 0, 1])
    u, pairs = r.normal(0, 1, n_lines.sum()), r.normal(0, 1, (2, 2))
    each, by_u, by_pairs = line_crf.loss(u, n_lines, pairs, label)
    at = 0
    for i, n in enumerate(n_lines):
        every = list(labellings(u[at : at + n], pairs))
        good = sum(w for y, w in every if all(y)) / sum(w for _, w in every)
        assert each[i] == pytest.approx(-math.log(good if label[i] else 1 - good))
        at += n
    for k in range(len(u)):
        step = np.eye(len(u))[k] * 1e-6
        slope = (line_crf.loss(u + step, n_lines, pairs, label)[0].sum() - line_crf.loss(u - step, n_lines, pairs, label)[0].sum()) / 2e-6
        assert by_u[k] == pytest.approx(slope, rel=1e-4, abs=1e-8)
    for k in range(4):
        step = (np.eye(4)[k] * 1e-6).reshape(2, 2)
        slope = (line_crf.loss(u, n_lines, pairs + step, label)[0].sum() - line_crf.loss(u, n_lines, pairs - step, label)[0].sum()) / 2e-6
        assert by_pairs.sum(axis=0).ravel()[k] == pytest.approx(slope, rel=1e-4, abs=1e-8)


def plain_features(line: str, seen: bool) -> list[float]:
    """One line at a time, by Python's own means."""
    raw = line.encode()
    kinds = Counter(line_crf.CLASSES[line_crf.CLASS_OF[b]] for b in raw)
    chars = len(line)
    words = raw.split()  # bytes split at the six ASCII blanks
    n = len(words)
    same = sum(a == b for a, b in itertools.pairwise(words))
    last = bool(raw) and raw[-1:] in b".,;:?"
    return [
        *(math.sqrt(kinds[s] / max(chars, 1)) for s in line_crf.SHARES),
        math.log1p(chars) / 4,
        math.log1p((chars - kinds["blank"]) / max(n, 1)) / 2 if n or chars else 0,
        math.sqrt(same / max(n - 1, 1)),
        (n - len(set(words))) / max(n, 1) / math.log2(n + 2),
        float(last),
        float(seen and chars > 0),
    ]


def test_features_equal_a_plain_count(monkeypatch):
    texts = [t or "" for t in odd_texts()] + ["a b a\n\na b a\n x  x x\t.", "\n" * 5, "é É\né É\r\nend!"]
    for piece in (line_crf.PIECE, 64):  # cut into many pieces, the same comes out
        monkeypatch.setattr(line_crf, "PIECE", piece)
        rows, chars, n_lines = line_crf.describe([t.encode() for t in texts])
        at = 0
        for t, n in zip(texts, n_lines, strict=True):
            lines, before = t.split("\n"), []
            assert n == len(lines)
            for line in lines:
                want = plain_features(line, line.encode().split() in before)
                blank = not line.encode().split()
                for name, a, b in zip(line_crf.FEATURES, rows[at], want, strict=True):
                    assert blank and name in ("word_length", "seen_line") or a == pytest.approx(b), (line[:40], name)
                assert chars[at] == len(line)
                before.append(line.encode().split())
                at += 1


def test_held_out_documents_are_told(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op13_quality_classifier(spark, sf).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(got[i], q) for i, q in labels if i in got and got[i]["held_out"]]
    assert len(held) > 40 and sum(r["predicted"] == q for r, q in held) >= 0.97 * len(held)
    ones, zeros = ([r["score"] for r, q in held if q == k] for k in (1, 0))
    assert sum(a > b for a in ones for b in zeros) >= 0.97 * len(ones) * len(zeros)


def test_op13_on_odd_texts_and_without_labels(spark, sf):
    rows = documents()
    d = sf(documents=(rows, DOCS), labels=([(i, i % 2, 0) for i in range(0, 70, 3)] + [(3, None, 0), (None, 1, 0), (5, 7, 0), (6, 1, 1)], LABELS))
    got = queries.op13_quality_classifier(spark, d).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    text = {(i, t or "") for i, t, *_ in rows}
    by_text = {}
    for r in got:
        for i, t in text:
            if i == r["doc_id"]:
                by_text.setdefault(t, set()).add(round(r["score"], 9))
    assert all(len(v) == 1 for v in by_text.values())
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, quality int")
    docs = spark.createDataFrame([(1, "a", "mine"), (2, None, None)], "doc_id bigint, text string, Quality_score string")
    model = line_crf.fit(docs, labels)
    assert model.constant == 0.75
    out = line_crf.score_documents(docs, model).collect()
    assert {r["Quality_score"] for r in out} == {"mine", None} and {r["quality_score_"] for r in out} == {0.75}
    assert line_crf.fit(docs, labels.limit(0)).constant == 0.5
    assert line_crf.score_documents(docs.limit(0), model).count() == 0


def test_bad_lines_are_found_within_a_document(spark):
    r = np.random.default_rng(8)
    word = lambda: "".join(r.choice(list("etaoinsh"), r.integers(2, 8)))
    clean = lambda: " ".join(word() for _ in range(12)) + "."
    junk = lambda: " ".join(word() + "###" for _ in range(12))
    texts = [[clean() for _ in range(6)] for _ in range(60)] + [[clean(), clean(), junk(), junk(), junk(), clean()] for _ in range(60)]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id bigint, quality int")
    model = line_crf.fit(docs, labels)
    rows = docs.where("doc_id >= 60").select(line_crf.line_labels(docs["text"], model).alias("p")).collect()
    told = np.array([row["p"] for row in rows])
    assert (told[:, 2:5] < 0.5).mean() > 0.95 and (told[:, 0] > 0.5).mean() > 0.8
