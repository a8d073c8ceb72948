"""Decontamination, near copies, the language model and the pipeline against brute force."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, documents, odd_texts
from pyspark.sql import functions as F
from sitelace.llm import decontam, jaccard, lm, pii, quality, queries
from sitelace.llm.common import tokenizer_path
from tokenizers import Tokenizer

BENCH = "item_id bigint, text string, doc_id string"


def prose(r, n, vocabulary=4000):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(r, text, k):
    s = list(text)
    for _ in range(k):
        p = r.randrange(len(s))
        s[p : p + 1] = r.choice([["z"], [], ["q", s[p]]])
    return "".join(s)


def distance(pattern, text):
    """Least edits that turn the pattern into a stretch of the text."""
    row = np.zeros(len(text) + 1, int)
    ramp, codes = np.arange(len(text) + 1), np.array(list(text))
    for i, c in enumerate(pattern):
        new = np.concatenate([[i + 1], np.minimum(row[:-1] + (codes != c), row[1:] + 1)])
        row = np.minimum.accumulate(new - ramp) + ramp
    return row.min()


def leaky():
    r = random.Random(11)
    items = [(i, prose(r, r.randint(12, 60)), "x") for i in range(30)] + [(30, None, "x"), (31, "", "x"), (32, "tiny one", "x"), (33, "ÉTÉ " * 20, "x")]
    texts = list(odd_texts())
    for i in range(30):
        own = items[i % 30][1]
        part = own if i % 3 else own[: len(own) // 2]
        texts.append(prose(r, 30) + " " + edited(r, part, int(len(part) * r.choice([0, 0.02, 0.04, 0.2]))).upper() + ". " + prose(r, r.randint(0, 400)))
    return items, [*texts, "a tiny, ONE here", "tinyone", " été" * 20]


def found_by_brute(items, texts):
    """By the rule alone: some 64 bytes of the item from a multiple of 16 on, or its last ones, within 5 edits; of shorter items all bytes."""
    want = {}
    for doc, text in enumerate(texts):
        raw = decontam.normal(text)
        for item, said, *_ in items:
            own = decontam.normal(said)
            if 0 < len(own) <= 10 and b" " + own + b" " in b" " + raw + b" ":
                want[doc, item] = 0
            for a in range(0, max(1, len(own) - 63), 1):
                if len(own) > 10 and (a % 16 == 0 or a == len(own) - 64):
                    piece = own[a : a + 64]
                    budget = min(len(piece) * 8 // 100, (len(piece) - 10) // 10)
                    if len(raw) + budget >= len(piece) and (e := distance(piece, raw)) <= budget:
                        want[doc, item] = min(e, want.get((doc, item), e))
    return want


def test_op1(spark, sf):
    items, texts = leaky()
    texts = [t for t in texts if len(t or "") < 4_000]
    rows = [(i, t, None, None, None, "x") for i, t in enumerate(texts)]
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in queries.op1_decontamination(spark, sf(documents=(rows, DOCS), benchmark=(items, BENCH))).collect()}
    want = found_by_brute(items, texts)
    assert got == want and len(want) > 12


def test_op1_long_texts_and_slices(monkeypatch):
    """Occurrences at every place of a long text, over the ends of its stretches and of slices of postings."""
    monkeypatch.setattr(decontam, "STRETCH", 700)
    monkeypatch.setattr(decontam, "SLICE", 40)
    r = random.Random(31)
    shared = prose(r, 9)
    items = [(i, prose(r, 6) + " " + shared + " " + prose(r, 6)) for i in range(12)]
    texts = []
    for _ in range(10):
        parts = [edited(r, items[r.randrange(12)][1], r.choice([0, 1, 3, 9])) if r.random() < 0.3 else prose(r, r.randint(1, 60), 10**6) for _ in range(8)]
        texts.append(" ".join([*parts, shared]))
    got = decontam.Benchmark(items).leaks(texts)
    assert {(d, i): e for d, f in enumerate(got) for i, e in f} == found_by_brute(items, texts)


def test_op1_passage_that_many_items_share():
    """3,000 items with one passage, texts that repeat it: bounded in time, and right for items picked out."""
    r = random.Random(32)
    passage = prose(r, 12)[:57]
    items = [(i, prose(r, 15) + " " + passage + " " + prose(r, 15)) for i in range(3000)]
    texts = [(passage + " ") * 20] * 8
    began = time.time()
    got = decontam.Benchmark(items).leaks(texts)
    assert time.time() - began < 40 and len({str(f) for f in got}) == 1
    some = items[::300]
    assert {i: e for i, e in got[0] if i % 300 == 0} == {i: e for (_, i), e in found_by_brute(some, texts[:1]).items()}


def test_op1_blocks_one_after_the_other(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1500)
    r = random.Random(33)
    items = [(i, prose(r, 40)) for i in range(20)]
    docs = spark.createDataFrame([(i, prose(r, 20) + " " + items[i][1], "clash") for i in range(0, 20, 2)] + [(99, prose(r, 90, 10**6), "")], "doc_id bigint, text string, leaked_items string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(decontam.blocks(benchmark))) > 2
    assert sorted((x["doc_id"], x["item_id"], x["edits"]) for x in decontam.leaks(docs, benchmark).collect()) == [(i, i, 0) for i in range(0, 20, 2)]
    kept = decontam.decontaminate(docs, benchmark)
    assert [x["doc_id"] for x in kept.collect()] == [99] and kept.columns == docs.columns


def test_op1_without_benchmark(spark, sf):
    at = sf(documents=(documents(), DOCS), benchmark=([], BENCH))
    assert queries.op1_decontamination(spark, at).count() == 0
    kept = decontam.decontaminate(spark.read.parquet(f"{at}/documents.parquet").withColumnRenamed("row_place", "leaked_items"), spark.read.parquet(f"{at}/benchmark.parquet"))
    assert kept.count() == len(documents()) and "leaked_items" in kept.columns


def near_texts():
    r = random.Random(12)
    texts = list(odd_texts())
    for g in range(12):
        base = prose(r, r.randint(40, 200)).split()
        for _ in range(r.randint(1, 9)):
            own = list(base)
            for _ in range(r.randint(0, 1 + len(own) // 60)):
                own[r.randrange(len(own))] = f"x{r.randrange(999)}"
            texts.append(" ".join(own))
        texts.append(texts[-1] if g % 2 else "  ".join(texts[-1].split()))
    return [*texts, "one two", "one two", "one  two", "three"]


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").encode().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else None)
    return out


def brute_classes(ids, texts):
    sets, n = sets_of(texts), len(texts)
    links = defaultdict(set)
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i].add(j), links[j].add(i)
    root = list(range(n))
    for i in range(n):
        front = [i] if root[i] == i else []
        while front:
            k = front.pop()
            for j in links[k]:
                if root[j] > i:
                    root[j] = i
                    front.append(j)
    members = defaultdict(list)
    for i in range(n):
        members[root[i]].append(i)
    name = {x: min((ids[i] for i in m if ids[i] is not None), default=None) for x, m in members.items()}
    return [name[root[i]] for i in range(n)], [len(links[i]) for i in range(n)], [len({frozenset(sets[j]) for j in links[i]} - {frozenset(sets[i] or ())}) for i in range(n)]


@pytest.mark.parametrize(("block", "sparse"), [(jaccard.BLOCK_SHINGLES, 4), (120, 10**9), (300, 0)])
def test_op3(spark, block, sparse, monkeypatch):
    """Whole components, those cut into blocks, and those cut into buckets."""
    monkeypatch.setattr(jaccard, "SPARSE", sparse)
    texts = near_texts()
    ids = list(range(len(texts)))
    df = spark.createDataFrame([(i, t, "clash") for i, t in zip(ids, texts, strict=True)], "doc_id bigint, text string, node string")
    got = {r["doc_id"]: r for r in jaccard.jaccard_join(df, block_shingles=block).collect()}
    classes, links, others = brute_classes(ids, texts)
    assert [got[i]["class_id"] for i in ids] == classes
    assert [got[i]["n_links"] for i in ids] == links
    assert [got[i]["n_set_links"] for i in ids] == others
    assert max(links) > 5


def test_op3_components_of_a_chain(spark):
    """Sliding windows: each like the next, the ends unlike."""
    words = [f"c{i}" for i in range(400)]
    texts = [" ".join(words[8 * k : 8 * k + 140]) for k in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in jaccard.jaccard_join(df).collect()}
    assert [got[i] for i in range(30)] == brute_classes(list(range(30)), texts)[0] == [0] * 30


@pytest.mark.parametrize("nodes", [jaccard.BLOCK_NODES, 16])
def test_op3_recall_near_the_threshold(spark, nodes):
    """Thousands of pairs at 0.8 to 0.85 and below it: nearly all of the former are linked, none of the latter."""
    r, rows, want = random.Random(16), [], {}
    for g in range(1500):
        base = [f"g{g}w{i}" for i in range(r.randint(80, 160))]
        near = list(base)
        for p in sorted(r.sample(range(0, len(base) - 5, 5), r.choice([2, 3]))):
            near[p] = "x"
        a, b = (sets_of([" ".join(w)])[0] for w in (base, near))
        want[2 * g] = len(a & b) / len(a | b)
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x["doc_id"]: x["n_links"] for x in jaccard.jaccard_join(df, block_nodes=nodes).collect()}
    close = [i for i, j in want.items() if 0.8 <= j < 0.85]
    assert len(close) > 300 and sum(got[i] for i in close) >= 0.99 * len(close)
    assert not any(got[i] for i, j in want.items() if j < 0.8 - 1e-9)


def test_op3_equals_sql(spark, sf):
    rows = [(i, t, None, None, None, "x") for i, t in enumerate(near_texts())]
    at = sf(documents=(rows, DOCS))
    got = queries.op3_jaccard(spark, at)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{at}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(f"select {', '.join(got.columns)} from ({queries.OP3_SQL})").fetchall())


def test_op3_empty_and_banding(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    bands, rows = jaccard.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= jaccard.MAX_PERMUTATIONS


def test_deduplicate_with_repeated_and_null_ids(spark):
    r = random.Random(13)
    a, b, c, d = (prose(r, 80) for _ in range(4))
    near = a.replace(a.split()[40], "zz")
    rows = [(1, a), (2, a), (3, near), (3, b), (4, b), (5, c), (5, c), (5, d), (None, c), (None, d + " x"), (None, None), (6, ""), (7, None), (1, a)]
    clash = ("other_id", "g", "k", "root", "class_id", "node", "shingle_set", "Set_Key", "least_set")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *(F.lit(i).alias(c) for i, c in enumerate(clash)))
    assert jaccard.deduplicate(df).columns == df.columns
    kept = [(x["doc_id"], x["text"]) for x in jaccard.deduplicate(df).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (3, b), (5, c), (5, d), (None, None), (6, ""), (7, None)], key=str)
    nulls = spark.createDataFrame([(None, a), (None, a), (None, b), (None, b)], "doc_id bigint, text string")
    assert sorted(x["text"] for x in jaccard.deduplicate(nulls).collect()) == sorted([a, b])


def test_op2(spark, sf):
    r = random.Random(14)
    chain = {f"v{i}": [f"v{r.randrange(80)}" for _ in range(3)] for i in range(80)}

    def said(n):
        out = ["v0"]
        for _ in range(n):
            out.append(r.choice(chain[out[-1]]))
        return " ".join(out) + f" rare{r.randrange(500)} RARE{r.randrange(500)}"

    rows = [*documents(), *((1000 + i, said(r.randint(20, 200)), None, None, None, None) for i in range(900))]
    got = queries.op2_lm(spark, sf(documents=(rows, DOCS))).collect()
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    counts = Counter()
    for i, t, *_ in rows:
        if not held(i):
            counts.update(lm.tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t, *_ in rows:
        w = lm.tokens(t)
        want.append((str(i), held(i), len(w), sum(x in counts for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 6)))
    assert sorted((str(g["doc_id"]), g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"], round(g["base_score"], 6)) for g in got) == sorted(want)
    fresh = [g for g in got if g["held_out"] and (g["doc_id"] or 0) >= 1000]
    assert sum(g["score"] for g in fresh) > sum(g["base_score"] for g in fresh) * 0.9  # well above the unigram base


def test_lm_is_normalised():
    words = lm.Words([(b"a", 50), (lm.END, 20), (b"b", 7), (b"c", 2)], 85, 9, classes=4)
    model = lm.Model(words.unigram)
    one, two, z = model.tables()
    p = np.exp(one[:, None, :] + two[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-5)
    # a and b have classes; c is in the rest, with five words of six tokens and all unseen ones
    rest = [(2 + 1)] + [x + 1 for x in (1, 1, 1, 1, 2)] + [1]
    assert words.rest_size == sum(rest)


def test_lm_all_held_out_or_empty(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score_documents(empty).count() == 0
    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = lm.score_documents(spark.createDataFrame([(i, "a b")], "doc_id bigint, text string")).collect()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)


def test_pipeline(spark, sf):
    r = random.Random(15)
    items = [(i, prose(r, 40), "x") for i in range(4)]
    texts = [*odd_texts(), *(t for t in near_texts()[70:] if t)]
    texts += [prose(r, 60) + " " + items[i][1] + " tail" for i in range(4)] + [prose(r, 70) + f" mail a{i}@b.example.org now" for i in range(5)]
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in enumerate(texts)]
    at = sf(documents=(rows, DOCS), benchmark=(items, BENCH))
    got = {g["doc_id"]: g for g in corpus_pipeline.run(spark, at).collect()}
    kept = [r["doc_id"] for r in quality.keep(spark.read.parquet(f"{at}/documents.parquet")).collect()]
    classes = brute_classes(kept, [texts[i] for i in kept])[0]
    kept = [i for i, c in zip(kept, classes, strict=True) if i == c]
    kept = [i for i in kept if not any(decontam.normal(b) in decontam.normal(texts[i]) for _, b, _ in items)]
    assert sorted(got) == sorted(kept) and len(kept) > 15
    library = Tokenizer.from_file(tokenizer_path())
    for i in kept:
        ids = library.encode(pii.redacted(texts[i]), add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, at)
        assert docs.columns == spark.read.parquet(f"{at}/documents.parquet").columns
    assert docs.where(F.col("text").contains("@b.example.org")).count() == 0


def test_hot_words_are_bounded(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 1 + i // 10) for i in range(300)], "word binary, c bigint")
    hot = lm.hot_words(counts, 50)
    assert 0 < len(hot) <= 50 and hot == sorted(hot, key=lambda x: (-x[1], x[0])) and min(c for _, c in hot) > 20
    assert len(lm.hot_words(counts, 1000)) == 300 and lm.hot_words(counts, 3) == [] and lm.hot_words(counts.limit(0)) == []


def test_lm_tells_words_without_class_apart():
    """c and d are equally frequent and lie in one group; c follows a, d follows b."""
    ranked = [(b"a", 90), (b"b", 80), (lm.END, 20), (b"c", 7), (b"d", 7), (b"z", 5)]
    words = lm.Words(ranked, 219, 9, classes=4, edges=[b"m"], others=np.array([[7, 2], [3, 1]]))
    inner = lm.Inner(words)
    a, b, c, d = (words.rank[x] for x in (b"a", b"b", b"c", b"d"))
    trainer = lm.InnerTrainer(inner, words, 1)
    w, p = np.array([c, d] * 200), np.array([a, b] * 200)
    for _ in range(20):
        trainer.step(np.zeros_like(w), w, p, np.zeros_like(w))
    ask = lambda x, y: inner.logs(words, np.array([0]), np.array([x]), np.array([y]), np.array([0]))[0]
    assert ask(c, a) > ask(d, a) + 1 and ask(d, b) > ask(c, b) + 1
    # Both groups' members, and over all words of the model, add up to one.
    one, two, z = lm.Model(words.unigram).tables()
    total = sum(np.exp(one[3, k] + two[0, k] - z[3, 0]) for k in (0, 3, 4))
    for g in (0, 1):
        members = words.members[words.first[g] : words.first[g + 1]]
        n = len(members)
        within = np.exp(inner.logs(words, np.full(n, g), members, np.full(n, a), np.zeros(n, int))).sum()
        assert abs(within - 1) < 1e-5
        total += np.exp(one[3, 1 + g] + two[0, 1 + g] - z[3, 0]) * within
    assert abs(total - 1) < 1e-5 and words.others_size.tolist() == [10, 5]
    assert words.ranks([b"new", b"c", b"tx"]) == [-2, c, -2] and words.ranks([b"ea"]) == [-1]


def test_lm_where_no_word_is_hot(spark, monkeypatch):
    """All words tie, so the first bin overflows: the end and the classes are known all the same, and counts stay exact."""
    monkeypatch.setattr(lm, "HOT_WORDS", 3)
    monkeypatch.setattr(lm, "CLASSES", 12)
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2][:1] + [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    texts = [" ".join(f"w{i}" for i in range(40)), "w1 w39 new"]
    counts = lm.word_counts(spark.createDataFrame([(texts[0],)], "text string"))
    assert lm.hot_words(counts, 3) == [] and lm.known_words(counts) == [(b"", 1), *sorted((f"w{i}".encode(), 1) for i in range(40))[:10]]
    got = {r["doc_id"]: r for r in lm.score_documents(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")).collect()}
    assert [got[i]["n_known"] for i in ids] == [41, 3]
    base = math.log10(2 / (41 + 41 + 1))
    assert abs(got[ids[0]]["base_score"] - 41 * base) < 1e-9 and abs(got[ids[1]]["base_score"] - 3 * base - math.log10(1 / 83)) < 1e-9


def test_lm_long_words_are_words_like_others(spark, monkeypatch):
    """A token that makes a third of all is learnt and counted alike whether it has 5, 64, 65 or 5,000 bytes."""
    r = random.Random(31)
    chain = [[r.randrange(40) for _ in range(3)] for _ in range(40)]
    scores = []
    for size in (5, 64, 65, 5000):
        frequent, docs, q = "z" * size, [], random.Random(32)
        for i in range(120):
            at, words = q.randrange(40), []
            for _ in range(30):
                at = q.choice(chain[at])
                words += [f"w{at}"] + ([frequent] if q.random() < 0.5 else [])
            docs.append((i, " ".join(words)))
        got = lm.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
        scores.append(sum(x["score"] for x in got))
        assert all(x["n_known"] == x["n_tokens"] or x["held_out"] for x in got)
    assert max(scores) - min(scores) < 0.01 * abs(scores[0])


def test_lm_hardly_depends_on_partitions(spark):
    r = random.Random(33)
    chain = [[r.randrange(60) for _ in range(3)] for _ in range(60)]
    docs = []
    for i in range(400):
        at, words = r.randrange(60), []
        for _ in range(60):
            at = r.choice(chain[at])
            words.append(f"w{at}")
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    means = []
    for parts in (1, 16, 64):
        rows = [x for x in lm.score_documents(df.repartition(parts, "doc_id")).collect() if x["held_out"]]
        means.append(sum(x["score"] for x in rows) / sum(x["n_tokens"] for x in rows))
    assert max(means) - min(means) < 0.01


@pytest.mark.parametrize("level", [2, 32])
def test_lm_scores_equal_a_plain_sum(spark, monkeypatch, level):
    """From text to score, token by token, with the parameters that were learnt; also for rare words, copies and long texts,
    and with sums in more levels."""
    monkeypatch.setattr(lm, "TASKS", level)
    monkeypatch.setattr(lm, "PART_TOKENS", 200)
    kept, fit = [], lm.fit
    monkeypatch.setattr(lm, "fit", lambda ranked, sent, rounds: kept.append((fit(ranked, sent, rounds), sent)) or kept[-1][0])
    monkeypatch.setattr(lm, "HOT_WORDS", 60)
    monkeypatch.setattr(lm, "CLASSES", 20)
    r = random.Random(34)
    texts = [" ".join(f"w{min(int(r.expovariate(0.05)), 400)}" for _ in range(r.randint(0, 60))) for _ in range(80)]
    texts += [texts[0], texts[0], "w1 " * 4000, "never seen words", None, ""]
    got = {x["doc_id"]: x for x in lm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(9)).collect()}
    ((model, inner), sent) = kept[0]
    words = lm.Words(*sent.value)
    counts = Counter(w for i, t in enumerate(texts) if not got[i]["held_out"] for w in lm.tokens(t))
    soft = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    r32, q = model.r.astype(float), model.q.astype(float)
    for i, t in enumerate(texts):
        total, before = 0.0, [(0, 0), (0, 0)]
        split = lm.tokens(t)
        for w in split[:200] if len(split) > 200 else split:
            (rank,) = words.ranks([w])
            k, own = (int(f(np.array([rank]))[0]) for f in (words.classes_of, words.ids))
            h = r32[before[-1][0]] @ model.c[0] + r32[before[-2][0]] @ model.c[1]
            total += soft(q[:, :-1] @ h + q[:, -1])[k]
            if 0 < k <= words.groups:
                members = words.members[words.first[k - 1] : words.first[k]]
                g = inner.r[before[-1][1]] @ inner.c[0] + inner.r[before[-2][1]] @ inner.c[1]
                total += soft(inner.q[members, :-1].astype(float) @ g + inner.q[members, -1])[members.tolist().index(own)]
            if rank < 0:
                total += math.log((counts[w] + 1) / words.others_size[-1 - rank])
            before = [before[-1], (k, own)]
        if len(split) <= 200:
            assert got[i]["score"] == pytest.approx(total / math.log(10), rel=1e-4, abs=1e-4)
    assert got[80]["score"] == pytest.approx(got[0]["score"], rel=1e-9) and got[82]["n_tokens"] == 4001


def lm_groups():
    """Three groups of 20, 19 and 18 words and their others, 3 words with classes of their own."""
    ranked = [(lm.END, 99), *((w.encode(), 90) for w in ("the", "of", "and")), *((f"{i}{x}".encode(), 3 + i) for x in "aku" for i in range(20 - "aku".index(x)))]
    ranked.sort(key=lambda x: (-x[1], x[0]))
    return ranked, 5000, 400, 5, [b"d", b"p"], np.array([[40, 30], [9, 5], [0, 0]])


def test_lm_step_in_blocks_adds_up_over_targets():
    """A group of many blocks, one of a single target, and one that lacks: as target by target in 64 bits."""
    words = lm.Words(*lm_groups())
    inner, old = lm.Inner(words), lm.Inner(words)
    r = np.random.default_rng(8)
    group = np.where(np.arange(3 * lm.LANES + 5) == 7, 2, 0)
    w = np.array([r.choice(words.members[words.first[g] : words.first[g + 1]]) for g in group])
    p1, p2 = r.integers(0, len(words.share), (2, len(w)))
    lm.InnerTrainer(inner, words, 5).step(group, w, p1, p2)
    draws = np.random.default_rng(5).random((2, lm.GROUP_NOISE))
    dr, dq, dc = np.zeros(old.r.shape), np.zeros(old.q.shape), np.zeros(old.c.shape)
    noise = {}
    for g, u in zip((0, 2), draws, strict=True):
        cumulative = np.concatenate([[0], np.cumsum(words.share[words.members])])
        low, high = words.first[g], words.first[g + 1]
        u = cumulative[low] + u * (cumulative[high] - cumulative[low])
        noise[g] = words.members[np.clip(np.searchsorted(cumulative, u, side="right") - 1, low, high - 1)]
    for g, x, a, b in zip(group, w, p1, p2, strict=True):
        h = np.append(old.r[a].astype(float) @ old.c[0] + old.r[b].astype(float) @ old.c[1], 1)
        dh = np.zeros(lm.DIM + 1)
        for k, sign in [(x, 1), *((k, -1) for k in noise[g])]:
            s = h @ old.q[k] - np.log(lm.GROUP_NOISE * words.share[k])
            weight = sign / (1 + np.exp(sign * s))
            dq[k] += weight * h
            dh += weight * old.q[k]
        for i, place in enumerate((a, b)):
            dr[place] += dh[:-1] @ old.c[i].T
            dc[i] += np.outer(old.r[place], dh[:-1]) / len(w)
    for name, grad in (("r", dr), ("q", dq), ("c", dc)):
        want = getattr(old, name) + lm.GROUP_RATE * grad / np.sqrt(0.1 + grad * grad)
        assert np.allclose(getattr(inner, name), want, atol=1e-5) and np.abs(grad).max() > 0


def test_lm_logs_within_groups_with_small_and_large_scores(monkeypatch):
    """Normalised in 64 bits as well, in one piece or many, whether or not exp would overflow."""
    words = lm.Words(*lm_groups())
    r = np.random.default_rng(9)
    group = r.integers(0, 3, 200)
    w = np.array([r.choice(words.members[words.first[g] : words.first[g + 1]]) for g in group])
    p1, p2 = r.integers(0, len(words.share), (2, len(w)))
    for scale in (1, 300, 3000):
        inner = lm.Inner(words)
        inner.q *= scale
        want, largest = [], 0
        for g, x, a, b in zip(group, w, p1, p2, strict=True):
            h = np.append(inner.r[a].astype(float) @ inner.c[0] + inner.r[b].astype(float) @ inner.c[1], 1)
            scores = inner.q[words.members[words.first[g] : words.first[g + 1]]].astype(float) @ h
            want.append(h @ inner.q[x] - scores.max() - np.log(np.exp(scores - scores.max()).sum()))
            largest = max(largest, np.abs(scores).max())
        assert (largest > 700) == (scale > 1)
        for cells in (1, 1 << 17):
            monkeypatch.setattr(lm, "CELLS", cells)
            assert np.allclose(inner.logs(words, group, w, p1, p2), want, rtol=1e-5, atol=1e-5 * scale)


def test_lm_tables_are_made_once_for_a_worker(monkeypatch):
    made, tables = [], lm.Model.tables
    monkeypatch.setattr(lm.Model, "tables", lambda self: made.append(1) or tables(self))
    words = lm.Words(*lm_groups())
    sent = SimpleNamespace(value=lm_groups())
    texts = pa.RecordBatch.from_pylist([{"doc_id": i, "held_out": False, "key": i, "turn": 0, "text": t} for i, t in enumerate(["the 3a of 4k", "", "new and 7u"])])
    batch = next(lm._ranked(iter([texts]), sent)).select(["doc_id", "held_out", "key", "ranks"])
    learnt = SimpleNamespace(value=(lm.Model(words.unigram).flat(), lm.Inner(words)))
    tasks = [next(lm._score(iter([batch]), sent, learnt)) for _ in range(3)]
    assert len(made) == 1 and tasks[0].equals(tasks[1]) and tasks[0].equals(tasks[2])
    other = SimpleNamespace(value=(lm.Model(words.unigram, seed=5).flat(), lm.Inner(words)))
    assert not next(lm._score(iter([batch]), sent, other)).equals(tasks[0]) and len(made) == 2


def test_op1_parts_of_items():
    """Any 79 bytes of an item are found, and a short item without its last words."""
    r = random.Random(21)
    items = [(i, prose(r, n)[:m]) for i, (n, m) in enumerate([(30, 82), (40, 100), (60, 160), (80, 233), (120, 394)])]
    index = decontam.Benchmark(items)
    for i, text in items:
        raw = decontam.normal(text).decode()
        passages = [raw[a : a + 79] for a in range(len(raw) - 78)]
        texts = ["qq " * 9 + p + " zz" * 30 for p in passages]
        assert all(i in dict(f) for f in index.leaks(texts))
    assert index.leaks([items[0][1][:68], prose(r, 200, 10**6)]) == [[(0, 0)], []]


def test_op1_short_items_at_document_starts():
    """A match at a document's first bytes is that document's alone, wherever the document lies in the batch."""
    for n in range(11, 30):
        item = "".join(chr(97 + (7 * k + n) % 26) for k in range(n))
        index = decontam.Benchmark([(1, item)])
        for before in range(1, 40):
            assert index.leaks(["y" * before, item + " tail", "x"]) == [[], [(1, 0)], []]
            assert index.leaks([item, "y" * before]) == [[(1, 0)], []]


def test_op1_items_without_id(spark):
    text = prose(random.Random(22), 30)
    benchmark = spark.createDataFrame([(None, text), (7, text)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "so " + text), (2, "clean")], "doc_id bigint, text string")
    assert sorted((r["doc_id"], str(r["item_id"])) for r in decontam.leaks(docs, benchmark).collect()) == [(1, "7"), (1, "None")]
    assert [r["doc_id"] for r in decontam.decontaminate(docs, benchmark.where("item_id is null")).collect()] == [2]
