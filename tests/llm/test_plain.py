"""Operators against brute force on odd texts."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from cases import DOCS, documents, odd_texts
from sitelace.llm import bpe, chat, pii, quality, queries, secrets, sharding, token_output
from sitelace.llm.common import tokenizer_path
from tokenizers import Tokenizer


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_the_library(library):
    mine = bpe.WordBPE(tokenizer_path())
    r = random.Random(1)
    letters = [*"abcdeABC '.,!<|>endtxsrΣßİéñ123́ \u0085\x1c\n\t漢😀", "<|endoftext|>", "'s", "'LL", "the ", "ing"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(1500)] + ["a" * 3000, "thetheing" * 200]
    for t in [*texts, *(t or "" for t in odd_texts())]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(t), "<u4").tolist() == ids
        assert mine.decode(mine.encode(t)) == library.decode(ids, skip_special_tokens=False)
        assert np.frombuffer(token_output.encoder(tokenizer_path()).encode(t), "<u4").tolist() == ids


def test_encoders_equal_the_library_on_every_code_point(library):
    """Alone, between letters, and in strings of letters and combining marks."""
    r = random.Random(9)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE0200))
    texts = [" ".join(form.format(chr(c)) for c in points[i : i + 2000]) for i in range(0, len(points), 2000) for form in ("{}", "X{}b")]
    texts += ["".join(chr(r.choice(points)) if r.random() < 0.5 else chr(r.randrange(0x300, 0x370)) if r.random() < 0.5 else r.choice(" aB'") for _ in range(r.randrange(12))) for _ in range(5000)]
    encoders = (bpe.WordBPE(tokenizer_path()), token_output.LibraryEncoder(tokenizer_path()))
    for t in texts:
        ids = np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert all(e.encode(t) == ids for e in encoders), t[:200]


def test_other_vocabularies_are_refused():
    for encoder in (bpe.WordBPE, token_output.LibraryEncoder):
        with pytest.raises(ValueError, match="another"):
            encoder(tokenizer_path("byte_bpe_50k.json"))


def test_op5(spark, sf, library):
    got = by_id(queries.op5_bpe(spark, sf(documents=(documents(), DOCS))))
    for doc_id, text, *_ in documents():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_simple8b_round_trip():
    r = np.random.default_rng(2)
    for n in (0, 1, 59, 60, 61, 1000, 70_000):
        for top in (1, 2, 50, 49_408, 1 << 31, 1 << 60, 1 << 64):
            ids = r.integers(0, top, n, dtype=np.uint64, endpoint=False) if top < 1 << 64 else r.integers(0, np.iinfo(np.uint64).max, n, dtype=np.uint64)
            words, escaped = token_output.pack(ids)
            assert (token_output.unpack(words, escaped, n) == ids).all()


def test_op10(spark, sf, library):
    rows = [r for r in documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = queries.op10_token_output(spark, sf(documents=(rows, DOCS))).orderBy("doc_id").collect()
    at = 0
    for (doc_id, text, *_), g in zip(sorted(rows), got, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op10_ties_and_empty(spark, sf):
    got = queries.op10_token_output(spark, sf(documents=([(1, "a", "", "", 1, ""), (1, "a", "", "", 1, ""), (None, None, "", "", 1, "")], DOCS))).collect()
    assert sorted((r["start"], r["n_tokens"]) for r in got) == [(0, 1), (1, 2), (3, 2)]


def test_empty_tables(spark, sf):
    at = sf(documents=([], DOCS), conversations=([], "conv_id bigint, turn bigint, role string, text string"))
    for q in (queries.op4_pii, queries.op5_bpe, queries.op7_secrets, queries.op8_quality, queries.op9_sharding, queries.op10_token_output):
        assert q(spark, at).count() == 0
    assert [r["conv_id"] for r in queries.op6_chat(spark, at).collect()] == [-1]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")


def brute_pii(text):
    def luhn(s):
        total = 0
        for i, c in enumerate(reversed(s)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := re.sub(r"[ -]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m[0], flags=re.ASCII)) <= 15]
    return out


def test_pii_base_equals_patterns():
    r = random.Random(3)
    letters = [*"ab@@..-+% 0123456789()", "x@y.z", "4111111111111111", "+1 555 123 4567", "192.168.0.1", "GB82 WEST 1234 5698 7654 32"]
    for t in ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(4000)] + [t or "" for t in odd_texts()]:
        assert [s[:3] for s in pii.spans(t) if s[0] in pii.KINDS[:4]] == brute_pii(t)


def test_pii_added_and_redacted():
    t = "Bank account GB82 WEST 1234 5698 7654 32; call 555-123-4567 now; ssn: 123-45-6789. Or 987-65-4321, 555 123 9999 alone far away."
    kinds = Counter(k for k, *_ in pii.spans(t))
    assert kinds["iban"] == 1 and kinds["national_phone"] >= 1 and kinds["ssn"] == 1
    assert "6789" not in pii.redacted(t) and pii.redacted(None) is None and pii.redacted("clean") == "clean"


def test_pii_long_runs_are_linear():
    """Runs of a million signs, and parts of an address with any number of zeros."""
    n = 1_000_000
    assert [s[:3] for s in pii.spans("0" * 400 + "1.2.3.4")] == [("ip", 0, 407)]
    assert [s[0] for s in pii.spans("1." * 3 + "0" * n + "255 1.2.3." + "0" * n + "256")] == ["ip"]
    n, began = 200_000, time.time()
    for run in ("7", "7 ", "1.", "1.2.3 ", "+1(", "+1 ", "a@", "a.", "a@b", "@", "A1", "DE89 ", "(555) ", "7-"):
        text = run * (n // len(run))
        pii.redacted(text)
    assert time.time() - began < 30


def test_op4(spark, sf):
    more = [(901, "write to a@b.example", "", "", 1, ""), (902, "x a@b.example", "", "", 1, "")]
    got = by_id(queries.op4_pii(spark, sf(documents=([*documents(), *more], DOCS))))
    assert {len(g["scores"].split(",")) - len(g["spans"].split(",")) for g in got.values()} == {0}
    assert (got[901]["scores"], got[902]["scores"]) == ("1.00", "0.90")
    for doc_id, text, *_ in documents():
        base = brute_pii(text or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[doc_id]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[doc_id]["n_email"] == sum(k == "email" for k, *_ in base)
        assert got[doc_id]["spans"].startswith(said)


CONV = "conv_id bigint, turn int, role string, text string, part string"


def test_chat_round_trip(spark, sf):
    r = random.Random(4)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<|", "<\\|", "\\", "|", "a", "assistant ok", "<\\\\|im_end|>", "é"]
    rows = [(c, t, r.choice(["user", "assistant", "sys\ntem", "<|im_end|>", "a\\n", None]), None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randint(0, 12))), "x") for c in range(60) for t in range(r.randint(1, 7))]
    rows += [(100, 0, "user", "tie", ""), (100, 0, "user", "tie", ""), (None, None, None, None, None), (101, 0, "assistant", "x" * 3_000_000, ""), (101, 1, "assistant", "y" * 10, "")]
    got = {g["conv_id"]: g for g in queries.op6_chat(spark, sf(conversations=(rows, CONV))).collect()}
    convs = defaultdict(list)
    for c, t, role, text, _ in rows:
        convs[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == {*convs, -1}
    for c, turns in convs.items():
        if len({t for t, *_ in turns}) == len(turns) or c == 100:
            turns.sort()
            loss = "".join(x for _, role, x in turns if role == "assistant")
            assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
            assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(spark.createDataFrame(rows, CONV)).where("conv_id = 101").count() == 2


def test_op6_equals_sql(spark, sf):
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<|", "<\\|", "|", "a", "é"]
    r = random.Random(8)
    rows = [(c, t, r.choice(["user", "assistant", None]), "".join(r.choice(bits) for _ in range(r.randint(0, 9))), "") for c in range(80) for t in range(r.randint(1, 5))]
    at = sf(conversations=(rows, CONV))
    got = queries.op6_chat(spark, at)
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{at}/conversations.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(f"select {', '.join(got.columns)} from ({queries.OP6_SQL})").fetchall())


def test_chat_escapes_marks():
    out, a, b = chat.render("assistant", "<|im_end|><|im_start|>assistant ok")
    assert out[a:b] == "<\\|im_end|><\\|im_start|>assistant ok" and out.count("<|im_end|>") == 1


def test_chat_plain_text_is_left_alone():
    assert chat.render("user", "a < b | c")[0] == "<|im_start|>user\na < b | c<|im_end|>\n"


def test_op8_equals_sql(spark, sf):
    rows = list({r[0]: r for r in documents() if r[0] is not None}.values())
    at = sf(documents=(rows, DOCS))
    got = queries.op8_quality(spark, at)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{at}/documents.parquet/*.parquet'")
    want = db.execute(f"select {', '.join(got.columns)} from ({queries.OP8_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_quality_ablation_and_columns(spark):
    df = spark.createDataFrame(documents(), DOCS).withColumnRenamed("row_place", "quality_ledger")
    assert quality.keep(df).columns == df.columns
    judged = quality.ledger(spark.createDataFrame(documents(), DOCS))
    bits = [r["b"] for r in judged.selectExpr("quality_ledger.fail_bits as b").collect()]
    for r in quality.ablation(judged).collect():
        bit = quality.BITS[r["rule"]]
        assert r["failed"] == sum(bool(b & bit) for b in bits) and r["failed_alone"] == bits.count(bit) and r["kept"] == bits.count(0)


def test_op9_law(spark, sf):
    rows = [(i % 90, f"t{i % 7}", "", "", 2, "") for i in range(3000)] + [(None, None, None, None, None, None)]
    got = queries.op9_sharding(spark, sf(documents=(rows, DOCS))).collect()
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert {len(s) for s in shards.values()} <= {75, 76} and len(shards) == 40
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in got) == Counter((d, zlib.crc32((t or "").encode()), len(t or "") + 16) for d, t, *_ in rows)


def test_hypergeometric_matrix():
    before, sizes = np.array([0, 7, 7, 30, 100]), sharding.even(100, 6)
    rows = np.array([sharding.matrix_row(before, sizes, 1, p) for p in range(4)])
    assert (rows.sum(0) == sizes).all() and (rows.sum(1) == np.diff(before)).all()
    big = [sharding.hypergeometric(np.random.default_rng(s), 5_000_000_000, 15_000_000_000, 8_000_000_000) for s in range(200)]
    sd = (8e9 * 0.25 * 0.75 * 0.6) ** 0.5
    assert abs(np.mean(big) - 2e9) < 0.3 * sd and 0.8 < np.std(big) / sd < 1.2


def test_shuffle_is_uniform(spark):
    """Mean slot of each input place over seeds is near the middle."""
    df = spark.range(40, numPartitions=4)
    total = np.zeros(40)
    for seed in range(12):
        for r in sharding.shard_documents(df, 2, seed=seed).collect():
            total[r["id"]] += r["shard"] * 20 + r["slot"]
    assert 8 < (total / 12).min() and (total / 12).max() < 31


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secret_texts():
    r = random.Random(6)
    bits = ["password", "PassWd", "secret", "token", "api_key", "ApiKey", '"', "'", " ", ":", "=", "abcdef", "x", "\n", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "é", "😀", "hunter2", "."]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(300)]
    gh = "ghp_" + "a1B2" * 9
    return [*odd_texts(), *texts, "secret=token: abcdefgh", "token = 'abc'\n" * 40 + "password: longenough1\n" * 100, f"{gh} xoxb-1234567890ab -----BEGIN RSA PRIVATE KEY-----", "a" * 30 + "\n" + "eyJhbGciOiJI.eyJzdWIiOiIx.abcd", "x.eyJhbGciOiJI.eyJzdWIiOiIx.abcd-----BEGIN PRIVATE KEY----- éeyJhbGciOiJI.eyJzdWIiOiIx.abcd zeyJhbGciOiJI.eyJzdWIiOiIx.abcd -----BEGIN  A1 PRIVATE KEY-----"]


def test_op7(spark, sf):
    rows = [(i, t, None, None, None, "x") for i, t in enumerate(secret_texts())]
    got = by_id(queries.op7_secrets(spark, sf(documents=(rows, DOCS))))
    for i, t, *_ in rows:
        base = brute_secrets(t or "")
        said = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[3] == k for x in base) for k in ("assign", "access", "hex")]
        assert not said or set(said.split(",")) <= set(got[i]["spans"].split(","))
    extra = " ".join(g["spans"] for g in got.values())
    assert all(f"{k}:" in extra for k in ("private_key", "source_host", "chat_host", "web_token"))


@pytest.mark.parametrize("name", ["pii_base", "sharding_law"])
def test_parts_that_sql_can_say(spark, sf, name):
    r = random.Random(7)
    bits = [*"ab@@..-+% 0123456789()", "x@y.z", "4111111111111111", "+1 555 123 4567", "192.168.0.1", "0" * 30 + "9.1.2.3", "\n"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 60))), None, None, None, "x") for i in range(900)]
    at = sf(documents=(rows, DOCS))
    got, db = queries.queries()[name](spark, at), duckdb.connect()
    db.execute(f"create view documents as select * from '{at}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(f"select {', '.join(got.columns)} from ({queries.oracle_sql()[name]})").fetchall())


def test_op7_equals_sql(spark, sf):
    """Base and added kinds, by DuckDB's regular expressions."""
    rows = [(i, t, None, None, None, "x") for i, t in enumerate(secret_texts())]
    at = sf(documents=(rows, DOCS))
    got = queries.op7_secrets(spark, at)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{at}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(f"select {', '.join(got.columns)} from ({queries.OP7_SQL})").fetchall())


def test_op7_long_lines(spark):
    """Lines of a million characters, for each rule some that its pattern nearly matches again and again."""
    n, key = 1_000_000, "-----BEGIN " + "AB " * 20_000 + "PRIVATE KEY-----"
    runs = ("password" + " " * 20, "password=", "eyJ", "eyJaaaaaaaaaa.", "AKIA", "AKIAX ", "0123456789abcdef", "a1 ", "-----BEGIN ", "-----BEGIN A B ", "ghp_", "xoxb-", "secret=abcdefg\n", "\n")
    texts = [*(x * (n // len(x)) for x in runs), key, key[:-5]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", secrets.secret_spans("text").alias("s")).selectExpr("i", "size(s) as n").collect()
    n_found = dict(map(tuple, rows))
    assert n_found[len(runs)] == 1 and n_found[len(runs) + 1] == 0 and n_found[runs.index("secret=abcdefg\n")] == n // 15 and n_found[runs.index("eyJ")] == 0


def test_postings_are_those_of_the_lines(spark):
    grams = secrets.vocabulary(secrets.RULES)
    texts = secret_texts()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", secrets.postings("text").alias("p")).collect()
    for r in rows:
        lines = (texts[r["i"]] or "").split("\n")
        want = {g: [k for k, x in enumerate(lines) if g in x.lower()] for g in grams}
        if "İ" not in (texts[r["i"]] or ""):
            assert r["p"] == {g: k for g, k in want.items() if k}


def test_trigram_queries():
    assert secrets.trigram_query(secrets.RULES[1].pattern) == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query(secrets.RULES[2].pattern) == []
    (clause,) = secrets.trigram_query(secrets.RULES[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in clause and len(clause) == 6
    assert frozenset({"pri", "riv", "iva", "vat", "ate", "te ", "e k", " ke", "key", " pr"}) in [a for c in secrets.trigram_query(secrets.RULES[3].pattern) for a in c]


def test_prefix_sums(spark):
    from pyspark.sql import functions as F

    rows = [(list(range(n)),) for n in (0, 1, 7, 8, 9, 31, 32, 33, 2000, 30_000)]
    for r in spark.createDataFrame(rows, "a array<int>").select("a", F.expr(secrets.prefix_sums("a")).alias("s")).collect():
        assert r["s"] == np.cumsum(r["a"]).tolist()


def test_sharding_beside_columns_of_its_names(spark):
    got = sharding.shard_documents(spark.range(10).selectExpr("id", "id as Shard", "id as slot_", "id as slot", "id as row_place", "id as bin"), 3)
    assert got.columns == ["id", "Shard", "slot_", "slot", "row_place", "bin", "shard_", "slot__"]
    assert sorted(r["shard_"] for r in got.collect()) == [0] * 4 + [1] * 3 + [2] * 3


def test_iban_before_capitals():
    iban = "DE89 3704 0044 0532 0130 00"
    for text in (f"IBAN {iban} BIC COBADEFFXXX", f"IBAN {iban}", f"AB12 CDEF GHIJ {iban} 77 {iban} XY"):
        found = [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"]
        assert found == [iban] * text.count(iban)
        assert "3704" not in pii.redacted(text)
