"""Quality rules as a ledger of bits, in DataFrame functions alone.

`ledger(text)` measures a text once and sets one bit for each rule that it fails.  Policies are masks with a version;
applying another one, or asking what each rule costs (`ablation`), needs only the ledger, never the text again.

Words are runs of anything but blank, tab and line ends.  Cases: a null or empty text has no words and fails
`few_words`; texts of fewer than three words have no windows.  Rows are judged one by one, so repeated rows and ties get
equal verdicts, and an empty table gives an empty ledger.  Only the text column is read; other columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: name: (failed when, of the measurements).  A rule's bit is its place here; add at the end only.
RULES: dict[str, Callable[[dict[str, Column]], Column]] = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "short_words": lambda m: m["word_chars"] < 2 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 30 * m["n_words"],
    "symbols": lambda m: 100 * m["n_symbols"] > 150 * m["n_words"],
    "repeated_lines": lambda m: (m["n_dup_lines"] >= 10) & (100 * m["n_dup_lines"] > 70 * m["n_lines"]),
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]
#: version: mask of the rules that reject.
POLICIES = {"base": BASE, "v1": sum(BITS.values())}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once: lambdas would inline it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words that stand in a window of three found twice or more."""
    n = F.size(words)
    windows = F.when(n < 3, F.lit(None)).otherwise(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def covered(places: Column) -> Column:
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda a: a["n"])

    def places(pairs: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(pairs, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(pairs, same), lambda x: x["i"]))

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0)).otherwise(let(pairs, lambda p: covered(places(p))))

    return let(windows, count)


def measured(text: Column) -> Column:
    """struct of the measurements, all bigint."""

    def of(t: Column) -> Column:
        words = F.array_remove(F.split(t, BLANKS), "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        symbols = sum((F.length(t) - F.length(F.replace(t, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0))
        by_words = let(
            words,
            lambda w: F.struct(
                F.size(w).alias("n_words"),
                F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("word_chars"),
                _repeated(w).alias("n_repeat_words"),
            ),
        )
        by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
        return let(
            F.struct(by_words.alias("w"), by_lines.alias("l"), symbols.alias("s")),
            lambda r: F.struct(
                *(r["w"][k].cast("bigint").alias(k) for k in ("n_words", "word_chars", "n_repeat_words")),
                *(r["l"][k].cast("bigint").alias(k) for k in ("n_lines", "n_dup_lines")),
                r["s"].cast("bigint").alias("n_symbols"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


MEASURES = ("n_words", "word_chars", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols")


def ledger(df: DataFrame, text: str = "text", into: str = "quality_ledger") -> DataFrame:
    """The rows with a struct column of all measurements and `fail_bits`; it takes the place of a column of that name."""
    out = df.withColumn(into, measured(F.col(text)))
    m = {k: F.col(into)[k] for k in MEASURES}
    bits = sum((F.when(rule(m), F.lit(BITS[name])).otherwise(0) for name, rule in RULES.items()), F.lit(0))
    return out.withColumn(into, F.struct(*(m[k].alias(k) for k in MEASURES), bits.cast("bigint").alias("fail_bits")))


def passes(policy: str = "v1", at: str = "quality_ledger") -> Column:
    return F.col(at)["fail_bits"].bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(ledgers: DataFrame, policy: str = "v1", at: str = "quality_ledger") -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that fail it alone, rows kept with and without it."""
    mask = POLICIES[policy]
    failed = F.col(at)["fail_bits"].bitwiseAND(F.lit(mask))
    rules = [(name, bit) for name, bit in BITS.items() if bit & mask]
    row = ledgers.agg(
        F.count_if(failed == 0).alias("kept"),
        *(F.count_if(failed.bitwiseAND(F.lit(bit)) != 0).alias(f"f{bit}") for _, bit in rules),
        *(F.count_if(failed == bit).alias(f"a{bit}") for _, bit in rules),
    )
    each = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"f{bit}").alias("failed"), F.col(f"a{bit}").alias("failed_alone"), F.col("kept"), (F.col("kept") + F.col(f"a{bit}")).alias("kept_without")) for name, bit in rules))
    return row.select(F.inline(each))


def keep(df: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they had."""
    at = fresh("quality_ledger", *df.columns)
    return ledger(df, text, at).where(passes(policy, at)).drop(at)
