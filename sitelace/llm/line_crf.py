"""Document quality from lines: a linear-chain conditional random field labels each line good or bad.

A line is described by numbers from its own bytes (shares of classes of characters, lengths, repeated words, whether its
words occurred before as a line of its text) and by the same numbers of the lines before and behind it.  The field adds weights for pairs
of labels of adjacent lines; forward and backward passes over all lines of a text give each line's probability of being
good, and their mean, weighted by length, is the text's.  A logistic map of that mean, fitted on the same sample, makes it
a probability of the label 1.

Labels exist for documents only.  A document labelled 1 has only good lines; one labelled 0 has at least one bad line, and
which ones is left to the field: the likelihood of "not all good" is one minus the path of good lines.  Both are maximised
on a bounded sample: the SAMPLE labelled documents whose ids have the smallest hashes, those of more than SAMPLE_LINES
lines or SAMPLE_BYTES bytes left out.  Scoring has no bound: every line of every text counts.

Null texts count as empty, and an empty text is one empty line.  Weights are code points plus one, so empty lines count a
little.  Equal texts have equal scores whatever their ids.  Labels that are neither 0 nor 1, or without an id, are left out;
of several for one id the larger counts.  Without labels of both kinds the score is the share of 1 among those there are,
(ones + 1) / (all + 2).  Texts are cut into pieces at line ends, so memory follows the longest line of a worker's batch;
what is kept for a text is some hundred numbers a line.  Other columns stay; new ones whose names are taken get
underscores.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, one_blas_thread, text_or_empty, worker_cache

SAMPLE, SAMPLE_LINES, SAMPLE_BYTES = 4096, 64, 1 << 18
#: Bytes that are described at once, unless a line is longer.
PIECE = 1 << 20
STEPS, RATE, DECAY = 250, 0.05, 1e-4
FLOOR = 1e-9

# --- lines as numbers -------------------------------------------------------------------------------------------------

CLASSES = ("blank", "upper", "lower", "digit", "stop", "shout", "symbol", "sign", "letter_byte", "continuation", "other")


def _class_table() -> np.ndarray:
    """The class of each byte."""
    of = np.full(256, CLASSES.index("other"), np.uint8)
    for name, members in (
        ("blank", b" \t\x0b\x0c\r\n"),
        ("upper", bytes(range(65, 91))),
        ("lower", bytes(range(97, 123))),
        ("digit", b"0123456789"),
        ("stop", b".,;:?"),
        ("shout", b"!"),
        ("symbol", b"#$%&*|<>=+~^_\\/@[]{}`"),
        ("sign", b"'\"()-"),
        ("letter_byte", bytes(range(0xC0, 0x100))),
        ("continuation", bytes(range(0x80, 0xC0))),
    ):
        of[list(members)] = CLASSES.index(name)
    return of


CLASS_OF = _class_table()
SHARES = ("upper", "lower", "digit", "stop", "shout", "symbol", "sign", "letter_byte", "blank", "other")
FEATURES = (*SHARES, "length", "word_length", "same_as_last_word", "repeated_words", "ends_in_stop", "seen_line")
FACTOR = 0x100000001B3


def _powers(n: int) -> np.ndarray:
    out = np.full(n, FACTOR, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _describe(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, code points, hashes) of the lines of a buffer in which a line feed ends each."""
    data = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    n, kinds = len(ends), len(CLASSES)
    classes = CLASS_OF[data]
    line_of = np.repeat(np.arange(n), ends - begins + 1)
    counts = np.bincount(line_of * kinds + classes, minlength=n * kinds).reshape(n, kinds).astype(float)
    at = CLASSES.index
    counts[:, at("blank")] -= 1  # the line feed itself
    chars = counts.sum(axis=1) - counts[:, at("continuation")]
    held = np.maximum(chars, 1)
    out = np.zeros((n, len(FEATURES)))
    for i, name in enumerate(SHARES):
        out[:, i] = np.sqrt(counts[:, at(name)] / held)
    put = lambda name, v: out.__setitem__((slice(None), FEATURES.index(name)), v)
    put("length", np.log1p(chars) / 4)
    letters = classes != at("blank")
    first = letters & np.concatenate([[True], ~letters[:-1]])
    words = np.flatnonzero(first)
    hashes = np.full(n, np.uint64(14695981039346656037))
    if len(words):
        # A word's hash is a polynomial in its bytes; whether bytes are the word's or the blanks' behind it is a factor.
        place = np.arange(len(data)) - np.repeat(words, np.diff(np.append(words, len(data)))).astype(np.int64) if words[0] == 0 else None
        if place is None:
            place = np.zeros(len(data), np.int64)
            place[words[0] :] = np.arange(words[0], len(data)) - np.repeat(words, np.diff(np.append(words, len(data))))
        terms = np.where(letters, data.astype(np.uint64) + np.uint64(1), np.uint64(0)) * _powers(int(place.max()) + 1)[place]
        sums = np.add.reduceat(terms, words)
        owner = line_of[words]
        per_line = np.bincount(owner, minlength=n)
        put("word_length", np.log1p((chars - counts[:, at("blank")]) / np.maximum(per_line, 1)) / 2)
        same = (sums[1:] == sums[:-1]) & (owner[1:] == owner[:-1])
        put("same_as_last_word", np.sqrt(np.bincount(owner[1:][same], minlength=n) / np.maximum(per_line - 1, 1)))
        order = np.lexsort((sums, owner))
        again = (sums[order][1:] == sums[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        repeats = np.bincount(owner[order][1:][again], minlength=n)
        # Long lines repeat words by nature: against the logarithm of their words.
        put("repeated_words", repeats / np.maximum(per_line, 1) / np.log2(per_line + 2))
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        rank = np.arange(len(words)) - np.repeat(starts, np.diff(np.append(starts, len(words))))
        mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes[owner[starts]] = np.add.reduceat(mixed * _powers(int(rank.max()) + 1)[rank], starts)
    last = np.where(ends > begins, classes[np.maximum(ends - 1, 0)], at("blank"))
    put("ends_in_stop", (last == at("stop")).astype(float))
    return out, chars, hashes


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, code points, lines of each text) of all lines of some texts."""
    n_lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    parts, piece, held = [], [], 0

    def close() -> None:
        nonlocal piece, held
        if piece:
            parts.append(_describe(b"".join(piece)))
        piece, held = [], 0

    for t in texts:
        at = 0
        while len(t) - at > PIECE:  # to the last line end within a piece, or the first behind it
            cut = t.rfind(b"\n", at, at + PIECE)
            cut = cut if cut >= 0 else t.find(b"\n", at + PIECE)
            if cut < 0:
                break
            close()
            parts.append(_describe(t[at : cut + 1]))
            at = cut + 1
        piece += [t[at:], b"\n"]
        held += len(t) - at + 1
        if held > PIECE:
            close()
    close()
    if not parts:
        return np.zeros((0, len(FEATURES))), np.zeros(0), n_lines
    rows, chars, hashes = (np.concatenate(p) for p in zip(*parts, strict=True))
    text_of = np.repeat(np.arange(len(texts)), n_lines)
    order = np.lexsort((hashes, text_of))  # stable, so of equal lines the earlier comes first
    seen = np.zeros(len(rows), bool)
    seen[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (text_of[order][1:] == text_of[order][:-1])
    rows[:, FEATURES.index("seen_line")] = seen & (chars > 0)
    return rows, chars, n_lines


def with_neighbours(rows: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Each line's numbers, then those of the line before and behind within its text, zeros at its ends, and whether there
    are such lines, and a one."""
    n, k = rows.shape
    out = np.zeros((n, 3 * k + 3))
    out[:, :k] = rows
    stops = np.cumsum(n_lines)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[(stops - n_lines)[n_lines > 0]] = True
    last[stops[n_lines > 0] - 1] = True
    out[1:, k : 2 * k] = rows[:-1]
    out[first, k : 2 * k] = 0
    out[:-1, 2 * k : 3 * k] = rows[1:]
    out[last, 2 * k : 3 * k] = 0
    out[:, 3 * k], out[:, 3 * k + 1], out[:, 3 * k + 2] = first, last, 1
    return out


# --- the field --------------------------------------------------------------------------------------------------------


def forward_backward(u: np.ndarray, n_lines: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains laid end to end, with `u` the weight of good against bad for each line and `pairs[i, j]` that of label j
    behind label i (0 bad, 1 good): (probability of good for each line, logarithm of each chain's sum over all labellings,
    expected number of each pair of labels in each chain).

    All chains take a step at once, longest first; messages are kept normalised."""
    order = np.argsort(-n_lines, kind="stable")
    lengths = n_lines[order]
    begin = (np.cumsum(n_lines) - n_lines)[order]
    total, longest = len(u), int(lengths[0]) if len(lengths) else 0
    good = np.exp(-np.logaddexp(0, -u))
    emit = np.stack([np.exp(-np.logaddexp(0, u)), good], axis=1)
    step = np.exp(pairs - pairs.max())
    alpha, beta, log_sum = np.empty((total, 2)), np.ones((total, 2)), np.zeros(len(n_lines))
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than t
    message = emit[begin]
    for t in range(longest):
        k = active[t]
        at = begin[:k] + t
        if t:
            message = (message[:k] @ step) * emit[at]
        norm = message.sum(axis=1)
        message = message / norm[:, None]
        alpha[at] = message
        log_sum[:k] += np.log(norm)
    expected = np.zeros((len(n_lines), 2, 2))
    for t in range(longest - 2, -1, -1):
        k = active[t + 1]
        at = begin[:k] + t
        ahead = emit[at + 1] * beta[at + 1]
        pair = alpha[at][:, :, None] * step * ahead[:, None, :]
        expected[:k] += pair / pair.sum(axis=(1, 2), keepdims=True)
        back = ahead @ step.T
        beta[at] = back / back.sum(axis=1, keepdims=True)
    both = alpha * beta
    p = both[:, 1] / both.sum(axis=1)
    log_z, counts = np.empty(len(n_lines)), np.empty_like(expected)
    log_z[order] = log_sum + np.maximum(lengths - 1, 0) * pairs.max()
    counts[order] = expected
    scale = np.logaddexp(0, u)  # emit is over both labels' sum
    log_z += np.add.reduceat(scale, np.cumsum(n_lines) - n_lines) if total else 0
    return p, log_z, counts


@dataclass(frozen=True)
class LineCrf:
    """Weights of standardised features, of pairs of labels, and the logistic map of the mean; `constant` is the score where
    nothing could be learnt."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def lines(self, rows: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        """Each line's probability of being good."""
        u = ((with_neighbours(rows, n_lines) - self.mean) / self.scale) @ self.weights
        return forward_backward(u, n_lines, self.pairs)[0]

    def means(self, rows: np.ndarray, chars: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length-weighted mean of the lines' probabilities, share of the weight that is rather bad) of each text."""
        p = self.lines(rows, n_lines)
        weight, at = chars + 1, np.cumsum(n_lines) - n_lines
        total = np.add.reduceat(weight, at)
        return np.add.reduceat(weight * p, at) / total, np.add.reduceat(weight * (p < 0.5), at) / total

    def scores(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _logit(mean) + self.shift, -40, 40)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def loss(u: np.ndarray, n_lines: np.ndarray, pairs: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(loss of each chain, its derivative by each line's weight, by the pairs): minus the log-likelihood of "all good" for
    label 1 and of "not all good" for label 0."""
    at = np.cumsum(n_lines) - n_lines
    p, log_z, counts = forward_backward(u, n_lines, pairs)
    path = np.add.reduceat(u, at) + (n_lines - 1) * pairs[1, 1] - log_z  # log-probability of all good
    path = np.minimum(path, -FLOOR)
    rest = -np.expm1(path)
    each = np.where(label == 1, -path, -np.log(rest))
    by_path = np.where(label == 1, -1.0, np.exp(path) / rest)
    by_u = np.repeat(by_path, n_lines) * (1 - p)
    straight = np.zeros_like(counts)
    straight[:, 1, 1] = n_lines - 1
    return each, by_u, by_path[:, None, None] * (straight - counts)


def learn(rows: np.ndarray, chars: np.ndarray, n_lines: np.ndarray, label: np.ndarray) -> LineCrf:
    """By full-batch Adam; both kinds of documents weigh the same, and in a kind all documents do."""
    ones, wide = int((label == 1).sum()), 3 * len(FEATURES) + 3
    if ones in (0, len(label)):
        return LineCrf(np.zeros(wide), np.ones(wide), np.zeros(wide), np.zeros((2, 2)), constant=(ones + 1) / (len(label) + 2))
    x = with_neighbours(rows, n_lines)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-9] = 0, 1
    x = (x - mean) / scale
    share = np.where(label == 1, 0.5 / ones, 0.5 / (len(label) - ones))
    theta = np.zeros(wide + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, STEPS + 1):
        _, by_u, by_pairs = loss(x @ theta[:wide], n_lines, theta[wide:].reshape(2, 2), label)
        g = np.concatenate([x.T @ (by_u * np.repeat(share, n_lines)), (by_pairs * share[:, None, None]).sum(axis=0).ravel()]) + DECAY * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    model = LineCrf(mean, scale, theta[:wide], theta[wide:].reshape(2, 2))
    slope, shift = _logistic(_logit(model.means(rows, chars, n_lines)[0]), label)
    return LineCrf(mean, scale, model.weights, model.pairs, slope, shift)


def _logistic(z: np.ndarray, label: np.ndarray, prior: float = 1e-3) -> tuple[float, float]:
    """Slope and shift by Newton's method, with a weak pull towards 1 and 0; a slope is never negative."""
    x, at = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    centre, pull = at.copy(), prior * len(z)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        g = x.T @ (p - label) + pull * (at - centre)
        h = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2)
        move = np.linalg.solve(h, g)
        at = at - move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


# --- on tables --------------------------------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> LineCrf:
    """Learns from `sample` labelled documents at most; which ones depends on their ids alone."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = known.orderBy(order, "id").limit(sample)  # ids and labels, no texts
    texts = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).cast("binary").alias("text")).join(F.broadcast(chosen), "id")
    small = texts.where((F.octet_length("text") <= SAMPLE_BYTES) & (F.size(F.split(F.col("text").cast("string"), "\n", -1)) <= SAMPLE_LINES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("line_crf")
        one_blas_thread()
        for batch in batches:
            rows, chars, n_lines = describe([t.as_py() for t in batch.column("text")])
            stops = np.cumsum(n_lines)
            whole = np.concatenate([rows, chars[:, None]], axis=1)
            cells = pa.array([whole[b - n : b].astype("<f4").tobytes() for b, n in zip(stops, n_lines, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label").cast(pa.int32()), cells], ["id", "label", "cells"])

    described = small.select("id", "label", "text").mapInArrow(run, "id string, label int, cells binary")
    taken = described.orderBy(F.xxhash64("id"), "id", "cells").limit(sample).collect()  # rows of one id may be many
    if not taken:
        return learn(np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(0, np.int64), np.zeros(0))
    cells = [np.frombuffer(r["cells"], "<f4").reshape(-1, len(FEATURES) + 1) for r in taken]
    whole = np.concatenate(cells).astype(float)
    return learn(whole[:, :-1], whole[:, -1], np.array([len(c) for c in cells]), np.array([r["label"] for r in taken]))


_KIND = pa.struct([("score", pa.float64()), ("mean", pa.float64()), ("bad_share", pa.float64()), ("n_lines", pa.int64())])


def quality(text: Column, model: LineCrf) -> Column:
    """struct(score, mean, bad_share, n_lines) of each text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_cache("line_crf")
        one_blas_thread()
        for column in batches:
            texts = [t.as_py() or b"" for t in column]
            if not texts:
                yield pa.array([], _KIND)
                continue
            rows, chars, n_lines = describe(texts)
            mean, bad = model.means(rows, chars, n_lines)
            score = model.scores(mean) if model.constant is None else np.full(len(texts), model.constant)
            yield pa.StructArray.from_arrays([pa.array(a) for a in (score, mean, bad, n_lines)], fields=list(_KIND))

    return F.arrow_udf(run, "struct<score:double,mean:double,bad_share:double,n_lines:bigint>")(text.cast("binary"))


def line_labels(text: Column, model: LineCrf) -> Column:
    """The probability of being good of each line of each text, in order."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_cache("line_crf")
        one_blas_thread()
        for column in batches:
            rows, _, n_lines = describe([t.as_py() or b"" for t in column])
            p = model.lines(rows, n_lines) if len(rows) else np.zeros(0)
            offsets = np.concatenate([[0], np.cumsum(n_lines)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(p))

    return F.arrow_udf(run, "array<double>")(F.coalesce(text, F.lit("")).cast("binary"))


def score_documents(docs: DataFrame, model: LineCrf, text: str = "text") -> DataFrame:
    """The rows with `quality_score`, `quality_bad_share` and `quality_lines`."""
    cell = fresh("quality_cell", *docs.columns)
    out = docs.withColumn(cell, quality(text_or_empty(text), model))
    for name, part in (("quality_score", "score"), ("quality_bad_share", "bad_share"), ("quality_lines", "n_lines")):
        out = out.withColumn(fresh(name, *docs.columns), F.col(cell)[part])
    return out.drop(cell)
