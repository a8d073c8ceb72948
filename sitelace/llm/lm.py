"""Log-bilinear language model, trained by noise-contrastive estimation, with normalised token probabilities.

The CLASSES - 2 most frequent training words are classes of their own, and the end of a text is one.  All other words, seen
or not, lie in at most GROUPS groups by their last bytes, each of which is a class.  A class is predicted from the two before it: its vector's product with the sum of their vectors, each sent through the
matrix of its place, plus a bias.  Training runs over all training tokens where they lie, in ROUNDS over disjoint parts
of the texts; after each round the tasks' parameters are averaged by their tokens.  For scoring, one product of
exp-tables gives the normaliser of every pair of contexts at once, so probabilities sum to one.  Within a group a second
log-bilinear model, over the words before, predicts the word: each hot word has its vectors as target and as context, and the
group's other words share theirs.  It is trained with noise from the group, normalised over the group's members, and its rows
are averaged by how often each task met them.  A word that is not hot has the probability of its group's others times its
add-one share in them, where one share is for all words of the group never seen.

Word counts cover the whole training part.  At most HOT_WORDS of the most frequent go to the workers, each of LONG bytes
at most: a longer word counts as a digest of 16 bytes, in all that is done with it.  Texts' other words are joined to the count table by a shuffle, so every count is exact.

Cases: null or empty texts have one token, their end.  A null id counts as the empty string for the held-out rule.  Equal
rows get a row each.  An empty table gives an empty result; a table whose every row is held out has N = V = 0 and the
uniform model.  Words equally frequent are ranked by their bytes.  Long texts and long words are like others: a text is
scored whole, in memory in proportion to it.  Only the id and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import one_blas_thread, worker_cache, written

CLASSES, DIM, NOISE, BATCH, ROUNDS, RATE = 1024, 16, 16, 512, 2, 0.2
GROUPS, GROUP_WORDS, GROUP_NOISE, GROUP_BATCH, GROUP_RATE = 384, 64, 16, 8192, 0.1
#: Words whose parameters travel in one row.
SLICE = 4096
HOT_WORDS = 100_000
#: Longer words stand as a digest behind a byte that no word has, so every word has this many bytes at most.
LONG = 64
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 400_000
#: Tasks whose parameters are added up at once, and tasks that make the last sums; each of these sends its own to the driver.
TASKS, ADDERS = 32, 16
#: Tokens that a training task has on average at least: fewer tasks train where there are fewer.
PART_TOKENS = 1 << 20
END = b""
BUFFER = 1 << 16
#: Targets of a group that meet their noise in one block; scores held at once within a group; bound below which exp and sums of it stay finite.
LANES, CELLS, SAFE = 16, 1 << 17, 60.0


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, then the end: both methods of bytes know ASCII only."""
    words = (text or "").encode().lower().split()
    if words and max(map(len, words)) > LONG:
        words = [w if len(w) <= LONG else b"\t" + blake2b(w, digest_size=16).digest() for w in words]
    words.append(END)
    return words


def held_out() -> str:
    return "crc32(coalesce(cast(doc_id as string), '')) % 7 = 2"


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over one column of texts, added up in tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

        for b in batches:
            for t in b.column(0):
                seen.update(tokens(t.as_py()))
                if len(seen) > HELD_WORDS:
                    yield batch()
                    seen.clear()
        if seen:
            yield batch()

    return texts.mapInArrow(count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Words:
    """Ranks and counts of the hot words, and their classes: 0 the end, 1 to `groups` the groups, then by rank.

    `edges` are the least reversed words of the groups from the second on; `others` has, by group, the tokens and the words
    that are not hot.  An id is a hot word's rank, or the number of hot words and a group, for the group's others."""

    def __init__(self, ranked: list[tuple[bytes, int]], total: int, distinct: int, classes: int = CLASSES, edges: list[bytes] = (), others: np.ndarray | None = None):
        counts = dict(ranked)
        own = [(w, c) for w, c in ranked if w != END]
        self.counts = np.array([counts.get(END, 0), *(c for _, c in own)], np.int64)
        self.rank = {END: 0} | {w: i + 1 for i, (w, _) in enumerate(own)}
        self.edges, self.groups = list(edges), len(edges) + 1
        n, hot = min(classes - 2, len(own)), len(self.counts)
        self.classes = n + 1 + self.groups
        if others is None:
            others = np.array([[total - int(self.counts.sum()), distinct - len(counts)]])
        group = np.array([self.group(w) for w, _ in own[n:]], np.int64)
        self.class_of = np.zeros(hot, np.int32)
        self.class_of[1 : n + 1] = np.arange(n) + 1 + self.groups
        self.class_of[n + 1 :] = group + 1
        known = int(self.counts[: n + 1].sum())
        self.total, self.distinct = total, distinct
        self.rest_size = (total - known) + (distinct - n - (END in counts)) + 1
        self.others_size = others.sum(axis=1) + 1
        tokens = np.bincount(group, self.counts[n + 1 :], self.groups) + others[:, 0]
        mass = np.array([self.counts[0], *tokens, *self.counts[1 : n + 1]], np.float64) + 1
        self.unigram = mass / mass.sum()
        # Members of the groups, one group after the other.
        ids = np.concatenate([np.arange(n + 1, hot), hot + np.arange(self.groups)])
        of = np.concatenate([group, np.arange(self.groups)])
        by = np.argsort(of, kind="stable")
        self.members = ids[by]
        self.first = np.searchsorted(of[by], np.arange(self.groups + 1))
        self.share = np.ones(hot + self.groups)
        self.share[ids] = np.concatenate([self.counts[n + 1 :] + 1, self.others_size])
        size = np.add.reduceat(self.share[self.members], self.first[:-1])
        self.share[ids] /= size[of]

    def group(self, word: bytes) -> int:
        return bisect_right(self.edges, word[::-1])

    def ranks(self, words: list[bytes]) -> list[int]:
        """Ranks of hot words; of others, the negative of their group's class."""
        get, edges = self.rank.get, self.edges
        return [r if (r := get(w)) is not None else -1 - bisect_right(edges, w[::-1]) for w in words]

    def classes_of(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks < 0, -ranks, self.class_of[np.maximum(ranks, 0)])

    def ids(self, ranks: np.ndarray) -> np.ndarray:
        return np.where(ranks < 0, len(self.counts) - 1 - ranks, ranks)


class Model:
    """Vectors of contexts (r) and of targets (q) with their biases behind, matrices of the two places (c)."""

    def __init__(self, unigram: np.ndarray, dim: int = DIM, seed: int = 3):
        g, m = np.random.default_rng(seed), len(unigram)
        self.r = (0.1 * g.standard_normal((m, dim))).astype(np.float32)
        self.q = np.concatenate([0.1 * g.standard_normal((m, dim)), np.log(unigram)[:, None]], axis=1).astype(np.float32)
        self.c = np.stack([np.eye(dim), 0.5 * np.eye(dim)]).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.c)]).astype(np.float64)

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for name in ("r", "q", "c"):
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (previous, class), by (one before, class), and log normalisers by (previous, one before)."""
        q, bias = self.q[:, :-1], self.q[:, -1]
        one, two = self.r @ self.c[0] @ q.T + bias, self.r @ self.c[1] @ q.T
        top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        z = np.exp((one - top1).astype(np.float64)) @ np.exp((two - top2).astype(np.float64)).T
        return one, two, (np.log(z) + top1 + top2.T).astype(np.float32)


def run_starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, in sorted values."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def by_group(group: np.ndarray) -> np.ndarray:
    """The stable order by group; numbers of 16 bits are sorted by radix."""
    return np.argsort(group.astype(np.uint16) if GROUPS < 1 << 16 else group, kind="stable")


def miss(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), which tanh gives without overflow."""
    return 0.5 - 0.5 * np.tanh(0.5 * x)


class Trainer:
    """Steps of Adagrad on the NCE objective; noise classes are shared by a batch."""

    def __init__(self, model: Model, unigram: np.ndarray, seed: int):
        self.m, self.noise, self.log_noise = model, unigram, np.log(NOISE * unigram).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.g = np.random.default_rng(seed)
        self.seen = {k: np.full_like(getattr(model, k), 1e-2) for k in ("r", "q", "c")}

    def apply(self, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        """Adds each row's gradients up and moves the rows that have any."""
        bits = len(rows).bit_length()
        keys = np.sort((rows.astype(np.int64) << bits) + np.arange(len(rows)))  # rows with their places: faster than argsort
        rows, by = keys >> bits, keys & ((1 << bits) - 1)
        at = run_starts(rows)
        own, grad = rows[at], np.add.reduceat(grads.take(by, axis=0), at, axis=0)
        seen = self.seen[name].take(own, axis=0) + grad * grad
        self.seen[name][own] = seen
        getattr(self.m, name)[own] += RATE * grad / np.sqrt(seen)

    def step(self, w: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> None:
        m, n = self.m, len(w)
        before = np.concatenate([p1, p2])
        r, qw = m.r.take(before, axis=0), m.q.take(w, axis=0)
        r1, r2 = r[:n], r[n:]
        h = np.ones((n, DIM + 1), np.float32)  # the last column is for biases
        h[:, :-1] = r1 @ m.c[0] + r2 @ m.c[1]
        noise = np.minimum(np.searchsorted(self.cumulative, self.g.random(NOISE)), len(self.noise) - 1)
        qn = m.q[noise]
        true = np.einsum("ij,ij->i", h, qw) - self.log_noise[w]
        false = h @ qn.T - self.log_noise[noise]
        gt, gf = miss(true) / n, miss(-false) / -n
        dh = (gt[:, None] * qw + gf @ qn)[:, :-1]
        dc = np.stack([r1.T @ dh, r2.T @ dh])
        self.apply("q", np.concatenate([w, noise]), np.concatenate([gt[:, None] * h, gf.T @ h]))
        self.apply("r", before, np.concatenate([dh @ m.c[0].T, dh @ m.c[1].T]))
        self.seen["c"] += dc * dc
        m.c = m.c + RATE * dc / np.sqrt(self.seen["c"])


class Inner:
    """Within groups: for each id a vector as context (r), one as target with a bias behind it (q), and matrices of the two
    places (c)."""

    def __init__(self, words: Words, seed: int = 4):
        g, n = np.random.default_rng(seed), len(words.share)
        rows = np.concatenate([0.1 * g.standard_normal((n, 2 * DIM)), np.log(words.share)[:, None]], axis=1)
        self.load(rows.astype(np.float32), np.stack([np.eye(DIM), 0.5 * np.eye(DIM)]).astype(np.float32))

    def load(self, rows: np.ndarray, c: np.ndarray) -> Inner:
        self.r, self.q, self.c = rows[:, :DIM].copy(), rows[:, DIM:].copy(), c.copy()
        return self

    def rows(self, ids: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.concatenate([self.r[ids], self.q[ids]], axis=1)

    def hidden(self, r1: np.ndarray, r2: np.ndarray) -> np.ndarray:
        """Contexts sent through their places; the last column multiplies the biases."""
        h = np.ones((len(r1), DIM + 1), np.float32)
        h[:, :-1] = r1 @ self.c[0]
        h[:, :-1] += r2 @ self.c[1]
        return h

    def logs(self, words: Words, group: np.ndarray, w: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
        """Log probabilities of ids in their groups."""
        by = by_group(group)
        ends = np.searchsorted(group[by], np.arange(words.groups + 1))
        h = self.hidden(self.r.take(p1[by], axis=0), self.r.take(p2[by], axis=0))
        true = np.einsum("ij,ij->i", h, self.q.take(w[by], axis=0))
        length = np.sqrt(np.einsum("ij,ij->i", h, h))
        for g in np.flatnonzero(np.diff(ends)).tolist():
            q = self.q.take(words.members[words.first[g] : words.first[g + 1]], axis=0)
            longest, n, turned = np.sqrt(np.einsum("ij,ij->i", q, q).max()), max(1, CELLS // len(q)), np.ascontiguousarray(q.T)
            for a in range(ends[g], ends[g + 1], n):
                span = slice(a, min(a + n, ends[g + 1]))
                scores = h[span] @ turned
                # No score is farther from 0 than the product of the lengths; only where exp might overflow is the top taken off.
                if not length[span].max() * longest < SAFE:
                    top = scores.max(axis=1)
                    scores -= top[:, None]
                    true[span] -= top
                true[span] -= np.log(np.exp(scores, out=scores).sum(axis=1))
        out = np.empty_like(true)
        out[by] = true
        return out


class InnerTrainer:
    """Steps of Adagrad on the rows that a batch meets; a batch's targets in one group share noise drawn from it."""

    def __init__(self, inner: Inner, words: Words, seed: int):
        self.m, self.words, self.g = inner, words, np.random.default_rng(seed)
        share = words.share[words.members]
        self.cumulative = np.concatenate([[0], np.cumsum(share)])
        self.log_noise = np.log(GROUP_NOISE * words.share).astype(np.float32)
        self.seen = {"r": np.full_like(inner.r, 1e-1), "q": np.full_like(inner.q, 1e-1), "c": np.full_like(inner.c, 1e-1)}
        self.times = np.zeros(len(inner.r), np.float32)

    def apply(self, name: str, ids: np.ndarray, grads: np.ndarray, times: np.ndarray) -> None:
        # Ids with their places sort faster than an argsort of ids, to the same order.
        bits = len(ids).bit_length()
        keys = np.sort((ids << bits) + np.arange(len(ids)))
        ids, by = keys >> bits, keys & ((1 << bits) - 1)
        at = run_starts(ids)
        own, grad = ids[at], np.add.reduceat(grads.take(by, axis=0), at, axis=0)
        seen = self.seen[name].take(own, axis=0) + grad * grad
        self.seen[name][own] = seen
        getattr(self.m, name)[own] += GROUP_RATE * grad / np.sqrt(seen)
        self.times[own] += np.add.reduceat(times[by], at)

    def step(self, group: np.ndarray, w: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> None:
        m, first = self.m, self.words.first
        by = by_group(group)
        group, w, p1, p2 = group[by], w[by], p1[by], p2[by]
        at = run_starts(group)
        own, sizes = group[at], np.diff(np.append(at, len(w)))
        low, high = first[own][:, None], first[own + 1][:, None]
        u = self.cumulative[low] + self.g.random((len(own), GROUP_NOISE)) * (self.cumulative[high] - self.cumulative[low])
        noise = self.words.members[np.clip(np.searchsorted(self.cumulative, u, side="right") - 1, low, high - 1)]
        r1, r2, qw, qn = m.r.take(p1, axis=0), m.r.take(p2, axis=0), m.q.take(w, axis=0), m.q.take(noise, axis=0)
        h = m.hidden(r1, r2)
        # Each group's targets in blocks of LANES, the last filled up with zeros: all blocks meet their noise in one product.
        blocks = -(-sizes // LANES)
        before = np.cumsum(blocks) - blocks
        of = np.repeat(np.arange(len(own)), blocks)
        slot = np.arange(len(w)) + np.repeat(before * LANES - at, sizes)
        laid, against = np.zeros((len(of) * LANES, DIM + 1), np.float32), qn.take(of, axis=0)
        laid[slot] = h
        laid = laid.reshape(-1, LANES, DIM + 1)
        false = laid @ against.transpose(0, 2, 1)
        false -= self.log_noise[noise][of][:, None, :]
        true = np.einsum("ij,ij->i", h, qw) - self.log_noise[w]
        gt, gf = miss(true), -miss(-false)
        dn = np.add.reduceat(gf.transpose(0, 2, 1) @ laid, before, axis=0)
        dh = (gt[:, None] * qw + (gf @ against).reshape(-1, DIM + 1).take(slot, axis=0))[:, :-1]
        dc = np.stack([r1.T @ dh, r2.T @ dh]) / len(w)
        dr = np.concatenate([dh @ m.c[0].T, dh @ m.c[1].T])
        once = np.ones(2 * len(w), np.float32)
        met = np.concatenate([once[: len(w)], np.repeat(sizes, GROUP_NOISE).astype(np.float32)])
        self.apply("q", np.concatenate([w, noise.ravel()]), np.concatenate([gt[:, None] * h, dn.reshape(-1, DIM + 1)]), met)
        self.apply("r", np.concatenate([p1, p2]), dr, once)
        self.seen["c"] += dc * dc
        m.c = m.c + GROUP_RATE * dc / np.sqrt(self.seen["c"])


def contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; texts begin after an end."""
    p1, p2 = np.empty_like(classes), np.empty_like(classes)
    p1[1:], p2[2:] = classes[:-1], classes[:-2]
    p2[:2] = 0
    p1[starts] = p2[starts] = 0
    second = starts + 1
    p2[second[second < len(classes)]] = 0
    return p1, p2


def moved(part: int, turn: int, ids: np.ndarray, times: np.ndarray, delta: np.ndarray) -> pa.RecordBatch:
    """How far a slice's parameters have moved, in 16 bits each, and how often each row was met."""
    row = {"part": part, "turn": turn, "n": 0.0, "ids": ids.astype(np.int32).tobytes(), "times": times.astype(np.float32).tobytes(), "p": delta.astype(np.float16).tobytes()}
    return pa.RecordBatch.from_pylist([row])


def arrived(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, times, delta = (np.frombuffer(bytes(row[k]), t) for k, t in (("ids", np.int32), ("times", np.float32), ("p", np.float16)))
    return ids, times[:, None].astype(np.float64), delta.reshape(-1, 2 * DIM + 1).astype(np.float32)


def train(ranked: DataFrame, words: Words, sent, model: Model, inner: Inner, round_no: int) -> None:
    """One round over one column of ranks: every task trains on its texts from the same start; the means by tokens are the
    result."""
    tasks = ranked.rdd.getNumPartitions()
    if (most := max(1, words.total // PART_TOKENS)) < tasks:
        ranked, tasks = ranked.coalesce(most), most
    start = ranked.sparkSession.sparkContext.broadcast((model.flat(), inner.rows(), inner.c))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, n, task = _words(sent), 0, TaskContext.get().partitionId()
        own, within = Model(known.unigram).load(start.value[0]), Inner.__new__(Inner).load(*start.value[1:])
        trainer = Trainer(own, known.unigram, seed=1000 * round_no + task % 1000)
        second = InnerTrainer(within, known, seed=1000 * round_no + task % 1000)
        waiting: list[np.ndarray] = []
        size = 0

        def learn():
            ranks = np.concatenate(waiting).astype(np.int64)
            starts = np.cumsum([0, *(len(x) for x in waiting[:-1])])
            w, ids = known.classes_of(ranks), known.ids(ranks)
            p1, p2 = contexts(w, starts)
            order = trainer.g.permutation(len(w))
            for a in range(0, len(order), BATCH):
                i = order[a : a + BATCH]
                trainer.step(w[i], p1[i], p2[i])
            p1, p2 = contexts(ids, starts)
            order = order[(w[order] > 0) & (w[order] <= known.groups)]
            for a in range(0, len(order), GROUP_BATCH):
                i = order[a : a + GROUP_BATCH]
                second.step(w[i] - 1, ids[i], p1[i], p2[i])

        for b in batches:
            for t in b.column(0):
                waiting.append(np.frombuffer(t.as_py(), "<i4"))
                size += len(waiting[-1])
                if size >= BUFFER:
                    learn()
                    n, size, waiting = n + size, 0, []
        if waiting:
            learn()
            n += size
        if n:
            flat = np.concatenate([own.flat(), within.c.ravel()]) * n
            turn = task // TASKS
            yield pa.RecordBatch.from_pylist([{"part": -1 - task // TASKS % ADDERS, "turn": turn, "n": float(n), "ids": b"", "times": b"", "p": flat.tobytes()}])
            met = np.flatnonzero(second.times)
            for part in np.unique(met // SLICE).tolist():
                ids = met[met // SLICE == part]
                yield moved(part, turn, ids, second.times[ids], within.rows(ids) - start.value[1][ids])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flats: dict[tuple[int, int], tuple] = {}
        slices: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                part, turn = r["part"], r["turn"] // TASKS
                if part < 0:
                    n, p = flats.get((part, turn), (0.0, 0.0))
                    flats[part, turn] = n + r["n"], p + np.frombuffer(r["p"])
                else:
                    held = slices.setdefault((part, turn), np.zeros((SLICE, 2 * DIM + 2)))
                    ids, times, delta = arrived(r)
                    held[ids - part * SLICE] += np.concatenate([delta * times, times], axis=1)
        for (part, turn), (n, p) in flats.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "turn": turn, "n": n, "ids": b"", "times": b"", "p": p.tobytes()}])
        for (part, turn), held in slices.items():
            ids = np.flatnonzero(held[:, -1])
            yield moved(part, turn, ids + part * SLICE, held[ids, -1], held[ids, :-1] / held[ids, -1:])

    shape = "part bigint, turn bigint, n double, ids binary, times binary, p binary"
    # Sums of TASKS at a time, in as many levels as that takes: no task reads a slice from more.
    some, turns = ranked.mapInArrow(fit, shape), -(-tasks // TASKS)
    while True:
        some = some.repartition("part", "turn").mapInArrow(total, shape)
        if turns <= TASKS:
            break
        turns = -(-turns // TASKS)
    sums = some.repartition(ADDERS, "part").mapInArrow(total, shape).collect()  # ADDERS rows at most, and one for each slice
    flats = [r for r in sums if r["part"] < 0]
    if n := sum(r["n"] for r in flats):
        flat = sum(np.frombuffer(bytes(r["p"])) for r in flats) / n
        model.load(flat[: -inner.c.size])
        rows = inner.rows()
        for r in sums:
            if r["part"] >= 0:
                ids, _, delta = arrived(r)
                rows[ids] += delta
        inner.load(rows, flat[-inner.c.size :].reshape(inner.c.shape).astype(np.float32))
    start.unpersist()


def _words(sent) -> Words:
    """The broadcast words, made ready once for each worker."""
    one_blas_thread()
    value, held = sent.value, worker_cache("lm")
    if held.get("of") is not value:
        held.clear()
        held |= {"of": value, "words": Words(*value)}
    return held["words"]


def _learnt(learnt, known: Words) -> tuple[Inner, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The inner model and the first one's tables, which are made once for each worker, not for each task."""
    value, held = learnt.value, worker_cache("lm")
    if held.get("learnt") is not value:
        held |= {"learnt": value, "tables": Model(known.unigram).load(value[0]).tables()}
    return value[1], held["tables"]


RANKED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("key", pa.int64()), ("turn", pa.int64()), ("ranks", pa.binary()),
    ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())),
])
RANKED_DDL = "doc_id bigint, held_out boolean, key bigint, turn bigint, ranks binary, words array<binary>, times array<int>"
SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("key", pa.int64()), ("n_tokens", pa.int64()), ("n_hot", pa.int64()), ("hot_log", pa.float64()), ("model_log", pa.float64()),
])
SCORED_DDL = "doc_id bigint, held_out boolean, key bigint, n_tokens bigint, n_hot bigint, hot_log double, model_log double"


def _ranked(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, key, turn, text) -> the ranks of its tokens, in 32 bits, and its words that are not hot with their
    times.  All that follows reads these, so texts are split and looked up once."""
    known = _words(sent)
    for b in batches:
        split = [tokens(t.as_py()) for t in b.column(4)]
        ranks = [np.array(known.ranks(x), "<i4") for x in split]
        others = [Counter(x[i] for i in np.flatnonzero(r < 0).tolist()) for x, r in zip(split, ranks, strict=True)]
        columns = [
            *(b.column(i) for i in range(4)), pa.array([r.tobytes() for r in ranks], pa.binary()),
            pa.array([list(o.keys()) for o in others], pa.list_(pa.binary())), pa.array([list(o.values()) for o in others], pa.list_(pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=RANKED)


def _score(batches: Iterator[pa.RecordBatch], sent, learnt) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, key, ranks) -> sums over the hot words and both models."""
    known = _words(sent)
    inner, (one, two, z) = _learnt(learnt, known)
    logs = np.log10(np.append(known.counts, 0) + 1.0)  # the last is for words that are not hot
    seen, share = np.append(known.counts > 0, False), np.log10(known.others_size)
    for b in batches:
        if not b.num_rows:
            continue
        ranks = [np.frombuffer(r.as_py(), "<i4") for r in b.column(3)]
        sizes = np.array([len(r) for r in ranks])
        starts = np.cumsum(sizes) - sizes
        flat_ranks = np.concatenate(ranks).astype(np.int64)
        w, ids = known.classes_of(flat_ranks), known.ids(flat_ranks)
        p1, p2 = contexts(w, starts)
        lp = (one[p1, w] + two[p2, w] - z[p1, p2]).astype(np.float64)
        p1, p2 = contexts(ids, starts)
        grouped = np.flatnonzero((w > 0) & (w <= known.groups))
        for a in range(0, len(grouped), 4 * BUFFER):
            i = grouped[a : a + 4 * BUFFER]
            lp[i] += inner.logs(known, w[i] - 1, ids[i], p1[i], p2[i])
        lp /= np.log(10)
        more = flat_ranks < 0
        lp[more] -= share[-1 - flat_ranks[more]]
        flat_ranks = np.where(more, -1, flat_ranks)
        columns = [
            b.column(0), b.column(1), b.column(2), pa.array(sizes, pa.int64()),
            pa.array(np.add.reduceat(seen[flat_ranks].astype(np.int64), starts)), pa.array(np.add.reduceat(logs[flat_ranks], starts)), pa.array(np.add.reduceat(lp, starts)),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=SCORED)


def hot_words(counts: DataFrame, most: int = HOT_WORDS) -> list[tuple[bytes, int]]:
    """The words from a count on above which there are at most `most`, by count, then bytes.

    The bound comes from a histogram of at most 1,024 bins, so no task sends more than its share of the words."""
    level = F.floor(F.log2(F.col("c")) * 16)
    edge, held = None, 0
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > most:
            break
        edge = r["level"]
    if edge is None:
        return []
    rows = counts.where(level >= edge).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def known_words(counts: DataFrame, most: int | None = None) -> list[tuple[bytes, int]]:
    """The hot words, and whatever the histogram says the end and the most frequent words, which become classes."""
    ranked = hot_words(counts, HOT_WORDS if most is None else most)
    end = [(END, r["c"]) for r in counts.where(F.col("word") == F.lit(END)).collect()] if END not in dict(ranked) else []
    lacks = CLASSES - 2 - len([w for w, _ in ranked if w != END])
    if lacks > 0:
        below = counts.where(F.col("word") != F.lit(END))
        if ranked:
            below = below.where(F.col("c") < ranked[-1][1])
        ranked = ranked + [(bytes(r["word"]), r["c"]) for r in below.orderBy(F.desc("c"), "word").limit(lacks).collect()]
    return sorted(ranked + end, key=lambda x: (-x[1], x[0]))


def group_edges(ranked: list[tuple[bytes, int]], classes: int = CLASSES) -> list[bytes]:
    """Least reversed words of the groups from the second on, so that each has about as many hot words."""
    turned = sorted(w[::-1] for w, _ in [x for x in ranked if x[0] != END][classes - 2 :])
    n = max(1, min(GROUPS, len(turned) // GROUP_WORDS))
    return [turned[len(turned) * i // n] for i in range(1, n)]


def other_sizes(counts: DataFrame, ranked: list[tuple[bytes, int]], edges: list[bytes]) -> np.ndarray:
    """By group, the tokens and the words that are not hot; a row for each group reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(edges) + 1, 2), np.int64)
        for b in batches:
            of = np.array([bisect_right(edges, w[::-1]) for w in b.column(0).to_pylist()], np.int64)
            c = b.column(1).to_numpy()
            np.add.at(held, of, np.stack([c, np.ones_like(c)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held[:, 0]), pa.array(held[:, 1])], ["g", "c", "n"])

    out = np.zeros((len(edges) + 1, 2), np.int64)
    for r in counts.mapInArrow(add, "g bigint, c bigint, n bigint").groupBy("g").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        out[r["g"]] = r["c"], r["n"]
    for w, c in ranked:
        out[bisect_right(edges, w[::-1])] -= (c, 1)
    return out


def counted(texts: DataFrame) -> tuple[DataFrame, Row, object]:
    """One column of training texts -> word counts, their totals (total, distinct), the broadcast hot words."""
    counts = written(word_counts(texts), "counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    ranked = known_words(counts)
    edges = group_edges(ranked)
    sent = texts.sparkSession.sparkContext.broadcast((ranked, sums["total"], sums["distinct"], CLASSES, edges, other_sizes(counts, ranked, edges)))
    return counts, sums, sent


def fit(ranked: DataFrame, sent, rounds: int = ROUNDS) -> tuple[Model, Inner]:
    """Both models from the training rows of `_ranked`, a round for each turn."""
    words = Words(*sent.value)
    model, inner = Model(words.unigram), Inner(words)
    for i in range(rounds):
        train(ranked.where(F.col("turn") == i).select("ranks"), words, sent, model, inner, i)
    return model, inner


def score_documents(df: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learnt from the rows that are not held out."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.expr(held_out()).alias("held_out"))
    counts, sums, sent = counted(rows.where("not held_out").select("text"))
    total, distinct = sums["total"], sums["distinct"]
    # The key goes with the row through Python and is written with it, so it is drawn once.
    keyed = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", F.monotonically_increasing_id().alias("key"), F.pmod(F.xxhash64("text"), F.lit(rounds)).alias("turn"), "text")
    ranked = written(keyed.mapInArrow(lambda b: _ranked(b, sent), RANKED_DDL), "ranks")
    model, inner = fit(ranked.where("not held_out"), sent, rounds)
    learnt = df.sparkSession.sparkContext.broadcast((model.flat(), inner))
    scored = ranked.select("doc_id", "held_out", "key", "ranks").mapInArrow(lambda b: _score(b, sent, learnt), SCORED_DDL)
    pairs = ranked.select("key", F.explode(F.arrays_zip("words", "times")).alias("p")).select("key", F.col("p.words").alias("word"), F.col("p.times").alias("times"))
    # Words are unique in the counts, so a partition of them makes a small table, and the many pairs need no sort.
    found = pairs.join(counts.hint("shuffle_hash"), "word").groupBy("key").agg(F.sum("times").alias("n_more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_log"))
    both = scored.join(found, "key", "left")
    more = F.coalesce("more_log", F.lit(0.0))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_hot") + F.coalesce("n_more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("hot_log") + more - F.col("n_tokens") * float(np.log10(total + distinct + 1))).alias("base_score"),
        (F.col("model_log") + more).alias("score"),
    )
