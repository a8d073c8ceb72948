"""Benchmark passages in documents, by q-gram lemma filtering.

Texts are lowered, every run of blanks and ASCII punctuation becomes one space, and characters are UTF-8 bytes.  An item
counts as found where PIECE bytes of it in a row, from some multiple of PIECE_STEP on or its last ones, occur with at most
EDITS of them edited; a shorter item is one piece.  So any verbatim PIECE + PIECE_STEP - 1 = 79 bytes of an item are found,
whatever its length, as they hold a whole piece.  A copy of a piece of length n with at most k = n * EDITS edits shares
n + 1 - q - q * k of the piece's q-grams with the document, all within k + 1 neighbouring diagonals.  Shared q-grams are
therefore counted in bands of 2 * STEP diagonals, each overlapping the next by half; bands that reach the bound are
verified by alignment within the band, all candidates at once.

The index has one posting for each byte of the items, not of the pieces.  Shared q-grams that follow each other on a
diagonal are counted as one run: postings are sorted by gram and the byte before it, so only those that the text's byte
before does not go on are expanded, and a passage that thousands of items share costs one run for each, not one posting
for each of its grams.  Texts are taken in stretches of STRETCH bytes, and those in slices of at most SLICE postings that
overlap by an occurrence, so memory does not grow with a text, a batch or a gram's frequency.

Cases: null or empty documents and items match nothing; a null item_id is reported as it is; items of at most Q bytes must
occur as whole words without edits; equal items are each reported; repeated documents are each reported; very long texts
are searched whole.  An empty benchmark leaks into nothing; an empty table gives an empty result.  Other columns, whatever
their names, are not touched.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, worker_cache, written

Q = 10
EDITS = 0.08
PIECE, PIECE_STEP = 64, 16
#: Diagonals between the starts of two bands; more than the largest budget.
STEP = 8
MARGIN = int(PIECE * EDITS)
#: Diagonals that an alignment may use, and bytes of text on them.
WIDTH = 2 * STEP + 2 * MARGIN
REACH = PIECE + WIDTH
#: Benchmark bytes in one index, of about 16 bytes each; a larger benchmark takes several, one after the other.
BLOCK_BYTES = 4 << 20
#: Bytes of text searched at a time, and postings.
STRETCH, SLICE = 1 << 17, 1 << 17
OVERLAP = 2 * REACH
_FOLD = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_ONE, _TWO, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF)
#: Between texts, and between items; neither byte is in a folded text.
GAP, MARK = b"\0" * 128, b"\1"


def normal(text: str | None) -> bytes:
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return b" ".join(text.encode().translate(_FOLD).split())


def grams(raw: bytes) -> np.ndarray:
    """A hash of the q bytes from each place on; its low byte is free."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = raw + b"\0" * 16
    more = Q - 8  # two words of eight bytes, the second so much later, cover a gram
    eight = np.empty(n + more, np.uint64)
    for o in range(8):
        own = eight[o::8]
        own[:] = np.frombuffer(padded, "<u8", count=len(own), offset=o)
    mixed = eight[:n] * _ONE
    mixed ^= mixed >> np.uint64(29)
    mixed += eight[more : n + more] * _TWO
    return mixed * _ONE & ~_LOW


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of n[i] numbers, one range after the other."""
    return np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)


def cut(raw: bytes) -> list[tuple[int, int]]:
    """Start and length of an item's pieces."""
    if len(raw) <= PIECE:
        return [(0, len(raw))]
    return [(s, PIECE) for s in sorted({*range(0, len(raw) - PIECE, PIECE_STEP), len(raw) - PIECE})]


class Benchmark:
    """Index of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids: list[int | None] = []
        self.short = ahocorasick.Automaton()
        held, pieces, at = [MARK], [], 1
        short: dict[str, list[int | None]] = {}
        for item_id, text in items:
            raw = normal(text)
            if 0 < len(raw) <= Q:
                short.setdefault(f" {raw.decode()} ", []).append(item_id)
            elif raw:
                pieces += [(len(self.ids), at + s, n) for s, n in cut(raw)]
                self.ids.append(item_id)
                held += [raw, MARK]
                at += len(raw) + 1
        for mark, ids in short.items():
            self.short.add_word(mark, ids)
        self.short.make_automaton()
        text = b"".join(held)
        self.bytes = np.frombuffer(text + b"\1" * (PIECE + 16), np.uint8)
        self.item, self.at, self.lengths = np.array(pieces, np.int64).reshape(-1, 3).T.copy()
        self.end = self.at + self.lengths
        self.budgets = np.minimum((self.lengths * EDITS).astype(np.int64), np.maximum(0, (self.lengths - Q) // Q))
        self.needed = self.lengths + 1 - Q - Q * self.budgets
        keys = grams(text)
        marks = np.concatenate([[0], np.cumsum(self.bytes[: len(text)] == MARK[0])])
        places = np.flatnonzero(marks[Q : Q + len(keys)] == marks[: len(keys)]).astype(np.int32)
        codes = keys[places] | self.bytes[places - 1]
        order = np.argsort(codes)
        self.codes, self.places = codes[order], places[order]
        self.bits = np.uint64(64 - max(16, min(25, (8 * len(codes)).bit_length())))
        self.table = np.zeros(1 << int(64 - self.bits), bool)
        self.table[self.codes >> self.bits] = True

    def hits(self, whole: bytes, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places of the text whose gram is in the index, its postings, and those among them that the text's byte before goes on."""
        found = grams(whole)
        at = np.flatnonzero(self.table[found >> self.bits])
        low = np.searchsorted(self.codes, found[at])
        good = low < len(self.codes)
        at, low = at[good], low[good]
        good = self.codes[low] & ~_LOW == found[at]
        at, low = at[good], low[good]
        key = found[at]
        high = np.searchsorted(self.codes, key | _LOW, side="right")
        same = key | text[at - 1]
        return at, low, high, np.searchsorted(self.codes, same), np.searchsorted(self.codes, same, side="right")

    def runs(self, text: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Bytes that text and items share from these places on."""
        mine, theirs = sliding_window_view(text, 8), sliding_window_view(self.bytes, 8)
        length, going = np.zeros(len(at), np.int64), np.arange(len(at))
        while len(going):
            a, b = at[going] + length[going], place[going] + length[going]
            differ = (mine[a].view("<u8") ^ theirs[b].view("<u8")).ravel()
            least = differ & (~differ + np.uint64(1))
            length[going] += np.where(differ == 0, 8, np.log2(np.maximum(least, 1).astype(np.float64)).astype(np.int64) // 8)
            going = going[differ == 0]
        return length

    def candidates(self, whole: bytes, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces and first diagonals of bands that reach the bound, and which of them hold the piece without edits."""
        at, low, high, same_low, same_high = self.hits(whole, text)
        before, after = same_low - low, high - same_high
        total = np.cumsum(before + after)
        first = 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(total, SLICE + (total[first - 1] if first else 0), side="right")))
            # The first place of a slice takes all postings, as the runs that cover it began before.
            n = before[first:last].copy()
            n[0] = high[first] - low[first]
            m = after[first:last].copy()
            m[0] = 0
            posts = self.places[np.concatenate([ranges(low[first:last], n), ranges(same_high[first:last], m)])].astype(np.int64)
            a = np.concatenate([np.repeat(at[first:last], n), np.repeat(at[first:last], m)])
            yield self.counted(text, a, posts)
            if last == len(at):
                return
            # The next slice begins an occurrence earlier, so that each lies within one.
            first = max(first + 1, int(np.searchsorted(at, at[last] - OVERLAP)))

    def counted(self, text: np.ndarray, a: np.ndarray, posts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = self.runs(text, a, posts)
        good = length >= Q
        a, posts, stop = a[good], posts[good], (posts + length)[good]
        low = np.searchsorted(self.end, posts + Q)
        n = np.maximum(np.searchsorted(self.at, stop - Q, side="right") - low, 0)
        piece, a, posts, stop = ranges(low, n), np.repeat(a, n), np.repeat(posts, n), np.repeat(stop, n)
        shared = np.minimum(self.end[piece], stop) - np.maximum(self.at[piece], posts) - Q + 1
        band = (a + self.at[piece] - posts) // STEP
        bands = len(text) // STEP + 2
        both = np.concatenate([piece * bands + band, piece * bands + band - 1])
        code, where = np.unique(both, return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([shared, shared]), minlength=len(code))
        whole = shared == self.lengths[piece] - Q + 1
        exact = np.zeros(len(code), bool)
        exact[where[np.concatenate([whole, whole])]] = True
        piece = code // bands
        enough = count >= self.needed[piece]
        return piece[enough], (code % bands * STEP)[enough], exact[enough]

    def edits(self, text: np.ndarray, piece: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Least edits that turn each piece into a stretch of the text on its band's diagonals, and MARGIN to either side."""
        rows = np.ascontiguousarray(text[(diagonal - MARGIN)[:, None] + np.arange(REACH)].T)
        pattern = np.ascontiguousarray(self.bytes[self.at[piece][:, None] + np.arange(PIECE)].T)
        # Costs less the number of their diagonal, so that a step along the text keeps the value of its neighbour.
        lengths, ramp = self.lengths[piece], np.arange(WIDTH, dtype=np.int16)[:, None]
        cost, out = np.repeat(-ramp, len(piece), axis=1), np.zeros(len(piece), np.int64)
        for i in range(int(lengths.max(initial=0))):
            new = cost + (rows[i : i + WIDTH] != pattern[i])
            np.minimum(new[:-1], cost[1:] + np.int16(2), out=new[:-1])
            for j in range(1, WIDTH):
                np.minimum(new[j], new[j - 1], out=new[j])
            cost = new
            if (done := lengths == i + 1).any():
                out[done] = (cost[:, done] + ramp).min(axis=0)
        return out

    def search(self, stretches: list[tuple[int, bytes]], found: list[dict]) -> None:
        """stretches: (document, bytes).  Adds item -> least edits to the documents' findings."""
        whole = GAP + GAP.join(s for _, s in stretches) + GAP
        text = np.frombuffer(whole, np.uint8)
        docs = np.array([d for d, _ in stretches])
        # A band that touches a stretch begins at most REACH before it; gaps are longer.
        starts = np.cumsum([len(GAP), *(len(s) + len(GAP) for _, s in stretches)])[:-1] - REACH
        for piece, diagonal, exact in self.candidates(whole, text):
            doc, item = docs[np.searchsorted(starts, diagonal, side="right") - 1], self.item[piece]
            pair = doc * len(self.ids) + item
            known = np.unique(pair[exact])
            rest = np.flatnonzero(~np.isin(pair, known))
            for a in range(0, len(rest), 1 << 15):
                some = rest[a : a + (1 << 15)]
                # Equal stretches of text, as in a text that repeats itself, are aligned once.
                bytes_at = np.zeros((len(some), -(-REACH // 8) * 8), np.uint8)
                bytes_at[:, :REACH] = text[(diagonal[some] - MARGIN)[:, None] + np.arange(REACH)]
                key = piece[some].astype(np.uint64) * _ONE
                for word in bytes_at.view(np.uint64).T:
                    key = (key ^ word) * _TWO
                    key ^= key >> np.uint64(31)
                _, once, of = np.unique(key, return_index=True, return_inverse=True)
                cost = np.concatenate([self.edits(text, piece[some[once[i : i + 4096]]], diagonal[some[once[i : i + 4096]]]) for i in range(0, len(once), 4096)])[of]
                good = cost <= self.budgets[piece[some]]
                self.add(found, doc[some[good]], item[some[good]], cost[good])
            self.add(found, known // max(1, len(self.ids)), known % max(1, len(self.ids)), np.zeros(len(known), np.int64))

    def add(self, found: list[dict], doc: np.ndarray, item: np.ndarray, cost: np.ndarray) -> None:
        for d, i, e in set(zip(doc.tolist(), item.tolist(), cost.tolist(), strict=True)):
            name = self.ids[i]
            found[d][name] = min(e, found[d].get(name, e))

    def leaks(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """For each text (item, edits of its closest piece), by item."""
        found: list[dict] = [{} for _ in texts]
        waiting: list[tuple[int, bytes]] = []
        size, first = 0, {}
        for doc, text in enumerate(texts):
            raw = normal(text)
            if (same := first.setdefault(raw, doc)) != doc:  # copies are searched once
                found[doc] = found[same]
                continue
            if len(self.short):
                for _, ids in self.short.iter(f" {raw.decode()} "):
                    found[doc] |= dict.fromkeys(ids, 0)
            for a in range(0, max(1, len(raw) - OVERLAP), STRETCH - OVERLAP):
                part = raw[a : a + STRETCH]
                waiting.append((doc, part))
                size += len(part)
                if size >= STRETCH:
                    self.search(waiting, found)
                    waiting, size = [], 0
        if waiting:
            self.search(waiting, found)
        return [sorted(f.items(), key=lambda x: (x[0] is not None, x[0] or 0)) for f in found]


TYPE = "array<struct<item_id:bigint,edits:int>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32())]))


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """The items in blocks of about BLOCK_BYTES, and whether it is the last: only so much, or one longer item, is on the
    driver at a time."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for b in range(n):
        yield [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b).orderBy("i", "t").collect()], b == n - 1


def leaks_of_block(spark, text: Column, items: list[tuple[int, str]]) -> Column:
    """text -> array of (item_id, edits) for the items found in it.  A worker holds the index of one block at a time."""
    sent, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = worker_cache("decontamination")
        if held.get("of") != name:
            held.clear()
            held |= {"of": name, "index": Benchmark(sent.value)}
        index = held["index"]
        for texts in batches:
            yield pa.array([[{"item_id": i, "edits": e} for i, e in f] for f in index.leaks(texts.to_pylist())], _ARROW)

    return F.arrow_udf(find, TYPE).asNondeterministic()(text)  # so that a filter on it does not run it twice


def leaks(df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits): a row for each document and item found in it.  Each block of the benchmark is a branch of
    a union, so its tasks hold that block alone."""
    out = df.select(F.col(doc_id).alias("doc_id"), F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("int").alias("edits")).limit(0)
    for n, (items, _) in enumerate(blocks(benchmark)):
        found = df.select(F.col(doc_id).alias("doc_id"), leaks_of_block(df.sparkSession, F.col(text), items).alias("found"))
        part = found.where(F.size("found") > 0).select("doc_id", F.inline("found"))
        out = out.unionByName(part) if n else part
    return out


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows without any item, with the columns they had.  After each block of the benchmark but the last, what is left
    is written, so that no task holds two."""
    at = fresh("leaked_items", *df.columns)
    for items, last in blocks(benchmark):
        df = df.withColumn(at, leaks_of_block(df.sparkSession, F.col(text), items)).where(F.size(at) == 0).drop(at)
        df = df if last else written(df, "clean")
    return df
