"""BPE encoding and decoding with a contiguous rank array.

A word's parts lie in one list of symbol ids, beside it a list of the merge ranks of neighbours.  The smallest rank is
found by a scan, its boundary deleted and the two neighbouring ranks looked up anew, until no pair merges.  Words are
short, so the scan beats a heap; words of more than `SCAN_PARTS` symbols go through a heap with the same order of merges.

The vocabulary file names the normal form and the pieces that it is for.  Words of letters that were proved to be their own
normal form need neither; for all other chunks between blanks both come from the tokenizers library, whose tables of
letters are the ones that count.  A file with another normaliser, pre-tokenizer or kind of model is refused with a ValueError.

Cases: a null or empty text has no ids and decodes to the empty string.  Very long texts are taken whole, chunk by chunk;
memory beyond the text and its ids is that of the longest chunk.  Equal texts give equal ids.  White space is no token and
does not come back; the decoded text is the tokens joined by single spaces, as the vocabulary has no decoder.  An empty
table gives an empty result.  Other columns, whatever their names, are not touched: the operator is a column expression.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import worker_cache

SCAN_PARTS = 128
#: Chunks and pieces met at least twice, and pieces met once, that a worker holds before it forgets them: under 110 MB.
CACHE_CHUNKS, CACHE_NEW = 400_000, 150_000
# What a vocabulary file must say for its ids to come out right here.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
NONE = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def checked(path: str) -> dict:
    """The vocabulary file, if it is of the one kind that this module knows."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    said = {"normalizer": spec["normalizer"], "pre_tokenizer": spec["pre_tokenizer"], "post_processor": spec["post_processor"], "decoder": spec["decoder"]}
    known = {"normalizer": NORMALIZER, "pre_tokenizer": PRE_TOKENIZER, "post_processor": None, "decoder": None}
    model = {k: v for k, v in spec["model"].items() if k not in ("vocab", "merges")}
    plain = all(t["special"] and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    if said != known or model != MODEL or not plain:
        raise ValueError(f"{path} has another normaliser, pre-tokenizer, model or kind of added tokens than this encoder")
    return spec


def word_pattern(library: Tokenizer) -> re.Pattern:
    """Chunks that are a word and maybe a run of signs: of small ASCII letters, and of those two-byte letters that the
    library, asked one by one, leaves as they are and takes into a word; signs are ASCII ones that never stand for more."""
    leads: dict[int, bytes] = {}
    normal, split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
    for c in map(chr, range(0xC0, 0x250)):
        if normal(f"a{c}b") == f"a{c}b" and len(split(f"a{c}b")) == 1 and [len(x) for x, _ in split(f"{c},")] == [2, 1]:
            raw = c.encode()
            leads[raw[0]] = leads.get(raw[0], b"") + re.escape(raw[1:])
    letters = b"|".join([b"[a-z]", *(bytes([lead]) + b"[" + follow + b"]" for lead, follow in leads.items())])
    return re.compile(rb"((?:" + letters + rb")+)([!-&(-/:;=?@\[-`{}~]*)")


class ChunkEncoder:
    """Ids of a text, chunk by chunk, from a cache of what was seen.

    Texts are cut at ASCII blanks, which no piece or special token holds.  Nearly all chunks are words, at most with signs
    behind them; the others go to `chunk_ids`.  A form of a word (with capitals or signs) is kept from the second time on
    that the word is met.
    """

    def __init__(self, library: Tokenizer):
        self.word = word_pattern(library)
        self.known: dict[bytes, bytes] = {}
        self.new: dict[bytes, bytes] = {}

    def piece_ids(self, raw: bytes) -> bytes:
        """Of a word or a run of signs as the pattern has them, not looked up."""
        raise NotImplementedError

    def chunk_ids(self, raw: bytes) -> bytes:
        """Of any other chunk."""
        raise NotImplementedError

    def keep(self, raw: bytes, ids: bytes) -> bytes:
        if len(self.known) >= CACHE_CHUNKS:
            self.known.clear()
        if len(raw) < 64:
            self.known[raw] = ids
        return ids

    def looked_up(self, raw: bytes, find) -> bytes:
        if (ids := self.known.get(raw)) is not None:
            return ids
        if (ids := self.new.pop(raw, None)) is not None:
            return self.keep(raw, ids)
        ids = find(raw)
        if len(self.new) >= CACHE_NEW:
            self.new.clear()
        if len(raw) < 64:
            self.new[raw] = ids
        return ids

    def piece(self, raw: bytes) -> bytes:
        return self.looked_up(raw, self.piece_ids)

    def chunk(self, raw: bytes) -> bytes:
        if (m := self.word.fullmatch(raw.lower())) is None:  # of bytes: ASCII capitals alone become small
            return self.looked_up(raw, self.chunk_ids)
        word, signs = m.groups()
        seen = word in self.known
        ids = self.piece(word) + self.piece(signs) if signs else self.piece(word)
        return self.keep(raw, ids) if seen else ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known = self.known.get
        return b"".join([i if (i := known(c)) is not None else self.chunk(c) for c in (text or "").encode().split()])


class WordBPE(ChunkEncoder):
    """The model of one vocabulary file: normal form, pieces, bytes, merges."""

    def __init__(self, path: str):
        spec, symbols, library = checked(path), byte_symbols(), Tokenizer.from_file(path)
        super().__init__(library)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_mark = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self.byte_of = {s: i for i, s in enumerate(symbols)}
        self.inner = [vocab.get(s) for s in symbols]
        self.final = [vocab.get(s + suffix) for s in symbols]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in (vocab | self.special).items():
            self.tokens[i] = t

    def merged(self, parts: list[int]) -> list[int]:
        if len(parts) > SCAN_PARTS:
            return self.merged_by_heap(parts)
        look = self.merge.get
        pairs = [look(p, (NONE, 0)) for p in zip(parts, parts[1:], strict=False)]
        ranks = [p[0] for p in pairs]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)
            parts[i] = pairs[i][1]
            del parts[i + 1], ranks[i], pairs[i]
            if i < len(ranks):
                pairs[i] = look((parts[i], parts[i + 1]), (NONE, 0))
                ranks[i] = pairs[i][0]
            if i:
                pairs[i - 1] = look((parts[i - 1], parts[i]), (NONE, 0))
                ranks[i - 1] = pairs[i - 1][0]
        return parts

    def merged_by_heap(self, parts: list[int]) -> list[int]:
        n, look = len(parts), self.merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, parts[i], parts[i + 1], m[1]) for i in range(n - 1) if (m := look((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        gone = -1
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = new, gone
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := look((parts[x], parts[y]))):
                    heapq.heappush(heap, (m[0], x, parts[x], parts[y], m[1]))
        return [p for p in parts if p != gone]

    def piece_ids(self, raw: bytes) -> bytes:
        parts = [i for i in map(self.inner.__getitem__, raw[:-1]) if i is not None]
        if (last := self.final[raw[-1]]) is not None:
            parts.append(last)
        return array("I", self.merged(parts)).tobytes()

    def chunk_ids(self, raw: bytes) -> bytes:
        text, out, at = raw.decode(), [], 0
        for m in self.special_mark.finditer(text):
            out += [self.plain_ids(text[at : m.start()]), array("I", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain_ids(text[at:])])

    def plain_ids(self, text: str) -> bytes:
        shown = self.split(self.normal(text)) if text else ()
        return b"".join(self.piece(bytes(map(self.byte_of.__getitem__, p))) for p, _ in shown)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def model(path: str) -> WordBPE:
    """The worker's model of a file; its caches outlive a task, but not the stage."""
    held = worker_cache("bpe")
    if path not in held:
        held[path] = WordBPE(path)
    return held[path]


def encoded(text: Column, path: str) -> Column:
    """text -> binary: its ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = model(path)
        for texts in batches:
            yield pa.array([bpe.encode(t.as_py()) for t in texts], pa.binary())

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """binary of ids -> text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = model(path)
        for packed in batches:
            yield pa.array([bpe.decode(p.as_py() or b"") for p in packed], pa.string())

    return decode(ids)


def round_trip(text: Column, path: str) -> Column:
    """text -> struct(ids binary, decoded string) in one pass through Python."""

    @F.arrow_udf("struct<ids:binary,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = model(path)
        for texts in batches:
            ids = [bpe.encode(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["ids", "decoded"])

    return both(text)
