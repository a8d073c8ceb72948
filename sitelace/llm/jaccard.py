"""N-gram Jaccard join by MinHash banding.

Documents are sets of hashed word 5-grams; texts with the same set are one node from the start, so copies cost nothing
later.  Band and row counts are chosen for the target recall at the threshold.  Nodes that share a band hash are joined
to the least node of that bucket (a star, never all pairs), and the stars' components say whose full sets have to meet.
Sets travel to where they are verified:

- a component of up to BLOCK_NODES sets is one group;
- a larger one, whose buckets hold most of its pairs, is cut into blocks, and each pair of blocks is a group;
- a larger one that only hangs together by chains is cut into its buckets, and those into blocks, so that nodes which share
  no band never meet; a pair is verified in the first band that it shares, and nowhere else.

In a group all pairs are verified on the full sets, by bit rows over the shingles that occur twice or more; it emits one row
for each node: its links and the root it hangs together with.  Links are counted, never listed.

Cases: null texts and texts without words have no n-grams and link to nothing, not even to each other; texts of one to
four words are one shingle.  A class is named after its least document id, a document with a null id and no links after
null.  Repeated rows are documents like others, equal to each other.  Very long texts are taken whole; a group of them has
fewer.  An empty table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, worker_cache, written

WORDS, THRESHOLD, RECALL, MAX_PERMUTATIONS = 5, 0.8, 0.999, 140
#: Hashes of the sets in one block of a large component (8 MB), and its sets.
BLOCK_SHINGLES, BLOCK_NODES = 1_000_000, 256
#: A component is cut into its buckets if these have so many times fewer pairs.
SPARSE = 4
#: Shingles compared at a time.
CHUNK_BITS = 1 << 16
#: A list of that many ids is broadcast (under 10 MB), a longer one joined by a shuffle.
BROADCAST_IDS = 250_000
CACHE_WORDS = 300_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows: the longest rows whose bands reach the recall at the threshold within `most` permutations."""
    best = (most, 1)
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-p)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def shingles(text: str | None, known: dict[bytes, int], words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams.  known: hashes of words, kept from text to text."""
    split = (text or "").encode().split()
    if not split:
        return np.empty(0, np.uint64)
    hashes = []
    for w in split:
        if (h := known.get(w)) is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) < 64:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                known[w] = h
        hashes.append(h)
    h = np.array(hashes, np.uint64)
    n = max(1, len(h) - words + 1)
    out = np.full(n, len(h) if len(h) < words else words, np.uint64)
    for i in range(min(words, len(h))):
        out = (out ^ h[i : i + n]) * _MIX[0]
        out ^= out >> np.uint64(29)
    out *= _MIX[1]
    out ^= out >> np.uint64(32)
    return np.unique(out)


class MinHash:
    def __init__(self, bands: int, rows: int):
        r = np.random.Generator(np.random.Philox(7))
        self.bands, self.rows = bands, rows
        self.a = (r.integers(0, 1 << 32, bands * rows, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = r.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)[:, None]
        self.mult = r.integers(0, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        self.salt = r.integers(0, 1 << 63, bands, dtype=np.uint64)

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        y = low * self.a
        y ^= y >> np.uint32(15)
        y += high ^ self.b
        y *= np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(13)
        y *= np.uint32(0xC2B2AE35)
        return y.min(axis=1)

    def band_hashes(self, members: np.ndarray) -> np.ndarray:
        low, high = members.astype(np.uint32), (members >> np.uint64(32)).astype(np.uint32)
        least = self.least(low[:4096], high[:4096])
        for i in range(4096, len(low), 4096):
            least = np.minimum(least, self.least(low[i : i + 4096], high[i : i + 4096]))
        mixed = ((least.reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)) * self.mult).sum(axis=1, dtype=np.uint64) + self.salt
        mixed ^= mixed >> np.uint64(31)
        mixed *= _MIX[2]
        return (mixed ^ mixed >> np.uint64(30)).view(np.int64)


def node_of(members: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None


def signed(text: Column, bands: int, rows: int) -> Column:
    """text -> node (null without words), number of shingles, band hashes."""

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        minhash, known = MinHash(bands, rows), worker_cache("jaccard")
        for texts in batches:
            sets = [shingles(t.as_py(), known) for t in texts]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([node_of(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([minhash.band_hashes(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "n", "bands"],
            )

    return F.arrow_udf(sign, "struct<node:binary,n:bigint,bands:array<bigint>>")(text)


def membered(text: Column) -> Column:
    """text -> node and its sorted hashes as bytes."""

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = worker_cache("jaccard")
        for texts in batches:
            sets = [shingles(t.as_py(), known) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([node_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "members"])

    return F.arrow_udf(find, "struct<node:binary,members:binary>").asNondeterministic()(text)


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root): the least node of each component.

    Labels spread to neighbours and then jump to their label's label, so the rounds grow with the logarithm of a
    component's length.  Each round is written to the shared folder.
    """
    both = written(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("m"))
        spread = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("root", "m").alias("next"), F.col("root").alias("was"))
        spread = written(spread, "labels")
        jump = spread.select(F.col("node").alias("a"), F.col("next").alias("onward"))
        moved = spread.join(jump, F.col("next") == F.col("a"), "left").select("node", F.least("next", F.coalesce("onward", "next")).alias("root"), "was")
        moved = written(moved, "labels")
        if not moved.where("root <> was").limit(1).count():
            return moved.select("node", "root")
        labels = moved.select("node", "root")


def verified(nodes: list[tuple[bytes, int, int, np.ndarray, list | None]], crossing: bool, threshold: float) -> list[tuple[bytes, int, int, bytes]]:
    """nodes: (node, block, copies, members, the bands before that of their bucket).  For each: linked documents, linked
    nodes, and its root; crossing: links between blocks only."""
    nodes.sort(key=lambda x: x[0])
    n = len(nodes)
    sizes = np.array([len(x[3]) for x in nodes])
    copies, block = np.array([x[2] for x in nodes]), np.array([x[1] for x in nodes])
    values, place, times = np.unique(np.concatenate([x[3] for x in nodes]), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    width = int((times > 1).sum())
    row, keep = np.repeat(np.arange(n), sizes), times[place] > 1
    row, place = row[keep], shared[place[keep]]
    common = np.zeros((n, n), np.int32)
    for low in range(0, width, CHUNK_BITS):
        own = (place >= low) & (place < low + CHUNK_BITS)
        bits = np.zeros((n, -(-min(CHUNK_BITS, width - low) // 64) * 64), bool)
        bits[row[own], place[own] - low] = True
        bits = np.packbits(bits, axis=1).view(np.uint64)
        step = max(1, 2_000_000 // (n * bits.shape[1]))
        for a in range(0, n, step):
            common[a : a + step] += np.bitwise_count(bits[a : a + step, None, :] & bits[None, :, :]).sum(axis=2, dtype=np.int32)
    linked = np.empty((n, n), bool)
    for a in range(0, n, 256):
        linked[a : a + 256] = common[a : a + 256] >= threshold * (sizes[a : a + 256, None] + sizes[None, :] - common[a : a + 256]) - 1e-9
    np.fill_diagonal(linked, False)
    if crossing:
        linked &= block[:, None] != block[None, :]
    for band in np.array([x[4] for x in nodes], np.int64).T if nodes[0][4] else ():
        linked &= band[:, None] != band[None, :]  # pairs that an earlier bucket has verified
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
                root[front] = i
    return [(nodes[i][0], int(linked[i] @ copies), int(linked[i].sum()), nodes[root[i]][0]) for i in range(n)]


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            yield from zip(*(b.column(i).to_pylist() for i in range(8)), strict=True)

    out = []
    for (_, i, j), group in groupby(rows(), key=lambda r: r[:3]):
        nodes = list({node: (node, block, copies, np.frombuffer(members, np.uint64), before) for _, _, _, node, block, copies, members, before in group}.values())
        out += verified(nodes, i != j, threshold) if len(nodes) > 1 else [(nodes[0][0], 0, 0, nodes[0][0])]
        if len(out) >= 4096:
            yield _links(out)
            out = []
    if out:
        yield _links(out)


def _links(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["a", "links", "node_links", "b"])


def signatures(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, node, n, bands) of each row, written once."""
    bands, rows = banding(threshold, recall)
    both = df.select(F.col(doc_id).alias("doc_id"), signed(F.col(text), bands, rows).alias("s"))
    return written(both.select("doc_id", "s.node", "s.n", "s.bands"), "signatures")


def classes(df: DataFrame, signed_rows: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(node, root, class_id, links of each of its documents, linked nodes) for nodes with copies or links."""
    nodes = written(
        signed_rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n"), F.any_value("bands").alias("bands")),
        "nodes",
    )
    posted = nodes.select("node", F.explode("bands").alias("band"))
    buckets = written(posted.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("k")).where("k > 1"), "hubs")
    stars = posted.join(buckets.select("band", "hub"), "band").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    near = written(components(stars).withColumnRenamed("root", "comp"), "components")
    sized = written(near.join(nodes.select("node", "rep", "copies", "n", "bands"), "node"), "sized")
    blocks = lambda total, k: F.greatest(F.ceil(total / block_shingles), F.ceil(k / block_nodes)).cast("int")
    whole = sized.groupBy("comp").agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    # Only large components are joined back, so that none of them has to lie in one task.  How many pairs their buckets have, and they themselves:
    held = buckets.join(near, F.col("hub") == F.col("node")).groupBy("comp").agg(F.sum(F.col("k").cast("double") * F.col("k")).alias("squares"))
    large = whole.select("comp", "k", blocks(F.col("total"), F.col("k")).alias("blocks")).where("blocks > 1")
    large = written(large.join(held, "comp").select(F.col("comp").alias("c"), "blocks", (F.col("k").cast("double") * F.col("k") > SPARSE * F.col("squares")).alias("sparse")), "large")
    large = F.broadcast(large) if large.count() <= BROADCAST_IDS else large
    placed = sized.join(large, F.col("comp") == F.col("c"), "left").select("node", "rep", "copies", "n", "comp", F.when(F.col("sparse"), F.col("bands")).alias("bands"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
    placed = written(placed, "placed")
    one = placed.where("bands is null").select("node", "copies", F.col("comp").alias("unit"), "blocks", F.lit(None).cast("array<bigint>").alias("before"))
    apart = placed.where("bands is not null").select("node", "copies", "n", "bands", F.posexplode("bands").alias("place", "band")).join(buckets.select("band", "k"), "band")
    # A block of a bucket has fewer sets, too, where they are large: by the mean of the bucket.
    sizes = apart.groupBy("band").agg(F.sum("n").alias("total"))
    apart = apart.join(sizes, "band").select("node", "copies", F.to_binary(F.hex("band"), F.lit("hex")).alias("unit"), blocks(F.col("total"), F.col("k")).alias("blocks"), F.slice("bands", F.lit(1), F.col("place")).alias("before"))
    units = one.unionByName(apart).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    reps = placed.select(F.col("rep").alias("doc_id")).distinct()
    if placed.count() <= BROADCAST_IDS:
        reps = F.broadcast(reps)
    few = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).alias("d").join(reps.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), "left_semi")
    sets = few.select(membered(F.col("d.text")).alias("m")).select("m.node", "m.members")
    # A document id can stand for several texts or rows: the node decides, and a group takes each node once.
    held = sets.join(units, "node")
    several = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    pairs = held.select("*", F.explode(several).alias("p")).select("unit", "p.i", "p.j", "node", "block", "copies", "members", "before")
    dealt = pairs.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    found = written(dealt.mapInArrow(lambda b: _verify(b, threshold), "a binary, links bigint, node_links bigint, b binary"), "links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"), F.sum("node_links").alias("node_links"))
    roots = components(found.select("a", "b"))
    joined = nodes.select("node", "rep", "copies").join(links, F.col("node") == F.col("a"), "left").join(roots.withColumnRenamed("node", "r"), F.col("node") == F.col("r"), "left")
    whole = joined.select("node", "rep", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("node_links", F.lit(0)).cast("bigint").alias("node_links"))
    whole = written(whole.where("links > 0"), "classes")
    names = whole.groupBy("root").agg(F.min("rep").alias("class_id"))
    return whole.join(names, "root").select("node", "root", "class_id", "links", "node_links")


def jaccard_join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, block_shingles: int = BLOCK_SHINGLES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """A row for each document: doc_id, class_id, n_links (documents at the threshold or above), n_set_links (of other sets)."""
    rows = signatures(df, doc_id, text, threshold, recall)
    linked = classes(df, rows, doc_id, text, threshold, block_shingles, block_nodes).withColumnRenamed("node", "k")
    joined = rows.select("doc_id", "node").join(linked, F.col("node") == F.col("k"), "left")
    zero = F.lit(0).cast("bigint")
    return joined.select("doc_id", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("links", zero).alias("n_links"), F.coalesce("node_links", zero).alias("n_set_links"))


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the least document id; all rows without links; the columns as they were."""
    rows = signatures(df, doc_id, text)
    linked = written(classes(df, rows, doc_id, text).select(F.col("node").alias("k"), "root", "class_id"), "linked")
    seen = rows.select("doc_id", "node").join(linked, F.col("node") == F.col("k"), "left")
    # Rows of one id and one set are alike here: the first of them stays where any does.
    fate = seen.groupBy("doc_id", "node").agg(F.count("*").alias("rows"), F.any_value("k").alias("k"), F.any_value("class_id").alias("class_id"))
    keeps = F.col("k").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))
    again = fate.groupBy("doc_id").agg(F.count("*").alias("sets"), F.sum(F.when(F.col("k").isNull(), 1).otherwise(F.col("rows"))).alias("linked_rows"), F.bool_and(~keeps).alias("gone"), F.bool_and(keeps).alias("stays"))
    again = written(again.where("not stays or sets > 1 or linked_rows > 1 or doc_id is null"), "fates")
    cols = df.columns
    other, key, root, name, at = (fresh(x, *cols) for x in ("other_id", "set_key", "set_root", "set_class", "shingle_set"))
    gone = again.where("gone").select(F.col("doc_id").alias(other))
    mixed = again.where("not gone").select(F.col("doc_id").alias(other))
    n_gone, n_mixed = gone.count(), mixed.count()
    same = F.col(doc_id).eqNullSafe(F.col(other))
    hint = lambda x, n: F.broadcast(x) if n <= BROADCAST_IDS else x
    out = df.join(hint(gone, n_gone), same, "left_anti")
    if not n_mixed:
        return out
    # Ids that stand for several rows: judged by their sets, which takes another look at these texts.
    single = out.join(hint(mixed, n_mixed), same, "left_anti")
    several = out.join(hint(mixed, n_mixed), same, "left_semi").withColumn(at, membered(F.col(text))["node"])
    names = linked.select(F.col("k").alias(key), F.col("root").alias(root), F.col("class_id").alias(name))
    chosen = written(several.join(names, F.col(at) == F.col(key), "left"), "several")
    free = chosen.where(F.col(key).isNull()).select(*cols)
    # The rows of the least id and of one class: of their sets the least, of its rows one.
    one = chosen.where(F.col(key).isNotNull() & F.col(doc_id).eqNullSafe(F.col(name)))
    first = fresh("least_set", *chosen.columns)
    least = one.groupBy(root).agg(F.min(at).alias(first)).select(first)
    one = one.join(least, F.col(at) == F.col(first), "left_semi").dropDuplicates([at])
    return single.unionByName(free).unionByName(one.select(*cols))
