"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows are first laid down with the number of their partition and their place in it, which later runs find unchanged.
How many rows each partition sends to each bin (a shard, or an equal piece of one) is drawn without replacement: a binary
tree over the partitions splits the bins' sizes by multivariate hypergeometric draws, each seeded by its node, so that a
task finds its own row of the matrix by one walk from the root.  A partition deals its rows to bins by a random
permutation; after the exchange each bin is permuted again.  Every order of the rows is equally likely, shard sizes
differ by one at most, and slots have no gaps.

Cases: nulls anywhere, equal rows and repeated ids are rows like others (copies go to shards like strangers: the law is
equal row counts, which a large group kept together would break).  With fewer rows than shards some shards are empty; an
empty table gives an empty result.  Input columns are kept; where one is called `shard` or `slot`, ours gets an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written

BIN_ROWS = 1024
#: Bins at most, but for more shards than that; beyond it bins grow with the table.  Each is then one sort of a task.
MOST_BINS = 1 << 16
#: monotonically_increasing_id() has the partition above this bit.
PLACE_BITS = 33


def even(total: int, n: int) -> np.ndarray:
    return np.full(n, total // n, np.int64) + (np.arange(n) < total % n)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among `drawn`.  Beyond numpy's range: by inversion on a window of 12 standard deviations about the mean."""
    total = good + bad
    if not good or not drawn:
        return 0
    if total < 900_000_000:
        return int(rng.hypergeometric(good, bad, drawn))
    mean = drawn * (good / total)
    sd = (mean * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    low, high = max(0, drawn - bad, int(mean - 12 * sd) - 2), min(good, drawn, int(mean + 12 * sd) + 2)
    k = np.arange(low, high, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1)))])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def split(rng: np.random.Generator, colours: np.ndarray, drawn: int) -> np.ndarray:
    """Of each colour, how many are among `drawn` taken without replacement."""
    out, rest = np.zeros_like(colours), int(colours.sum())
    for i, c in enumerate(colours.tolist()):
        rest -= c
        out[i] = took = hypergeometric(rng, c, rest, drawn)
        drawn -= took
    return out


def matrix_row(before: np.ndarray, sizes: np.ndarray, seed: int, p: int) -> np.ndarray:
    """Row p of the matrix.  before: rows in the partitions before each one, and at the end all."""
    low, high, colours = 0, len(before) - 1, sizes
    while high - low > 1:
        mid = (low + high) // 2
        left = split(np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, low, high]))), colours, int(before[mid] - before[low]))
        low, high, colours = (low, mid, left) if p < mid else (mid, high, colours - left)
    return colours


def shard_documents(df: DataFrame, n_shards: int, seed: int = 0, bin_rows: int = BIN_ROWS) -> DataFrame:
    """The rows with `shard` (int) and `slot` (bigint, gapless from 0 in each shard)."""
    spark, cols = df.sparkSession, df.columns
    mark, shard_name, slot_name = fresh("row_place", *cols), fresh("shard", *cols), fresh("slot", *cols)
    laid = written(df.withColumn(mark, F.monotonically_increasing_id()), "shuffle")
    # One row for each partition of the input.
    held = laid.groupBy(F.shiftright(mark, PLACE_BITS).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    numbers, counts = np.array([r["p"] for r in held], np.int64), np.array([r["n"] for r in held], np.int64)
    total = int(counts.sum())
    pieces = max(1, min(-(-total // (n_shards * bin_rows)), MOST_BINS // n_shards))
    sizes = np.concatenate([even(int(s), pieces) for s in even(total, n_shards)])
    before = np.concatenate([[0], np.cumsum(counts)])
    known = spark.sparkContext.broadcast((numbers, before, sizes))  # 16 bytes a partition, 8 a bin, MOST_BINS of them

    def dealt(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers, before, sizes = known.value
        last, labels, keys = None, None, None
        for marks in batches:
            m = marks.to_numpy(zero_copy_only=False)
            part, place = m >> PLACE_BITS, m & ((1 << PLACE_BITS) - 1)
            bins, order = np.empty(len(m), np.int32), np.empty(len(m), np.int64)
            for p in np.unique(part):
                if p != last:
                    i = int(np.searchsorted(numbers, p))
                    rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, 1, i])))
                    labels = rng.permutation(np.repeat(np.arange(len(sizes), dtype=np.int32), matrix_row(before, sizes, seed, i)))
                    keys, last = rng.integers(0, 1 << 62, len(labels)), p
                here = part == p
                bins[here], order[here] = labels[place[here]], keys[place[here]]
            yield pa.StructArray.from_arrays([pa.array(bins), pa.array(order)], ["bin", "key"])

    deal = F.arrow_udf(dealt, "struct<bin:int,key:bigint>")
    sent = laid.select(F.struct(*(F.col(c) for c in laid.columns)).alias("row"), deal(F.col(mark)).alias("to"))
    again = Window.partitionBy("to.bin").orderBy("to.key", f"row.{mark}")
    # Sizes are even, so a bin's first slot follows from its number.
    shard, piece = F.floor(F.col("to.bin") / pieces), F.pmod("to.bin", F.lit(pieces))
    rows = F.lit(total // n_shards) + F.when(shard < total % n_shards, 1).otherwise(0)
    bin_first = piece * F.floor(rows / pieces) + F.least(piece, rows % pieces)
    return sent.select(*(F.col("row")[c].alias(c) for c in cols), shard.cast("int").alias(shard_name), (bin_first + F.row_number().over(again) - 1).cast("bigint").alias(slot_name))
