"""Nearest neighbours without a radius (JOIN-02, JOIN-03, GEO-03), by boxes that hold boxes.

Points are places on the unit sphere.  Both sides are sorted along a curve through space and packed: some tens of neighbours
make a node with the box around them, some tens of nodes a node of the next level, until few are left.  The search goes down
both sides at once.  A row of the work is a pair of nodes, so what is compared, written and shuffled grows with the number
of nodes, not with points times candidates.  What a left node consists of meets what its right nodes consist of: of the
boxes that hold k points together the farthest reach is an upper bound for the k-th neighbour, and boxes that begin beyond
it are dropped.  Once the left side is down at nodes of points, these stay together and each of them bounds for itself, while
the right side goes on to its points; so a point far from all others looks at the front of them only.  Then straight distances
are compared, and great circles measured for the few rows that can be the nearest.

Numpy compares within a node; Spark sorts, packs and joins.  Rows on one spot are one point on the left, and at most k of
them count on the right.  Latitudes beyond the poles are taken as what they are on the sphere; infinite ones are no place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine_m, valid
from ..session import written

#: Members of a node at most, rows that are packed at once, and rows of a task that packs.
MEMBERS, PACK, PACKED = 64, 8192, 65_536
#: Nodes of a side that are not packed any more; left nodes of a task; right members that are compared at once.
TOP, NODES, AT_ONCE = 64, 2000, 16_384
#: Bits of a place along each axis of the curve.
BITS = 21
#: What rounding may do to a straight distance on the unit sphere, and more.
LOOSE, LEAST = 1 + 1e-9, 1e-12

BOX = ("x0", "y0", "z0", "x1", "y1", "z1")


def _curve(x: Column, y: Column, z: Column) -> Column:
    """The place along a Z-order curve: bits of the three axes in turn."""

    def apart(v: Column) -> Column:
        n = F.least(F.lit((1 << BITS) - 1), F.floor((v + 1) / 2 * (1 << BITS)))
        n = F.greatest(F.lit(0), n).cast("bigint")
        for by, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            n = n.bitwiseOR(F.shiftleft(n, by)).bitwiseAND(F.lit(mask))
        return n

    return apart(x).bitwiseOR(F.shiftleft(apart(y), 1)).bitwiseOR(F.shiftleft(apart(z), 2))


def _sphere(at: np.ndarray) -> np.ndarray:
    """Places of (lat, lon) as boxes without extent, a column for each of BOX."""
    lat, lon = np.radians(at[:, 0]), np.radians(at[:, 1])
    x, y, z = np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)
    return np.stack([x, y, z, x, y, z], axis=1)


def _groups(boxes: np.ndarray, most: int, halves: bool) -> Iterator[np.ndarray]:
    """Rows dealt into groups of at most so many, cut across the longest axis: by number, or in the middle of the extent, so
    that what lies apart is parted."""
    middle = boxes[:, :3] + boxes[:, 3:]
    todo = [np.arange(len(boxes))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            yield rows
            continue
        here = middle[rows]
        low, high = here.min(axis=0), here.max(axis=0)
        axis = int(np.argmax(high - low))
        beyond = here[:, axis] > (low[axis] + high[axis]) / 2
        if halves or not beyond.any() or beyond.all():
            beyond = np.zeros(len(rows), bool)
            beyond[np.argsort(here[:, axis], kind="stable")[len(rows) // 2 :]] = True
        todo += [rows[beyond], rows[~beyond]]


def _pack(points: bool, most: int, at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, lat, lon) of points or (id, n, box) of nodes to nodes: box, n, ids of the members, and `at`, what they are:
    lat and lon, or n and the box, as doubles."""

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        at = np.stack([rows[c].to_numpy() for c in rows.column_names[1:]], axis=1).astype(np.float64)
        boxes = _sphere(at) if points else at[:, 1:]
        groups = list(_groups(boxes, most, not points))
        ends = np.cumsum([0, *(len(g) for g in groups)])
        ids = rows["id"].combine_chunks().take(pa.array(np.concatenate(groups)))
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        around = np.stack([np.concatenate([boxes[g, :3].min(axis=0), boxes[g, 3:].max(axis=0)]) for g in groups])
        n = [len(g) if points else int(at[g, 0].sum()) for g in groups]
        columns = [pa.array(n, pa.int64()), *(pa.array(around[:, i]) for i in range(6)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids), pa.array([at[g].tobytes() for g in groups], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["n", *BOX, "ids", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= at_once:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return run


def _levels(points: DataFrame, what: str) -> list[tuple[DataFrame, int]]:
    """Nodes and their number, level by level: of points (id, lat, lon), of nodes of points, and so on."""
    kind = points.schema["id"].dataType.simpleString()
    columns = "n bigint," + ",".join(f"{c} double" for c in BOX) + ",ids array<{}>,at binary"
    levels: list[tuple[DataFrame, int]] = []
    items, size = points, points.count()
    while not levels or size > TOP:
        if size <= PACK:
            laid = items.repartition(1)
        else:
            lat, lon = F.radians("lat"), F.radians("lon")
            place = _curve(F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)) if not levels else _curve(*((F.col(c + "0") + F.col(c + "1")) / 2 for c in "xyz"))
            # Whatever lies in one stretch of the curve is told apart by its place, so no crowd is one task.
            keys = ["curve", *items.columns[1:]]
            laid = items.withColumn("curve", place).repartitionByRange(math.ceil(size / PACKED), *keys).sortWithinPartitions(*keys).drop("curve")
        nodes = laid.mapInArrow(_pack(not levels, MEMBERS, PACK), columns.format("bigint" if levels else kind)).withColumn("node", F.monotonically_increasing_id())
        nodes = written(nodes, what)
        size = nodes.count()
        levels.append((nodes, size))
        items = nodes.select(F.col("node").alias("id"), F.col("n").cast("double").alias("n"), *BOX)
    return levels


def _square(left: np.ndarray, right: np.ndarray, far: bool = False) -> np.ndarray:
    """Squares of the least, or the greatest, distance of each left box from each right box."""
    out = np.zeros((len(left), len(right)))
    for i in range(3):
        a, b = right[None, :, i] - left[:, None, i + 3], right[None, :, i + 3] - left[:, None, i]
        gap = np.maximum(-a, b) if far else np.maximum(a, -b)
        out += np.square(gap if far else np.maximum(gap, 0.0, out=gap))
    return out


def _bound(reach: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """For each row of `reach` how far k points can be at most, if column i holds n[i] points up to there."""
    out = np.full(len(reach), np.inf)
    for least in {1, -(-k // 4), k}:
        enough = n >= least
        many = -(-k // least)
        if enough.sum() >= many:
            here = reach if enough.all() else reach[:, enough]
            out = np.minimum(out, np.partition(here, many - 1, axis=1)[:, many - 1] if many > 1 else here.min(axis=1))
    return out


def _near(left: np.ndarray, right: np.ndarray, n: np.ndarray | None, k: int, within: float) -> np.ndarray:
    """Which right boxes of n points each (None: both sides are points) may hold one of the k nearest of which left box, and
    begin within the straight distance."""
    if n is None:
        low = high = np.sqrt(sum(np.square(right[None, :, i] - left[:, None, i]) for i in range(3)))
        n = np.ones(len(right))
    else:
        low, high = np.sqrt(_square(left, right)), np.sqrt(_square(left, right, far=True))
    return low <= np.minimum(_bound(high, n, k), within)[:, None] * LOOSE + LEAST


def _members(at: bytes, points: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """(what `at` says, boxes) of the members of a node."""
    held = np.frombuffer(at, np.float64).reshape(-1, 2 if points else 7)
    return held, _sphere(held) if points else held[:, 1:]


def _down(l_points: bool, r_points: bool, k: int, within: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (l, ids, at) sorted by l, the left node itself first (r null): to pairs (l, r) of the next level, or of points
    to the right rows that may be their nearest."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.Array, bytes]]:
        for batch in batches:
            l, own, ids, at = (batch.column(i) for i in range(4))
            for i, (node, first) in enumerate(zip(l.to_pylist(), own.to_pylist(), strict=True)):
                yield node, first, ids[i].values, at[i].as_py()

    def pairs(left: tuple, right: list[tuple]) -> list[pa.RecordBatch]:
        (mine, boxes), out = _members(left[3], l_points), []
        held = [_members(r[3], r_points) for r in right]
        ids = pa.concat_arrays([r[2] for r in right])
        what, theirs = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        if r_points:
            kept = np.zeros(0, np.int64)
            for begin in range(0, len(theirs), AT_ONCE):  # what is kept goes on to the next stretch
                some = np.concatenate([kept, np.arange(begin, min(begin + AT_ONCE, len(theirs)))])
                mask = _near(boxes, theirs[some], None, k, within)
                kept = some[mask.any(axis=0)]
            mask = mask[:, mask.any(axis=0)]
            who, which = np.nonzero(mask)
            which = pa.array(kept[which])
            found = pa.StructArray.from_arrays([ids.take(which), pa.array(what[:, 0]).take(which), pa.array(what[:, 1]).take(which)], ["r_rid", "lat", "lon"])
            ends = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(mine)))])
            out.append(pa.RecordBatch.from_arrays([pa.array(mine[:, 0]), pa.array(mine[:, 1]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], ["p_lat", "p_lon", "near"]))
            return out
        rows = max(1, (1 << 20) // len(theirs))
        together = np.zeros(len(theirs), bool)
        for begin in range(0, len(boxes), rows):
            mask = _near(boxes[begin : begin + rows], theirs, what[:, 0], k, within)
            if l_points:
                together |= mask.any(axis=0)
                continue
            who, which = np.nonzero(mask)
            out.append(pa.RecordBatch.from_arrays([left[2].take(pa.array(who + begin)), ids.take(pa.array(which))], ["l", "r"]))
        if l_points:
            which = np.nonzero(together)[0]
            out.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(which), left[0])), ids.take(pa.array(which))], ["l", "r"]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = None, []
        for row in groups(batches):
            if row[1]:
                if left and right:
                    yield from pairs(left, right)
                left, right = row, []
            else:
                right.append(row)
        if left and right:
            yield from pairs(left, right)

    return run


def candidates(points: DataFrame, right: DataFrame, k: int, within: float | None = None) -> DataFrame:
    """(p_lat, p_lon, near): for points (lat, lon) right rows (r_rid, lat, lon), among them the k nearest of each."""
    kind = right.schema["r_rid"].dataType.simpleString()
    ours = _levels(points.select(F.lit(0).cast("bigint").alias("id"), "lat", "lon"), "left_nodes")
    theirs = _levels(right.select(F.col("r_rid").alias("id"), "lat", "lon"), "right_nodes")
    chord = math.inf if within is None else 2 * math.sin(min(within / (2 * EARTH_M), math.pi / 2))
    i, j = min(len(ours), len(theirs)) - 1, len(theirs) - 1
    tops = [F.lit(r["node"]) for r in theirs[j][0].select("node").collect()]  # TOP at most
    tops = F.array(*tops) if tops else F.array().cast("array<bigint>")
    pairs = ours[i][0].select(F.col("node").alias("l"), F.explode(tops).alias("r"))
    while True:
        (a, n), b = ours[i], theirs[j][0]
        met = pairs.join(b.select(F.col("node").alias("r"), "ids", "at"), "r").select("l", F.lit(False).alias("own"), "ids", "at")
        itself = a.select(F.col("node").alias("l"), F.lit(True).alias("own"), (F.col("ids") if j else F.lit(None).cast(f"array<{kind}>")).alias("ids"), "at")
        # Few bytes are much work, so tasks are as many as set, or as nodes ask for.
        tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / NODES))
        both = itself.unionByName(met).repartition(tasks, "l").sortWithinPartitions("l", F.desc("own"))
        if j == 0:
            return both.mapInArrow(_down(True, True, k, chord), f"p_lat double, p_lon double, near array<struct<r_rid:{kind},lat:double,lon:double>>")
        pairs = written(both.mapInArrow(_down(i == 0, False, k, chord), "l bigint, r bigint"), "pairs")
        i, j = max(i - 1, 0), j - 1


def nearest_k(left: DataFrame, right: DataFrame, k: int, within: float | None = None) -> DataFrame:
    """(l_rid, r_rid, d, place): the k nearest right rows of every located left row, by distance, then rid; all of them if
    there are no more than k.  With a radius, only rows within it."""
    somewhere = valid(F.col("lat"), F.col("lon")) & (F.abs("lat") < math.inf) & (F.abs("lon") < math.inf)
    rows = written(left.where(somewhere).select(F.col("rid").alias("l_rid"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")), "points")
    spot = Window.partitionBy("lat", "lon").orderBy("r_rid")
    there = right.where(somewhere).select(F.col("rid").alias("r_rid"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    there = written(there.withColumn("turn", F.row_number().over(spot)).where(F.col("turn") <= k).drop("turn"), "points")
    near = candidates(written(rows.select("lat", "lon").distinct(), "points"), there, k, within)
    measured = F.transform("near", lambda r: F.struct(haversine_m(F.col("p_lat"), F.col("p_lon"), r["lat"], r["lon"]).alias("d"), r["r_rid"].alias("r_rid")))
    if within is not None:
        measured = F.filter(measured, lambda r: r["d"] <= within)
    best = near.select("p_lat", "p_lon", F.slice(F.array_sort(measured), 1, k).alias("best"))
    found = rows.join(best, (F.col("lat") == F.col("p_lat")) & (F.col("lon") == F.col("p_lon"))).select("l_rid", F.posexplode("best").alias("at", "b"))
    return found.select("l_rid", "b.r_rid", "b.d", (F.col("at") + 1).alias("place"))


def nearest(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l_rid, r_rid, d): the nearest right row, of equally near ones the first; located left rows stay with nulls if the
    right side has no point."""
    rows = left.where(valid(F.col("lat"), F.col("lon"))).select(F.col("rid").alias("l_rid"))
    return rows.join(nearest_k(left, right, 1).drop("place"), "l_rid", "left")
