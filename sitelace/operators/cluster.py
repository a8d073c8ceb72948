"""Leader clustering by distance, representatives and variants (AGG-01 to 03, NUM-01).

A row is a leader if no leader with a smaller rid lies within the radius; every other row belongs to the first leader
within its radius.  Chains do not merge.  Rows on one spot share their fate, so a crowd on one spot is one point.  Rows
without coordinates are leaders of themselves.

Spots are dealt out in tiles, which are groups of grid cells with a bounded number of spots, and a tile also sees the spots
around it.  A task walks through its tile in order of rid and compares each spot with the leaders near it, of which there
are few however dense the ground is, as they keep their distance; no pairs are listed.  What depends on an undecided spot of another tile
waits for the next round, so rounds follow the chains that cross tiles, not the spots in them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import asin, cos, radians, sin, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, Grid, valid
from ..functions.text import distinct_joined
from ..session import written
from .join import first_rows

#: Spots of a tile at most, unless one grid cell has more; halvings of the globe that tiles are made of.
TILE_SPOTS, LEVELS = 50_000, 20


def tiles(cells: DataFrame, most: int) -> DataFrame:
    """(cell, tile): cells (cell, lat, lon, n) in the largest square of a quadtree that holds `most` at most, or alone."""
    at = lambda v, low, span: F.floor((v - low) / span * F.lit(float(1 << LEVELS))).cast("bigint")
    placed = cells.select("cell", "n", at(F.col("lat"), -90.0, 180.0).alias("y"), at(F.pmod(F.col("lon") + 180, F.lit(360.0)), 0.0, 360.0).alias("x"))
    squares = [
        F.struct(F.lit(k).alias("level"), F.shiftright("y", LEVELS - k).alias("y"), F.shiftright("x", LEVELS - k).alias("x")) for k in range(0, LEVELS + 1, 2)
    ]
    every = placed.select("cell", "n", F.explode(F.array(*squares)).alias("square"))
    small = every.groupBy("square").agg(F.sum("n").alias("held")).where(F.col("held") <= most)
    largest = every.join(small, "square").groupBy("cell").agg(F.min("square").alias("square"))
    alone = F.concat(F.lit("c"), F.col("cell").cast("string"))
    named = F.concat_ws("/", *(F.col("square")[c].cast("string") for c in ("level", "y", "x")))
    return placed.select("cell").join(largest, "cell", "left").select("cell", F.when(F.col("square").isNull(), alone).otherwise(named).alias("tile"))


def _placed(spots: DataFrame, grid: Grid) -> DataFrame:
    """(tile, v, lat, lon, cell, near, own): each spot in its tile, and in those that touch it."""
    number = lambda c: (c["y"] * F.lit(1 << 32) + c["x"]).cast("bigint")
    own = spots.withColumn("cell", number(grid.cell(F.col("lat"), F.col("lon")))).withColumn("near", F.transform(grid.around(F.col("lat"), F.col("lon")), number))
    own = written(own, "spots")
    cells = own.groupBy("cell").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.count("*").alias("n"))
    where = written(tiles(cells, TILE_SPOTS), "tiles")
    seen = own.withColumn("at", F.explode("near")).join(where.select(F.col("cell").alias("at"), "tile"), "at")
    return seen.groupBy("tile", "v").agg(*(F.first(c).alias(c) for c in ("lat", "lon", "cell", "near")), F.bool_or(F.col("at") == F.col("cell")).alias("own"))


def _distance(a: tuple[float, float, float], b: tuple[float, float, float]) -> float:
    """Of (latitude in radians, its cosine, longitude in radians)."""
    h = sin((b[0] - a[0]) / 2) ** 2 + a[1] * b[1] * sin((b[2] - a[2]) / 2) ** 2
    return 2 * EARTH_M * asin(min(1.0, sqrt(h)))


OPEN, LEADER, MEMBER = 0, 1, 2


def _walk(radius_m: float, last: bool):
    """A task over rows sorted by tile and v.  With `last`, all is decided and each own spot gets its first leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = None
        leaders: dict = defaultdict(list)
        waiting: dict = defaultdict(list)
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("tile", "v", "lat", "lon", "cell", "near", "own", "state")), strict=True):
                name, v, lat, lon, cell, near, own, state = row
                if name != tile:
                    tile = name
                    leaders.clear()
                    waiting.clear()
                at = (radians(lat), cos(radians(lat)), radians(lon))
                if last:
                    first = v if state == LEADER else None
                    if own and first is None:  # leaders come in order of rid, so the first found in a cell is its first
                        first = min((next((u for u, b in leaders[c] if _distance(at, b) <= radius_m), v) for c in near if c in leaders), default=v)
                    if own:
                        out.append((v, first))
                    if state == LEADER:
                        leaders[cell].append((v, at))
                    continue
                was = state
                if state == OPEN and own:
                    if any(_distance(at, b) <= radius_m for c in near if c in leaders for _, b in leaders[c]):
                        state = MEMBER
                    elif not any(_distance(at, b) <= radius_m for c in near if c in waiting for b in waiting[c]):
                        state = LEADER
                    if state != was:
                        out.append((v, state))
                if state == LEADER:
                    leaders[cell].append((v, at))
                elif state == OPEN:
                    waiting[cell].append(at)
            columns = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64())], ["v", "said"])

    return run


def leaders(df: DataFrame, radius_m: float) -> DataFrame:
    """(rid, leader) for every row."""
    located = valid(F.col("lat"), F.col("lon"))
    spots = df.where(located).groupBy("lat", "lon").agg(F.min("rid").alias("v"))
    placed = written(_placed(spots, Grid(radius_m)), "placed")
    state = placed.select("v", F.lit(OPEN).cast("bigint").alias("said")).limit(0)

    def walk(rows: DataFrame, last: bool) -> DataFrame:
        known = rows.join(state, "v", "left").withColumn("state", F.coalesce("said", F.lit(OPEN))).drop("said")
        return known.repartition("tile").sortWithinPartitions("tile", "v").mapInArrow(_walk(radius_m, last), "v bigint, said bigint")

    rest = placed
    while True:
        found = written(walk(rest, False), "decided")
        if found.isEmpty():
            break
        state = written(state.unionByName(found), "state")
        # Tiles with nothing left to decide are done.
        undecided = placed.where("own").join(state, "v", "left_anti").select("tile").distinct()
        rest = placed.join(undecided, "tile", "left_semi")
    own = walk(placed, True).select(F.col("v").alias("spot"), F.col("said").alias("leader"))
    rows = df.where(located).select("rid", "lat", "lon").join(spots, ["lat", "lon"]).join(own, F.col("v") == F.col("spot")).select("rid", "leader")
    return rows.unionByName(df.where(~F.coalesce(located, F.lit(False))).select("rid", F.col("rid").alias("leader")))


def keep_score(name: Column, voltage: Column, operator: Column, lat: Column, lon: Column, tags: Column) -> Column:
    """How much a row says: 4 name, 3 place, 2 voltage, 1 operator, up to 10 for tags."""
    has = lambda c: F.when(F.coalesce(c.cast("string"), F.lit("")) != "", 1).otherwise(0)
    place = F.when(F.coalesce(valid(lat, lon), F.lit(False)), 1).otherwise(0)
    return 4 * has(name) + 2 * has(voltage) + has(operator) + 3 * place + F.least(F.coalesce(tags, F.lit(0)), F.lit(10))


def representatives(clustered: DataFrame, cluster: str = "leader", score: str = "score", stamp: str = "stamp", rid: str = "rid") -> DataFrame:
    """One row of each cluster: best score, then latest, then smallest id; a missing stamp counts as the epoch."""
    late = F.coalesce(F.col(stamp), F.lit("1970-01-01 00:00:00").cast("timestamp"))
    return first_rows(clustered, [cluster], [F.col(score).desc(), late.desc(), F.col(rid).asc()])


def variants(clustered: DataFrame, columns: tuple[str, ...], cluster: str = "leader") -> DataFrame:
    """For each cluster the distinct values of columns, as `{column}_variants`."""
    return clustered.groupBy(cluster).agg(*(distinct_joined(F.col(c)).alias(f"{c}_variants") for c in columns))


def deduplicate(df: DataFrame, radius_m: float, columns: tuple[str, ...] = ("name", "operator", "voltage")) -> DataFrame:
    """Representatives with their clusters' variants."""
    clustered = written(df.join(leaders(df, radius_m), "rid"), "clusters")
    return representatives(clustered).join(variants(clustered, columns), "leader").drop("leader")
