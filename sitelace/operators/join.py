"""Distance and key joins (JOIN-01 to 14; the search by similar name is in `alike`).

Sides are tables with a `rid` that orders them; ties go to the smaller one.  Distance joins look at distinct coordinates
first, so a crowd of rows on one spot is one point, and meet on grid cells; none of them is a cross join.  Cells with more
points than a task should meet are dealt into blocks, and nearest searches go down boxes of neighbours there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import Grid, haversine_m, valid
from ..session import written
from .nearest import nearest, nearest_k

__all__ = ["exact_first", "exact_prefer_located", "first_rows", "knn", "lookup", "lookup_default", "member", "missing_keys", "nearest", "nearest_k", "nearest_within", "points", "proximity_pairs", "radius_pairs"]


#: Rows of a side that meet under one key; right rows of a cell that are met whole by nearest searches; cells to broadcast.
BLOCK, CROWD, FEW_CELLS = 4096, 256, 100_000


def points(df: DataFrame, prefix: str) -> DataFrame:
    """Distinct valid coordinates with the first row on each: `{prefix}_rid`, `{prefix}_lat`, `{prefix}_lon`."""
    at = df.where(valid(F.col("lat"), F.col("lon"))).groupBy("lat", "lon").agg(F.min("rid").alias(f"{prefix}_rid"))
    return at.select(f"{prefix}_rid", F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon"))


def _crowded(at: DataFrame, more: int, n: str) -> DataFrame:
    """Cells of more than so many rows, with their number."""
    return at.groupBy("at.y", "at.x").agg(F.count("*").alias(n)).where(F.col(n) > more)


def _kept(crowds: DataFrame) -> DataFrame | None:
    """The crowded cells as a written table, broadcast if they are few (else the planner chooses); None without any."""
    crowds = written(crowds, "crowds")
    n = crowds.count()
    return None if n == 0 else F.broadcast(crowds) if n <= FEW_CELLS else crowds


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both sides whose cells `at` are equal, each pair once.

    A cell with more than BLOCK rows of a side has that side dealt into blocks, and its pairs of blocks are keys of their
    own, so a task's share doesn't grow with the crowd.  Points are told apart by their coordinates.
    """
    crowds = _crowded(left, BLOCK, "nl").join(_crowded(right, BLOCK, "nr"), ["y", "x"], "full")
    blocks = lambda n: F.ceil(F.coalesce(F.col(n), F.lit(1)) / BLOCK).cast("int")
    crowds = _kept(crowds.select("y", "x", blocks("nl").alias("l_blocks"), blocks("nr").alias("r_blocks")))
    if crowds is None:
        return left.join(right, (left["at"]["y"] == right["at"]["y"]) & (left["at"]["x"] == right["at"]["x"])).drop("at")

    def dealt(df: DataFrame, side: str, other: str) -> DataFrame:
        df = df.select("*", F.col("at.y").alias("y"), F.col("at.x").alias("x")).drop("at").join(crowds, ["y", "x"], "left")
        mine, theirs = F.coalesce(f"{side}_blocks", F.lit(1)), F.coalesce(f"{other}_blocks", F.lit(1))
        df = df.withColumn(f"{side}_block", F.pmod(F.xxhash64(f"{side}_lat", f"{side}_lon"), mine).cast("int"))
        return df.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), theirs - 1))).drop("l_blocks", "r_blocks")

    keys = ["y", "x", "l_block", "r_block"]
    return dealt(left, "l", "r").join(dealt(right, "r", "l"), keys).drop(*keys)


def radius_pairs(left: DataFrame, right: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of `points` within the radius, with their distance `d`."""
    grid = Grid(radius_m)
    near = left.withColumn("at", F.explode(grid.around(F.col("l_lat"), F.col("l_lon"))))
    here = right.withColumn("at", grid.cell(F.col("r_lat"), F.col("r_lon")))
    d = haversine_m(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon"))
    return _met(near, here).withColumn("d", d).where(F.col("d") <= radius_m)


def _nearest_of_cells(left: DataFrame, here: DataFrame, k: int, radius_m: float) -> DataFrame:
    """(l_lat, l_lon, r_rid, d): of each cell around a left point its k nearest rows within the radius.

    `here` has at most CROWD rows in a cell `at`.  A cell is one row with all of its points, so pairs are compared within a
    row and never listed: what is sorted later are at most nine times k rows for each left point.
    """
    grid = Grid(radius_m)
    spot = F.struct("r_lat", "r_lon", "r_rid")
    cells = here.groupBy("at").agg(F.collect_list(spot).alias("there"), F.min("r_lat").alias("r_lat"), F.min("r_lon").alias("r_lon"))
    # Few bytes may be many comparisons, so tasks are as many as set, not as bytes suggest.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = left.withColumn("at", F.explode(grid.around(F.col("l_lat"), F.col("l_lon")))).repartition(tasks, "at.y", "at.x")
    measured = lambda r: F.struct(haversine_m(F.col("l_lat"), F.col("l_lon"), r["r_lat"], r["r_lon"]).alias("d"), r["r_rid"].alias("r_rid"))
    within = F.filter(F.transform("there", measured), lambda r: r["d"] <= radius_m)
    best = F.array(F.array_min(within)) if k == 1 else F.slice(F.array_sort(within), 1, k)
    found = _met(near, cells).select("l_lat", "l_lon", F.explode(best).alias("b")).where(F.col("b").isNotNull())
    return found.select("l_lat", "l_lon", "b.r_rid", "b.d")


def _nearest_pairs(left: DataFrame, right: DataFrame, k: int, radius_m: float) -> DataFrame:
    """(l_lat, l_lon, r_rid, d) of distinct left points: a superset of their k nearest within the radius, by cells.

    The searches below go down boxes throughout; tests hold this way to the same distances.

    Cells of more than CROWD right rows are searched down boxes of neighbours, so on dense ground a point looks at a few
    of its neighbours only; the others are met whole.
    """
    grid = Grid(radius_m)
    here = written(right.withColumn("at", grid.cell(F.col("r_lat"), F.col("r_lon"))), "points")
    crowds = _kept(_crowded(here, CROWD, "n").select(F.struct("y", "x").alias("at")))
    if crowds is None:
        return _nearest_of_cells(left, here, k, radius_m)
    sparse = _nearest_of_cells(left, here.join(crowds, "at", "left_anti"), k, radius_m)
    near = left.withColumn("at", F.explode(grid.around(F.col("l_lat"), F.col("l_lon")))).join(crowds, "at", "left_semi")
    near = near.select(F.col("l_rid").alias("rid"), F.col("l_lat").alias("lat"), F.col("l_lon").alias("lon")).distinct()
    dense = here.join(crowds, "at", "left_semi").select(F.col("r_rid").alias("rid"), F.col("r_lat").alias("lat"), F.col("r_lon").alias("lon"))
    found = nearest_k(near, dense, k, radius_m).join(left.select("l_rid", "l_lat", "l_lon"), "l_rid")
    columns = ("l_lat", "l_lon", "r_rid", "d")
    return sparse.select(*columns).unionByName(found.select(*columns))


def nearest_within(left: DataFrame, right: DataFrame, radius_m: float) -> DataFrame:
    """(l_rid, r_rid, d): the nearest right row within the radius, of equally near ones the first (JOIN-01)."""
    return nearest_k(left, right, 1, radius_m).drop("place")


def knn(left: DataFrame, right: DataFrame, k: int, radius_m: float | None = None) -> DataFrame:
    """(l_rid, r_rid, d, place): the k nearest right rows, within a radius if one is given, by distance, then rid (JOIN-03)."""
    return nearest_k(left, right, k, radius_m)


def proximity_pairs(df: DataFrame, radius_m: float) -> DataFrame:
    """(i, j, d) of distinct spots, i < j by their first rows (JOIN-14)."""
    spots = written(points(df, "l"), "points")
    other = spots.select(F.col("l_rid").alias("r_rid"), F.col("l_lat").alias("r_lat"), F.col("l_lon").alias("r_lon"))
    pairs = radius_pairs(spots, other, radius_m).where("l_rid < r_rid")
    return pairs.select(F.col("l_rid").alias("i"), F.col("r_rid").alias("j"), "d")


def exact_first(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """(l_rid, r_rid): the first right row of the same key; null and empty keys match nothing (JOIN-04)."""
    own = lambda df: df.where(F.col(key).isNotNull() & (F.col(key) != ""))
    first = own(right).groupBy(key).agg(F.min("rid").alias("r_rid"))
    return own(left).select(F.col("rid").alias("l_rid"), key).join(first, key).select("l_rid", "r_rid")


def exact_prefer_located(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """(l_rid, r_rid): of the right rows of the same key the first with coordinates, else the first (JOIN-05)."""
    own = lambda df: df.where(F.col(key).isNotNull() & (F.col(key) != ""))
    missing = F.when(valid(F.col("lat"), F.col("lon")), 0).otherwise(1)
    first = own(right).groupBy(key).agg(F.min(F.struct(missing.alias("missing"), F.col("rid").alias("r_rid"))).alias("b"))
    return own(left).select(F.col("rid").alias("l_rid"), key).join(first, key).select("l_rid", F.col("b.r_rid").alias("r_rid"))


def lookup(df: DataFrame, other: DataFrame, on: str, columns: dict[str, str]) -> DataFrame:
    """Columns of `other` by its rid, renamed; rows without a partner stay (JOIN-09)."""
    picked = other.select(F.col("rid").alias("lookup_rid"), *(F.col(c).alias(n) for c, n in columns.items()))
    return df.join(picked, F.col(on) == F.col("lookup_rid"), "left").drop("lookup_rid")


def lookup_default(df: DataFrame, values: DataFrame, key: str, value: str, default: str = "") -> DataFrame:
    """The value of a key, or a default (JOIN-11)."""
    return df.join(values.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def member(df: DataFrame, other: DataFrame, key: str, into: str) -> DataFrame:
    """Whether a non-empty key occurs on the other side (JOIN-12)."""
    keys = other.where(F.col(key).isNotNull() & (F.col(key) != "")).select(F.col(key).alias("member_key")).distinct()
    return df.join(keys, F.col(key) == F.col("member_key"), "left").withColumn(into, F.col("member_key").isNotNull()).drop("member_key")


def missing_keys(df: DataFrame, other: DataFrame, key: str = "key") -> DataFrame:
    """Distinct keys without one on the other side; here the empty key counts (JOIN-13)."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().join(other.select(key).distinct(), key, "left_anti")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("rid",)) -> DataFrame:
    """The first row of each combination of keys (AGG-04)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("first_place", place).where("first_place = 1").drop("first_place")
