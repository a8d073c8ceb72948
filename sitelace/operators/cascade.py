"""Matching in stages, and what matches write back (JOIN-07, UPD-01 to 04, SET-01).

`matches` has (l_rid, stage, method, r_rid, aux): stage 0 location, 1 exact key, 2 fuzzy name; a left row has one match at
most, a right row any number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import MatchConfig
from ..functions.geo import valid
from ..functions.parse import robust_float
from ..functions.text import format_coordinate, key_station_plus, strip_voltage
from ..session import written
from . import alike, join

LOCATION, EXACT, FUZZY = "location", "name_exact", "name_fuzzy"
METHODS = (LOCATION, EXACT, FUZZY)


def with_keys(df: DataFrame, name: str, config: MatchConfig, raw: bool = False) -> DataFrame:
    """Adds `name` (voltage taken off) and `key`; placeholders for missing names become null and match nothing by name."""
    text = F.col(name).cast("string")
    text = F.when(F.lower(F.trim(text)).isin("nan", "none", "", "-"), None).otherwise(text)
    made = config.key_fn or key_station_plus
    shown = text if raw else strip_voltage(text)
    return df.withColumn("site_name", F.when(text.isNull(), None).otherwise(shown)).withColumn("key", F.when(text.isNull(), None).otherwise(text if raw else made(text))).withColumn("name", F.col("site_name")).drop("site_name")


def sites(df: DataFrame) -> DataFrame:
    """Located rows, the first of each key and place; their own numbers stay."""
    located = df.where(valid(F.col("lat"), F.col("lon")))
    return join.first_rows(located, ["key", "lon", "lat"])


def cascade(left: DataFrame, right: DataFrame, config: MatchConfig, location: bool = True) -> DataFrame:
    """Location, then exact key, then fuzzy name; a left row matched once is out of the later stages."""
    stages: list[DataFrame] = []
    rest = left

    def add(found: DataFrame, method: str, aux: Column) -> None:
        nonlocal rest
        found = found.select("l_rid", F.lit(METHODS.index(method)).alias("stage"), F.lit(method).alias("method"), "r_rid", aux.cast("double").alias("aux"))
        found = written(found, "stage")  # read by every later stage
        stages.append(found)
        rest = rest.join(found.select(F.col("l_rid").alias("rid")), "rid", "left_anti")

    if location:
        add(join.nearest_within(rest, right, config.radius_m), LOCATION, F.col("d"))
        add(join.exact_first(rest, right), EXACT, F.lit(None))
    else:
        add(join.exact_prefer_located(rest, right), EXACT, F.lit(None))
    if config.use_fuzzy:
        add(alike.fuzzy_best(rest, right, threshold=config.fuzzy_threshold, backend=config.scorer), FUZZY, F.col("score"))
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s)
    return out


def _writes(left: DataFrame, matches: DataFrame) -> DataFrame:
    sources = left.select(F.col("rid").alias("l_rid"), F.col("lon").alias("w_lon"), F.col("lat").alias("w_lat"), F.col("name").alias("w_name"))
    return matches.join(sources, "l_rid").withColumn("turn", F.struct("stage", "l_rid"))


def _audit(conflict: str) -> Column:
    said = F.struct("method", "aux", "w_name", "w_lon", "w_lat")
    return F.min_by(said, F.col("turn")) if conflict == "best" else F.max_by(said, F.col("turn"))


def replace_coordinates(right: DataFrame, left: DataFrame, matches: DataFrame, config: MatchConfig) -> DataFrame:
    """Matched rows take the site's coordinates; of several the last writer's (UPD-01), with its method, aux and name."""
    last = _writes(left, matches).groupBy("r_rid").agg(_audit(config.conflict).alias("w"))
    joined = right.join(last, right["rid"] == last["r_rid"], "left").drop("r_rid")
    out = joined.withColumn("lon", F.when(F.col("w").isNotNull(), F.col("w.w_lon")).otherwise(F.col("lon"))).withColumn("lat", F.when(F.col("w").isNotNull(), F.col("w.w_lat")).otherwise(F.col("lat")))
    return out.withColumns({"match_method": F.col("w.method"), "match_aux": F.col("w.aux"), "matched_name": F.col("w.w_name")}).drop("w")


def fill_coordinates(right: DataFrame, left: DataFrame, matches: DataFrame, config: MatchConfig) -> DataFrame:
    """Rows that lack a coordinate take both from the first writer; what is noted is the last writer's (UPD-02)."""
    both = _writes(left, matches).groupBy("r_rid").agg(F.min_by(F.struct("w_lon", "w_lat"), "turn").alias("f"), _audit(config.conflict).alias("w"))
    joined = right.join(both, right["rid"] == both["r_rid"], "left").drop("r_rid")
    lacks = ~valid(F.col("lat"), F.col("lon")) & F.col("f").isNotNull()
    out = joined.withColumn("lacks", lacks)
    out = out.withColumn("lon", F.when(F.col("lacks"), F.col("f.w_lon")).otherwise(F.col("lon"))).withColumn("lat", F.when(F.col("lacks"), F.col("f.w_lat")).otherwise(F.col("lat")))
    return out.withColumns({"match_method": F.col("w.method"), "match_aux": F.col("w.aux"), "matched_name": F.col("w.w_name")}).drop("f", "w", "lacks")


def write_formatted(targets: DataFrame, sources: DataFrame, matches: DataFrame, sep: str = ",", places: int = 6) -> DataFrame:
    """Each target row takes its one source's coordinates as text, if both have one; `filled` says so (UPD-03)."""
    given = matches.select(F.col("l_rid").alias("rid"), "r_rid")
    from_source = sources.select(F.col("rid").alias("r_rid"), format_coordinate(F.col("lon"), sep, places).alias("t_lon"), format_coordinate(F.col("lat"), sep, places).alias("t_lat"))
    joined = targets.join(given.join(from_source, "r_rid").drop("r_rid"), "rid", "left")
    out = joined.withColumn("filled", (F.coalesce("t_lon", F.lit("")) != "") & (F.coalesce("t_lat", F.lit("")) != ""))
    for c in ("lon", "lat"):
        out = out.withColumn(c, F.when(F.col("filled"), F.col(f"t_{c}")).otherwise(F.col(c).cast("string")))
    return out.drop("t_lon", "t_lat")


def without_coordinates(df: DataFrame) -> DataFrame:
    """Rows whose coordinates are still missing."""
    return df.where(~F.coalesce(valid(F.col("lat"), F.col("lon")), F.lit(False)))


def gaps(df: DataFrame, most: int = 10) -> DataFrame:
    """The first rows that lack a coordinate, `most` at most, as an error shows them (LIM-02)."""
    return without_coordinates(df).orderBy("rid").limit(most)


def require_coordinates(df: DataFrame) -> DataFrame:
    """The rows, written; raises, with a sample, if one lacks a coordinate (UPD-04).

    They are counted while they are written, so the plan runs once, and the sample comes from what was written."""
    seen = Observation("coordinates")
    lacks = ~F.coalesce(valid(F.col("lat"), F.col("lon")), F.lit(False))
    out = written(df.observe(seen, F.count("*").alias("rows"), F.coalesce(F.count_if(lacks), F.lit(0)).alias("gaps")), "checked")
    if seen.get["gaps"]:
        raise ValueError(f"{seen.get['gaps']} of {seen.get['rows']} rows without coordinates, such as {gaps(out).collect()}")
    return out


def append_unmatched(enriched: DataFrame, unmatched: DataFrame, name: str, voltage: str, method: str = "left_only_append") -> DataFrame:
    """Unmatched sites as rows of the target's shape; other columns are null (SET-01).

    unmatched: (left_name, left_lon, left_lat, left_voltages)."""
    text = F.trim(F.col("left_voltages"))
    rows = unmatched.select(
        F.col("left_name").alias(name),
        F.col("left_lon").alias("lon"),
        F.col("left_lat").alias("lat"),
        F.when(text != "", F.col("left_voltages")).alias(voltage),
        F.lit(method).alias("match_method"),
        F.col("left_name").alias("matched_name"),
    )
    return enriched.unionByName(rows, allowMissingColumns=True)


def located(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Coordinates parsed as tolerantly as the sources need."""
    return df.withColumn("lon", robust_float(F.col(lon))).withColumn("lat", robust_float(F.col(lat)))
