"""Matched and unmatched reports, coverage (DIA-01 to 05, AGG-05 to 11).

Columns are called left_ and right_; `renamed` gives them a pipeline's own names.  Reports of nothing are empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MatchConfig
from ..functions.parse import max_kv
from ..functions.text import distinct_joined
from . import alike, join
from .cascade import FUZZY, LOCATION


def renamed(report: DataFrame, left: str, right: str) -> DataFrame:
    """left_index -> {left}_index and so on, also inside names."""
    swap = lambda c: "_".join({"left": left, "right": right}.get(p, p) for p in c.split("_"))
    return report.toDF(*map(swap, report.columns))


def matched(left: DataFrame, right: DataFrame, matches: DataFrame) -> DataFrame:
    """A row for each match: distance where it was the location, score where it was a fuzzy name."""
    out = join.lookup(matches, left, "l_rid", {"name": "left_name", "key": "left_key"})
    out = join.lookup(out, right, "r_rid", {"name": "right_name", "key": "right_key"})
    return out.select(
        F.col("l_rid").alias("left_index"),
        "left_name",
        "left_key",
        F.col("r_rid").alias("right_index"),
        "right_name",
        "right_key",
        "method",
        F.when(F.col("method") == LOCATION, F.col("aux")).alias("distance_m"),
        F.when(F.col("method") == FUZZY, F.col("aux")).alias("score"),
    ).orderBy("method", "left_name", "left_index")


def different_names(report: DataFrame) -> DataFrame:
    """Matches that were not by exact name and whose names differ (PRJ-16)."""
    return report.where((F.col("method") != "name_exact") & ~F.col("left_name").eqNullSafe(F.col("right_name")))


def voltages_by_key(df: DataFrame, voltage: str) -> DataFrame:
    """(key, voltages): distinct, sorted, joined by semicolons (AGG-05)."""
    return df.where(F.col("key").isNotNull()).groupBy("key").agg(distinct_joined(F.col(voltage), ";").alias("voltages"))


def unmatched_sites(left: DataFrame, right: DataFrame, matches: DataFrame, config: MatchConfig, voltages: DataFrame | None = None) -> DataFrame:
    """Why sites found no partner (DIA-01, DIA-04): nearest row, best fuzzy name, whether the key exists, a reason."""
    rest = left.join(matches.select(F.col("l_rid").alias("rid")), "rid", "left_anti")
    out = join.member(rest, right, "key", "key_in_right")
    near = join.nearest(rest, right).select(F.col("l_rid").alias("rid"), F.col("r_rid").alias("nearest_right_index"), F.col("d").alias("nearest_distance_m"))
    out = join.lookup(out.join(near, "rid", "left"), right, "nearest_right_index", {"name": "nearest_right_name", "key": "nearest_right_key"})
    if config.use_fuzzy:
        best = alike.fuzzy_best(rest, right, backend=config.scorer).select(F.col("l_rid").alias("rid"), F.col("r_rid").alias("best_fuzzy_right_index"), F.col("score").alias("best_fuzzy_score"))
        out = join.lookup(out.join(best, "rid", "left"), right, "best_fuzzy_right_index", {"name": "best_fuzzy_right_name"})
    else:
        out = out.withColumns({"best_fuzzy_right_index": F.lit(None).cast("bigint"), "best_fuzzy_right_name": F.lit(None).cast("string"), "best_fuzzy_score": F.lit(None).cast("double")})
    out = join.lookup_default(out, voltages, "key", "voltages") if voltages is not None else out.withColumn("voltages", F.lit(""))
    return out.select(
        F.col("rid").alias("left_index"),
        F.col("name").alias("left_name"),
        F.col("key").alias("left_key"),
        F.col("lon").alias("left_lon"),
        F.col("lat").alias("left_lat"),
        F.col("voltages").alias("left_voltages"),
        "nearest_right_index",
        "nearest_right_name",
        "nearest_right_key",
        "nearest_distance_m",
        "key_in_right",
        "best_fuzzy_right_index",
        "best_fuzzy_right_name",
        "best_fuzzy_score",
        site_reason(config).alias("reason"),
    ).orderBy("reason", "left_name", "left_index")


def site_reason(config: MatchConfig) -> Column:
    """PRJ-15 for sites; without any right point there is no distance, and that counts as outside."""
    d = F.col("nearest_distance_m")
    outside = d.isNull() | (d > config.radius_m)
    return (
        F.when(F.col("lon").isNull() | F.col("lat").isNull(), "left_missing_coords")
        .when(F.col("key_in_right") & outside, "same_name_in_right_but_outside_radius")
        .when((F.coalesce("best_fuzzy_score", F.lit(-1.0)) >= config.fuzzy_threshold) & outside, "fuzzy_name_match_but_outside_radius")
        .when(d <= config.nearby_m, "nearby_right_but_name_mismatch")
        .otherwise("no_close_match")
    )


def unmatched_targets(targets: DataFrame, sources: DataFrame, matches: DataFrame, config: MatchConfig) -> DataFrame:
    """Targets of a name-only match that found no source (DIA-02)."""
    rest = targets.join(matches.select(F.col("l_rid").alias("rid")), "rid", "left_anti")
    out = join.member(rest, sources, "key", "key_in_right")
    out = _with_best(out, rest, sources, config)
    score = F.coalesce("best_fuzzy_right_score", F.lit(-1.0))
    reason = F.when(F.col("key_in_right"), "same_name_exists_in_right_but_not_selected").when(score >= config.fuzzy_threshold, "fuzzy_match_below_policy").otherwise("no_name_match")
    return out.select(
        F.col("rid").alias("left_index"), F.col("name").alias("left_name"), F.col("key").alias("left_key"), "best_fuzzy_right_index", "best_fuzzy_right_name", "best_fuzzy_right_score", reason.alias("reason")
    ).orderBy("reason", "left_name", "left_index")


def uncovered_sources(sources: DataFrame, targets: DataFrame, config: MatchConfig) -> DataFrame:
    """Source keys that no target has, with the most similar target (DIA-03).  The empty key counts."""
    keys = join.missing_keys(sources, targets)
    rows = first_non_null(sources.where(F.col("key").isNotNull()), "key").join(keys, "key", "left_semi")
    out = _with_best(rows, rows, targets, config)
    return out.select(
        F.col("name").alias("right_name"),
        F.col("key").alias("right_key"),
        F.col("best_fuzzy_right_index").alias("best_fuzzy_left_index"),
        F.col("best_fuzzy_right_name").alias("best_fuzzy_left_name"),
        F.col("best_fuzzy_right_score").alias("best_fuzzy_left_score"),
        F.lit("right_key_not_in_left").alias("reason"),
    ).orderBy("right_name", "right_key")


def _with_best(out: DataFrame, rows: DataFrame, others: DataFrame, config: MatchConfig) -> DataFrame:
    if not config.use_fuzzy:
        return out.withColumns({"best_fuzzy_right_index": F.lit(None).cast("bigint"), "best_fuzzy_right_score": F.lit(None).cast("double"), "best_fuzzy_right_name": F.lit(None).cast("string")})
    best = alike.fuzzy_best(rows, others, backend=config.scorer).select(F.col("l_rid").alias("rid"), F.col("r_rid").alias("best_fuzzy_right_index"), F.col("score").alias("best_fuzzy_right_score"))
    return join.lookup(out.join(best, "rid", "left"), others, "best_fuzzy_right_index", {"name": "best_fuzzy_right_name"})


def first_non_null(df: DataFrame, key: str, order: str = "rid") -> DataFrame:
    """For each key, of every column the first value that is not null (AGG-06)."""
    others = [c for c in df.columns if c not in (key, order)]
    first = lambda c: F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return df.groupBy(key).agg(F.min(order).alias(order), *map(first, others)).select(*df.columns)


def coverage(right: DataFrame, matches: DataFrame, key: str = "key") -> DataFrame:
    """One row: distinct right keys, those with a match, and the share in percent, 0 without keys (AGG-07, AGG-08)."""
    hit = matches.select(F.col("r_rid").alias("rid")).distinct().withColumn("hit", F.lit(True))
    both = right.join(hit, "rid", "left").where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.coalesce("hit", F.lit(False))).alias("hit"))
    row = both.agg(F.count("*").alias("total_keys"), F.count_if("hit").alias("matched_keys"))
    return row.withColumn("coverage_pct", F.when(F.col("total_keys") == 0, 0.0).otherwise(100.0 * F.col("matched_keys") / F.col("total_keys")))


def missing_high_voltage(left: DataFrame, matches: DataFrame, voltage: str, high_kv: float) -> DataFrame:
    """One row: distinct keys of high voltage on the left, and those of them that have no match (AGG-09)."""
    high = left.where(F.col("key").isNotNull() & (max_kv(F.col(voltage)) > high_kv)).select("key").distinct()
    done = left.join(matches.select(F.col("l_rid").alias("rid")), "rid", "left_semi").select("key").distinct().withColumn("done", F.lit(True))
    return high.join(done, "key", "left").agg(F.count("*").alias("high_kv_keys"), F.count_if(F.col("done").isNull()).alias("missing_high_kv"))


def any_missing(df: DataFrame, columns: tuple[str, ...] = ("lon", "lat")) -> DataFrame:
    """One row: whether any of the columns is null anywhere (AGG-11)."""
    gaps = F.lit(False)
    for c in columns:
        gaps = gaps | F.col(c).isNull()
    return df.agg(F.coalesce(F.bool_or(gaps), F.lit(False)).alias("any_missing"))


def summary(**tables: DataFrame) -> DataFrame:
    """(metric, value): the row count of each table (AGG-10, SNK-11)."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("metric"), F.count("*").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out
