"""The eight stages as functions from tables to tables; reading and writing stay outside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ENRICH_NAMES, FILL_COORDINATES, LINK_SITES, MatchConfig
from ..functions.parse import has_text, named_split, numeric, parse_voltage, sanitize
from ..functions.text import clean_name, popup, safe_value
from ..operators import cascade, cluster, fill, join, palette, reports, semistructured
from ..session import with_row_id, written
from . import schema


@dataclass(frozen=True)
class Linked:
    """What a linking stage gives: the enriched table and its reports; unused ones are None."""

    enriched: DataFrame
    matched: DataFrame
    unmatched: DataFrame
    uncovered: DataFrame | None = None
    statistics: DataFrame | None = None
    different: DataFrame | None = None


def map_sites(elements: DataFrame, config: MatchConfig = LINK_SITES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stage 1: elements -> one row for each site within the radius, then (all, named, unnamed)."""
    rows = semistructured.flatten_elements(elements)
    rows = rows.withColumn("name_clean", clean_name(F.col("name_raw")))
    rows = with_row_id(rows, ["element_type", "element_id"])
    stamp = F.coalesce(F.try_to_timestamp("timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp"))
    score = cluster.keep_score(F.col("name_clean"), F.col("voltage"), F.col("operator"), F.col("lat"), F.col("lon"), F.col("tags_count"))
    scored = rows.withColumns({"score": score, "stamp": stamp})
    clustered = written(scored.join(cluster.leaders(scored, config.dedup_m), "rid"), "sites")
    picked = cluster.representatives(clustered, rid="element_id").join(cluster.variants(clustered, ("name_clean", "operator", "voltage")), "leader").drop("leader")
    return picked, *named_split(picked)


def workbook(rows: DataFrame, group: str = "Nombre") -> DataFrame:
    """Stage 2: a sheet with merged cells (all text, `rid` in sheet order) -> a filled table."""
    return fill.clean_workbook(schema.require(rows, group), group)


def markers(payloads: DataFrame) -> DataFrame:
    """Stage 3: JSON payloads of unknown shape (url, payload) -> features with their properties."""
    return semistructured.flatten_features(payloads, "payload", ("url",)).withColumn("source", semistructured.short_name(F.col("url")))


def service(features: DataFrame, attributes: dict[str, str], name: str = "nombre_subestacion") -> DataFrame:
    """Stage 4: GeoJSON features -> flat rows with a name, texts on one line."""
    rows = semistructured.service_rows(features, "feature", attributes)
    rows = rows.where(has_text(F.col(name)))
    return rows.select(*(sanitize(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes))


def _numbered(df: DataFrame) -> DataFrame:
    """Rows need `rid`; readers give it in file order."""
    return schema.require(df, "rid")


def link_sites(targets: DataFrame, source: DataFrame, config: MatchConfig = LINK_SITES) -> Linked:
    """Stage 5: sites of the source matched to targets; matched targets take their coordinates, unmatched sites are appended."""
    name = schema.name_column(targets.columns)
    right = cascade.with_keys(schema.ensure_coordinates(_numbered(targets)), name, config)
    all_left = cascade.with_keys(schema.ensure_coordinates(_numbered(source)), schema.name_column(source.columns, ("nombre_subestacion", "name")), config)
    left = written(cascade.sites(all_left), "left_sites")
    right = written(right, "targets")
    matches = written(cascade.cascade(left, right, config), "matches")
    enriched = cascade.require_coordinates(cascade.replace_coordinates(right, left, matches, config))
    voltage = schema.voltage_column(source.columns)
    levels = reports.voltages_by_key(all_left, voltage) if voltage else None
    unmatched = written(reports.unmatched_sites(left, right, matches, config, levels), "unmatched")
    target_voltage = schema.voltage_column(targets.columns) or "voltage"
    if name in ("name", "key"):
        appended = cascade.append_unmatched(enriched, unmatched, name, target_voltage)
    else:
        appended = cascade.append_unmatched(enriched.drop("name", "key"), unmatched, name, target_voltage)
    return Linked(appended, reports.matched(left, right, matches), unmatched)


def enrich_names(targets: DataFrame, sources: DataFrame, config: MatchConfig = ENRICH_NAMES, sep: str = ",") -> Linked:
    """Stage 6: each target takes the coordinates of the source of its name, as text of its file's dialect."""
    lon, lat = schema.coordinate_columns(sources.columns)
    sources = _numbered(sources).withColumn("lon", numeric(F.col(lon))).withColumn("lat", numeric(F.col(lat)))
    right = written(cascade.with_keys(sources, schema.name_column(sources.columns, ("elementName", "name")), config), "sources")
    left = schema.with_defaults(_numbered(targets), lon="string", lat="string")
    left = written(cascade.with_keys(left, schema.name_column(left.columns, schema.TARGET_NAMES), config), "targets")
    matches = written(cascade.cascade(left, right, config, location=False), "matches")
    enriched = cascade.write_formatted(left, right, matches, sep)
    return Linked(enriched, reports.matched(left, right, matches), reports.unmatched_targets(left, right, matches, config), reports.uncovered_sources(right, left, config))


def fill_coordinates(targets: DataFrame, source: DataFrame, config: MatchConfig = FILL_COORDINATES) -> Linked:
    """Stage 7: targets without coordinates take those of a site of their name; statistics of what is covered."""
    name = schema.name_column(targets.columns, schema.TARGET_NAMES)
    right = cascade.with_keys(schema.ensure_coordinates(_numbered(targets)), name, config, raw=config.key_mode == "raw")
    all_left = cascade.with_keys(schema.ensure_coordinates(_numbered(source)), schema.name_column(source.columns, ("name_clean", "name")), config)
    left, right = written(cascade.sites(all_left), "left_sites"), written(right, "targets")
    matches = written(cascade.cascade(left, right, config), "matches")
    enriched = cascade.fill_coordinates(right, left, matches, config)
    voltage = schema.voltage_column(source.columns)
    levels = reports.voltages_by_key(all_left, voltage) if voltage else None
    matched = reports.matched(left, right, matches)
    statistics = reports.coverage(right, matches)
    if voltage:
        statistics = statistics.crossJoin(reports.missing_high_voltage(all_left, matches, voltage, config.high_kv))  # one row each
    located = enriched.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    unmatched = reports.unmatched_sites(left, right, matches, config, levels)
    return Linked(located, matched, unmatched, statistics=statistics, different=reports.different_names(matched))


def map_rows(stations: DataFrame, ways: DataFrame, nodes: DataFrame, name: str, voltage: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stage 8: (markers, lines, palette), ready to draw.  ways: (way_id, nodes, voltage); fields: label -> column."""
    spots = stations.withColumns({"lat": numeric(F.col("lat")), "lon": numeric(F.col("lon")), "kv": parse_voltage(F.col(voltage))}).dropna(subset=["lat", "lon"])
    lines = ways.withColumn("kv", parse_voltage(F.col("voltage")))
    colours = palette.palette(spots.select("kv").unionByName(lines.select("kv")))
    points = palette.coloured(spots, colours, palette.NO_STATION)
    points = points.select("lat", "lon", "kv", "colour", safe_value(F.col(name)).alias("tooltip"), popup({k: F.col(c) for k, c in fields.items()}).alias("popup"))
    drawn = semistructured.assemble_ways(ways, nodes).join(lines.select("way_id", "kv"), "way_id")
    drawn = palette.coloured(drawn, colours, palette.NO_LINE).withColumn("weight", palette.line_weight(F.col("kv")))
    drawn = drawn.withColumn("tooltip", F.when(F.col("kv").isNull(), "n/a").otherwise(F.concat(F.col("kv").cast("string"), F.lit(" kV"))))
    return points, drawn, colours


def nearest_k(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    return join.knn(left, right, k)
