"""JSON of loose shape to rows (SEM-01 to 09, SRC-03).  Values are VARIANT until a column is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import lenient_float

# Where lists and coordinates are looked for, in this order.
LIST_KEYS = ("features", "data", "result", "results", "items", "value", "lines", "Lineas")
LAT_KEYS = ("latitude", "lat", "LAT", "Lat", "y", "Y")
LON_KEYS = ("longitude", "lon", "lng", "long", "LON", "Lng", "x", "X")
TEXT_MAP = "map<string,string>"
ELEMENT = (
    "struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,nodes:array<bigint>,"
    "tags:map<string,string>,timestamp:string>"
)


def payload_items(payload: Column) -> Column:
    """JSON text -> array of variants: the features of a collection, else the first listed key that holds a list, else
    the value itself.  Text that is no JSON, and null, have no items."""
    v = F.try_parse_json(payload)
    lists = [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in LIST_KEYS]
    itself = F.try_variant_get(v, "$", "array<variant>")
    collection = F.when(F.try_variant_get(v, "$.type", "string") == "FeatureCollection", F.coalesce(lists[0], F.array().cast("array<variant>")))
    is_list = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(v.isNull(), F.array().cast("array<variant>")).when(is_list, itself).otherwise(F.coalesce(collection, *(F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")).startswith("ARRAY"), x) for k, x in zip(LIST_KEYS, lists, strict=True)), F.array(v)))


def split_payloads(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(payloads that are JSON, the others with a `reason`): what the source said of its failure in a column `error`, else
    `no payload` for null and blank text, else `not JSON`."""
    text = F.col(payload)
    blank = text.isNull() | (F.trim(text) == "")
    reason = F.when(blank, "no payload").when(F.try_parse_json(text).isNull(), "not JSON")
    if "error" in df.columns:
        reason = F.coalesce(F.col("error"), reason)
    told = df.withColumn("reason", reason)
    return told.where("reason IS NULL").drop("reason"), told.where("reason IS NOT NULL")


def _object(v: Column, path: str) -> Column:
    """An object's members as text; null if there is none."""
    held = F.try_variant_get(v, path, "map<string,variant>")
    return F.transform_values(held, lambda _, x: F.coalesce(x.try_cast("string"), F.to_json(x)))


def feature(v: Column) -> Column:
    """variant -> struct(props map, geometry_type, coordinates variant)."""
    none = F.lit(None).cast(TEXT_MAP)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    props, attributes, plain = (_object(v, p) for p in ("$.properties", "$.attributes", "$"))
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    is_feature = F.coalesce(F.try_variant_get(v, "$.type", "string") == "Feature", F.lit(False))
    geometry = F.try_variant_get(v, "$.geometry", "variant")
    wrapped = F.coalesce(F.map_contains_key(plain, "attributes") | F.map_contains_key(plain, "geometry"), F.lit(False))
    overlaid = _overlay(F.coalesce(attributes, empty), F.coalesce(props, empty))
    scalar = F.create_map(F.lit("value"), F.coalesce(v.try_cast("string"), F.to_json(v)))
    chosen = F.when(is_object & is_feature, F.coalesce(props, empty)).when(is_object & wrapped, overlaid).when(is_object, plain).otherwise(scalar)
    has_geometry = is_object & (is_feature | wrapped)
    return F.struct(
        F.coalesce(chosen, none).alias("props"),
        F.when(has_geometry, F.try_variant_get(geometry, "$.type", "string")).alias("geometry_type"),
        F.when(has_geometry, F.try_variant_get(geometry, "$.coordinates", "variant")).alias("coordinates"),
    )


def _overlay(under: Column, over: Column) -> Column:
    """Both maps' members; of a key in both, the second's."""
    return F.map_concat(F.map_filter(under, lambda k, _: ~F.map_contains_key(over, k)), over)


def point_in(props: Column) -> tuple[Column, Column]:
    """(lat, lon) from the first key that is present, even if its value is no number."""

    def first(keys: tuple[str, ...]) -> Column:
        out = F.lit(None).cast("double")
        for k in reversed(keys):
            out = F.when(F.map_contains_key(props, F.lit(k)), lenient_float(props[k])).otherwise(out)
        return out

    return first(LAT_KEYS), first(LON_KEYS)


def flatten_features(df: DataFrame, payload: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON payloads -> a row for each object: place, props, where its geometry came from, lon and lat of points, a sample."""
    rows = df.select(*keep, F.posexplode(payload_items(F.col(payload))).alias("place", "item"))
    rows = rows.select(*keep, "place", feature(F.col("item")).alias("f")).select(*keep, "place", "f.*")
    lat, lon = point_in(F.col("props"))
    rows = rows.withColumns({"p_lat": lat, "p_lon": lon})
    recovered = F.col("p_lat").isNotNull() & F.col("p_lon").isNotNull()
    at = lambda i: F.try_variant_get(F.col("coordinates"), f"$[{i}]", "double")
    is_point = (F.col("geometry_type") == "Point") & at(0).isNotNull() & at(1).isNotNull()
    own = F.col("geometry_type").isNotNull()
    first = F.slice(F.try_variant_get(F.col("coordinates"), "$", "array<variant>"), 1, 3)
    return rows.select(
        *keep,
        "place",
        "props",
        F.when(own, "geometry").when(recovered, "props(lat,lon)").otherwise("none").alias("geom_from"),
        F.when(own, F.col("geometry_type")).when(recovered, "Point").alias("geometry_type"),
        F.when(is_point, at(0)).when(~own & recovered, F.col("p_lon")).alias("lon"),
        F.when(is_point, at(1)).when(~own & recovered, F.col("p_lat")).alias("lat"),
        F.when(own, F.to_json(first)).when(recovered, F.to_json(F.array("p_lon", "p_lat"))).alias("geometry_sample"),
    )


def short_name(url: Column) -> Column:
    """The last part of a URL's path, without its query; `output` if there is none."""
    last = F.element_at(F.split(F.regexp_replace(F.split_part(url, F.lit("?"), F.lit(1)), "/+$", ""), "/"), -1)
    return F.when(F.coalesce(last, F.lit("")) == "", "output").otherwise(last)


def header_keys(features: DataFrame, order: tuple[str, ...] = ("place",)) -> list[str]:
    """Property names in order of first appearance: as many rows as there are names."""
    named = features.select(F.struct(*order).alias("at"), F.posexplode(F.map_keys("props")).alias("n", "key"))
    first = named.groupBy("key").agg(F.min(F.struct("at", "n")).alias("f")).orderBy("f")
    return [r["key"] for r in first.select("key").collect()]


def wide(features: DataFrame, keys: list[str], more: tuple[str, ...] = ("geom_from", "geometry_type", "lon", "lat", "geometry_sample")) -> DataFrame:
    """Properties as columns, missing ones null."""
    return features.select(*(F.col("props")[k].alias(k) for k in keys if k not in more), *more)


def service_rows(df: DataFrame, feature_json: str, attributes: dict[str, str]) -> DataFrame:
    """GeoJSON features -> flat rows: attribute name -> column, lon, lat; missing ones null, and all of text that is no
    JSON (SEM-08)."""
    v = F.try_parse_json(F.col(feature_json))
    at = lambda i: F.try_variant_get(v, f"$.geometry.coordinates[{i}]", "double")
    return df.select(*(F.try_variant_get(v, f"$.properties.{k}", "string").alias(c) for k, c in attributes.items()), at(0).alias("lon"), at(1).alias("lat"))


def flatten_elements(df: DataFrame, elements: str = "elements") -> DataFrame:
    """Map elements -> rows (SRC-03): if a coordinate is missing both come from the centre; missing texts are empty."""
    rows = df.select(F.explode(elements).alias("e"))
    lacks = F.col("e.lat").isNull() | F.col("e.lon").isNull()
    tag = lambda k: F.coalesce(F.col("e.tags")[k], F.lit(""))
    return rows.select(
        F.col("e.type").alias("element_type"),
        F.col("e.id").alias("element_id"),
        F.when(lacks, F.col("e.center.lat")).otherwise(F.col("e.lat")).alias("lat"),
        F.when(lacks, F.col("e.center.lon")).otherwise(F.col("e.lon")).alias("lon"),
        tag("name").alias("name_raw"),
        tag("operator").alias("operator"),
        tag("voltage").alias("voltage"),
        F.coalesce(F.to_json("e.tags"), F.lit("{}")).alias("tags_json"),
        F.coalesce(F.size(F.col("e.tags")), F.lit(0)).alias("tags_count"),
        F.coalesce("e.timestamp", F.lit("")).alias("timestamp"),
    )


def assemble_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways (way_id, nodes), nodes (node_id, lat, lon) -> (way_id, path): nodes that are known, in order (SEM-09, JOIN-10).
    Ways without any known node are not there."""
    steps = ways.select("way_id", F.posexplode("nodes").alias("pos", "node_id"))
    placed = steps.join(nodes.select("node_id", "lat", "lon"), "node_id")
    path = F.array_sort(F.collect_list(F.struct("pos", "lat", "lon")))
    return placed.groupBy("way_id").agg(F.transform(path, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("path"))
