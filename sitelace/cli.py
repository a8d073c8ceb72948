"""`python -m sitelace.cli STAGE ...`: the eight stages on files and services (EXT-04)."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ENRICH_NAMES, FILL_COORDINATES, LINK_SITES
from .operators import semistructured
from .plans import schema, stages
from .session import session, ship, with_row_id, written
from .sinks.export import features, write_csv, write_dialect, write_geojson, write_map, write_union_csv
from .sources import http
from .sources.files import Dialect, read_sniffed

LINKING = {"link-sites": LINK_SITES, "enrich-names": ENRICH_NAMES, "fill-coordinates": FILL_COORDINATES}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sitelace")
    stage = parser.add_subparsers(dest="stage", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        p = stage.add_parser(name, help=text)
        p.add_argument("--out", required=True, help="folder for the results")
        return p

    def with_map_data(p: argparse.ArgumentParser) -> None:
        p.add_argument("--payload", help="a saved answer of the map service; without it the service is asked")
        p.add_argument("--endpoints", help="map services to ask in turn, comma-separated")
        p.add_argument("--country", default="CO", help="its two letters")

    with_map_data(add("map-sites", "1: substations of a country, one row a site"))
    add("workbook", "2: a sheet with merged cells, filled").add_argument("--targets", required=True)
    p = add("markers", "3: JSON endpoints, a table and a GeoJSON file each")
    p.add_argument("--urls", required=True, nargs="+")
    p.add_argument("--header", action="append", default=[], metavar="NAME=VALUE")
    p = add("service", "4: all features of a paged layer")
    p.add_argument("--url", required=True)
    p.add_argument("--attribute", action="append", required=True, metavar="FIELD=COLUMN", help="one column must be --name")
    p.add_argument("--name", default="nombre_subestacion", help="column that a row must have text in")
    p.add_argument("--at-once", type=int, default=http.AT_ONCE, help="requests at a time")
    for name, text in (("link-sites", "5: sites of a source matched to targets"), ("enrich-names", "6: targets take coordinates by name"), ("fill-coordinates", "7: targets without coordinates take those of a site")):
        p = add(name, text)
        p.add_argument("--targets", required=True)
        p.add_argument("--source", required=True)
        p.add_argument("--radius-m", type=float)
        p.add_argument("--fuzzy-threshold", type=int)
        p.add_argument("--scorer", choices=("difflib", "indel", "edits"))
    p = add("map", "8: stations and lines as an HTML map")
    p.add_argument("--targets", required=True)
    with_map_data(p)
    return parser


def _pair(text: str) -> tuple[str, str]:
    key, sep, value = text.partition("=")
    if not sep or not key or not value:
        raise SystemExit(f"{text!r} must be two names with = between")
    return key, value


def _table(spark: SparkSession, path: str) -> tuple[DataFrame, Dialect]:
    # A file's own order is its reader's: one file of a person's size is one partition.
    df, dialect = read_sniffed(spark, path)
    return with_row_id(df.coalesce(1).withColumn("file_place", F.monotonically_increasing_id()), ["file_place"]).drop("file_place"), dialect


def _elements(spark: SparkSession, args: argparse.Namespace, query: str) -> DataFrame:
    """(elements) of a saved or fresh answer, written, so that the service is asked once."""
    if args.payload:
        said = spark.read.text(args.payload, wholetext=True).withColumnRenamed("value", "payload")
    elif args.endpoints:
        said = spark.read.format("map_elements").option("endpoints", args.endpoints).option("query", query).load()
    else:
        raise SystemExit("--payload or --endpoints is needed")
    good, bad = semistructured.split_payloads(written(said, "payloads"))
    if (why := bad.first()) is not None:
        raise SystemExit(f"the answer is of no use: {why['reason']}")
    return good.select(F.from_json("payload", f"elements array<{semistructured.ELEMENT}>").alias("p")).select("p.elements")


def _map_sites(spark: SparkSession, args: argparse.Namespace, out: Path) -> None:
    for name, rows in zip(("sites", "named", "unnamed"), stages.map_sites(_elements(spark, args, http.substations_query(args.country))), strict=True):
        write_csv(rows.orderBy("element_type", "element_id"), str(out / f"{name}.csv"))


def _markers(spark: SparkSession, args: argparse.Namespace, out: Path) -> None:
    reader = spark.read.format("json_endpoints").option("urls", " ".join(args.urls))
    for h in args.header:
        name, value = _pair(h)
        reader = reader.option(f"header.{name}", value)
    good, bad = semistructured.split_payloads(written(reader.load(), "payloads"))
    rows = written(stages.markers(good), "markers")
    for r in rows.select("url", "source").distinct().collect():  # a row for each endpoint
        mine = rows.where(F.col("url") == r["url"])
        others = rows.where((F.col("source") == r["source"]) & (F.col("url") != r["url"])).limit(1).count()
        name = r["source"] if not others else f"{r['source']}_{args.urls.index(r['url'])}"
        write_union_csv(mine, str(out / f"{name}.csv"))
        flat = semistructured.wide(mine.orderBy("place"), semistructured.header_keys(mine))
        write_geojson(features(flat.drop("geom_from", "geometry_type", "geometry_sample")), str(out / f"{name}.geojson"), pretty=True)
    write_csv(bad.select("url", "reason").orderBy("url"), str(out / "rejected.csv"))


def _service(spark: SparkSession, args: argparse.Namespace, out: Path) -> None:
    rows = spark.read.format("feature_service").option("url", args.url).option("at_once", args.at_once).load()
    attributes = dict(map(_pair, args.attribute))
    if args.name not in attributes.values():
        raise SystemExit(f"no --attribute gives the column {args.name}")
    done = written(stages.service(rows, attributes, args.name), "service")
    write_csv(done, str(out / "service.csv"), ";")
    write_geojson(features(done), str(out / "service.geojson"), sort_keys=True, crs=True, newline=True)


def _link(spark: SparkSession, args: argparse.Namespace, out: Path) -> None:
    (targets, dialect), (source, _) = _table(spark, args.targets), _table(spark, args.source)
    config = LINKING[args.stage].override(radius_m=args.radius_m, fuzzy_threshold=args.fuzzy_threshold, scorer=args.scorer)
    if args.stage == "link-sites":
        done = stages.link_sites(targets, source, config)
    elif args.stage == "enrich-names":
        done = stages.enrich_names(targets, source, config, dialect.sep)
    else:
        done = stages.fill_coordinates(targets, source, config)
    helpers = [c for c in ("rid", "name", "key", "filled") if c in done.enriched.columns and c not in targets.columns or c == "rid"]
    write_dialect(schema.without_helpers(done.enriched.orderBy("rid").drop(*helpers)), str(out / "enriched.csv"), dialect)
    for name in ("matched", "unmatched", "uncovered", "statistics"):
        if (report := getattr(done, name)) is not None:
            write_csv(report, str(out / f"{name}.csv"), dialect.sep)
    if done.different is not None:
        places = source.select(F.col("rid").alias("left_index"), *(F.col(c) for c in ("lon", "lat")))
        write_geojson(features(schema.ensure_coordinates(done.different.join(places, "left_index"))), str(out / "different_names.geojson"), pretty=True)


def _map(spark: SparkSession, args: argparse.Namespace, out: Path) -> None:
    stations, _ = _table(spark, args.targets)
    stations = schema.ensure_coordinates(stations)
    name, voltage = schema.name_column(stations.columns, schema.TARGET_NAMES), schema.voltage_column(stations.columns)
    if voltage is None:
        voltage, stations = "voltage", stations.withColumn("voltage", F.lit(None).cast("string"))
    e = written(_elements(spark, args, http.lines_query(args.country)).select(F.explode("elements").alias("e")), "elements")
    ways = e.where("e.type = 'way'").select(F.col("e.id").alias("way_id"), "e.nodes", F.col("e.tags")["voltage"].alias("voltage"))
    nodes = e.where("e.type = 'node'").select(F.col("e.id").alias("node_id"), "e.lat", "e.lon")
    points, lines, colours = stages.map_rows(stations, ways, nodes, name, voltage, {"Name": name, "Voltage": voltage})
    write_map(points, lines, colours, str(out / "map.html"))


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark, out = session(), Path(args.out)
    ship(spark)
    http.register(spark)
    out.mkdir(parents=True, exist_ok=True)
    if args.stage == "workbook":
        targets, _ = _table(spark, args.targets)
        write_csv(stages.workbook(targets).orderBy("rid").drop("rid"), str(out / "workbook.csv"), ";", True, "nonnumeric")
    else:
        {"map-sites": _map_sites, "markers": _markers, "service": _service, "map": _map}.get(args.stage, _link)(spark, args, out)


if __name__ == "__main__":
    main()
