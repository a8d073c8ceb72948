"""Exporters (SNK-01 to 10).  `write_csv` and the like stream rows to one file of a person's size, partition by partition, in
order; `write_csv_parts` and `write_feature_parts` write large tables from all tasks at once."""

from __future__ import annotations

import csv
import html
import io
import json
import math
import re
from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.semistructured import header_keys, wide
from ..sources.files import Dialect

BOM = "﻿"
#: Fixed value: how the files name their reference system.
CRS = {"type": "name", "properties": {"name": "EPSG:4326"}}


def _blank(v) -> object:
    return "" if v is None or isinstance(v, float) and math.isnan(v) else v


def write_csv(df: DataFrame, path: str, sep: str = ",", bom: bool = True, quoting: str = "minimal", newline: str = "\n", quote: str = '"', encoding: str = "utf-8") -> int:
    """One file; quoting: minimal, nonnumeric or all.  Returns the number of rows."""
    kinds = {"minimal": csv.QUOTE_MINIMAL, "nonnumeric": csv.QUOTE_NONNUMERIC, "all": csv.QUOTE_ALL}
    n = 0
    with open(path, "w", encoding=encoding, newline="") as f:
        if bom:
            f.write(BOM)
        out = csv.writer(f, delimiter=sep, quoting=kinds[quoting], lineterminator=newline, quotechar=quote)
        out.writerow(df.columns)
        for row in df.toLocalIterator(prefetchPartitions=True):
            out.writerow([_blank(v) for v in row])
            n += 1
    return n


def csv_lines(df: DataFrame, sep: str = ",", quoting: str = "minimal", quote: str = '"', newline: str = "\n") -> DataFrame:
    """(line): each row as a record of `write_csv`, in column expressions.  Null and NaN are empty; numbers are Spark's text of
    them (very large and very small ones as 1.0E20); columns must cast to text."""
    if quoting not in ("minimal", "nonnumeric", "all"):
        raise ValueError(f"unknown quoting {quoting}")
    special = "[" + "".join(re.escape(c) for c in dict.fromkeys((sep, quote, "\r", "\n", *newline))) + "]"

    def cell(name: str, kind: str) -> Column:
        c = F.col("`" + name.replace("`", "``") + "`")
        number = kind in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
        text = F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string")
        if kind in ("float", "double"):
            text = F.when(~F.isnan(c), text)
        quoted = F.concat(F.lit(quote), F.replace(F.coalesce(text, F.lit("")), F.lit(quote), F.lit(quote * 2)), F.lit(quote))
        if quoting == "all":
            return quoted
        if quoting == "nonnumeric":
            return F.coalesce(text, quoted) if number else quoted
        needs = text.rlike(special)
        if len(df.columns) == 1:  # an empty line would be no record
            needs = needs | text.isNull() | (text == "")
        return F.when(needs, quoted).otherwise(F.coalesce(text, F.lit("")))

    return df.select(F.concat_ws(sep, *(cell(n, k) for n, k in df.dtypes)).alias("line"))


def write_csv_parts(df: DataFrame, folder: str, sep: str = ",", bom: bool = True, quoting: str = "minimal", newline: str = "\n", quote: str = '"') -> None:
    """A folder in which every task writes its own part, UTF-8, by Spark's commit protocol.  The first part holds the header
    alone (and the byte order mark), so the parts one after the other are the file that `write_csv` gives; of an empty
    table it is the only one with content."""
    names = io.StringIO()
    kinds = {"minimal": csv.QUOTE_MINIMAL, "nonnumeric": csv.QUOTE_NONNUMERIC, "all": csv.QUOTE_ALL}
    csv.writer(names, delimiter=sep, quoting=kinds[quoting], lineterminator="", quotechar=quote).writerow(df.columns)
    head = df.sparkSession.range(0, 1, 1, 1).select(F.lit((BOM if bom else "") + names.getvalue()).alias("line"))
    head.unionAll(csv_lines(df, sep, quoting, quote, newline)).write.option("lineSep", newline).text(folder)


def write_feature_parts(feature_rows: DataFrame, folder: str) -> None:
    """A folder of parts with one GeoJSON feature a line (text sequences without a collection around them); feature_rows as
    of `features`."""
    feature_rows.select("feature").write.text(folder)


def write_dialect(df: DataFrame, path: str, dialect: Dialect) -> int:
    """In the dialect that a table was read in; plain UTF-8 gets a byte order mark."""
    plain = dialect.encoding.lower().replace("_", "-") in ("utf-8", "utf-8-sig")
    return write_csv(df, path, dialect.sep, plain, "minimal", dialect.newline, dialect.quote, "utf-8" if plain else dialect.encoding)


def features(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(feature): GeoJSON text of each row; other columns are properties, null and NaN as null."""
    others = [c for c in df.columns if c not in (lon, lat)]
    kinds = dict(df.dtypes)
    value = lambda c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if kinds[c] in ("double", "float") else F.col(f"`{c}`")
    geometry = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    whole = F.struct(F.lit("Feature").alias("type"), F.struct(*map(value, others)).alias("properties") if others else F.create_map().alias("properties"), geometry.alias("geometry"))
    return df.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("feature"))


def write_geojson(feature_rows: DataFrame, path: str, sort_keys: bool = False, pretty: bool = False, crs: bool = False, newline: bool = False) -> int:
    """One FeatureCollection; feature_rows: (feature), GeoJSON text.  Members are sorted, or `type`, `features`, `crs`; pretty:
    the whole file is indented by two."""
    said = partial(json.dumps, ensure_ascii=False, sort_keys=sort_keys, indent=2 if pretty else None)
    # The collection without its features tells what stands before and after them.
    around = {"type": "FeatureCollection", "features": []} | ({"crs": CRS} if crs else {})
    head, tail = said(around).split('"features": []')
    inner, outer = ("\n    ", "\n  ") if pretty else ("", "")
    n = 0
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        f.write(f'{head}"features": [')
        for row in feature_rows.toLocalIterator(prefetchPartitions=True):
            text = said(json.loads(row["feature"]))
            f.write((("," if pretty else ", ") if n else "") + inner + text.replace("\n", inner))
            n += 1
        f.write((outer if n else "") + f"]{tail}" + ("\n" if newline else ""))
    return n


def write_union_csv(features: DataFrame, path: str, order: tuple[str, ...] = ("place",)) -> int:
    """Flattened features with a column for each property that any of them has, in order of first appearance (SNK-04)."""
    return write_csv(wide(features.orderBy(*order), header_keys(features, order)), path)


def _markers(rows: Iterator) -> Iterator[str]:
    for r in rows:
        yield f"L.circleMarker([{r['lat']},{r['lon']}],{{radius:5,color:{json.dumps(r['colour'])},fillOpacity:0.9}}).bindTooltip({json.dumps(html.escape(r['tooltip'] or ''))}).bindPopup({json.dumps(r['popup'] or '')}).addTo(m);"


def _lines(rows: Iterator) -> Iterator[str]:
    for r in rows:
        yield f"L.polyline({json.dumps([[p['lat'], p['lon']] for p in r['path']])},{{color:{json.dumps(r['colour'])},weight:{r['weight']}}}).bindTooltip({json.dumps(html.escape(r['tooltip'] or ''))}).addTo(m);"


def write_map(markers: DataFrame, lines: DataFrame | None, palette: DataFrame, path: str, zoom: int = 6) -> None:
    """An HTML map from render-ready rows: markers (lat, lon, colour, tooltip, popup), lines (path, colour, weight, tooltip).

    The page asks for the Leaflet script when it is opened; writing it needs no network."""
    centre = markers.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).first()
    legend = "".join(f'<div><span style="color:{r["colour"]}">&#9632;</span> {r["kv"]} kV</div>' for r in palette.orderBy("kv").collect())
    with open(path, "w", encoding="utf-8") as f:
        f.write(
            '<!doctype html><html><head><meta charset="utf-8"><link rel="stylesheet" href="https://unpkg.com/leaflet/dist/leaflet.css"><script src="https://unpkg.com/leaflet/dist/leaflet.js"></script>'
            "<style>html,body,#m{height:100%;margin:0}#legend{position:fixed;bottom:20px;left:20px;z-index:9999;background:#000d;color:#fff;padding:10px}</style></head>"
            f'<body><div id="m"></div><div id="legend"><b>Voltage</b>{legend}</div><script>var m=L.map("m",{{preferCanvas:true}}).setView([{centre["lat"] or 0},{centre["lon"] or 0}],{zoom});'
            'L.tileLayer("https://tile.openstreetmap.org/{z}/{x}/{y}.png").addTo(m);\n'
        )
        for line in _lines(lines.toLocalIterator()) if lines is not None else ():
            f.write(line + "\n")
        for line in _markers(markers.toLocalIterator()):
            f.write(line + "\n")
        f.write("</script></body></html>\n")
