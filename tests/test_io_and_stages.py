"""Readers, exporters, services on a local stub, and the stages from end to end."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F
from sitelace import cli
from sitelace.config import MatchConfig
from sitelace.operators import semistructured
from sitelace.operators.semistructured import ELEMENT
from sitelace.plans import schema, stages
from sitelace.sinks import export
from sitelace.sources import files, http
from sitelace.streaming.refresh import drain, refresh


class Stub(BaseHTTPRequestHandler):
    fails = {"n": 0}

    def _say(self, status, body):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def do_GET(self):
        path, q = urlparse(self.path).path, parse_qs(urlparse(self.path).query)
        if path == "/bad":
            return self._say(500, {})
        if "returnIdsOnly" in q:
            if Stub.fails["n"] < 2:
                Stub.fails["n"] += 1
                return self._say(503, {})
            return self._say(200, {"objectIds": [5, 3, 1, 4, 2]})
        if "objectIds" in q:
            return self._say(200, {"features": [{"properties": {"nm": f"s{i}"}, "geometry": {"type": "Point", "coordinates": [int(i), 1.5]}} for i in q["objectIds"][0].split(",")]})
        return self._say(200, {"data": [{"lat": 1, "lon": 2, "elementName": "Alfa"}]})

    def do_POST(self):
        self._say(200, {"elements": [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"name": "Alfa"}}]})

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_services(spark, url):
    http.register(spark)
    rows = spark.read.format("feature_service").option("url", url).option("page", 2).option("backoff", 0.01).load()
    flat = stages.service(rows, {"nm": "nombre_subestacion"})
    assert sorted(r["nombre_subestacion"] for r in flat.collect()) == ["s1", "s2", "s3", "s4", "s5"]
    payload = spark.read.format("json_endpoint").option("url", url + "/markers?x=1").option("header.Accept", "*/*").load()
    (row,) = stages.markers(payload).collect()
    assert (row["props"]["elementName"], row["lat"], row["source"]) == ("Alfa", 1.0, "markers")
    answer = spark.read.format("map_elements").option("endpoints", url).option("query", http.substations_query(" co ")).load()
    parsed = answer.select(F.from_json("payload", f"elements array<{ELEMENT}>").alias("p")).select("p.elements")
    assert stages.map_sites(parsed)[1].first()["name_clean"] == "Alfa"


def test_failing_endpoints_do_not_stop_others(spark, url, capsys):
    http.register(spark)
    seen = []

    def job(u):
        seen.append(spark.read.format("json_endpoint").option("url", u).option("pause", 0).load().count())

    assert list(http.each_endpoint([url + "/bad", url + "/ok"], job)) == [url + "/bad"] and seen == [1]
    assert "/bad" in capsys.readouterr().err


class Layer(BaseHTTPRequestHandler):
    """A paged service that counts: what was asked for, and how many requests were open at a time."""

    ids: list[int] = []
    broken: set[int] = set()
    asked: list[int] = []
    most = now = 0
    lock = threading.Lock()

    def do_GET(self):
        q = parse_qs(urlparse(self.path).query)
        if "returnIdsOnly" in q:
            return self._say(200, {"objectIds": Layer.ids})
        ids = [int(i) for i in q["objectIds"][0].split(",")]
        with Layer.lock:
            Layer.now += 1
            Layer.most = max(Layer.most, Layer.now)
            Layer.asked += ids
        time.sleep(0.05)
        with Layer.lock:
            Layer.now -= 1
        if Layer.broken & set(ids):
            return self._say(200, {"error": {"code": 400}})
        self._say(200, {"features": [{"properties": {"id": i}} for i in ids]})

    def _say(self, status, body):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def layer():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Layer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Layer.ids, Layer.broken, Layer.asked, Layer.most = [], set(), [], 0
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_paged_service_sees_few_requests_at_a_time(spark, layer):
    http.register(spark)
    Layer.ids = list(range(20, 0, -1))
    service = spark.read.format("feature_service").option("url", layer).option("page", 2).option("at_once", 2).option("pause", 0)
    assert service.load().count() == 20 and sorted(Layer.asked) == list(range(1, 21)) and Layer.most <= 2
    Layer.ids = []
    with pytest.raises(Exception, match="no objects"):
        service.load().count()


def test_paged_stream_fetches_nothing_twice(spark, layer, tmp_path):
    http.register(spark)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        drain(spark.readStream.format("feature_service").option("url", layer).option("page", 2).option("at_once", 2).load(), lambda df: df, out, check)
        return sorted(json.loads(r["feature"])["properties"]["id"] for r in spark.read.parquet(out).collect())

    Layer.ids = [5, 3, 1, 4, 2]
    assert run() == [1, 2, 3, 4, 5]
    Layer.ids = [*range(1, 16)]
    Layer.broken = {13}
    with pytest.raises(Exception, match="400"):
        run()
    before = list(Layer.asked)
    assert sorted(set(before)) == [*range(1, 14)] + [14] * (14 in before) + [15] * (15 in before)
    assert all(before.count(i) == 1 for i in range(1, 10))
    Layer.broken = set()
    assert run() == [*range(1, 16)]
    assert all(Layer.asked.count(i) == 1 for i in range(1, 10)) and Layer.most <= 2
    n = len(Layer.asked)
    assert run() == [*range(1, 16)] and len(Layer.asked) == n


def test_endpoints_in_partitions(spark, url):
    http.register(spark)
    urls = f"{url}/bad {url}/ok\n{url}/also nothing"
    rows = spark.read.format("json_endpoints").option("urls", urls).option("pause", 0).load()
    assert rows.rdd.getNumPartitions() == 4
    good, bad = semistructured.split_payloads(rows)
    assert sorted(r["url"] for r in good.collect()) == [f"{url}/also", f"{url}/ok"]
    assert {r["url"]: "500" in r["reason"] for r in bad.collect()} == {f"{url}/bad": True, "nothing": False}
    assert sorted(r["source"] for r in stages.markers(good).collect()) == ["also", "ok"]


def test_rejected_payloads(spark):
    df = spark.createDataFrame([("{}",), ("null",), (" ",), (None,), ("{",), ("NaN x",)], "payload string")
    good, bad = semistructured.split_payloads(df)
    assert {r["payload"] for r in good.collect()} == {"{}", "null"}
    assert {r["payload"]: r["reason"] for r in bad.collect()} == {" ": "no payload", None: "no payload", "{": "not JSON", "NaN x": "not JSON"}


def test_rounds_of_retries():
    calls, naps = [], []

    def get(u, *_):
        calls.append(u)
        raise OSError("no")

    with pytest.raises(RuntimeError):
        http.post_in_turn(["a", "b"], "q", get=get, sleep=naps.append)
    assert calls == ["a", "b"] * 4 and naps == [2.0, 2.0, 4.0, 4.0, 6.0, 6.0, 8.0, 8.0]
    assert [list(c) for c in http.chunked([1, 2, 3], 2)] == [[1, 2], [3]]


def test_csv_round_trip(spark, tmp_path):
    raw = '﻿Nombre;lat\r\n"a;b\nc";1,5\r\nshort\r\ntoo;many;cells\r\n'
    (tmp_path / "in.csv").write_bytes(raw.encode())
    df, dialect = files.read_sniffed(spark, str(tmp_path / "in.csv"))
    assert dialect.sep == ";" and dialect.newline == "\r\n" and df.columns == ["Nombre", "lat"]
    rows = [tuple(r) for r in df.collect()]
    assert ("a;b\nc", "1,5") in rows and ("short", None) in rows and len(rows) == 2
    assert export.write_dialect(df, str(tmp_path / "out.csv"), dialect) == 2
    back = (tmp_path / "out.csv").read_bytes()
    assert back.startswith("﻿".encode()) and b"\r\n" in back and '"a;b\nc";1,5'.encode() in back


def test_latin_1_and_defaults():
    assert files.sniff("a\tñ\n1\t2\n".encode("latin-1")).encoding == "latin-1"
    assert files.sniff(b"abc\n").sep == "," and files.sniff(b"").newline == "\n"


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("x", None, 1.5, 2.5), ("ñ", float("nan"), None, 2.0)], "b string, a double, lon double, lat double")
    export.write_csv(df, str(tmp_path / "a.csv"), ";", quoting="nonnumeric")
    assert (tmp_path / "a.csv").read_text(encoding="utf-8-sig").splitlines()[1] == '"x";"";1.5;2.5'
    assert export.write_geojson(export.features(df), str(tmp_path / "a.geojson"), sort_keys=True, crs=True, newline=True) == 2
    got = json.loads((tmp_path / "a.geojson").read_text())
    assert got["type"] == "FeatureCollection" and got["features"][0]["geometry"]["coordinates"] == [1.5, 2.5]
    assert got["features"][1]["properties"] == {"b": "ñ", "a": None} and got["features"][1]["geometry"] is None
    for rows in (df, df.limit(0)):
        for pretty in (True, False):
            for sort_keys in (True, False):
                export.write_geojson(export.features(rows), str(tmp_path / "b.geojson"), sort_keys, pretty, crs=sort_keys)
                said = (tmp_path / "b.geojson").read_text(encoding="utf-8")
                assert said == json.dumps(json.loads(said), ensure_ascii=False, indent=2 if pretty else None)
                assert list(json.loads(said)) == (["crs", "features", "type"] if sort_keys else ["type", "features"])


def parts(folder):
    return b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))


@pytest.mark.parametrize("quoting", ["minimal", "nonnumeric", "all"])
@pytest.mark.parametrize(("sep", "newline"), [(";", "\n"), ("|", "\r\n")])
def test_parts_are_the_file(spark, tmp_path, quoting, sep, newline):
    rows = [("x", None, 1.5, True, 3), ('a "b"', "c;d|e", float("nan"), None, -1), ("l\nm\r", "", 2.25, False, None), (None, " ", None, True, 0)]
    df = spark.createDataFrame(rows, "`a;b` string, b string, c double, d boolean, e bigint").repartitionByRange(3, "c").sortWithinPartitions("c")
    for name, table in (("rows", df), ("none", df.limit(0)), ("one", df.select("b"))):
        export.write_csv(table, str(tmp_path / f"{name}.csv"), sep, True, quoting, newline)
        export.write_csv_parts(table, str(tmp_path / name), sep, True, quoting, newline)
        assert parts(tmp_path / name) == (tmp_path / f"{name}.csv").read_bytes()
    assert len(list((tmp_path / "rows").glob("part-*"))) > 2
    with pytest.raises(ValueError):
        export.csv_lines(df, quoting="some")


def test_feature_parts(spark, tmp_path):
    df = spark.createDataFrame([("x\ny", 1.5, 2.5), (None, None, 1.0)], "b string, lon double, lat double").repartition(2)
    export.write_feature_parts(export.features(df), str(tmp_path / "f"))
    said = [json.loads(x) for x in parts(tmp_path / "f").decode().splitlines()]
    assert sorted(str(x["properties"]["b"]) for x in said) == ["None", "x\ny"]


def test_union_of_keys(spark, tmp_path):
    payload = '[{"b": 1, "lat": "1,5", "lon": 2}, {"a": "x;y", "b": 2}]'
    rows = semistructured.flatten_features(spark.createDataFrame([(payload,), ("no JSON {",), (None,)], "payload string"), "payload")
    assert rows.count() == 2
    export.write_union_csv(rows, str(tmp_path / "u.csv"))
    lines = (tmp_path / "u.csv").read_text(encoding="utf-8-sig").splitlines()
    assert lines[0].startswith("b,a,geom_from") and lines[1].startswith("1,,") and lines[2].startswith("2,x;y,")


def elements(spark):
    rows = [
        ("node", 1, 4.5, -74.0, None, None, {"name": "Torca 115 kV", "voltage": "115000"}, None),
        ("way", 2, None, None, (4.5001, -74.0), [1], {"name": "Torca", "operator": "op"}, "2024-01-02T00:00:00Z"),
        ("way", 3, 5.5, None, (6.0, -75.0), [1], {"name": "nan"}, "bad"),
        ("node", 4, None, None, None, None, None, None),
    ]
    return spark.createDataFrame([(rows,)], f"elements array<{ELEMENT}>")


def test_stage_1(spark):
    all_sites, named, unnamed = stages.map_sites(elements(spark))
    got = {r["element_id"]: r for r in all_sites.collect()}
    assert set(got) == {1, 3, 4} and got[1]["operator_variants"] == "op" and got[1]["name_clean_variants"] == "Torca; Torca 115 kV"
    assert got[3]["lat"] == 6.0 and named.count() == 1 and unnamed.count() == 2


def linked(spark):
    targets = spark.createDataFrame([(0, "Torca 115 kV", 4.5, -74.0, "x"), (1, "San Carlos", 6.0, -75.0, "y"), (2, "Guavio Central Nueva", 1.0, -70.0, "z")], "rid bigint, elementName string, lat double, lon double, other string")
    source = spark.createDataFrame([(0, "Torca", "4,5001", "-74.0", "115"), (1, "SAN CARLOS 230kV", "7", "-76", "230"), (2, "Lejos", "10", "-60", "34.5"), (3, "Guavio Central Nueba", "3", "-71", None)], "rid bigint, nombre_subestacion string, lat string, lon string, tension_kV string")
    return targets, source


def test_stage_5(spark):
    done = stages.link_sites(*linked(spark))
    rows = {r["elementName"]: r for r in done.enriched.collect()}
    assert rows["Torca 115 kV"]["match_method"] == "location" and rows["Torca 115 kV"]["lat"] == 4.5001
    assert rows["San Carlos"]["match_method"] == "name_exact" and rows["San Carlos"]["lat"] == 7.0
    assert rows["Lejos"]["match_method"] == "left_only_append" and rows["Lejos"]["voltage"] == "34.5" and rows["Lejos"]["rid"] is None
    assert rows["Guavio Central Nueva"]["match_method"] == "name_fuzzy"
    assert done.matched.count() == 3 and [r["reason"] for r in done.unmatched.collect()] == ["no_close_match"]


def test_stage_6(spark):
    sources, _ = linked(spark)
    targets = spark.createDataFrame([(0, "torca", "k"), (1, "nothing like it", "k"), (2, None, "k")], "rid bigint, Nombre string, other string")
    done = stages.enrich_names(targets, sources, sep=";")
    rows = {r["rid"]: r for r in done.enriched.collect()}
    assert (rows[0]["lon"], rows[0]["lat"], rows[0]["filled"]) == ("-74,000000", "4,500000", True) and rows[1]["lon"] is None
    assert {r["left_index"] for r in done.unmatched.collect()} == {1, 2}
    assert {r["right_key"] for r in done.uncovered.collect()} == {"san carlos", "guavio central nueva"}


def test_stage_7(spark):
    targets = spark.createDataFrame([(0, "torca", None, None), (1, "otra", "5", "-70"), (2, "guavio", None, None)], "rid bigint, Nombre string, lat string, lon string")
    source = spark.createDataFrame([(0, "Torca", 4.5, -74.0, "115000"), (1, "Nada Igual", 5.0, -70.0, "230000"), (2, "Sola", 9.0, -60.0, "500000")], "rid bigint, name_clean string, lat double, lon double, voltage string")
    done = stages.fill_coordinates(targets, source)
    rows = {r["rid"]: r for r in done.enriched.collect()}
    assert set(rows) == {0, 1} and rows[0]["lat"] == 4.5 and rows[0]["match_method"] == "name_exact" and rows[1]["match_method"] == "location"
    (s,) = done.statistics.collect()
    assert (s["total_keys"], s["matched_keys"], s["high_kv_keys"], s["missing_high_kv"]) == (3, 2, 3, 1)
    assert [r["right_name"] for r in done.different.collect()] == ["otra"]


def test_stage_8(spark, tmp_path):
    stations = spark.createDataFrame([("A", "4.5", "-74", "115"), ("B", "x", "-74", "34.5"), ("C", "4", "-73", "-")], "Nombre string, lat string, lon string, kv string")
    ways = spark.createDataFrame([(1, [10, 11, 99], "500000"), (2, [99], "230000")], "way_id bigint, nodes array<bigint>, voltage string")
    nodes = spark.createDataFrame([(10, 1.0, 2.0), (11, 3.0, 4.0)], "node_id bigint, lat double, lon double")
    points, lines, colours = stages.map_rows(stations, ways, nodes, "Nombre", "kv", {"Name": "Nombre", "kV": "kv"})
    assert {r["tooltip"]: r["colour"] for r in points.collect()} == {"A": "#2979FF", "C": "#BDBDBD"}
    assert [(r["weight"], [tuple(p) for p in r["path"]]) for r in lines.collect()] == [(4.5, [(1.0, 2.0), (3.0, 4.0)])]
    assert {r["kv"] for r in colours.collect()} == {115, 230, 500}
    export.write_map(points, lines, colours, str(tmp_path / "map.html"))
    page = (tmp_path / "map.html").read_text()
    assert page.count("circleMarker") == 2 and page.count("polyline") == 1 and "230 kV" in page


def test_headers():
    assert schema.voltage_column(["Nombre", "Nivel de Tensión", "kv"]) == "Nivel de Tensión" and schema.voltage_column(["a"]) is None
    assert schema.coordinate_columns(["longitude", "lat"]) == ("longitude", "lat")
    with pytest.raises(ValueError):
        schema.coordinate_columns(["lon"])
    with pytest.raises(ValueError):
        schema.name_column(["x"])


def test_helpers_and_defaults(spark):
    df = spark.createDataFrame([(1, 2)], "a int, __key int")
    assert schema.without_helpers(schema.with_defaults(df, lon="double")).columns == ["a", "lon"]
    assert MatchConfig().override(radius_m=None, fuzzy_threshold=70).fuzzy_threshold == 70


def test_cli(spark, tmp_path):
    (tmp_path / "t.csv").write_text("elementName,lat,lon\nTorca 115 kV,4.5,-74.0\nSan Carlos,6.0,-75.0\n")
    (tmp_path / "s.csv").write_text("nombre_subestacion;lat;lon;tension_kV\nTorca;4,5001;-74;115\nLejos;10;-60;34.5\n")
    cli.main(["link-sites", "--targets", str(tmp_path / "t.csv"), "--source", str(tmp_path / "s.csv"), "--out", str(tmp_path / "out"), "--radius-m", "3000"])
    text = (tmp_path / "out/enriched.csv").read_text(encoding="utf-8-sig")
    assert "left_only_append" in text and (tmp_path / "out/matched.csv").exists()


def test_cli_map_sites_and_map(spark, tmp_path):
    said = [
        {"type": "node", "id": 1, "lat": 4.5, "lon": -74.0, "tags": {"name": "Torca", "voltage": "115000"}},
        {"type": "way", "id": 2, "center": {"lat": 6.0, "lon": -75.0}, "nodes": [1, 3], "tags": {"voltage": "500000"}},
        {"type": "node", "id": 3, "lat": 4.6, "lon": -74.1},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"elements": said}))
    cli.main(["map-sites", "--payload", str(tmp_path / "a.json"), "--out", str(tmp_path / "one")])
    assert "Torca" in (tmp_path / "one/named.csv").read_text(encoding="utf-8-sig") and len((tmp_path / "one/sites.csv").read_text().splitlines()) == 4
    (tmp_path / "t.csv").write_text("Nombre;Latitud;Longitud;Tension\nTorca;4,5;-74;115\nNada;;;\n".replace("Latitud", "lat").replace("Longitud", "lon"))
    cli.main(["map", "--targets", str(tmp_path / "t.csv"), "--payload", str(tmp_path / "a.json"), "--out", str(tmp_path / "eight")])
    page = (tmp_path / "eight/map.html").read_text()
    assert page.count("circleMarker") == 1 and page.count("polyline") == 1 and "500 kV" in page
    (tmp_path / "b.json").write_text("<html>")
    with pytest.raises(SystemExit, match="not JSON"):
        cli.main(["map-sites", "--payload", str(tmp_path / "b.json"), "--out", str(tmp_path / "two")])
    with pytest.raises(SystemExit):
        cli.main(["map-sites", "--out", str(tmp_path / "two")])


def test_cli_markers_and_service(spark, url, layer, tmp_path):
    cli.main(["markers", "--urls", f"{url}/ok", f"{url}/bad", "--header", "Accept=*/*", "--out", str(tmp_path)])
    assert "Alfa" in (tmp_path / "ok.csv").read_text(encoding="utf-8-sig")
    assert json.loads((tmp_path / "ok.geojson").read_text())["features"][0]["geometry"]["coordinates"] == [2.0, 1.0]
    assert "/bad" in (tmp_path / "rejected.csv").read_text(encoding="utf-8-sig")
    Layer.ids = [2, 1, 3]
    cli.main(["service", "--url", layer, "--attribute", "id=code", "--name", "code", "--out", str(tmp_path)])
    assert len((tmp_path / "service.csv").read_text().splitlines()) == 4 and len(json.loads((tmp_path / "service.geojson").read_text())["features"]) == 3
    with pytest.raises(SystemExit):
        cli.main(["service", "--url", layer, "--attribute", "id", "--out", str(tmp_path)])


def test_refresh(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    refresh(stream, lambda df: df.where("id > 1"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
