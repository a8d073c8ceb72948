"""Operators against plain models on random rows, and the shape of their plans."""

import math
import random

import pytest
from pyspark.sql import functions as F
from sitelace.config import MatchConfig
from sitelace.functions.fuzzy import score_keys
from sitelace.operators import alike, cascade, cluster, fill, join, nearest, palette, reports, semistructured
from sitelace.session import with_row_id

ROW = "rid bigint, lat double, lon double, name string, key string"


def meters(p, q):
    a, b = math.radians(p[0]), math.radians(q[0])
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(min(1, h)), math.sqrt(max(0, 1 - h)))


def places(seed, n, where="city"):
    r = random.Random(seed)
    spot = {
        "city": lambda: (4.5 + r.random() * 0.2, -74 + r.random() * 0.2),
        "dateline": lambda: (r.uniform(-1, 1), (179.5 + r.random() + 180) % 360 - 180),
        "pole": lambda: (r.uniform(88.5, 90), r.uniform(-180, 180)),
        "globe": lambda: (r.uniform(-90, 90), r.uniform(-180, 180)),
    }[where]
    rows = []
    for i in range(n):
        lat, lon = rows[-1][1:3] if i % 9 == 8 else spot()
        if i % 10 == 3:
            lat = None
        rows.append((i, lat, lon, r.choice(["alfa uno", "beta dos", "gama tres", "delta", None, ""]), r.choice(["k1", "k2", "k3", "", None])))
    return rows


@pytest.mark.parametrize(("where", "radius"), [("city", 3000.0), ("city", 0.0), ("dateline", 40_000.0), ("pole", 60_000.0), ("globe", 2_000_000.0), ("globe", 15_000_000.0)])
def test_grid_finds_all_pairs(spark, where, radius):
    rows = places(1, 120, where)
    spots = join.points(spark.createDataFrame(rows, ROW), "l")
    other = join.points(spark.createDataFrame(rows, ROW), "r")
    got = {(r["l_rid"], r["r_rid"]) for r in join.radius_pairs(spots, other, radius).collect()}
    first = {}
    for i, lat, lon, *_ in rows:
        if lat is not None:
            first.setdefault((lat, lon), i)
    want = {(i, j) for p, i in first.items() for q, j in first.items() if meters(p, q) <= radius}
    sure = {(i, j) for p, i in first.items() for q, j in first.items() if meters(p, q) <= radius - 1e-3}
    assert sure <= got <= want | got and not got - {(i, j) for p, i in first.items() for q, j in first.items() if meters(p, q) <= radius + 1e-3}


def test_no_nested_loops(spark):
    a = spark.createDataFrame(places(1, 50), ROW)
    for df in (join.nearest_within(a, a, 3000.0), alike.fuzzy_best(a, a, threshold=65)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def crowd(seed, n):
    """Half of the points within some hundred metres, the others scattered around; some share a spot."""
    r = random.Random(seed)
    rows = [(i, 4.5 + r.gauss(0, 0.0005 if i % 2 else 0.1), -74 + r.gauss(0, 0.0005 if i % 2 else 0.1), None, None) for i in range(n)]
    return rows + [(n + i, *rows[i][1:]) for i in range(20)]


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_within_on_dense_ground(spark, monkeypatch, k):
    monkeypatch.setattr(join, "CROWD", 16)
    monkeypatch.setattr(join, "BLOCK", 32)
    left, right = crowd(5, 300), crowd(6, 260)
    a, b = spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW)
    found = join.nearest_within(a, b, 3000.0).withColumn("place", F.lit(1)) if k == 1 else join.knn(a, b, k, 3000.0)
    got = {(r["l_rid"], r["place"]): (round(r["d"], 3), r["r_rid"]) for r in found.collect()}
    want = {}
    for i, lat, lon, *_ in left:
        near = sorted((d, r[0]) for r in right if (d := meters((lat, lon), (r[1], r[2]))) <= 3000.0)[:k]
        want |= {(i, n): (round(d, 3), j) for n, (d, j) in enumerate(near, 1)}
    assert got.keys() == want.keys() and all(abs(got[x][0] - want[x][0]) <= 2e-3 for x in want)
    assert sum(got[x][1] != want[x][1] for x in want) <= 2  # rounding may swap equal distances


def test_crowded_cells_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(join, "BLOCK", 32)
    rows = spark.createDataFrame(crowd(7, 400), ROW)
    left, right = join.points(rows, "l"), join.points(rows, "r")
    got = join.radius_pairs(left, right, 3000.0)
    seen = [(r["l_rid"], r["r_rid"]) for r in got.collect()]
    at = {r["l_rid"]: (r["l_lat"], r["l_lon"]) for r in left.collect()}
    assert len(seen) == len(set(seen)) and set(seen) == {(i, j) for i in at for j in at if meters(at[i], at[j]) <= 3000.0}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "l_block" in plan and "r_block" in plan


def test_names_found_early_are_out_of_lower_thresholds(spark, monkeypatch):
    names = [(i, None, None, f"estacion {'abcdefghij'[i] * 4} numero {'qrstuvwxyz'[i] * 4}", None) for i in range(10)]
    lost = [(i, None, None, name[:2] + name[3:], None) for i, _, _, name, _ in names]
    seen, search = [], alike.likely_pairs

    def counted(a, b, threshold, of):
        seen.append((threshold, a.count()))
        return search(a, b, threshold, of)

    monkeypatch.setattr(alike, "likely_pairs", counted)
    got = alike.fuzzy_best(spark.createDataFrame(lost, ROW), spark.createDataFrame(names, ROW), threshold=85.0, backend="edits").collect()
    assert {r["l_rid"]: r["r_rid"] for r in got} == {i: i for i in range(10)}
    assert seen[0] == (95.0, 10) and seen[-1] == (85.0, 0)


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_within_lists_few_pairs(spark, k):
    left = [(i, 4.5 + i / 1e5, -74.0, None, None) for i in range(20)]
    right = [(i, 4.5 + i % 17 / 1e4, -74.0 - i / 1e5, None, None) for i in range(200)]
    a, b = (spark.createDataFrame(rows, ROW) for rows in (left, right))
    pairs = join._nearest_pairs(join.points(a, "l"), join.points(b, "r"), k, 9000.0).collect()
    assert len(pairs) <= 9 * k * len(left)
    for i, lat, lon, *_ in left:
        got = sorted((r["d"], r["r_rid"]) for r in pairs if r["l_lat"] == lat)[:k]
        assert [j for _, j in got] == [j for _, j in sorted((meters((lat, lon), q[1:3]), q[0]) for q in right)[:k]]


def test_nearest_unbounded(spark):
    left, right = places(2, 40, "globe"), places(3, 30, "globe")
    got = {r["l_rid"]: r["r_rid"] for r in join.nearest(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW)).collect()}
    for i, lat, lon, *_ in left:
        if lat is None:
            assert i not in got
        else:
            best = min((round(meters((lat, lon), (r[1], r[2])), 3), r[0]) for r in right if r[1] is not None)
            assert round(meters((lat, lon), right[got[i]][1:3]), 3) == best[0]
    nothing = join.nearest(spark.createDataFrame(left, ROW), spark.createDataFrame([], ROW)).collect()
    assert nothing and all(r["r_rid"] is None for r in nothing)


@pytest.mark.parametrize("k", [1, 4, 50])
def test_k_nearest_without_a_radius(spark, k):
    """At the poles, over the date line, on one spot, far away, and with more asked for than there is."""
    odd = [(89.9, 10.0), (-90.0, 0.0), (90.0, 77.0), (0.0, 180.0), (0.0, -180.0), (0.0, 179.9999), (71.0, 179.99), (95.0, 20.0), (5.0, 365.0)]
    r = random.Random(11)
    cluster_ = [(50 + r.random() / 1e4, 100 + r.random() / 1e4) for _ in range(25)] + [(50.0, 100.0)] * 6
    left = [(i, *p, None, None) for i, p in enumerate([*odd, (50.0, 100.0), (-33.0, -70.0), (None, 1.0), (math.nan, 2.0), (-33.0, -70.0)])]
    right = [(i, *p, None, None) for i, p in enumerate([*odd[::2], *cluster_, (1.0, None)])]
    got = {}
    for row in join.knn(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW), k).collect():
        got.setdefault(row["l_rid"], []).append((row["place"], row["r_rid"], row["d"]))
    held = [x for x in right if x[2] is not None]
    assert set(got) == {x[0] for x in left if x[1] is not None and not math.isnan(x[1])}
    for i, found in got.items():
        every = sorted((round(meters(left[i][1:3], x[1:3]), 4), x[0]) for x in held)[:k]
        assert len(found) == min(k, len(held)) and [p for p, *_ in sorted(found)] == list(range(1, len(found) + 1))
        assert [d for _, _, d in sorted(found)] == pytest.approx([d for d, _ in every], abs=0.05)


def near_model(left, right, k, within=math.inf):
    held = [x for x in right if x[1] is not None]
    found = {x[0]: sorted((round(meters(x[1:3], y[1:3]), 4), y[0]) for y in held) for x in left if x[1] is not None}
    return {i: [d for d, _ in every if d <= within][:k] for i, every in found.items()}


def distances(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r["l_rid"], r["place"])):
        got.setdefault(r["l_rid"], []).append(r["d"])
        assert r["place"] == len(got[r["l_rid"]])
    return got


def test_nearest_search_writes_few_rows(spark, monkeypatch):
    """What is written grows with the rows and with nodes of neighbours, not with the candidates of each point."""
    rows, write = [], nearest.written

    def counted(df, name):
        out = write(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(nearest, "written", counted)
    r = random.Random(21)
    left, right = ([(i, math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180), None, None) for i in range(700)] for _ in "ab")
    got = distances(join.knn(*(spark.createDataFrame(x, ROW) for x in (left, right)), 3).collect())
    assert sum(rows) < 4 * (len(left) + len(right))
    want = near_model(left, right, 3)
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], abs=0.05) for i in want)


def test_k_nearest_within_a_radius_writes_few_rows(spark, monkeypatch):
    """Dense ground within the radius costs boxes, not cells around each point, nor squares of each point level by level."""
    rows, write = [], nearest.written

    def counted(df, name):
        out = write(df, name)
        rows.append(out.count())
        return out

    for module in (join, nearest):
        monkeypatch.setattr(module, "written", counted)
    r = random.Random(27)
    left, right = ([(i, 60.01 + r.random() / 200, 100.01 + r.random() / 200, None, None) for i in range(600)] for _ in "ab")
    got = distances(join.knn(*(spark.createDataFrame(x, ROW) for x in (left, right)), 3, 20_000.0).collect())
    assert sum(rows) < 2 * (len(left) + len(right))
    want = near_model(left, right, 3, 20_000.0)
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], abs=0.05) for i in want)


@pytest.mark.parametrize(("k", "within"), [(1, None), (5, None), (3, 40_000.0)])
def test_nearest_search_through_many_levels(spark, monkeypatch, k, within):
    """Small nodes, so that both sides have many levels: a dense town, the globe, a far crowd, and few points against many."""
    for name, value in (("MEMBERS", 4), ("TOP", 3), ("PACK", 50), ("PACKED", 60)):
        monkeypatch.setattr(nearest, name, value)
    r = random.Random(22)
    town = [(i, 60 + r.random() / 1e3, 100 + r.random() / 1e3, None, None) for i in range(150)]
    right = town + [(1000 + i, *x[1:]) for i, x in enumerate(places(23, 40, "city"))]
    few = [(i, *x[1:]) for i, x in enumerate([*places(24, 40, "globe"), *places(25, 30, "city"), *[(0, 60 + r.random() / 1e3, 100 + r.random() / 1e2, None, None) for _ in range(20)]])]
    for left, other in ((few, right), (right, few)):
        got = distances(join.nearest_k(*(spark.createDataFrame(x, ROW) for x in (left, other)), k, within).collect())
        want = {i: d for i, d in near_model(left, other, k, within or math.inf).items() if d}
        assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], abs=0.05) for i in want)


def test_leaders_of_a_long_line_take_few_rounds(spark, monkeypatch):
    rounds = []
    write = cluster.written
    monkeypatch.setattr(cluster, "written", lambda df, name: rounds.append(name) or write(df, name))
    line = spark.range(2000).selectExpr("id AS rid", "0.0D AS lat", "id * 200 / 111194.9 AS lon")
    assert {r["leader"] - r["rid"] for r in cluster.leaders(line, 300.0).collect()} == {0, -1}
    assert rounds.count("decided") < 10
    monkeypatch.setattr(cluster, "TILE_SPOTS", 7)  # and in many tiles the same
    rows = places(12, 120)
    assert {r["rid"]: r["leader"] for r in cluster.leaders(spark.createDataFrame(rows, ROW), 4000.0).collect()} == model_leaders(rows, 4000.0)


def test_leaders_on_dense_ground(spark):
    r = random.Random(13)
    rows = [(i, 4 + r.random() / 500, -74 + r.random() / 500, None, None) for i in range(600)]
    assert {x["rid"]: x["leader"] for x in cluster.leaders(spark.createDataFrame(rows, ROW), 60.0).collect()} == model_leaders(rows, 60.0)


def model_cascade(left, right, config):
    out = {}
    for i, lat, lon, name, key in left:
        if lat is None:
            near = []
        else:
            near = [(d, r[0]) for r in right if r[1] is not None and (d := meters((lat, lon), (r[1], r[2]))) <= config.radius_m]
        if near:
            out[i] = (0, min(near, key=lambda x: (round(x[0], 6), x[1]))[1])
            continue
        same = [r[0] for r in right if key and r[4] == key]
        if same:
            out[i] = (1, min(same))
            continue
        scored = [(-score_keys(name, r[3]), r[0]) for r in right if name and r[3]]
        if scored and -min(scored)[0] >= config.fuzzy_threshold:
            out[i] = (2, min(scored)[1])
    return out


def test_cascade_reads_each_stage_once(spark, monkeypatch):
    """What a stage found is written, so later stages do not search again; the search by place keeps boxes, not crowds of cells."""
    names, write = [], nearest.written

    def named(df, name):
        names.append(name)
        return write(df, name)

    for module in (cascade, join, nearest):
        monkeypatch.setattr(module, "written", named)
    a, b = (spark.createDataFrame(places(seed, 60), ROW) for seed in (31, 32))
    config = MatchConfig(radius_m=3000.0, use_fuzzy=False)
    matches = cascade.cascade(a, b, config)
    assert names.count("stage") == 2 and names.count("pairs") <= 1
    assert "Generate" not in matches._jdf.queryExecution().optimizedPlan().toString()
    want = model_cascade(places(31, 60), places(32, 60), config)
    assert {r["l_rid"]: (r["stage"], r["r_rid"]) for r in matches.collect()} == {i: w for i, w in want.items() if w[0] < 2}


@pytest.mark.parametrize("seed", [5, 6])
def test_cascade_and_write_back(spark, seed):
    config = MatchConfig(radius_m=1500.0, fuzzy_threshold=80.0)
    left, right = places(seed, 60), places(seed + 10, 60)
    a, b = spark.createDataFrame(left, ROW).repartition(3), spark.createDataFrame(right, ROW).repartition(5)
    matches = cascade.cascade(a, b, config)
    got = {r["l_rid"]: (r["stage"], r["r_rid"]) for r in matches.collect()}
    want = model_cascade(left, right, config)
    assert got == want and {s for s, _ in want.values()} == {0, 1, 2}
    last, first = {}, {}
    for turn in sorted((s, i, j) for i, (s, j) in want.items()):
        last[turn[2]] = turn[1]
        first.setdefault(turn[2], turn[1])
    replaced = {r["rid"]: r for r in cascade.replace_coordinates(b, a, matches, config).collect()}
    filled = {r["rid"]: r for r in cascade.fill_coordinates(b, a, matches, config).collect()}
    for j, lat, lon, *_ in right:
        source = left[last[j]] if j in last else None
        assert (replaced[j]["lat"], replaced[j]["lon"]) == ((source[1], source[2]) if source else (lat, lon))
        assert replaced[j]["matched_name"] == (source[3] if source else None)
        giver = left[first[j]] if j in first and lat is None else None
        assert (filled[j]["lat"], filled[j]["lon"]) == ((giver[1], giver[2]) if giver else (lat, lon))
    rest = {r["left_index"] for r in reports.unmatched_sites(a, b, matches, config).collect()}
    assert rest | set(want) == {r[0] for r in left} and not rest & set(want)
    assert reports.matched(a, b, matches).count() == len(want)


def test_empty_sides(spark):
    none = spark.createDataFrame([], ROW)
    some = spark.createDataFrame(places(7, 10), ROW)
    config = MatchConfig()
    for a, b in ((none, some), (some, none), (none, none)):
        m = cascade.cascade(a, b, config)
        assert m.count() == 0 and reports.matched(a, b, m).count() == 0
        assert reports.unmatched_sites(a, b, m, config).count() == a.count()
        assert reports.coverage(b, m).first()["coverage_pct"] == 0


def model_leaders(rows, radius):
    leader = {}
    for i, lat, lon, *_ in rows:
        if i in leader:
            continue
        leader[i] = i
        if lat is not None:
            for j, la, lo, *_ in rows[i + 1 :]:
                if j not in leader and la is not None and meters((lat, lon), (la, lo)) <= radius:
                    leader[j] = i
    return leader


@pytest.mark.parametrize("radius", [300.0, 4000.0, 30_000.0])
def test_leaders(spark, radius):
    rows = places(8, 90)
    got = {r["rid"]: r["leader"] for r in cluster.leaders(spark.createDataFrame(rows, ROW), radius).collect()}
    assert got == model_leaders(rows, radius)


def test_leaders_do_not_chain(spark):
    at = [(i, 0.0, x / 111_194.9, None, None) for i, x in enumerate((0, 200, 400, 650))]
    assert {r["rid"]: r["leader"] for r in cluster.leaders(spark.createDataFrame(at, ROW), 300.0).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}


def test_fills(spark, monkeypatch):
    monkeypatch.setattr(fill, "BLOCK_ROWS", 7)
    r = random.Random(9)
    rows = [(i, r.choice([None, f"v{i}"]), r.choice([None, "g"])) for i in range(60)]
    df = spark.createDataFrame(rows, "rid bigint, v string, w string").repartition(4)
    got = {x["rid"]: x for x in fill.fill_forward(df, ["v"]).collect()}
    last = None
    for i, v, w in rows:
        last = v or last
        assert (got[i]["v"], got[i]["w"]) == (last, w)


def test_fills_within_groups_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(fill, "BLOCK_ROWS", 5)
    r = random.Random(10)
    rows = [(i, r.choice("aab") if r.random() < 0.9 else None, r.choice([None, None, f"v{i}"])) for i in range(90)]
    got = {x["rid"]: x["v"] for x in fill.fill_forward(spark.createDataFrame(rows, "rid bigint, g string, v string").repartition(4), ["v"], within=["g"]).collect()}
    last, want = {}, {}
    for i, g, v in rows:
        if g is not None:
            want[i] = last[g] = v or last.get(g)
    assert got == want


def test_workbook(spark):
    rows = [(0, "A", "1", " "), (1, "", None, "x"), (2, None, "-", ""), (3, "B", "", None)]
    got = fill.clean_workbook(spark.createDataFrame(rows, "rid bigint, Nombre string, kv string, note string"), "Nombre").orderBy("rid").collect()
    assert [tuple(r) for r in got] == [(0, "A", "1", "-"), (1, "A", "1", "x"), (2, "A", "-", "x"), (3, "B", "-", "-")]


def test_row_ids_are_dense_and_ordered(spark):
    xs = list(range(0, 500, 3))
    random.Random(1).shuffle(xs)
    df = with_row_id(spark.createDataFrame([(x,) for x in xs], "x int").repartition(6), ["x"])
    assert [(r["x"], r["rid"]) for r in df.orderBy("x").collect()] == [(x, i) for i, x in enumerate(sorted(xs))]
    assert with_row_id(spark.createDataFrame([], "x int"), ["x"]).count() == 0


def test_palette(spark):
    got = {r["kv"]: r["colour"] for r in palette.palette(spark.createDataFrame([(k,) for k in [500, 13, 115, 13, None, *range(600, 612)]], "kv int")).collect()}
    assert got[500] == "#FF1744" and got[13] == palette.CYCLE[0] and got[600] == palette.CYCLE[1] and got[611] == palette.CYCLE[0]


PAYLOADS = {
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1,"b":{"c":2}},"geometry":null}]}': ("none", None, None),
    '[{"lat":"4,5","lng":-74.25,"n":"x"}]': ("props(lat,lon)", 4.5, -74.25),
    '{"result":[{"attributes":{"a":1},"geometry":{"type":"LineString","coordinates":[[1,2],[3,4]]}}]}': ("geometry", None, None),
    '{"latitude":"abc","lat":4,"lon":5}': ("none", None, None),
    '{"items":7}': ("none", None, None),
    '"word"': ("none", None, None),
    '[{"type":"Feature","geometry":{"type":"Point","coordinates":[1.5,2.5,9]},"properties":{"lat":7,"lon":8}}]': ("geometry", 2.5, 1.5),
}


def test_payload_shapes(spark):
    df = spark.createDataFrame(list(enumerate(PAYLOADS)), "i int, payload string")
    got = {r["i"]: r for r in semistructured.flatten_features(df, "payload", ("i",)).collect()}
    assert {i: (r["geom_from"], r["lat"], r["lon"]) for i, r in got.items()} == dict(enumerate(PAYLOADS.values()))
    assert got[0]["props"] == {"a": "1", "b": '{"c":2}'} and got[5]["props"] == {"value": "word"} and got[2]["geometry_sample"] == "[[1,2],[3,4]]"
    features = semistructured.flatten_features(df, "payload", ("i",))
    assert semistructured.header_keys(features, ("i", "place"))[:3] == ["a", "b", "lat"]
    assert semistructured.wide(features, ["a", "n"]).columns == ["a", "n", "geom_from", "geometry_type", "lon", "lat", "geometry_sample"]


def test_variants_and_first_values(spark):
    df = spark.createDataFrame([(0, 1, " b", None), (1, 1, "a", "x"), (2, 1, "b", "y"), (3, 2, "", None)], "rid int, leader int, name string, operator string")
    assert [tuple(r) for r in cluster.variants(df, ("name", "operator")).orderBy("leader").collect()] == [(1, "a; b", "x; y"), (2, "", "")]
    assert [tuple(r) for r in reports.first_non_null(df, "leader").orderBy("leader").collect()] == [(0, 1, " b", "x"), (3, 2, "", None)]


def test_missing_coordinates_raise(spark):
    assert cascade.require_coordinates(spark.createDataFrame([(1, 2.0, 1.0)], "rid int, lat double, lon double")).count() == 1
    with pytest.raises(ValueError, match="1 of 1 rows without coordinates"):
        cascade.require_coordinates(spark.createDataFrame([(1, None, 1.0)], "rid int, lat double, lon double"))


def test_reports_take_a_pipelines_names(spark):
    df = spark.createDataFrame([(1, "x", True)], "left_index int, nearest_right_name string, key_in_right boolean")
    assert reports.renamed(df, "station", "marker").columns == ["station_index", "nearest_marker_name", "key_in_marker"]
    assert F.col("x") is not None


def test_uncovered_sources_sees_every_target(spark, monkeypatch):
    """Both halves go in whole: only keys of rows change."""
    from sitelace import catalog

    seen = []
    monkeypatch.setattr(catalog.reports, "uncovered_sources", lambda sources, targets, config: seen.append((sources, targets)))
    a, b = (spark.createDataFrame([(i, f"k{i}") for i in ids], "rid bigint, key string") for ids in (range(0, 16, 2), range(1, 16, 2)))
    monkeypatch.setattr(catalog, "_by_name", lambda spark, sf_dir: (a, b))
    catalog.uncovered_sources(spark, "")
    ((sources, targets),) = seen
    assert sorted(r["rid"] for r in targets.collect()) == list(range(0, 16, 2)) and sources.count() == 8
    assert sorted(r["key"] for r in targets.collect() if r["rid"] % 4) == ["k10", "k14", "k2", "k6"]
