"""Queries over the driver's tables, one for each operator or group of them, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import LINK_SITES
from .functions import fuzzy, geo, parse, text
from .operators import alike, cascade, cluster, fill, join, palette, reports, semistructured
from .plans import schema
from .sinks import export
from .session import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Sites scatter over degrees, so demonstrations take larger radii than 300 m and 3 km.
WIDE = LINK_SITES.override(radius_m=9000.0, dedup_m=10_000.0)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sites: coordinates from embeddings, names from parts; gaps and copies by number ---------------------------------

SITES_SQL = """
sites AS (
  SELECT vec_id AS rid,
    CASE WHEN vec_id % 17 = 0 THEN NULL WHEN vec_id % 29 = 0 THEN 4.5 + 8 * CAST(1 AS DOUBLE) * (vec_id % 3) / 100 ELSE 4.5 + 8 * CAST(embedding[1] AS DOUBLE) END AS lat,
    CASE WHEN vec_id % 17 = 0 THEN NULL WHEN vec_id % 29 = 0 THEN -74.0 ELSE -74 + 6 * CAST(embedding[2] AS DOUBLE) END AS lon,
    CASE WHEN vec_id % 13 = 0 THEN NULL ELSE p_name END AS name,
    CASE WHEN vec_id % 13 = 0 THEN NULL ELSE lower(p_name) || ' ' || (vec_id % 5) END AS key
  FROM embeddings JOIN part ON p_partkey = vec_id % 200
), a AS (SELECT * FROM sites WHERE rid % 2 = 0), b AS (SELECT * FROM sites WHERE rid % 2 = 1)
"""
D_SQL = "2 * 6371000.0 * atan2(sqrt({h}), sqrt(1 - {h}))"
H_SQL = "least(1.0, pow(sin(radians({r}.lat - {l}.lat) / 2), 2) + cos(radians({l}.lat)) * cos(radians({r}.lat)) * pow(sin(radians({r}.lon - {l}.lon) / 2), 2))"


def distance_sql(left: str = "a", right: str = "b") -> str:
    return D_SQL.format(h=H_SQL.format(l=left, r=right))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, p = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "part").select("p_partkey", "p_name")
    rows = e.join(p, F.col("p_partkey") == F.col("vec_id") % 200)
    v = F.col("vec_id")
    at = lambda i: F.get(F.col("embedding"), F.lit(i)).cast("double")
    lat = F.when(v % 17 == 0, None).when(v % 29 == 0, 4.5 + F.lit(8.0) * (v % 3) / 100).otherwise(4.5 + 8 * at(0))
    lon = F.when(v % 17 == 0, None).when(v % 29 == 0, -74.0).otherwise(-74 + 6 * at(1))
    name = F.when(v % 13 == 0, None).otherwise(F.col("p_name"))
    key = F.when(v % 13 == 0, None).otherwise(F.concat(F.lower("p_name"), F.lit(" "), (v % 5).cast("string")))
    return rows.select(v.alias("rid"), lat.alias("lat"), lon.alias("lon"), name.alias("name"), key.alias("key"))


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    all_sites = sites(spark, sf_dir)
    return all_sites.where("rid % 2 = 0"), all_sites.where("rid % 2 = 1")


def _decorated():
    """Part names dressed up as station names."""
    k = F.col("p_partkey")
    n = F.col("p_name")
    return (
        F.when(k % 6 == 0, F.concat(F.lit("Subestacion "), n, F.lit(" II 115 kV")))
        .when(k % 6 == 1, F.concat(n, F.lit(" - Antioquia")))
        .when(k % 6 == 2, F.concat(F.lit("Sta. "), n, F.lit(" (norte) 34.5kV")))
        .when(k % 6 == 3, F.concat(n, F.lit(" "), n))
        .when(k % 6 == 4, F.concat(F.lit("S/E "), n, F.lit(" -- 500 / KV V")))
        .otherwise(F.concat(n, F.lit(" norte occidente x")))
    )


DECORATED_SQL = """CASE p_partkey % 6 WHEN 0 THEN 'Subestacion ' || p_name || ' II 115 kV' WHEN 1 THEN p_name || ' - Antioquia'
 WHEN 2 THEN 'Sta. ' || p_name || ' (norte) 34.5kV' WHEN 3 THEN p_name || ' ' || p_name
 WHEN 4 THEN 'S/E ' || p_name || ' -- 500 / KV V' ELSE p_name || ' norte occidente x' END"""
CORE_SQL = r"trim(regexp_replace(regexp_replace(lower(strip_accents({s})), '[^0-9a-z\s]+', ' ', 'g'), '\s+', ' ', 'g'))"
VOLT_SQL = r"trim(regexp_replace(regexp_replace({s}, '\b\d{{1,3}}(?:\.\d+)?\s*[-/]?\s*k\s*?v\b', ' ', 'gi'), '\s+', ' ', 'g'))"


def core_sql(s: str) -> str:
    return CORE_SQL.format(s=s)


def _map_sql(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"


def key_sql(s: str) -> str:
    """A normalized text to its key."""
    roman = _map_sql({r: str(i) for i, r in enumerate(text.ROMAN, 1)})
    aliases = _map_sql(text.ALIASES)
    stop = ", ".join(f"'{w}'" for w in text.STOPWORDS)
    tokens = f"list_filter(string_split({s}, ' '), lambda t: t <> '')"
    tokens = f"list_transform({tokens}, lambda t: coalesce({roman}[t], t))"
    tokens = f"list_filter(list_transform({tokens}, lambda t: coalesce({aliases}[t], t)), lambda t: t NOT IN ({stop}))"
    return f"coalesce(array_to_string(list_filter({tokens}, lambda t, i: i = 1 OR t <> ({tokens})[i - 1]), ' '), '')"


HEAVY_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(" + VOLT_SQL.format(s="n") + r", '\([^)]*\)', ' ', 'g'), '\s*[-–—,]\s*[A-Za-z\s]+$', ' ', 'g'), '[/_\-–—]{2,}', ' ', 'g')"
)


@query(
    f"""WITH d AS (SELECT p_partkey, {DECORATED_SQL} AS n FROM part)
    SELECT p_partkey, n, {key_sql(core_sql("translate(" + HEAVY_SQL + ", '-–—/', '    ')"))} AS station_key FROM d"""
)
def key_station_plus(spark, sf_dir):
    """STR-05, 06, 08 to 11, 15."""
    d = table(spark, sf_dir, "part").select("p_partkey", _decorated().alias("n"))
    return d.withColumn("station_key", text.key_station_plus(F.col("n")))


@query(f"""WITH d AS (SELECT p_partkey, {DECORATED_SQL} AS n FROM part) SELECT p_partkey, {key_sql(core_sql("n"))} AS strict_key, {core_sql("n")} AS relaxed_key FROM d""")
def key_strict(spark, sf_dir):
    """STR-10 to 14."""
    d = table(spark, sf_dir, "part").select("p_partkey", _decorated().alias("n"))
    return d.select("p_partkey", text.key_strict(F.col("n")).alias("strict_key"), text.key_relaxed(F.col("n")).alias("relaxed_key"))


@query(f"SELECT doc_id, md5({core_sql('text')}) AS core_md5 FROM documents")
def normalize_core(spark, sf_dir):
    """STR-01 to 03, over whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize_core(F.col("text"))).alias("core_md5"))


@query(f"WITH d AS (SELECT p_partkey, {DECORATED_SQL} AS n FROM part) SELECT p_partkey, {VOLT_SQL.format(s='n')} AS plain FROM d")
def strip_voltage(spark, sf_dir):
    """STR-04."""
    d = table(spark, sf_dir, "part").select("p_partkey", _decorated().alias("n"))
    return d.select("p_partkey", text.strip_voltage(F.col("n")).alias("plain"))


@query("""SELECT p_partkey, list_filter(t, lambda x, i: i = 1 OR x <> t[i - 1]) AS kept FROM (SELECT p_partkey, string_split(p_type || ' ' || p_type || ' a a b a', ' ') AS t FROM part)""")
def collapse_repeats(spark, sf_dir):
    """STR-11."""
    tokens = F.split(F.concat(F.col("p_type"), F.lit(" "), F.col("p_type"), F.lit(" a a b a")), " ")
    return table(spark, sf_dir, "part").select("p_partkey", text.collapse_repeats(tokens).alias("kept"))


ROMAN_SQL = _map_sql({r: str(i) for i, r in enumerate(text.ROMAN, 1)})


@query(
    f"""WITH t AS (SELECT c_custkey, (ARRAY['i','XIV','v','Norte','sta','x','16','9'])[c_custkey % 8 + 1] AS tok FROM customer)
    SELECT c_custkey, tok, coalesce({ROMAN_SQL}[lower(tok)], tok) AS arabic, coalesce({_map_sql({str(i): r.upper() for i, r in enumerate(text.ROMAN, 1)})}[tok], tok) AS roman, coalesce({_map_sql(text.ALIASES)}[tok], tok) AS aliased FROM t"""
)
def numerals_and_aliases(spark, sf_dir):
    """STR-06 to 08."""
    words = F.array(*map(F.lit, ("i", "XIV", "v", "Norte", "sta", "x", "16", "9")))
    t = table(spark, sf_dir, "customer").select("c_custkey", F.get(words, (F.col("c_custkey") % 8).cast("int")).alias("tok"))
    tok = F.col("tok")
    return t.select("c_custkey", "tok", text.roman_to_arabic(tok).alias("arabic"), text.arabic_to_roman(tok).alias("roman"), text.alias(tok).alias("aliased"))


RAW_NAMES = ("  Alpha \t Beta ", "nan", "(Sin nombre)", "---", "A​B", "None", "", "x\x07y")


@query(
    r"""WITH t AS (SELECT c_custkey, (ARRAY['  Alpha ' || chr(9) || ' Beta ', 'nan', '(Sin nombre)', '---', 'A' || chr(8203) || 'B', 'None', '', 'x' || chr(7) || 'y'])[c_custkey % 8 + 1] AS raw FROM customer),
    s AS (SELECT c_custkey, raw, trim(regexp_replace(regexp_replace(raw, '[\x{200B}-\x{200D}\x{FEFF}\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), '[ \t\r\f\v]+', ' ', 'g')) AS n FROM t)
    SELECT c_custkey, CASE WHEN lower(n) IN ('', 'nan', 'none', 'null', '(sin nombre)', 'sin nombre') OR NOT regexp_matches(n, '[0-9A-Za-z_\x{C0}-\x{FF}]') THEN '' ELSE n END AS clean,
    CASE WHEN lower(trim(raw)) IN ('nan', 'none', '') THEN 'n/a' ELSE raw END AS shown FROM s"""
)
def clean_name(spark, sf_dir):
    """STR-16 to 18."""
    raw = F.get(F.array(*map(F.lit, RAW_NAMES)), (F.col("c_custkey") % 8).cast("int"))
    t = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return t.select("c_custkey", text.clean_name(F.col("raw")).alias("clean"), text.safe_value(F.col("raw")).alias("shown"))


@query(
    f"""WITH t AS (SELECT p_partkey, {core_sql("p_name")} AS a, {core_sql("p_type")} || ' ' || {core_sql("p_name")} AS b FROM part),
    l AS (SELECT p_partkey, list_distinct(list_filter(string_split(a, ' '), lambda x: x <> '')) AS x, list_distinct(list_filter(string_split(b, ' '), lambda x: x <> '')) AS y FROM t)
    SELECT p_partkey, 100.0 * len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS jaccard FROM l"""
)
def token_jaccard(spark, sf_dir):
    """FUZ-02."""
    a = text.key_relaxed(F.col("p_name"))
    b = F.concat(text.key_relaxed(F.col("p_type")), F.lit(" "), a)
    return table(spark, sf_dir, "part").select("p_partkey", fuzzy.token_jaccard(a, b).alias("jaccard"))


@query()
def fuzzy_score(spark, sf_dir):
    """FUZ-01, 03, 04: both backends on pairs of names."""
    p = table(spark, sf_dir, "part").select("p_partkey", text.key_relaxed(F.col("p_name")).alias("a"), text.key_relaxed(F.col("p_type")).alias("b"))
    return p.select("p_partkey", F.round(fuzzy.fuzzy_score(F.col("a"), F.col("b")), 6).alias("difflib"), F.round(fuzzy.fuzzy_score(F.col("a"), F.col("b"), "indel"), 6).alias("indel"))


@query()
def fuzzy_best_match(spark, sf_dir):
    """JOIN-06, FUZ-05: names that lost a letter, against all names."""
    a, b = halves(spark, sf_dir)
    a = a.withColumn("name", F.concat(F.substring("name", 1, 3), F.substring("name", 5, 100)))
    return alike.fuzzy_best(a, b, threshold=65.0).select("l_rid", "r_rid", F.round("score", 6).alias("score"))


OPENING_SQL = f"""k AS (SELECT doc_id AS rid, string_split({core_sql("coalesce(text, '')")}, ' ') AS w FROM documents),
b AS (SELECT rid, trim(array_to_string(w[1:4], ' ')) AS y FROM k),
a AS (SELECT rid, trim({core_sql("substring(y, 1, 2) || substring(y, 4)")}) AS x FROM b),
p AS (SELECT a.rid AS l_rid, b.rid AS r_rid, 100.0 * (greatest(length(x), length(y)) - levenshtein(x, y)) / greatest(length(x), length(y)) AS score
  FROM (SELECT DISTINCT ON (x) x, rid FROM a WHERE x <> '' ORDER BY x, rid) a, (SELECT y, min(rid) AS rid FROM b WHERE y <> '' GROUP BY y) b),
best AS (SELECT a.x, p.r_rid, p.score, row_number() OVER (PARTITION BY a.x ORDER BY p.score DESC, p.r_rid) AS n FROM p JOIN a ON a.rid = p.l_rid)"""
OPENING_OUT_SQL = "SELECT a.rid AS l_rid, best.r_rid, round(best.score, 6) AS score FROM a JOIN best USING (x) WHERE n = 1"


#: Five letters or digits with a blank between each and the next: at least four whole words and the start of a fifth, however letters fold.
FIVE_WORDS = r"(?:[0-9A-Za-z][^ \n]*+[ \n][^0-9A-Za-z]*+){4}[0-9A-Za-z]"
HEAD = 200


def first_words(texts: Column) -> Column:
    """The first four words of the relaxed key.  Letters fold one by one and a blank parts words, so where the head of a text holds more
    than four words, they are the same as the whole text's, and only the head is normalised."""
    texts = F.coalesce(texts, F.lit(""))
    head = F.substring(texts, 1, HEAD)
    key = text.key_relaxed(F.when(head.rlike(FIVE_WORDS), head).otherwise(texts))
    return F.trim(F.array_join(F.slice(F.split(key, " "), 1, 4), " "))


def _openings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The first four words of every document, and the same without their third letter."""
    whole = written(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rid"), first_words(F.col("text")).alias("name")), "openings")
    return whole.withColumn("name", F.concat(F.substring("name", 1, 2), F.substring("name", 4, 1_000_000))), whole


@query(f"WITH {OPENING_SQL} {OPENING_OUT_SQL} AND best.score >= 85")
def fuzzy_names(spark, sf_dir):
    """JOIN-06, FUZ-05, EXT-01: every document's opening with a letter lost, against all openings, by single edits."""
    best = alike.fuzzy_best(*_openings(spark, sf_dir), threshold=85.0, backend="edits")
    return best.select("l_rid", "r_rid", F.round("score", 6).alias("score"))


@query(f"WITH {OPENING_SQL} {OPENING_OUT_SQL}")
def fuzzy_names_any(spark, sf_dir):
    """JOIN-06 without a threshold, as reports ask for it."""
    best = alike.fuzzy_best(*_openings(spark, sf_dir), backend="edits")
    return best.select("l_rid", "r_rid", F.round("score", 6).alias("score"))


@query()
def fuzzy_names_composite(spark, sf_dir):
    """JOIN-06, FUZ-01, 04: the same by the composite score."""
    return alike.fuzzy_best(*_openings(spark, sf_dir), threshold=65.0).select("l_rid", "r_rid", F.round("score", 6).alias("score"))


@query(f"""WITH {SITES_SQL} SELECT a.rid AS l_rid, b.rid AS r_rid, round({distance_sql()}, 3) AS d FROM a JOIN b ON {distance_sql()} <= 9000""")
def haversine_pairs(spark, sf_dir):
    """GEO-01, by grid cells."""
    a, b = halves(spark, sf_dir)
    rows = lambda df, p: df.where("lat is not null").select(F.col("rid").alias(f"{p}_rid"), F.col("lat").alias(f"{p}_lat"), F.col("lon").alias(f"{p}_lon"))
    return join.radius_pairs(rows(a, "l"), rows(b, "r"), 9000.0).select("l_rid", "r_rid", F.round("d", 3).alias("d"))


@query(f"""WITH {SITES_SQL} SELECT a.rid, round(2 * 6371000.0 * asin(sqrt({H_SQL.format(l="a", r="o")})), 3) AS d FROM a, (SELECT 4.6 AS lat, -74.08 AS lon) o WHERE a.lat IS NOT NULL""")
def haversine_asin(spark, sf_dir):
    """GEO-02: distance to one place."""
    a, _ = halves(spark, sf_dir)
    d = geo.haversine_asin_m(F.col("lat"), F.col("lon"), F.lit(4.6), F.lit(-74.08))
    return a.where("lat is not null").select("rid", F.round(d, 3).alias("d"))


@query(
    f"""WITH {SITES_SQL}, p AS (SELECT a.rid AS l_rid, b.rid AS r_rid, {distance_sql()} AS d FROM a JOIN b ON {distance_sql()} <= 9000)
    SELECT l_rid, r_rid, round(d, 3) AS d FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p) WHERE n = 1"""
)
def nearest_within_radius(spark, sf_dir):
    """JOIN-01."""
    return join.nearest_within(*halves(spark, sf_dir), 9000.0).select("l_rid", "r_rid", F.round("d", 3).alias("d"))


@query(
    f"""WITH {SITES_SQL}, p AS (SELECT a.rid AS l_rid, b.rid AS r_rid, {distance_sql()} AS d FROM a, b WHERE a.lat IS NOT NULL AND b.lat IS NOT NULL)
    SELECT l_rid, r_rid, round(d, 3) AS d FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p) WHERE n = 1"""
)
def nearest_unbounded(spark, sf_dir):
    """JOIN-02."""
    return join.nearest(*halves(spark, sf_dir)).select("l_rid", "r_rid", F.round("d", 3).alias("d"))


@query(
    f"""WITH {SITES_SQL}, p AS (SELECT a.rid AS l_rid, b.rid AS r_rid, {distance_sql()} AS d FROM a JOIN b ON {distance_sql()} <= 30000)
    SELECT l_rid, r_rid, round(d, 3) AS d, CAST(n AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p) WHERE n <= 3"""
)
def knn_3(spark, sf_dir):
    """JOIN-03, GEO-03."""
    return join.knn(*halves(spark, sf_dir), 3, 30_000.0).select("l_rid", "r_rid", F.round("d", 3).alias("d"), "place")


#: Places of all customers and parts: scattered over the globe, one customer in nine on a spot where a part lies, and a
#: third of the parts within a few kilometres, far from all others.
GROUND_SQL = """
c AS (SELECT c_custkey AS rid, CASE WHEN c_custkey % 9 = 0 THEN p.lat ELSE -89.9 + CAST(c_custkey * 7919 % 1799 AS DOUBLE) / 10 END AS lat, CASE WHEN c_custkey % 9 = 0 THEN p.lon ELSE -179.95 + CAST(c_custkey * 104729 % 3599 AS DOUBLE) / 10 END AS lon
  FROM customer LEFT JOIN q p ON p.rid = c_custkey // 9),
"""
PARTS_SQL = """
q AS (SELECT p_partkey AS rid, CASE WHEN p_partkey % 3 = 0 THEN 71 + CAST(p_partkey * 31 % 997 AS DOUBLE) / 50000 ELSE -88.5 + CAST(p_partkey * 6101 % 1777 AS DOUBLE) / 10 END AS lat,
  CASE WHEN p_partkey % 3 = 0 THEN 179.99 + CAST(p_partkey * 17 % 991 AS DOUBLE) / 50000 ELSE -180 + CAST(p_partkey * 5003 % 3593 AS DOUBLE) / 10 END AS lon FROM part),
"""


def _ground(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    k, n = F.col("p_partkey"), F.col("c_custkey")
    part = table(spark, sf_dir, "part").select(
        k.alias("rid"),
        F.when(k % 3 == 0, 71 + (k * 31 % 997).cast("double") / 50000).otherwise(-88.5 + (k * 6101 % 1777).cast("double") / 10).alias("lat"),
        F.when(k % 3 == 0, 179.99 + (k * 17 % 991).cast("double") / 50000).otherwise(-180 + (k * 5003 % 3593).cast("double") / 10).alias("lon"),
    )
    spots = part.select((F.col("rid") * 9).alias("c_custkey"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    c = table(spark, sf_dir, "customer").select("c_custkey").join(spots, "c_custkey", "left")
    c = c.select(
        n.alias("rid"),
        F.when(n % 9 == 0, F.col("p_lat")).otherwise(-89.9 + (n * 7919 % 1799).cast("double") / 10).alias("lat"),
        F.when(n % 9 == 0, F.col("p_lon")).otherwise(-179.95 + (n * 104729 % 3599).cast("double") / 10).alias("lon"),
    )
    return c, part


@query(
    f"""WITH {PARTS_SQL} {GROUND_SQL} p AS (SELECT c.rid AS l_rid, q.rid AS r_rid, {distance_sql("c", "q")} AS d FROM c, q WHERE c.lat IS NOT NULL AND q.lat IS NOT NULL)
    SELECT l_rid, CAST(n AS INT) AS place, round(d, 2) AS d FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p) WHERE n <= 3"""
)
def knn_anywhere(spark, sf_dir):
    """JOIN-03, GEO-03: three nearest parts of every customer, however far.  Distances alone: rounding may swap equal ones."""
    return join.knn(*_ground(spark, sf_dir), 3).select("l_rid", "place", F.round("d", 2).alias("d"))


@query(
    f"""WITH {PARTS_SQL} {GROUND_SQL} p AS (SELECT c.rid AS l_rid, q.rid AS r_rid, {distance_sql("c", "q")} AS d FROM c, q WHERE c.lat IS NOT NULL AND q.lat IS NOT NULL)
    SELECT l_rid, CAST(n AS INT) AS place, round(d, 2) AS d FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p WHERE d <= 20000) WHERE n <= 3"""
)
def knn_dense(spark, sf_dir):
    """JOIN-01, JOIN-03 where a third of the parts lie in a few cells: three nearest within 20 km of every customer."""
    return join.knn(*_ground(spark, sf_dir), 3, 20_000.0).select("l_rid", "place", F.round("d", 2).alias("d"))


@query(f"WITH {SITES_SQL} SELECT rid, name FROM sites WHERE lat IS NULL OR lon IS NULL ORDER BY rid LIMIT 10")
def coordinate_gaps(spark, sf_dir):
    """LIM-02, UPD-04: the rows that an error about missing coordinates shows."""
    return cascade.gaps(sites(spark, sf_dir)).select("rid", "name")


@query(
    """SELECT event_id AS rid, event_type, last_value(u IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS u
    FROM (SELECT *, CASE WHEN user_id % 5 = 0 THEN user_id END AS u FROM events)"""
)
def ffill_few_groups(spark, sf_dir):
    """WIN-02: a handful of groups of all events."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), "event_type", F.when(F.col("user_id") % 5 == 0, F.col("user_id")).alias("u"))
    return fill.fill_forward(rows, ["u"], within=["event_type"])


KEYED_SQL = SITES_SQL.replace("lower(p_name) || ' ' || (vec_id % 5)", "lower(p_name)")


def _by_name(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return tuple(df.withColumn("key", F.lower("name")) for df in halves(spark, sf_dir))


@query(f"WITH {KEYED_SQL} SELECT a.rid AS l_rid, f.r_rid FROM a JOIN (SELECT key, min(rid) AS r_rid FROM b WHERE key <> '' GROUP BY key) f USING (key)")
def exact_key_first(spark, sf_dir):
    """JOIN-04, JOIN-08."""
    return join.exact_first(*_by_name(spark, sf_dir))


@query(f"WITH {KEYED_SQL} SELECT a.rid AS l_rid, f.r_rid FROM a JOIN (SELECT key, arg_min(rid, (lat IS NULL)::INT * 1000000000 + rid) AS r_rid FROM b WHERE key <> '' GROUP BY key) f USING (key)")
def exact_key_prefer_located(spark, sf_dir):
    """JOIN-05."""
    return join.exact_prefer_located(*_by_name(spark, sf_dir))


MATCHES_SQL = f"""WITH {KEYED_SQL}, p AS (SELECT a.rid AS l_rid, b.rid AS r_rid, {distance_sql()} AS d FROM a JOIN b ON {distance_sql()} <= 9000),
loc AS (SELECT l_rid, r_rid, d FROM (SELECT *, row_number() OVER (PARTITION BY l_rid ORDER BY d, r_rid) AS n FROM p) WHERE n = 1),
ex AS (SELECT a.rid AS l_rid, f.r_rid FROM a JOIN (SELECT key, min(rid) AS r_rid FROM b WHERE key <> '' GROUP BY key) f USING (key) WHERE a.rid NOT IN (SELECT l_rid FROM loc)),
m AS (SELECT l_rid, 0 AS stage, 'location' AS method, r_rid, d AS aux FROM loc UNION ALL SELECT l_rid, 1, 'name_exact', r_rid, NULL FROM ex),
w AS (SELECT m.*, a.lon AS w_lon, a.lat AS w_lat, a.name AS w_name FROM m JOIN a ON a.rid = m.l_rid)
"""
NAMES_OFF = WIDE.override(use_fuzzy=False)


def _matches(spark, sf_dir):
    a, b = _by_name(spark, sf_dir)
    return a, b, written(cascade.cascade(a, b, NAMES_OFF), "matches")


@query(MATCHES_SQL + "SELECT l_rid, stage, method, r_rid, round(aux, 3) AS aux FROM m")
def cascade_location_exact(spark, sf_dir):
    """JOIN-07."""
    return _matches(spark, sf_dir)[2].withColumn("aux", F.round("aux", 3))


@query()
def cascade_with_fuzzy(spark, sf_dir):
    """JOIN-06 and 07: all three stages."""
    a, b = _by_name(spark, sf_dir)
    a = a.withColumn("key", F.concat("key", F.lit("~"))).withColumn("name", F.reverse("name"))
    return cascade.cascade(a, b, WIDE.override(fuzzy_threshold=30)).withColumn("aux", F.round("aux", 3))


@query(
    MATCHES_SQL
    + """, l AS (SELECT r_rid, arg_max(struct_pack(lon := w_lon, lat := w_lat, method := method, aux := aux, nm := w_name), stage * 1000000000 + l_rid) AS w FROM w GROUP BY r_rid)
    SELECT b.rid, round(CASE WHEN w IS NULL THEN b.lon ELSE w.lon END, 9) AS lon, round(CASE WHEN w IS NULL THEN b.lat ELSE w.lat END, 9) AS lat, b.name, b.key, w.method AS match_method, round(w.aux, 3) AS match_aux, w.nm AS matched_name FROM b LEFT JOIN l ON l.r_rid = b.rid"""
)
def writeback_last_wins(spark, sf_dir):
    """UPD-01."""
    a, b, m = _matches(spark, sf_dir)
    out = cascade.replace_coordinates(b, a, m, NAMES_OFF)
    return out.select("rid", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"), "name", "key", "match_method", F.round("match_aux", 3).alias("match_aux"), "matched_name")


@query(
    MATCHES_SQL
    + """, l AS (SELECT r_rid, arg_max(struct_pack(method := method, aux := aux, nm := w_name), stage * 1000000000 + l_rid) AS w, arg_min(struct_pack(lon := w_lon, lat := w_lat), stage * 1000000000 + l_rid) AS f FROM w GROUP BY r_rid)
    SELECT b.rid, round(CASE WHEN f IS NOT NULL AND (b.lon IS NULL OR b.lat IS NULL) THEN f.lon ELSE b.lon END, 9) AS lon, round(CASE WHEN f IS NOT NULL AND (b.lon IS NULL OR b.lat IS NULL) THEN f.lat ELSE b.lat END, 9) AS lat, w.method AS match_method, round(w.aux, 3) AS match_aux, w.nm AS matched_name FROM b LEFT JOIN l ON l.r_rid = b.rid"""
)
def fill_first_wins(spark, sf_dir):
    """UPD-02."""
    a, b, m = _matches(spark, sf_dir)
    out = cascade.fill_coordinates(b, a, m, NAMES_OFF)
    return out.select("rid", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"), "match_method", F.round("match_aux", 3).alias("match_aux"), "matched_name")


@query(
    MATCHES_SQL
    + """, u AS (SELECT a.* FROM a WHERE rid NOT IN (SELECT l_rid FROM m))
    SELECT rid, name, round(lon, 9) AS lon, round(lat, 9) AS lat, NULL::VARCHAR AS voltage, NULL::VARCHAR AS match_method, NULL::VARCHAR AS matched_name FROM b
    UNION ALL SELECT NULL, name, round(lon, 9), round(lat, 9), '115;34.5', 'left_only_append', name FROM u"""
)
def append_unmatched(spark, sf_dir):
    """SET-01, SET-02."""
    a, b, m = _matches(spark, sf_dir)
    rest = a.join(m.select(F.col("l_rid").alias("rid")), "rid", "left_anti")
    rest = rest.select(F.col("name").alias("left_name"), F.col("lon").alias("left_lon"), F.col("lat").alias("left_lat"), F.lit("115;34.5").alias("left_voltages"))
    out = cascade.append_unmatched(b.drop("key"), rest, "name", "voltage")
    return out.select("rid", "name", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"), "voltage", "match_method", "matched_name")


@query(
    f"""WITH {KEYED_SQL}, f AS (SELECT key, arg_min(rid, (lat IS NULL)::INT * 1000000000 + rid) AS r_rid FROM b WHERE key <> '' GROUP BY key),
    w AS (SELECT a.rid, a.lon, a.lat, b.lon AS w_lon, b.lat AS w_lat, b.lon IS NOT NULL AND b.lat IS NOT NULL AS filled FROM a LEFT JOIN f USING (key) LEFT JOIN b ON b.rid = f.r_rid)
    SELECT rid, CASE WHEN filled THEN replace(printf('%.6f', w_lon), '.', ',') END AS lon_text, CASE WHEN filled THEN replace(printf('%.6f', w_lat), '.', ',') END AS lat_text,
    CASE WHEN NOT filled THEN round(lon, 6) END AS lon_kept, CASE WHEN NOT filled THEN round(lat, 6) END AS lat_kept, filled FROM w"""
)
def formatted_fill(spark, sf_dir):
    """UPD-03, STR-19: texts that were filled in, and as numbers those that were left."""
    a, b = _by_name(spark, sf_dir)
    out = cascade.write_formatted(a, b, cascade.cascade(a, b, NAMES_OFF, location=False), ";")
    texts = (F.when(F.col("filled"), F.col(c)).alias(f"{c}_text") for c in ("lon", "lat"))
    kept = (F.when(~F.col("filled"), F.round(F.col(c).try_cast("double"), 6)).alias(f"{c}_kept") for c in ("lon", "lat"))
    return out.select("rid", *texts, *kept, "filled")


LEADER_SQL = f"""WITH RECURSIVE {SITES_SQL}, o AS (SELECT *, row_number() OVER (ORDER BY rid) AS n FROM sites WHERE lat IS NOT NULL),
e AS (SELECT x.n AS i, y.n AS j FROM o x JOIN o y ON x.n < y.n AND {distance_sql("x", "y")} <= 10000),
near AS (SELECT j, list(i) AS smaller FROM e GROUP BY j),
scan AS (
  SELECT 0::BIGINT AS n, []::BIGINT[] AS leaders
  UNION ALL
  SELECT s.n + 1, CASE WHEN near.j IS NULL OR len(list_intersect(near.smaller, s.leaders)) = 0 THEN list_append(s.leaders, s.n + 1) ELSE s.leaders END
  FROM scan s LEFT JOIN near ON near.j = s.n + 1 WHERE s.n < (SELECT max(n) FROM o)
), lead AS (SELECT unnest(leaders) AS n FROM (SELECT leaders FROM scan ORDER BY n DESC LIMIT 1)),
own AS (SELECT o.rid, coalesce(CASE WHEN o.n IN (SELECT n FROM lead) THEN o.rid END, (SELECT min(l.rid) FROM e JOIN lead ON lead.n = e.i JOIN o l ON l.n = e.i WHERE e.j = o.n)) AS leader FROM o),
clustered AS (SELECT rid, leader FROM own UNION ALL SELECT rid, rid FROM sites WHERE lat IS NULL)
"""


@query(LEADER_SQL + "SELECT rid, leader FROM clustered")
def leader_dedup(spark, sf_dir):
    """AGG-01, JOIN-14."""
    return cluster.leaders(sites(spark, sf_dir), 10_000.0)


TAGGED_SQL = """, t AS (SELECT s.*, c.leader, CASE WHEN s.rid % 3 = 0 THEN '' ELSE CAST(100 + s.rid % 7 AS VARCHAR) END AS voltage, CASE WHEN s.rid % 4 = 0 THEN NULL ELSE 'op' || s.rid % 2 END AS operator, CAST(s.rid % 15 AS INT) AS tags FROM sites s JOIN clustered c USING (rid)),
g AS (SELECT *, 4 * (coalesce(name, '') <> '')::INT + 2 * (voltage <> '')::INT + (coalesce(operator, '') <> '')::INT + 3 * (lat IS NOT NULL)::INT + least(tags, 10) AS score FROM t)
"""


def _tagged(spark, sf_dir) -> DataFrame:
    s = sites(spark, sf_dir)
    rid = F.col("rid")
    t = s.withColumns({"voltage": F.when(rid % 3 == 0, "").otherwise((100 + rid % 7).cast("string")), "operator": F.when(rid % 4 == 0, None).otherwise(F.concat(F.lit("op"), (rid % 2).cast("string"))), "tags": (rid % 15).cast("int")})
    t = t.withColumns({"score": cluster.keep_score(F.col("name"), F.col("voltage"), F.col("operator"), F.col("lat"), F.col("lon"), F.col("tags")), "stamp": F.lit(None).cast("timestamp")})
    return t.join(cluster.leaders(s, 10_000.0), "rid")


@query(LEADER_SQL + TAGGED_SQL + "SELECT leader, rid, score FROM (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY score DESC, rid) AS n FROM g) WHERE n = 1")
def cluster_representative(spark, sf_dir):
    """AGG-02, NUM-01, SRT-01, LIM-01."""
    return cluster.representatives(_tagged(spark, sf_dir)).select("leader", "rid", "score")


@query(
    LEADER_SQL
    + TAGGED_SQL
    + """SELECT leader, coalesce(string_agg(DISTINCT nullif(trim(name), ''), '; ' ORDER BY nullif(trim(name), '')), '') AS name_variants, coalesce(string_agg(DISTINCT nullif(voltage, ''), '; ' ORDER BY nullif(voltage, '')), '') AS voltage_variants FROM g GROUP BY leader"""
)
def cluster_variants(spark, sf_dir):
    """AGG-03, STR-20."""
    return cluster.variants(_tagged(spark, sf_dir), ("name", "voltage"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1")
def dedup_keep_first(spark, sf_dir):
    """AGG-04."""
    return join.first_rows(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""SELECT l_suppkey AS key, coalesce(string_agg(DISTINCT l_returnflag || l_linestatus, ';' ORDER BY l_returnflag || l_linestatus), '') AS voltages FROM lineitem GROUP BY l_suppkey""")
def distinct_join(spark, sf_dir):
    """AGG-05."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"), F.concat("l_returnflag", "l_linestatus").alias("v"))
    return reports.voltages_by_key(rows, "v")


@query(
    """SELECT o_custkey AS k, min(o_orderkey) AS rid, arg_min(s, o_orderkey) FILTER (s IS NOT NULL) AS s, arg_min(p, o_orderkey) FILTER (p IS NOT NULL) AS p
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders) GROUP BY o_custkey"""
)
def first_non_null(spark, sf_dir):
    """AGG-06."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), k.alias("rid"), F.when(k % 3 != 0, F.col("o_orderstatus")).alias("s"), F.when(k % 2 != 0, F.col("o_orderpriority")).alias("p"))
    return reports.first_non_null(rows, "k")


@query(
    MATCHES_SQL
    + """, k AS (SELECT key, max((rid IN (SELECT r_rid FROM m))::INT) AS hit FROM b WHERE key IS NOT NULL GROUP BY key)
    SELECT count(*) AS total_keys, CAST(sum(hit) AS BIGINT) AS matched_keys, CASE WHEN count(*) = 0 THEN 0.0 ELSE 100.0 * sum(hit) / count(*) END AS coverage_pct FROM k"""
)
def coverage_pct(spark, sf_dir):
    """AGG-07, AGG-08."""
    _, b, m = _matches(spark, sf_dir)
    return reports.coverage(b, m)


@query(
    MATCHES_SQL
    + """, v AS (SELECT a.*, CASE WHEN rid % 5 = 0 THEN '34500' WHEN rid % 7 = 0 THEN '115000;x' ELSE '115000;34500' END AS voltage FROM a),
    h AS (SELECT DISTINCT key FROM v WHERE key IS NOT NULL AND voltage = '115000;34500'),
    done AS (SELECT DISTINCT key FROM v WHERE rid IN (SELECT l_rid FROM m) AND key IS NOT NULL)
    SELECT count(*) AS high_kv_keys, count(*) FILTER (key NOT IN (SELECT key FROM done)) AS missing_high_kv FROM h"""
)
def missing_high_kv(spark, sf_dir):
    """AGG-09, PARSE-03."""
    a, _, m = _matches(spark, sf_dir)
    rid = F.col("rid")
    a = a.withColumn("voltage", F.when(rid % 5 == 0, "34500").when(rid % 7 == 0, "115000;x").otherwise("115000;34500"))
    return reports.missing_high_voltage(a, m, "voltage", 57.0)


@query("SELECT event_id AS rid, last_value(u IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS u FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id END AS u FROM events)")
def ffill_global(spark, sf_dir):
    """WIN-01."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), F.when(F.col("event_id") % 4 == 0, F.col("user_id")).alias("u"))
    return fill.fill_forward(rows, ["u"])


@query("SELECT conv_id, turn, last_value(r IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS r FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN NULL ELSE role END AS r FROM conversations)")
def ffill_grouped(spark, sf_dir):
    """WIN-02."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 != 1, F.col("role")).alias("r"))
    return fill.fill_forward(rows, ["r"], "turn", within=["conv_id"])


VOLT_TEXTS = ("230", "230000", "110;220", "500 kV", "34.5", "34,5", "35.5", "115000;34500", "999", "-")


@query(
    r"""WITH t AS (SELECT event_id, (ARRAY['230','230000','110;220','500 kV','34.5','34,5','35.5','115000;34500','999','-'])[event_id % 10 + 1] AS v FROM events),
    n AS (SELECT event_id, v, list_transform(regexp_extract_all(replace(v, ',', '.'), '\d+(?:\.\d+)?'), lambda x: CASE WHEN CAST(x AS DOUBLE) >= 1000 THEN CAST(x AS DOUBLE) / 1000 ELSE CAST(x AS DOUBLE) END) AS l FROM t)
    SELECT event_id, CAST(round_even(list_max(l), 0) AS INT) AS kv FROM n"""
)
def parse_voltage(spark, sf_dir):
    """PARSE-02."""
    v = F.get(F.array(*map(F.lit, VOLT_TEXTS)), (F.col("event_id") % 10).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", parse.parse_voltage(v).alias("kv"))


FLOAT_TEXTS = ("4.5", " -74,08 ", "5º 30'", "lat: 7.25 N", "", "abc", "-1e3", "+12,5°")


@query(
    r"""WITH t AS (SELECT event_id, trim((ARRAY['4.5',' -74,08 ','5º 30''','lat: 7.25 N','','abc','-1e3','+12,5°'])[event_id % 8 + 1]) AS v FROM events)
    SELECT event_id, coalesce(TRY_CAST(v AS DOUBLE), TRY_CAST(replace(regexp_extract(translate(v, 'º°', ''), '[-+]?\d+(?:[.,]\d+)?'), ',', '.') AS DOUBLE)) AS x, TRY_CAST(replace(v, ',', '.') AS DOUBLE) AS lenient FROM t"""
)
def robust_float(spark, sf_dir):
    """PARSE-01, SEM-03, PRJ-13."""
    v = F.get(F.array(*map(F.lit, FLOAT_TEXTS)), (F.col("event_id") % 8).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", parse.robust_float(v).alias("x"), parse.lenient_float(v).alias("lenient"))


@query(
    """WITH t AS (SELECT event_id, (ARRAY['115000;34500','500000','x;1',''])[event_id % 4 + 1] AS v FROM events)
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN 115.0 WHEN 1 THEN 500.0 ELSE 0.0 END AS kv FROM t"""
)
def max_kv(spark, sf_dir):
    """PARSE-03."""
    v = F.get(F.array(*map(F.lit, ("115000;34500", "500000", "x;1", ""))), (F.col("event_id") % 4).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", parse.max_kv(v).alias("kv"))


PREFERRED_SQL = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in palette.PREFERRED.items()) + "}"
CYCLE_SQL = "ARRAY[" + ", ".join(f"'{c}'" for c in palette.CYCLE) + "]"
LEVELS_SQL = "SELECT DISTINCT CAST(34 + (p_size * 7) % 480 AS INT) AS kv FROM part UNION SELECT unnest([34, 110, 115, 230, 500])"


@query(f"WITH l AS ({LEVELS_SQL}), f AS (SELECT kv, {PREFERRED_SQL}[kv] AS fixed FROM l) SELECT kv, coalesce(fixed, {CYCLE_SQL}[(row_number() OVER (PARTITION BY fixed IS NULL ORDER BY kv) - 1) % 12 + 1]) AS colour FROM f")
def palette_colours(spark, sf_dir):
    """PAL-01, SET-03, SRT-03."""
    own = table(spark, sf_dir, "part").select((34 + (F.col("p_size") * 7) % 480).cast("int").alias("kv"))
    return palette.palette(own.unionByName(spark.createDataFrame([(k,) for k in (34, 110, 115, 230, 500)], "kv int")))


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '#757575' ELSE '#2979FF' END AS colour, CASE WHEN p_size % 5 = 0 OR p_size * 12 < 200 THEN 2.5 WHEN p_size * 12 < 400 THEN 3.5 ELSE 4.5 END AS weight FROM part")
def line_style(spark, sf_dir):
    """PAL-02, NUM-02."""
    size = F.col("p_size")
    lines = table(spark, sf_dir, "part").select("p_partkey", F.when(size % 5 != 0, 115).alias("kv"), palette.line_weight(F.when(size % 5 != 0, size * 12)).cast("double").alias("weight"))
    colours = palette.palette(spark.createDataFrame([(115,)], "kv int"))
    return palette.coloured(lines, colours, palette.NO_LINE).select("p_partkey", "colour", "weight")


@query(
    """WITH j AS (SELECT event_id, CAST(props ->> '$.k' AS INT) AS k FROM events)
    SELECT event_id, 0 AS place, CASE event_id % 4 WHEN 0 THEN 'geometry' WHEN 1 THEN 'props(lat,lon)' WHEN 2 THEN 'none' ELSE 'geometry' END AS geom_from,
    CASE event_id % 4 WHEN 0 THEN 'Point' WHEN 1 THEN 'Point' WHEN 2 THEN NULL ELSE 'Point' END AS geometry_type,
    CASE event_id % 4 WHEN 2 THEN NULL ELSE -74.0 - k END AS lon, CASE event_id % 4 WHEN 2 THEN NULL ELSE 4.5 END AS lat,
    CASE event_id % 4 WHEN 0 THEN 'f' || k WHEN 1 THEN 'p' || k WHEN 2 THEN NULL ELSE 'a' || k END AS name FROM j"""
)
def feature_flatten(spark, sf_dir):
    """SEM-01 to 06: four shapes of payload."""
    k = F.get_json_object("props", "$.k")
    lon = F.concat(F.lit("-"), (F.lit(74) + k.cast("int")).cast("string"))
    i = F.col("event_id") % 4
    payload = (
        F.when(i == 0, F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"name":"f'), k, F.lit('"},"geometry":{"type":"Point","coordinates":['), lon, F.lit(",4.5]}}]}")))
        .when(i == 1, F.concat(F.lit('{"data":[{"name":"p'), k, F.lit('","lat":"4,5","lng":'), lon, F.lit("}]}")))
        .when(i == 2, F.concat(F.lit("["), k, F.lit("]")))
        .otherwise(F.concat(F.lit('{"lines":[{"attributes":{"name":"z"},"properties":{"name":"a'), k, F.lit('"},"geometry":{"type":"Point","coordinates":['), lon, F.lit(",4.5]}}]}")))
    )
    out = semistructured.flatten_features(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")), "payload", ("event_id",))
    return out.select("event_id", "place", "geom_from", "geometry_type", "lon", "lat", F.col("props")["name"].alias("name"))


@query("SELECT page_id, CASE WHEN n = '' THEN 'output' ELSE n END AS short FROM (SELECT page_id, list_last(string_split(rtrim(string_split(url, '?')[1], '/'), '/')) AS n FROM pages)")
def url_short_name(spark, sf_dir):
    """SEM-07."""
    return table(spark, sf_dir, "pages").select("page_id", semistructured.short_name(F.col("url")).alias("short"))


@query("""SELECT event_id, 'n' || (props ->> '$.k') AS name, NULL::VARCHAR AS owner, CAST(event_id % 90 AS DOUBLE) AS lon, 1.5 AS lat FROM events""")
def service_rows(spark, sf_dir):
    """SEM-08."""
    k = F.get_json_object("props", "$.k")
    feature = F.concat(F.lit('{"properties":{"id":"'), F.col("event_id").cast("string"), F.lit('","nm":"n'), k, F.lit('"},"geometry":{"type":"Point","coordinates":['), (F.col("event_id") % 90).cast("string"), F.lit(",1.5]}}"))
    rows = semistructured.service_rows(table(spark, sf_dir, "events").select(feature.alias("feature")), "feature", {"id": "event_id", "nm": "name", "own": "owner"})
    return rows.withColumn("event_id", F.col("event_id").cast("bigint")).select("event_id", "name", "owner", "lon", "lat")


@query(
    """WITH n AS (SELECT l_partkey AS node_id, l_orderkey AS way_id, l_linenumber AS pos FROM lineitem WHERE l_partkey % 3 <> 0)
    SELECT way_id, string_agg(CAST(node_id AS VARCHAR), ',' ORDER BY pos, node_id) AS path FROM n GROUP BY way_id"""
)
def way_assembly(spark, sf_dir):
    """SEM-09, JOIN-10."""
    lines = table(spark, sf_dir, "lineitem")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    ways = lines.groupBy(F.col("l_orderkey").alias("way_id")).agg(ordered.alias("nodes"))
    nodes = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("node_id"), F.col("p_partkey").cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    paths = semistructured.assemble_ways(ways, nodes)
    return paths.select("way_id", F.array_join(F.transform("path", lambda p: p["lat"].cast("bigint").cast("string")), ",").alias("path"))


@query(
    """SELECT 'node' AS element_type, s_suppkey AS element_id, CASE WHEN s_suppkey % 3 = 0 THEN 2.5 ELSE 1.5 END AS lat, CASE WHEN s_suppkey % 3 = 0 THEN -72.5 ELSE -71.5 END AS lon,
    CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END AS name_raw, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS tags_count, '' AS timestamp FROM supplier"""
)
def element_flatten(spark, sf_dir):
    """SRC-03."""
    k = F.col("s_suppkey")
    element = F.struct(
        F.lit("node").alias("type"), k.alias("id"), F.lit(1.5).alias("lat"), F.when(k % 3 != 0, -71.5).alias("lon"), F.struct(F.lit(2.5).alias("lat"), F.lit(-72.5).alias("lon")).alias("center"),
        F.array().cast("array<bigint>").alias("nodes"), F.when(k % 2 == 0, F.create_map(F.lit("name"), F.col("s_name"))).alias("tags"), F.lit(None).cast("string").alias("timestamp"),
    )
    rows = semistructured.flatten_elements(table(spark, sf_dir, "supplier").select(F.array(element.cast(semistructured.ELEMENT)).alias("elements")))
    return rows.select("element_type", "element_id", "lat", "lon", "name_raw", "tags_count", "timestamp")


@query(
    """SELECT doc_id, reason, count(*) AS n FROM (
      SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '{"n": ' || n_chars || '}' WHEN 1 THEN '[' || n_chars WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE '["' || source || '"]' END AS p FROM documents) t,
    LATERAL (SELECT CASE WHEN p IS NULL OR trim(p) = '' THEN 'no payload' WHEN NOT json_valid(p) THEN 'not JSON' END AS reason) WHERE reason IS NOT NULL GROUP BY ALL"""
)
def rejected_payloads(spark, sf_dir):
    """SEM-02, SRC-08: payloads without JSON and why."""
    k = F.col("doc_id") % 5
    said = F.when(k == 0, F.concat(F.lit('{"n": '), "n_chars", F.lit("}"))).when(k == 1, F.concat(F.lit("["), "n_chars")).when(k == 3, "  ").when(k == 4, F.concat(F.lit('["'), "source", F.lit('"]')))
    docs = table(spark, sf_dir, "documents").select("doc_id", said.alias("payload"))
    return semistructured.split_payloads(docs)[1].groupBy("doc_id", "reason").agg(F.count("*").alias("n"))


@query(
    MATCHES_SQL
    + f""", u AS (SELECT a.* FROM a WHERE rid NOT IN (SELECT l_rid FROM m) AND lat IS NOT NULL),
    near AS (SELECT rid, r_rid, d FROM (SELECT u.rid, b.rid AS r_rid, {distance_sql("u", "b")} AS d, row_number() OVER (PARTITION BY u.rid ORDER BY {distance_sql("u", "b")}, b.rid) AS n FROM u, b WHERE b.lat IS NOT NULL) WHERE n = 1)
    SELECT u.rid AS left_index, u.name AS left_name, near.r_rid AS nearest_right_index, round(near.d, 3) AS nearest_distance_m, coalesce(u.key IN (SELECT key FROM b WHERE key IS NOT NULL), false) AS key_in_right,
    CASE WHEN coalesce(u.key IN (SELECT key FROM b WHERE key IS NOT NULL), false) AND near.d > 9000 THEN 'same_name_in_right_but_outside_radius' WHEN near.d <= 10000 THEN 'nearby_right_but_name_mismatch' ELSE 'no_close_match' END AS reason
    FROM u JOIN near USING (rid)"""
)
def unmatched_reason(spark, sf_dir):
    """DIA-01, JOIN-02, JOIN-09, JOIN-12, PRJ-15."""
    a, b, m = _matches(spark, sf_dir)
    out = reports.unmatched_sites(a.where("lat is not null"), b, m, NAMES_OFF)
    return out.select("left_index", "left_name", "nearest_right_index", F.round("nearest_distance_m", 3).alias("nearest_distance_m"), "key_in_right", "reason")


ALL_REASONS = NAMES_OFF.override(scorer="edits", use_fuzzy=True, fuzzy_threshold=80.0)


def _with_gaps(spark, sf_dir):
    """Sites of which some have a key or a name that no target has, with their matches by place and key, and voltages."""
    a, b = _by_name(spark, sf_dir)
    rid = F.col("rid")
    a = a.withColumn("key", F.when(rid % 3 == 0, F.concat("key", F.lit("~"))).otherwise(F.col("key")))
    a = a.withColumn("name", F.when(rid % 7 == 0, F.concat(F.substring("name", 1, 3), F.lit(" zz"))).otherwise(F.col("name")))
    a = a.withColumn("lat", F.when(rid % 5 == 0, F.col("lat") + 40).otherwise(F.col("lat")))
    levels = reports.voltages_by_key(a.withColumn("v", F.concat((rid % 4).cast("string"), F.lit("00"))), "v")
    return a, b, written(cascade.cascade(a, b, NAMES_OFF), "matches"), levels


GAPS_SQL = MATCHES_SQL.replace(
    "a AS (SELECT * FROM sites WHERE rid % 2 = 0)",
    """a AS (SELECT rid, CASE WHEN rid % 5 = 0 THEN lat + 40 ELSE lat END AS lat, lon, CASE WHEN rid % 7 = 0 THEN substring(name, 1, 3) || ' zz' ELSE name END AS name, CASE WHEN rid % 3 = 0 THEN key || '~' ELSE key END AS key FROM sites WHERE rid % 2 = 0)""",
) + f""", u AS (SELECT a.*, {core_sql("name")} AS x FROM a WHERE rid NOT IN (SELECT l_rid FROM m)),
near AS (SELECT rid, r_rid, d FROM (SELECT u.rid, b.rid AS r_rid, {distance_sql("u", "b")} AS d, row_number() OVER (PARTITION BY u.rid ORDER BY {distance_sql("u", "b")}, b.rid) AS n FROM u, b WHERE b.lat IS NOT NULL AND u.lat IS NOT NULL) WHERE n = 1),
names AS (SELECT {core_sql("name")} AS y, min(rid) AS r_rid FROM b WHERE {core_sql("name")} <> '' GROUP BY ALL),
alike AS (SELECT rid, r_rid, score FROM (SELECT u.rid, names.r_rid, 100.0 * (greatest(length(x), length(y)) - levenshtein(x, y)) / greatest(length(x), length(y)) AS score,
  row_number() OVER (PARTITION BY u.rid ORDER BY 100.0 * (greatest(length(x), length(y)) - levenshtein(x, y)) / greatest(length(x), length(y)) DESC, names.r_rid) AS n FROM u, names WHERE x <> '') WHERE n = 1),
levels AS (SELECT key, string_agg(DISTINCT (rid % 4) || '00', ';' ORDER BY (rid % 4) || '00') AS voltages FROM a WHERE key IS NOT NULL GROUP BY key),
r AS (SELECT u.rid AS left_index, u.name AS left_name, u.lat, u.lon, near.r_rid AS nearest_right_index, near.d, coalesce(u.key IN (SELECT key FROM b WHERE key IS NOT NULL), false) AS key_in_right,
  alike.r_rid AS best_fuzzy_right_index, alike.score, coalesce(voltages, '') AS left_voltages FROM u LEFT JOIN near USING (rid) LEFT JOIN alike USING (rid) LEFT JOIN levels ON levels.key = u.key)
SELECT left_index, left_name, nearest_right_index, round(d, 3) AS nearest_distance_m, key_in_right, best_fuzzy_right_index, round(score, 6) AS best_fuzzy_score, left_voltages,
  CASE WHEN lat IS NULL OR lon IS NULL THEN 'left_missing_coords' WHEN key_in_right AND (d IS NULL OR d > 9000) THEN 'same_name_in_right_but_outside_radius'
    WHEN coalesce(score, -1) >= 80 AND (d IS NULL OR d > 9000) THEN 'fuzzy_name_match_but_outside_radius' WHEN d <= 10000 THEN 'nearby_right_but_name_mismatch' ELSE 'no_close_match' END AS reason
FROM r"""


@query(GAPS_SQL)
def unmatched_all_reasons(spark, sf_dir):
    """DIA-01, DIA-04, JOIN-11, FUZ-05: with fuzzy names, voltages and missing coordinates."""
    a, b, m, levels = _with_gaps(spark, sf_dir)
    out = reports.unmatched_sites(a, b, m, ALL_REASONS, levels)
    return out.select("left_index", "left_name", "nearest_right_index", F.round("nearest_distance_m", 3).alias("nearest_distance_m"), "key_in_right", "best_fuzzy_right_index", F.round("best_fuzzy_score", 6).alias("best_fuzzy_score"), "left_voltages", "reason")


@query(
    MATCHES_SQL
    + """SELECT m.l_rid AS left_index, a.name AS left_name, a.key AS left_key, m.r_rid AS right_index, b.name AS right_name, b.key AS right_key, m.method, round(CASE WHEN stage = 0 THEN aux END, 3) AS distance_m, NULL::DOUBLE AS score
    FROM m JOIN a ON a.rid = m.l_rid JOIN b ON b.rid = m.r_rid"""
)
def matched_report(spark, sf_dir):
    """DIA-05, SRT-02."""
    return reports.matched(*_matches(spark, sf_dir)).withColumn("distance_m", F.round("distance_m", 3))


@query(
    MATCHES_SQL
    + """SELECT m.l_rid AS left_index, m.r_rid AS right_index, a.name AS left_name, b.name AS right_name FROM m JOIN a ON a.rid = m.l_rid JOIN b ON b.rid = m.r_rid WHERE method <> 'name_exact' AND a.name IS DISTINCT FROM b.name"""
)
def different_names(spark, sf_dir):
    """PRJ-16, SNK-09."""
    return reports.different_names(reports.matched(*_matches(spark, sf_dir))).select("left_index", "right_index", "left_name", "right_name")


@query(f"WITH {KEYED_SQL} SELECT DISTINCT key FROM b WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM a WHERE key IS NOT NULL AND rid % 4 = 0)")
def missing_keys(spark, sf_dir):
    """JOIN-13, DIA-03."""
    a, b = _by_name(spark, sf_dir)
    return join.missing_keys(b, a.where("rid % 4 = 0"))


@query()
def unmatched_targets(spark, sf_dir):
    """DIA-02."""
    a, b = _by_name(spark, sf_dir)
    a = a.withColumn("key", F.when(F.col("rid") % 4 == 0, F.concat("key", F.lit(" x"))).otherwise(F.col("key")))
    config = WIDE.override(fuzzy_threshold=85)
    return reports.unmatched_targets(a, b, cascade.cascade(a, b, config, location=False), config)


@query()
def uncovered_sources(spark, sf_dir):
    """DIA-03."""
    a, b = _by_name(spark, sf_dir)
    a = a.withColumn("key", F.when(F.col("rid") % 4 == 0, F.concat("key", F.lit(" x"))).otherwise(F.col("key")))
    return reports.uncovered_sources(b, a, WIDE)


@query(
    """SELECT event_id, CASE WHEN trim(v) = '' OR v IS NULL THEN '-' ELSE v END AS v FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE event_type END AS v FROM events)"""
)
def blank_to_null_fill_dash(spark, sf_dir):
    """PRJ-01, PRJ-02."""
    i = F.col("event_id") % 4
    rows = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.when(i == 0, "  ").when(i > 1, F.col("event_type")).alias("v"))
    return parse.nulls_to_dash(parse.blanks_to_null(rows)).withColumn("event_id", F.col("event_id").cast("bigint"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN false WHEN c_custkey % 5 = 0 THEN false ELSE true END AS named FROM customer")
def named_split(spark, sf_dir):
    """PRJ-05, PRJ-03."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 == 0, None).when(k % 5 == 0, " ").otherwise(F.col("c_name")).alias("name_clean"))
    named, rest = parse.named_split(rows)
    return named.select("c_custkey", F.lit(True).alias("named")).unionByName(rest.select("c_custkey", F.lit(False).alias("named")))


@query("SELECT c_custkey, c_custkey || ' ' || c_name AS line FROM customer")
def sanitize(spark, sf_dir):
    """PRJ-04."""
    dirty = F.concat(F.lit(" \n"), F.col("c_custkey").cast("string"), F.lit("\r\n"), F.col("c_name"), F.lit("\n"))
    return table(spark, sf_dir, "customer").select("c_custkey", parse.sanitize(dirty).alias("line"))


@query("SELECT round(avg(lat), 9) AS lat, round(avg(lon), 9) AS lon FROM (WITH " + SITES_SQL + " SELECT * FROM sites)")
def map_centre(spark, sf_dir):
    """GEO-04."""
    return sites(spark, sf_dir).agg(F.round(F.avg("lat"), 9).alias("lat"), F.round(F.avg("lon"), 9).alias("lon"))


@query(f"WITH {SITES_SQL} SELECT bool_or(lon IS NULL OR lat IS NULL) AS any_missing FROM sites")
def any_missing(spark, sf_dir):
    """AGG-11, UPD-04."""
    return reports.any_missing(sites(spark, sf_dir))


@query(f"WITH {SITES_SQL} SELECT 'left' AS metric, count(*) AS value FROM a UNION ALL SELECT 'right', count(*) FROM b")
def row_counts(spark, sf_dir):
    """AGG-10, SNK-11."""
    a, b = halves(spark, sf_dir)
    return reports.summary(left=a, right=b)


@query("SELECT c_custkey, 'Nombre' AS name_column, 'Tensión kV' AS voltage_column, 1.5 AS lon, 2.5 AS lat FROM customer")
def header_heuristics(spark, sf_dir):
    """PRJ-09 to 11, PRJ-14."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lit("a").alias("Nombre"), F.lit("115").alias("Tensión kV"), F.lit("1,5").alias("longitud"), F.lit("2.5 N").alias("LATITUDE"))
    rows = schema.ensure_coordinates(rows)
    return rows.select("c_custkey", F.lit(schema.name_column(rows.columns)).alias("name_column"), F.lit(schema.voltage_column(rows.columns)).alias("voltage_column"), "lon", "lat")


@query("SELECT rid, lat, lon, feature FROM (SELECT vec_id AS rid, 1.5 AS lat, 2.5 AS lon, '{\"type\":\"Feature\",\"properties\":{\"rid\":' || vec_id || ',\"note\":null},\"geometry\":{\"type\":\"Point\",\"coordinates\":[2.5,1.5]}}' AS feature FROM embeddings)")
def geojson_features(spark, sf_dir):
    """SNK-07 to 09, as text rows."""
    from .sinks.export import features

    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("rid"), F.lit(None).cast("double").alias("note"), F.lit(2.5).alias("lon"), F.lit(1.5).alias("lat"))
    made = features(rows)
    return made.select(F.get_json_object("feature", "$.properties.rid").cast("bigint").alias("rid"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), "feature")


_CELL_SQL = """CASE WHEN {0} IS NULL THEN '' WHEN regexp_matches({0}, '[;"\\r\\n]') THEN '"' || replace({0}, '"', '""') || '"' ELSE {0} END"""
_QUOTED_SQL = """'"' || replace(coalesce({0}, ''), '"', '""') || '"'"""


def _records_sql(quoting: str) -> str:
    text = (_CELL_SQL if quoting == "minimal" else _QUOTED_SQL).format
    number = _QUOTED_SQL.format if quoting == "all" else (lambda c: f"CASE WHEN {c} IS NULL THEN '\"\"' ELSE {c} END" if quoting == "nonnumeric" else f"coalesce({c}, '')")
    return " || ';' || ".join((number("CAST(doc_id AS VARCHAR)"), text("text"), text("source"), number("CAST(n AS VARCHAR)")))


@query(
    f"""WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE n_chars END AS n FROM documents)
    SELECT 'minimal' AS quoting, md5({_records_sql("minimal")}) AS record, count(*) AS times FROM d GROUP BY ALL UNION ALL SELECT 'nonnumeric', md5({_records_sql("nonnumeric")}), count(*) FROM d GROUP BY ALL
    UNION ALL SELECT 'all', md5({_records_sql("all")}), count(*) FROM d GROUP BY ALL"""
)
def csv_records(spark, sf_dir):
    """SNK-01 to 03, 06: records of whole documents in the three ways of quoting."""
    d = table(spark, sf_dir, "documents")
    d = d.select("doc_id", "text", F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("source"), F.when(F.col("doc_id") % 5 != 0, F.col("n_chars")).alias("n"))
    each = [export.csv_lines(d, ";", q).select(F.lit(q).alias("quoting"), F.md5(F.col("line").cast("binary")).alias("record")) for q in ("minimal", "nonnumeric", "all")]
    return each[0].unionAll(each[1]).unionAll(each[2]).groupBy("quoting", "record").agg(F.count("*").alias("times"))
