"""Further queries of the record operators over the tables, each with SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from lodestone.functions import geo, nested
from lodestone.functions import text as tx
from lodestone.operators import reconcile, search
from lodestone.plans.queries import Query, table
from lodestone.sources import readers, sinks

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return register


NAMED_PAGES = "(SELECT source AS volume, doc_id AS idx, CASE WHEN doc_id % 7 <> 0 THEN doc_id % 500 END AS printed_page, text FROM documents)"


def named_pages(spark, d):
    """Documents as scanned pages: every seventh has no printed number."""
    number = F.when(F.expr("doc_id % 7 <> 0"), F.expr("doc_id % 500"))
    return table(spark, d, "documents").select(F.col("source").alias("volume"), F.col("doc_id").alias("idx"), number.alias("printed_page"), "text")


@query("printed_page_index", f"SELECT volume, printed_page, min(idx) AS idx FROM {NAMED_PAGES} WHERE printed_page IS NOT NULL GROUP BY ALL")
def printed_page_index(spark, d):
    return readers.scan_text_pages(named_pages(spark, d))[0]


@query("low_text_pages", f"SELECT volume, idx FROM {NAMED_PAGES} WHERE length(trim(text)) < 120")
def low_text_pages(spark, d):
    return readers.scan_text_pages(named_pages(spark, d))[1]


PLACES = """(SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'g' || o_custkey END AS match_id,
  ['extracted', 'demo', 'unmatched', 'reconciled'][o_orderkey % 4 + 1] AS status, o_orderkey % 100 / 4.0 AS match_score, o_orderstatus AS recon_pass FROM orders)"""


def order_places(spark, d):
    k = F.col("o_orderkey")
    status = F.get(F.array(*[F.lit(s) for s in ("extracted", "demo", "unmatched", "reconciled")]), (k % 4).cast("int"))
    match = F.when(k % 3 != 0, F.concat(F.lit("g"), F.col("o_custkey").cast("string")))
    return table(spark, d, "orders").select(k.alias("key"), match.alias("match_id"), status.alias("status"), (k % 100 / 4.0).alias("match_score"), F.col("o_orderstatus").alias("recon_pass"))


@query("select_work", f"SELECT key, status FROM {PLACES} WHERE match_id IS NULL AND status IN ('extracted', 'demo', 'unmatched')")
def select_work(spark, d):
    return reconcile.select_work(order_places(spark, d), retry_unmatched=True).select("key", "status")


@query(
    "reset_matches",
    f"""
    SELECT key, NULL::VARCHAR AS match_id, CASE WHEN status IN ('reconciled', 'unmatched') THEN 'extracted' ELSE status END AS status,
      NULL::DOUBLE AS match_score, NULL::VARCHAR AS recon_pass FROM {PLACES}
    """,
)
def reset_matches(spark, d):
    return reconcile.reset(order_places(spark, d))


@query("score_gaps", "SELECT count(gap) AS n, avg(gap) AS mean_gap, max(gap) AS max_gap FROM (SELECT CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 17 / 4.0 END AS gap FROM orders)")
def score_gaps(spark, d):
    k = F.col("o_custkey")
    return reconcile.score_gaps(table(spark, d, "orders").select(F.when(k % 5 > 0, k % 17 / 4.0).alias("gap")))


@query(
    "digitised_tables",
    """
    SELECT p_partkey AS volume, p_size AS page_start, t AS table_no, t AS n_rows, t + 1 AS n_cols, 'table ' || t AS subject
    FROM (SELECT p_partkey, p_size, unnest(generate_series(1, p_size % 4)) AS t FROM part)
    """,
)
def digitised_tables(spark, d):
    one = F.expr("transform(sequence(1, p_size % 4), t -> struct('table ' || t AS subject, array_repeat(array('x'), t) AS rows, array_repeat('c', t + 1) AS columns))")
    pages = table(spark, d, "part").select(F.col("p_partkey").alias("volume"), F.col("p_size").alias("page_start"), F.when(F.expr("p_size % 4 > 0"), one).alias("tables"))
    return sinks.table_rows(pages).select("volume", "page_start", "table_no", "n_rows", "n_cols", "subject")


@query(
    "sparse_records",
    """
    SELECT '{"id":' || o_orderkey || CASE WHEN o_orderstatus <> 'O' THEN ',"state":"' || o_orderstatus || '"' ELSE '' END
      || CASE WHEN o_orderkey % 3 > 0 THEN ',"tags":["né"' || CASE WHEN o_orderkey % 3 = 2 THEN ',"né"' ELSE '' END || ']' ELSE '' END || ',"zero":0}' AS body FROM orders
    """,
)
def sparse_records(spark, d):
    tags = nested.none_if_empty(F.array_repeat(F.lit("né"), (F.col("o_orderkey") % 3).cast("int")))
    return table(spark, d, "orders").select(nested.sparse_json(id=F.col("o_orderkey"), state=F.nullif(F.col("o_orderstatus"), F.lit("O")), tags=tags, zero=F.lit(0)).alias("body"))


@query("late_columns", "SELECT c_custkey, c_name, NULL::VARCHAR AS plate_kind, NULL::INTEGER AS n_tables FROM customer")
def late_columns(spark, d):
    return sinks.with_missing_columns(table(spark, d, "customer").select("c_custkey", "c_name"), {"C_NAME": "string", "plate_kind": "string", "n_tables": "int"})


@query("authority_lines", """SELECT '{"fold":"' || lower(p_brand) || '","canonical":"' || min(p_brand) || '","count":' || count(*) || '}' AS value FROM part GROUP BY lower(p_brand)""")
def authority_lines(spark, d):
    return sinks.authority_json(table(spark, d, "part").groupBy(F.lower("p_brand").alias("fold")).agg(F.min("p_brand").alias("canonical"), F.count("*").alias("count")))


def geometries(spark, d):
    """Binaries of every kind of geometry in both byte orders; those of each third supplier are empty."""
    k = F.col("s_suppkey")
    code = F.lpad(F.hex(F.expr("s_suppkey % 7 + 1")), 2, "0")
    head = F.when(k % 2 == 0, F.concat(F.lit("01"), code, F.lit("000000"))).otherwise(F.concat(F.lit("00000000"), code))
    body = F.when(k % 3 == 0, F.lit("00000000")).otherwise(F.lit("0000000000000000"))
    wkb = F.unhex(F.concat(head, body))
    return table(spark, d, "supplier").select(k, wkb.alias("wkb"), sinks.wkb_kind(wkb).alias("kind"))


KINDS = "['Point', 'LineString', 'Polygon', 'MultiPoint', 'MultiLineString', 'MultiPolygon', 'GeometryCollection']"


@query("geometry_kinds", f"SELECT {KINDS}[s_suppkey % 7 + 1] AS kind, count(*) AS n FROM supplier GROUP BY 1")
def geometry_kinds(spark, d):
    return geometries(spark, d).groupBy("kind").agg(F.count("*").alias("n"))


@query("non_point_geometries", f"SELECT s_suppkey, {KINDS}[s_suppkey % 7 + 1] AS kind FROM supplier WHERE s_suppkey % 7 IN (1, 2, 4, 5) AND s_suppkey % 3 <> 0")
def non_point_geometries(spark, d):
    return sinks.non_point_features(geometries(spark, d)).select("s_suppkey", "kind")


@query(
    "page_links",
    """
    SELECT o_orderkey, 'https://pages.example/' || 'k' || o_custkey || '/seq/' || CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey END AS link,
      'vol_' || o_custkey AS stem, format('{:,}', o_orderkey * 1000) AS printed, 'so ' || o_orderstatus || ' lest' AS plain FROM orders
    """,
)
def page_links(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    link = tx.page_link("https://pages.example/{key}/seq/{seq}", F.concat(F.lit("k"), c), F.when(k % 5 > 0, k))
    stem = tx.key_before_last_underscore(F.concat(F.lit("vol_"), c, F.lit("_"), k.cast("string")))
    plain = tx.long_s(F.concat(F.lit("ſo "), F.col("o_orderstatus"), F.lit(" leſt")))
    return table(spark, d, "orders").select("o_orderkey", link.alias("link"), stem.alias("stem"), tx.thousands(k * 1000).alias("printed"), plain.alias("plain"))


@query(
    "points_near",
    """
    WITH p AS (SELECT c_custkey, c_custkey % 120 - 60.0 AS lat, c_custkey % 340 - 170.0 AS lon, c_custkey % 7 / 4.0 AS off FROM customer)
    SELECT c_custkey, abs(off) <= 1.0 AS inside, lon - 1.0 AS west, lat + 1.0 AS north FROM p
    """,
)
def points_near(spark, d):
    k = F.col("c_custkey")
    lat, lon, off = k % 120 - 60.0, k % 340 - 170.0, k % 7 / 4.0
    box = geo.square_box(lat, lon, 111.0)
    return table(spark, d, "customer").select("c_custkey", geo.in_box(lat + off, lon, box).alias("inside"), box["west"].alias("west"), box["north"].alias("north"))


@query(
    "polygon_boxes",
    """
    SELECT l_orderkey, min(l_partkey) AS x0, min(l_suppkey) AS y0, max(l_partkey) AS x1, max(l_suppkey) AS y1 FROM lineitem GROUP BY 1
    """,
)
def polygon_boxes(spark, d):
    rings = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.array("l_partkey", "l_suppkey")).alias("ring"))
    return rings.select("l_orderkey", geo.polygon_box(F.col("ring")).alias("b")).select("l_orderkey", "b.*")


@query(
    "manifest_merge",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'v0=new,v1=old' ELSE 'v0=old,v1=new' END AS entries FROM supplier",
)
def manifest_merge(spark, d):
    old = F.create_map(F.lit("v0"), F.lit("old"), F.lit("v1"), F.lit("old"))
    merged = nested.merge_key(old, F.concat(F.lit("v"), (F.col("s_suppkey") % 2).cast("string")), F.lit("new"))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("entries"))


@query(
    "running_heads",
    """
    SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN upper(p_name) || '|' ELSE '' END || 'LA-VAL' AS heads FROM part
    """,
)
def running_heads(spark, d):
    name = F.when(F.expr("p_size % 2 = 0"), F.concat(F.lit("  "), F.upper("p_name"))).otherwise(F.lower("p_name"))
    lines = F.array(name, F.lit("XIV"), F.lit("LA-VAL"), F.lit("TOTAL"), F.lit("A B"), F.lit("123"))
    return table(spark, d, "part").select("p_partkey", F.array_join(readers.running_heads(lines), "|").alias("heads"))


@query(
    "match_keys",
    r"""
    WITH w AS (SELECT p_partkey, string_split(upper(p_name), ' ') AS a, [p_type] AS b FROM part)
    SELECT p_partkey, array_to_string(list_sort(list_distinct([array_to_string(a, ''), array_to_string(list_sort(a), ''), array_to_string(b, '')])), ',') AS keys FROM w
    """,
)
def match_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(tx.match_keys(F.concat("p_name", F.lit(" or "), "p_type", F.lit("; ab"))), ",").alias("keys"))


@query("reader_locations", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey % 9 ELSE o_custkey // 150 END AS chunk FROM orders")
def reader_locations(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    written = orders.where("o_orderkey % 4 = 1").select("o_orderkey", F.expr("o_orderkey % 9").alias("chunk"))
    return search.locate(orders, written, "o_orderkey", "o_custkey").select("o_orderkey", "chunk")


@query("orientation_issues", "SELECT 'P-' || o_orderkey AS plate, 90 * (o_custkey % 4) AS degrees FROM orders WHERE o_custkey % 4 > 0")
def orientation_issues(spark, d):
    title = F.concat(F.lit("Plate #P-"), F.col("o_orderkey").cast("string"))
    body = F.concat(F.lit("Please rotate by "), (F.col("o_custkey") % 4 * 90).cast("string"), F.lit(" degrees"))
    return readers.orientation_issues(table(spark, d, "orders").select(title.alias("title"), body.alias("body")))


@query("transcript_names", "SELECT DISTINCT replace(upper(p_name), ' ', '') AS key FROM part WHERE p_size % 2 = 0")
def transcript_names(spark, d):
    name = F.when(F.expr("p_size % 2 = 0"), F.upper("p_name")).otherwise(F.col("p_name"))
    pages = table(spark, d, "part").select(F.concat(F.lit("<p>Prose, x</p><p> "), name, F.lit(", a town</p>")).alias("html"))
    return readers.transcript_headwords(pages)


@query(
    "label_lookup",
    """
    WITH l AS (SELECT DISTINCT p_name AS label FROM part), t AS (SELECT DISTINCT 'old ' || split_part(p_name, ' ', 1) || 's' AS term, split_part(p_name, ' ', 1) AS head FROM part),
      r AS (SELECT term, label, row_number() OVER (PARTITION BY term ORDER BY label) AS rank FROM t JOIN l ON starts_with(lower(label), head))
    SELECT term, label, rank FROM r WHERE rank <= 3
    """,
)
def label_lookup(spark, d):
    part = table(spark, d, "part")
    terms = part.select(F.concat(F.lit("old "), F.split("p_name", " ")[0], F.lit("s")).alias("term")).distinct()
    return reconcile.fuzzy_labels(part.select(F.col("p_name").alias("label")), terms)


@query(
    "broader_paths",
    """
    WITH RECURSIVE w AS (
      SELECT c_custkey AS concept, c_custkey AS spot, 0 AS n, '' AS path FROM customer
      UNION ALL SELECT concept, up, n + 1, path || CASE WHEN n > 0 THEN '>' ELSE '' END || up FROM (SELECT *, spot // 3 AS up FROM w WHERE spot > 0 AND n < 6))
    SELECT concept::VARCHAR AS concept, arg_max(path, n) AS path FROM w GROUP BY ALL
    """,
)
def broader_paths(spark, d):
    k = F.col("c_custkey")
    customers = table(spark, d, "customer")
    broader = customers.where(k > 0).select(k.cast("string").alias("concept"), F.floor(k / 3).cast("string").alias("broader"))
    return reconcile.ancestors(customers.select(k.cast("string").alias("concept")), broader).select("concept", F.array_join("path", ">").alias("path"))


@query(
    "feature_lines",
    """
    SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (s_suppkey % 180)::DOUBLE || ',' || (s_suppkey % 85)::DOUBLE || ']},"properties":{"id":' || s_suppkey
      || ',"name":"' || s_name || '"}}' AS value FROM supplier
    """,
)
def feature_lines(spark, d):
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(k.alias("id"), F.col("s_name").alias("name"), (k % 180).cast("double").alias("lon"), (k % 85).cast("double").alias("lat"))
    return sinks.point_features(rows, ["id", "name"])


@query(
    "printed_page_guesses",
    """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey % 900 + 1 WHEN 1 THEN o_custkey % 1000 END::INTEGER AS page
    FROM (SELECT o_orderkey, CASE WHEN o_custkey % 1000 > 0 THEN o_custkey END AS o_custkey FROM orders)
    """,
)
def printed_page_guesses(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    mark = F.concat(F.lit("title\n## p. "), (k % 900 + 1).cast("string"), F.lit(" (#7)\nprose"))
    bare = F.concat(F.lit("prose\n\n  "), (c % 1000).cast("string"), F.lit(" \nmore prose"))
    body = F.when(k % 3 == 0, mark).when(k % 3 == 1, bare).otherwise(F.lit("prose of 1841"))
    return table(spark, d, "orders").select("o_orderkey", readers.printed_page_guess(body).alias("page"))
