"""Graphs derived from the given tables, in Spark and in SQL; each holds all its edges.

* lanes: nations; an edge for each pair with routes. Small and dense, for motifs and paths
  between sets.
* shipments: suppliers and customers; goods go out along every line item and
  come back along returned ones. Directed, with cycles, as large as the tables.
* links: pages and what they link to, resolved against the page's host, with
  text ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.functions.geo import haversine_km
from airlake.graph.graph import Graph, collapse_routes, edges_of, touched_vertices
from airlake.operators.quality import with_distances
from airlake.plans.tables import AIRPORTS, ROUTE_TABLES, airports, haversine_sql, routes, table
from airlake.scratch import WorkingArea, keep, working_area


def labelled_airports(spark: SparkSession, folder: str) -> DataFrame:
    return airports(spark, folder).select(
        "id",
        F.coalesce("iata", "icao", F.col("id").cast("string")).alias("code"),
        "name", "city", "country", "latitude", "longitude",
    )


def located_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return with_distances(collapse_routes(routes(spark, folder)), airports(spark, folder))


def route_edges(spark: SparkSession, folder: str) -> DataFrame:
    return edges_of(located_pairs(spark, folder))


ROUTE_EDGES = f"""{ROUTE_TABLES},
route_edges AS (
    SELECT src_id AS src, dst_id AS dst, MIN(distance_km) AS distance_km,
           COUNT(DISTINCT airline_id) AS airlines, COUNT(*) AS flights
    FROM distances GROUP BY src_id, dst_id
),
labelled AS (
    SELECT id, COALESCE(iata, icao, CAST(id AS VARCHAR)) AS code, name, city, country, latitude, longitude
    FROM airports
)"""


def lanes(spark: SparkSession, folder: str, reused: bool = False) -> Graph:
    return _connected(labelled_airports(spark, folder), route_edges(spark, folder), reused)


def _connected(vertices: DataFrame, edges: DataFrame, reused: bool) -> Graph:
    """The graph over materialised edges and the vertices they touch.

    ``reused`` materialises the vertices too, for work that looks at them repeatedly.
    """
    edges = keep(edges, "edges")
    touched = touched_vertices(vertices, edges)
    return Graph(keep(touched, "vertices") if reused else touched, edges)


LANES = f"""{ROUTE_EDGES},
edges AS (SELECT src, dst, distance_km, airlines FROM route_edges),
vertices AS (
    SELECT * FROM labelled WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)
)"""


def traders(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with odd, customers with even ids."""
    places = airports(spark, folder).select(
        F.col("id").alias("_nation"), F.col("name").alias("nation"), "latitude", "longitude"
    )
    suppliers = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("id"), F.col("s_name").alias("code"),
        F.lit("SUPPLIER").alias("country"), F.col("s_nationkey").alias("_nationkey"),
    )
    customers = table(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("id"), F.col("c_name").alias("code"),
        F.col("c_mktsegment").alias("country"), F.col("c_nationkey").alias("_nationkey"),
    )
    return (
        suppliers.unionByName(customers)
        .join(places, F.col("_nationkey") == F.col("_nation"))
        .select("id", "code", F.col("nation").alias("city"), "country", "latitude", "longitude")
    )


def _shipment_edges(spark: SparkSession, folder: str, people: DataFrame, area: WorkingArea) -> DataFrame:
    """Edges to be written before the area goes: pairs are kept there, so that their joins' shuffles are off the disk."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    # Lines of one pair are summed, and both ends looked up, before both directions are unfolded.
    dealt = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy((F.col("l_suppkey") * 2 + 1).alias("seller"), (F.col("o_custkey") * 2).alias("buyer"))
        .agg(F.count(F.lit(1)).alias("sent"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    )

    def end(side: str) -> DataFrame:
        return people.select(
            F.col("id").alias(f"_{side}"), F.col("latitude").alias(f"_{side}_lat"), F.col("longitude").alias(f"_{side}_lon"),
        )

    def shipment(src: str, dst: str, lines_sent: str):
        return F.struct(
            F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(lines_sent).alias("airlines"),
            F.col(f"_{src}_lat").alias("_src_lat"), F.col(f"_{src}_lon").alias("_src_lon"),
            F.col(f"_{dst}_lat").alias("_dst_lat"), F.col(f"_{dst}_lon").alias("_dst_lon"),
        )

    pairs = area.keep(dealt, "pairs")
    placed = pairs.join(end("buyer"), F.col("buyer") == F.col("_buyer")).join(end("seller"), F.col("seller") == F.col("_seller"))
    both_ways = F.array(shipment("seller", "buyer", "sent"), shipment("buyer", "seller", "returned"))
    edges = placed.select(F.explode(both_ways).alias("way")).select("way.*").where(F.col("airlines") > 0)
    distance = haversine_km(F.col("_src_lat"), F.col("_src_lon"), F.col("_dst_lat"), F.col("_dst_lon"))
    return edges.select("src", "dst", distance.alias("distance_km"), "airlines")


def shipments(spark: SparkSession, folder: str, reused: bool = False) -> Graph:
    people = traders(spark, folder)
    with working_area(spark) as area:
        return _connected(people, _shipment_edges(spark, folder, people, area), reused)


SHIPMENTS = f"""{AIRPORTS},
people AS (
    SELECT p.id, p.code, a.name AS city, p.country, a.latitude, a.longitude
    FROM (
        SELECT s_suppkey * 2 + 1 AS id, s_name AS code, 'SUPPLIER' AS country, s_nationkey AS n FROM supplier
        UNION ALL
        SELECT c_custkey * 2, c_name, c_mktsegment, c_nationkey FROM customer
    ) p JOIN airports a ON p.n = a.id
),
dealt AS (
    SELECT l_suppkey * 2 + 1 AS seller, o_custkey * 2 AS buyer, COUNT(*) AS sent,
           COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
),
edges AS (
    SELECT t.src, t.dst, {haversine_sql("s", "d")} AS distance_km, t.airlines
    FROM (
        SELECT seller AS src, buyer AS dst, sent AS airlines FROM dealt
        UNION ALL
        SELECT buyer, seller, returned FROM dealt WHERE returned > 0
    ) t JOIN people s ON t.src = s.id JOIN people d ON t.dst = d.id
),
vertices AS (
    SELECT * FROM people WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)
)"""


# The shape of addresses and of links in the pages.
HOST = r"^[a-z]+://([^/]+)"
LINK = r'href="([^"]*)"'


def links(spark: SparkSession, folder: str, reused: bool = False) -> Graph:
    pages = table(spark, folder, "pages").select(
        "page_id", F.regexp_extract("url", HOST, 1).alias("host"), "html"
    )
    page = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    kept_pages = pages.select(page.alias("src"), "host", F.explode(F.regexp_extract_all("html", F.lit(LINK))).alias("href"))
    found = (
        kept_pages.select("src", F.concat("host", "href").alias("dst"), "host").distinct()
    )
    edges = found.select("src", "dst")
    domain = F.regexp_extract("host", r"([a-z]+)$", 1)
    vertices = (
        pages.select(page.alias("id"), F.col("host").alias("city"), domain.alias("country"))
        .union(found.select("dst", "host", domain).distinct())
        .select("id", F.col("id").alias("code"), "city", "country")
    )
    return _connected(vertices, edges, reused)


LINKS = f"""
found AS (
    SELECT DISTINCT src, host || href AS dst, host
    FROM (
        SELECT 'page ' || page_id AS src, regexp_extract(url, '{HOST}', 1) AS host,
               unnest(regexp_extract_all(html, '{LINK}', 1)) AS href
        FROM pages
    )
),
edges AS (SELECT src, dst FROM found),
vertices AS (
    SELECT id, id AS code, city, country
    FROM (
        SELECT 'page ' || page_id AS id, regexp_extract(url, '{HOST}', 1) AS city,
               regexp_extract(regexp_extract(url, '{HOST}', 1), '([a-z]+)$', 1) AS country
        FROM pages
        UNION ALL
        SELECT DISTINCT dst, host, regexp_extract(host, '([a-z]+)$', 1) FROM found
    )
    WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)
)"""
