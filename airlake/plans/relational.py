"""Queries over projections, filters, joins, aggregates, windows, sorting and sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.functions.formats import label_with_value
from airlake.functions.geo import haversine_km
from airlake.graph.communities import group_sizes, largest_group
from airlake.graph.components import connected_components
from airlake.graph.graph import Graph
from airlake.graph.motif import find_motif, walk
from airlake.graph.paths import select_vertices
from airlake.operators.aggregates import concat_sorted, ranked_list, row_counts, share
from airlake.operators.combiner import Combined, combined
from airlake.operators.joins import grid_join, not_in, pair_totals, pairs_by_key
from airlake.operators.quality import (
    DEFECTS, airline_totals, distance_stats, exclude_airports, route_quality, with_distances,
)
from airlake.operators.windows import largest_per_group, number_within, top_n_per_group
from airlake.operators.wordcount import top_words, word_counts
from airlake.plans.networks import (
    LANES, LINKS, ROUTE_EDGES, SHIPMENTS, labelled_airports, lanes, links, route_edges, shipments, traders,
)
from airlake.plans.registry import query
from airlake.plans.tables import (
    AIRLINES, AIRPORTS, COMPANIES, ROUTE_TABLES, ROUTES, airlines, airports, companies, haversine_sql, routes, table,
)
from airlake.scratch import keep
from airlake.sources.catalog import register_view

BROKEN = [3, 17]


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def flown(spark, folder) -> DataFrame:
    return with_distances(routes(spark, folder), airports(spark, folder))


def totals(spark, folder) -> DataFrame:
    return airline_totals(routes(spark, folder), airports(spark, folder), airlines(spark, folder))


# --- projections and filters -------------------------------------------------

@query("project_alias", """
SELECT l_orderkey AS order_key, l_extendedprice * (1 - l_discount) AS net_price, l_linenumber + 1 AS next_line
FROM lineitem""")
def net_prices(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
        (F.col("l_linenumber") + 1).alias("next_line"),
    )


@query("project_lit", "SELECT 1 AS segments, o_orderkey FROM orders")
def with_constant(spark, folder):
    return table(spark, folder, "orders").select(F.lit(1).alias("segments"), "o_orderkey")


@query("project_struct_field", f"""
WITH {LANES}
SELECT v.code AS from_code, w.code AS to_code, e.airlines
FROM edges e JOIN vertices v ON e.src = v.id JOIN vertices w ON e.dst = w.id""")
def struct_fields(spark, folder):
    return find_motif(lanes(spark, folder), "(a)-[e1]->(b)").select(
        F.col("a.code").alias("from_code"), F.col("b.code").alias("to_code"), F.col("e1.airlines").alias("airlines")
    )


@query("with_column", """
SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS doubled FROM orders""")
def added_column(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.withColumn("doubled", F.col("o_totalprice") * 2).drop("o_totalprice")


@query("drop_column", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def dropped_columns(spark, folder):
    return table(spark, folder, "orders").drop("o_orderdate", "o_orderpriority")


@query("filter_eq", f"WITH {COMPANIES} SELECT code, address FROM companies WHERE stan = 'P'")
def equal_state(spark, folder):
    return companies(spark, folder).where(F.col("stan") == "P").select("code", "address")


@query("filter_conjunction", f"""
WITH {COMPANIES}
SELECT code, price FROM companies WHERE 1=1 AND stan = 'O' AND price >= 250000 AND address <> 7""")
def several_conditions(spark, folder):
    conditions = [F.col("stan") == "O", F.col("price") >= 250000, F.col("address") != 7]
    kept = companies(spark, folder).where(reduce(lambda a, b: a & b, conditions, F.lit(True)))
    return kept.select("code", "price")


@query("filter_is_null", f"""
WITH {ROUTES} SELECT src_id, COUNT(*) AS own_routes FROM routes WHERE codeshare IS NULL GROUP BY src_id""")
def own_routes(spark, folder):
    return routes(spark, folder).where(F.col("codeshare").isNull()).groupBy("src_id").agg(rows("own_routes"))


@query("filter_neq", f"""
WITH {ROUTES} SELECT src_id, dst_id, COUNT(*) AS routes FROM routes WHERE src_id <> dst_id GROUP BY ALL""")
def without_loops(spark, folder):
    kept = routes(spark, folder).where(F.col("src_id") != F.col("dst_id"))
    return kept.groupBy("src_id", "dst_id").agg(rows("routes"))


@query("filter_in_list", f"""
WITH {AIRPORTS} SELECT id, name, city, country, latitude, longitude FROM airports WHERE id IN (3, 17)""")
def suspicious_records(spark, folder):
    return airports(spark, folder).where(F.col("id").isin(*BROKEN)).select(
        "id", "name", "city", "country", "latitude", "longitude"
    )


@query("filter_not_in_list", f"""
WITH {ROUTES}
SELECT src_id, dst_id, COUNT(*) AS routes FROM routes
WHERE src_id NOT IN (3, 17) AND dst_id NOT IN (3, 17) GROUP BY ALL""")
def without_listed(spark, folder):
    kept = exclude_airports(routes(spark, folder), BROKEN)
    return kept.groupBy("src_id", "dst_id").agg(rows("routes"))


@query("filter_having", f"""
WITH {COMPANIES} SELECT address, COUNT(*) AS count FROM companies GROUP BY address HAVING COUNT(*) >= 5""")
def large_groups(spark, folder):
    return companies(spark, folder).groupBy("address").count().where("count >= 5")


@query("filter_expr_template", f"""
WITH {SHIPMENTS} SELECT id, code, country FROM vertices WHERE country = 'BUILDING' AND latitude > 0""")
def templated(spark, folder):
    vertices = shipments(spark, folder).vertices
    return select_vertices(vertices, "{v}.country = 'BUILDING' AND {v}.latitude > 0").select("id", "code", "country")


def ends_bound(graph: Graph, first: str, last: str) -> dict[str, DataFrame]:
    """Walks from one region to another."""
    return {
        first: graph.vertices.where("country = 'ASIA'"),
        last: graph.vertices.where("country = 'EUROPE'"),
    }


@query("filter_pairwise_distinct", f"""
WITH {LANES}
SELECT e1.src AS a, e1.dst AS b, e2.dst AS c, e3.dst AS d
FROM edges e1 JOIN edges e2 ON e1.dst = e2.src JOIN edges e3 ON e2.dst = e3.src
WHERE e1.src <> e1.dst AND e1.src <> e2.dst AND e1.src <> e3.dst
  AND e1.dst <> e2.dst AND e1.dst <> e3.dst AND e2.dst <> e3.dst
  AND e1.src IN (SELECT id FROM vertices WHERE country = 'ASIA')
  AND e3.dst IN (SELECT id FROM vertices WHERE country = 'EUROPE')""")
def different_vertices(spark, folder):
    graph = lanes(spark, folder)
    found = find_motif(graph, walk("abcd"), distinct=True, bound=ends_bound(graph, "a", "d"))
    return found.select(*(F.col(f"{v}.id").alias(v) for v in "abcd"))


@query("quote_escape_literal", """
SELECT c_custkey, c_mktsegment || '''s' AS owner FROM customer WHERE c_mktsegment || '''s' = 'BUILDING''s'""")
def quoted_literal(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_mktsegment", F.lit("'s")).alias("owner")
    )
    return spark.sql("SELECT * FROM {customers} WHERE owner = :owner", {"owner": "BUILDING's"}, customers=customers)


# --- joins -------------------------------------------------------------------

def _pair_sides(spark, folder):
    buyers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    sellers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"), "s_name")
    return buyers, sellers


@query("join_inner_mm", """
SELECT COUNT(*) AS pairs, COUNT(DISTINCT c_nationkey) AS nations,
       COUNT(*) FILTER (WHERE c_acctbal > s_acctbal) AS richer_buyers
FROM customer, supplier WHERE c_nationkey = s_nationkey""")
def pairs_in_total(spark, folder):
    """Every pair is formed, as the column compared is of both sides."""
    buyers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"), "c_acctbal")
    sellers = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"), "s_acctbal")
    formed = grid_join(buyers, sellers, "nation")
    return formed.agg(
        rows("pairs"), F.count_distinct("nation").alias("nations"),
        F.count_if(F.col("c_acctbal") > F.col("s_acctbal")).alias("richer_buyers"),
    )


@query("join_inner_mm_counted", """
SELECT COUNT(*) AS pairs, COUNT(DISTINCT c_nationkey) AS nations FROM customer, supplier WHERE c_nationkey = s_nationkey""")
def counted_pairs(spark, folder):
    """Pairs that are only counted need not be formed."""
    totals = pair_totals(*_pair_sides(spark, folder), "nation")
    return totals.select(F.col("shared_keys").alias("nations"), F.col("pairs").cast("long").alias("pairs"))


@query("join_inner_mm_by_key", """
SELECT c_nationkey AS nation, COUNT(*) AS pairs, COUNT(DISTINCT c_custkey) AS buyers, COUNT(DISTINCT s_name) AS sellers
FROM customer, supplier WHERE c_nationkey = s_nationkey GROUP BY c_nationkey""")
def pairs_per_nation(spark, folder):
    sides = _pair_sides(spark, folder)
    pairs = pairs_by_key(*sides, "nation", "c_custkey", "s_name", "buyers", "sellers")
    return pairs.withColumn("pairs", F.col("pairs").cast("long"))


@query("join_dim_twice", f"""
WITH {ROUTE_TABLES}
SELECT src_country, dst_country, COUNT(*) AS routes, ROUND(SUM(distance_km)) AS km FROM distances GROUP BY ALL""")
def both_ends(spark, folder):
    return flown(spark, folder).groupBy("src_country", "dst_country").agg(
        rows("routes"), F.round(F.sum("distance_km")).alias("km")
    )


@query("join_fact_dim", f"""
WITH {ROUTE_TABLES}
SELECT a.country, COUNT(*) AS routes FROM distances f JOIN airlines a ON f.airline_id = a.id GROUP BY a.country""")
def per_airline_country(spark, folder):
    joined = flown(spark, folder).join(
        airlines(spark, folder).select(F.col("id").alias("_airline"), "country"),
        F.col("airline_id") == F.col("_airline"),
    )
    return joined.groupBy("country").agg(rows("routes"))


@query("join_semi", f"""
WITH {SHIPMENTS}
SELECT id, code FROM people WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)""")
def connected_people(spark, folder):
    edges = shipments(spark, folder).edges
    ends = edges.select(F.col("src").alias("end")).union(edges.select("dst")).distinct()
    return traders(spark, folder).join(ends, F.col("id") == F.col("end"), "left_semi").select("id", "code")


@query("join_anti_null_aware", f"""
WITH {SHIPMENTS}
SELECT id, code FROM vertices WHERE id NOT IN (
    SELECT e.src FROM edges e JOIN vertices v ON e.dst = v.id WHERE v.country = 'SUPPLIER' AND v.city = 'NATION_3')""")
def not_in_subquery(spark, folder):
    """Who never sent anything to a supplier of one nation."""
    graph = shipments(spark, folder)
    there = graph.vertices.where("country = 'SUPPLIER' AND city = 'NATION_3'").select(F.col("id").alias("_there"))
    connected = graph.edges.join(there, F.col("dst") == F.col("_there"), "left_semi")
    return not_in(graph.vertices.select("id", "code"), "id", connected, "src")


@query("join_left_outer", f"""
WITH {SHIPMENTS}, deg AS (SELECT dst AS id, COUNT(*) AS arrivals FROM edges GROUP BY dst)
SELECT v.id, v.code, arrivals FROM people v LEFT JOIN deg ON v.id = deg.id""")
def arrivals(spark, folder):
    degrees = shipments(spark, folder).in_degrees.withColumnRenamed("inDegree", "arrivals")
    return traders(spark, folder).select("id", "code").join(degrees, "id", "left")


DEGREES = """
indeg AS (SELECT dst AS id, COUNT(*) AS "inDegree" FROM edges GROUP BY dst),
outdeg AS (SELECT src AS id, COUNT(*) AS "outDegree" FROM edges GROUP BY src)"""


@query("join_degrees", f"""
WITH {SHIPMENTS}, {DEGREES}
SELECT i.id, "inDegree", "outDegree" FROM indeg i JOIN outdeg o ON i.id = o.id""")
def joined_degrees(spark, folder):
    return shipments(spark, folder).degrees()


@query("join_back_group_size", f"""
WITH {COMPANIES}, sizes AS (SELECT address, COUNT(*) AS companies FROM companies GROUP BY address)
SELECT code, c.address, companies FROM companies c JOIN sizes s ON c.address = s.address""")
def with_group_size(spark, folder):
    members = companies(spark, folder).select("code", "address")
    return members.join(members.groupBy("address").agg(rows("companies")), "address")


@query("join_self_chain", f"""
WITH {LANES}
SELECT x.code AS a, y.code AS b, z.code AS c
FROM edges e1 JOIN edges e2 ON e1.dst = e2.src
JOIN vertices x ON e1.src = x.id JOIN vertices y ON e1.dst = y.id JOIN vertices z ON e2.dst = z.id""")
def two_hops(spark, folder):
    found = find_motif(lanes(spark, folder), "(a)-[e1]->(b); (b)-[e2]->(c)")
    return found.select(*(F.col(f"{v}.code").alias(v) for v in "abc"))


# --- aggregates --------------------------------------------------------------

@query("agg_count", "SELECT COUNT(*) AS rows_count FROM lineitem")
def counted(spark, folder):
    return table(spark, folder, "lineitem").agg(rows("rows_count"))


@query("agg_row_counts", """
SELECT 'orders' AS "table", COUNT(*) AS rows FROM orders
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
UNION ALL SELECT 'customer', COUNT(*) FROM customer""")
def table_sizes(spark, folder):
    return row_counts({name: table(spark, folder, name) for name in ("orders", "lineitem", "customer")})


@query("agg_count_distinct", "SELECT COUNT(DISTINCT o_custkey) AS addresses FROM orders")
def distinct_addresses(spark, folder):
    return companies(spark, folder).agg(F.count_distinct("address").alias("addresses"))


@query("agg_multi_distinct", """
SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(DISTINCT l_partkey) AS parts, COUNT(*) AS lines
FROM lineitem GROUP BY l_returnflag""")
def two_distincts(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"),
        rows("lines"),
    )


@query("agg_count_distinct_grouped", f"""
WITH {ROUTES} SELECT src_id, dst_id, COUNT(DISTINCT airline_id) AS airlines FROM routes GROUP BY ALL""")
def airlines_per_pair(spark, folder):
    return routes(spark, folder).groupBy("src_id", "dst_id").agg(F.count_distinct("airline_id").alias("airlines"))


#: The library's rules, each counted by itself.
QUALITY = f"WITH {ROUTES} " + " UNION ALL ".join(
    f"SELECT '{name}' AS defect, COUNT(*) AS routes FROM routes WHERE {rule}" for name, rule in {"all": "TRUE", **DEFECTS}.items()
)


@query("agg_count_if", """
SELECT COUNT(*) FILTER (WHERE o_totalprice > 250000) AS dear, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS filled
FROM orders""")
def counters(spark, folder):
    return table(spark, folder, "orders").agg(
        F.count_if(F.col("o_totalprice") > 250000).alias("dear"),
        F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
    )


@query("agg_stats", f"""
WITH {ROUTE_TABLES}
SELECT COUNT(*) AS routes, ROUND(MIN(distance_km)) AS min_km, ROUND(AVG(distance_km)) AS avg_km,
       ROUND(MAX(distance_km)) AS max_km
FROM distances""")
def statistics_of_distances(spark, folder):
    return distance_stats(flown(spark, folder))


TOTALS = f"""
WITH {ROUTE_TABLES},
own AS (
    SELECT airline_id, COUNT(*) AS legs, SUM(distance_km) AS flown FROM distances
    WHERE codeshare IS NULL AND airline_id IS NOT NULL GROUP BY airline_id
)
SELECT id, name AS carrier, country AS home, legs, ROUND(flown) AS km FROM airlines JOIN own ON id = airline_id"""


@query("agg_sum_round", TOTALS)
def totals_per_airline(spark, folder):
    return totals(spark, folder)


@query("agg_first", f"""
WITH {ROUTE_EDGES} SELECT src, dst, ROUND(distance_km, 6) AS distance_km FROM route_edges""")
def constant_in_group(spark, folder):
    return route_edges(spark, folder).select("src", "dst", F.round("distance_km", 6).alias("distance_km"))


NUMBERED = f"""{COMPANIES},
numbered AS (
    SELECT code, address, stan, ROW_NUMBER() OVER (PARTITION BY address ORDER BY code) AS rn FROM companies
)"""


def numbered(spark, folder):
    return number_within(companies(spark, folder).select("code", "address", "stan"), ["address"], [F.asc("code")])


@query("agg_max_of_window", f"""
WITH {NUMBERED} SELECT address, MAX(rn) AS companies FROM numbered GROUP BY address""")
def companies_per_address(spark, folder):
    return numbered(spark, folder).groupBy("address").agg(F.max("rn").alias("companies"))


@query("agg_group_count", "SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1")
def orders_per_priority(spark, folder):
    return table(spark, folder, "orders").groupBy("o_orderpriority").count()


@query("agg_concat_sorted", f"""
WITH {AIRPORTS}
SELECT country,
       string_agg(concat_ws(' ', COALESCE(iata, icao), '(' || city || ')'), ', '
                  ORDER BY concat_ws(' ', COALESCE(iata, icao), '(' || city || ')')) AS airports
FROM airports GROUP BY country""")
def airports_per_country(spark, folder):
    """The nations of a region are few."""
    place = F.concat_ws(" ", F.coalesce("iata", "icao"), F.concat(F.lit("("), "city", F.lit(")")))
    return concat_sorted(airports(spark, folder).withColumn("place", place), ["country"], "place", "airports")


@query("agg_concat_distinct", """
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments
FROM customer GROUP BY c_nationkey""")
def segments_per_nation(spark, folder):
    """The segments are few."""
    distinct = table(spark, folder, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return concat_sorted(distinct, ["c_nationkey"], "c_mktsegment", "segments")


@query("agg_concat_ranked", """
WITH ranked AS (
    SELECT c_nationkey, c_name,
           ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
    FROM customer)
SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY rank) AS richest FROM ranked WHERE rank <= 5 GROUP BY c_nationkey""")
def richest_customers(spark, folder):
    customer = table(spark, folder, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    top = top_n_per_group(customer, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 5)
    return ranked_list(top, ["c_nationkey"], "rank", "c_name", "richest")


@query("agg_ratio", """
WITH n AS (SELECT c_nationkey, COUNT(*) AS a, COUNT(*) FILTER (WHERE c_acctbal < 0) AS b FROM customer GROUP BY 1)
SELECT c_nationkey, ((200 * b + a) // (2 * a)) / 100 AS in_debt FROM n""")
def debt_share(spark, folder):
    counts = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        rows("_all"), F.count_if(F.col("c_acctbal") < 0).alias("_debt")
    )
    return counts.select("c_nationkey", share(F.col("_debt"), F.col("_all"), 2).alias("in_debt"))


@query("agg_combiner", """
SELECT user_id, event_type, COUNT(*) AS events, ROUND(SUM(value), 2) AS value,
       (SELECT COUNT(*) FROM events) AS rows_in, TRUE AS fewer_shuffled
FROM events GROUP BY ALL""")
def combined_before_shuffle(spark, folder):
    """Sums per user and type, with the rows that came in and whether fewer were shuffled, as Spark counted them."""
    sums = table(spark, folder, "events").groupBy("user_id", "event_type").agg(
        rows("events"), F.round(F.sum("value"), 2).alias("value")
    )
    counted = next(iter(combined(sums)), Combined(0, 0))
    return sums.withColumns({"rows_in": F.lit(counted.rows_in).cast("long"), "fewer_shuffled": F.lit(counted.rows_shuffled < counted.rows_in)})


@query("wordcount_combiner")
def combined_words(spark, folder):
    """The most frequent words with the pairs before and after combining; the latter depend on how files are split."""
    counts = word_counts(table(spark, folder, "documents"), "text")
    counted = next(iter(combined(counts)), Combined(0, 0))
    return top_words(counts).withColumns({"pairs": F.lit(counted.rows_in).cast("long"), "pairs_shuffled": F.lit(counted.rows_shuffled).cast("long")})


# --- windows -----------------------------------------------------------------

@query("win_row_number", f"WITH {NUMBERED} SELECT code, address, stan, rn FROM numbered")
def numbered_companies(spark, folder):
    return numbered(spark, folder)


def numbered_view(spark, folder) -> str:
    """A view that numbers the companies of each address; a filter on the address goes below the window."""
    name = "airlake_numbered"
    by_address = Window.partitionBy("address").orderBy("code")
    register_view(companies(spark, folder).withColumn("rn", F.row_number().over(by_address).cast("long")), name)
    return name


@query("win_view_filter", f"""
WITH {NUMBERED} SELECT rn, code, stan FROM numbered
WHERE address = (SELECT address FROM companies GROUP BY address ORDER BY COUNT(*) DESC, address LIMIT 1)
ORDER BY rn LIMIT 20""")
def first_of_busiest_address(spark, folder):
    """The view is there first; the address it is filtered by is found later."""
    view = numbered_view(spark, folder)
    busiest = spark.sql(f"SELECT address FROM {view} GROUP BY address ORDER BY COUNT(*) DESC, address LIMIT 1").first()
    address = busiest.address if busiest else None
    found = spark.sql(f"SELECT rn, code, stan FROM {view} WHERE address = :address", {"address": address})
    return found.orderBy("rn").limit(20)


@query("win_topn_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 5""")
def dearest_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_n_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


@query("win_argmax_per_group", """
WITH n AS (SELECT l_suppkey, l_returnflag, COUNT(*) AS lines FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag, lines FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY lines DESC, l_returnflag) AS rn FROM n)
WHERE rn = 1""")
def main_flag(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(rows("lines"))
    return largest_per_group(counts, ["l_suppkey"], "lines", "l_returnflag")


@query("win_sum_total", """
WITH n AS (SELECT event_type, user_id, COUNT(*) AS events FROM events GROUP BY ALL)
SELECT event_type, user_id, events, CAST(SUM(events) OVER (PARTITION BY event_type) AS BIGINT) AS all_events FROM n""")
def with_total(spark, folder):
    counts = keep(table(spark, folder, "events").groupBy("event_type", "user_id").agg(rows("events")))
    return counts.join(counts.groupBy("event_type").agg(F.sum("events").alias("all_events")), "event_type")


@query("win_head_per_group", """
SELECT l_shipdate, l_orderkey, l_partkey, CAST(rank AS INTEGER) AS rank FROM (
    SELECT l_shipdate, l_orderkey, l_partkey,
           ROW_NUMBER() OVER (PARTITION BY l_shipdate ORDER BY l_orderkey, l_partkey) AS rank
    FROM (SELECT DISTINCT l_shipdate, l_orderkey, l_partkey FROM lineitem))
WHERE rank <= 8""")
def head_of_day(spark, folder):
    shipped = table(spark, folder, "lineitem").select("l_shipdate", "l_orderkey", "l_partkey").distinct()
    return top_n_per_group(shipped, ["l_shipdate"], [F.asc("l_orderkey"), F.asc("l_partkey")], 8)


# --- sorting and limits ------------------------------------------------------

@query("topk_desc", f"{TOTALS} ORDER BY km DESC, id LIMIT 10")
def longest_totals(spark, folder):
    return totals(spark, folder).orderBy(F.desc("km"), "id").limit(10)


@query("topk_asc", f"{TOTALS} ORDER BY km, id LIMIT 10")
def shortest_totals(spark, folder):
    return totals(spark, folder).orderBy("km", "id").limit(10)


@query("top1_row", f"""
WITH {COMPANIES}
SELECT address, COUNT(*) AS companies FROM companies GROUP BY address ORDER BY companies DESC, address LIMIT 1""")
def largest_address(spark, folder):
    sizes = companies(spark, folder).groupBy("address").agg(rows("companies"))
    return sizes.orderBy(F.desc("companies"), "address").limit(1)


@query("mass_registration", f"""
WITH {COMPANIES}
SELECT address, COUNT(*) AS companies FROM companies GROUP BY address ORDER BY companies DESC, address LIMIT 20""")
def mass_registration(spark, folder):
    """The largest row number of an address is its row count, which needs no window."""
    sizes = companies(spark, folder).groupBy("address").agg(rows("companies"))
    return sizes.orderBy(F.desc("companies"), "address").limit(20)


# --- set operations ----------------------------------------------------------

@query("union_distinct", f"WITH {ROUTES} SELECT src_id AS id FROM routes UNION SELECT dst_id FROM routes")
def all_ends(spark, folder):
    source = routes(spark, folder)
    return source.select(F.col("src_id").alias("id")).union(source.select("dst_id")).distinct()


@query("union_by_name", """
SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier""")
def all_parties(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    return customers.unionByName(suppliers)


@query("union_keyed", f"""
WITH {COMPANIES}
SELECT 'state' AS run, stan AS label, COUNT(*) AS companies FROM companies GROUP BY stan
UNION ALL SELECT 'address', CAST(address AS VARCHAR), COUNT(*) FROM companies GROUP BY address""")
def labelled_runs(spark, folder):
    source = companies(spark, folder)
    runs = {"state": F.col("stan"), "address": F.col("address").cast("string")}
    parts = [
        source.groupBy(label.alias("label")).agg(rows("companies")).withColumn("run", F.lit(run))
        for run, label in runs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- scalar functions --------------------------------------------------------

@query("geo_haversine", f"""
WITH {ROUTE_TABLES}
SELECT src_id, dst_id, ROUND(MIN(distance_km), 6) AS km, COUNT(*) AS routes FROM distances GROUP BY ALL""")
def pair_distances(spark, folder):
    return flown(spark, folder).groupBy("src_id", "dst_id").agg(
        F.round(F.min("distance_km"), 6).alias("km"), rows("routes")
    )


@query("math_basic", """
SELECT l_orderkey, l_partkey, l_linenumber,
       ROUND(ASIN(l_discount) + SQRT(l_quantity) + POWER(l_tax, 2), 9) AS x,
       ROUND(SIN(RADIANS(l_quantity)) * COS(RADIANS(l_quantity)), 9) AS y
FROM lineitem""")
def functions_of_lines(spark, folder):
    q = F.col("l_quantity")
    x = F.asin("l_discount") + F.sqrt(q) + F.pow("l_tax", F.lit(2))
    y = F.sin(F.radians(q)) * F.cos(F.radians(q))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.round(x, 9).alias("x"), F.round(y, 9).alias("y")
    )


@query("math_round", """
SELECT o_orderkey, ROUND(o_totalprice) AS price, ROUND(o_totalprice / 7, 2) AS weekly FROM orders""")
def rounded_prices(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.round(price).alias("price"), F.round(price / 7, 2).alias("weekly")
    )


@query("null_coalesce", f"""
WITH {AIRPORTS} SELECT id, COALESCE(iata, icao, CAST(id AS VARCHAR)) AS code FROM airports""")
def first_known_code(spark, folder):
    return labelled_airports(spark, folder).select("id", "code")


@query("str_concat", f"""
WITH {AIRPORTS}
SELECT id, concat_ws(' ', iata, '(' || city || ')') AS label, iata || '/' || city AS both FROM airports""")
def concatenated(spark, folder):
    return airports(spark, folder).select(
        "id",
        F.concat_ws(" ", "iata", F.concat(F.lit("("), "city", F.lit(")"))).alias("label"),
        F.concat("iata", F.lit("/"), "city").alias("both"),
    )


@query("str_split_index", "SELECT event_id, split_part(replace(props, '\"', ''), ': ', 2) AS tail FROM events")
def split_props(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.split(F.regexp_replace("props", '"', ""), ": ")[1].alias("tail")
    )


@query("str_format", """
WITH c AS (SELECT c_custkey, c_name, c_acctbal < 0 AS below,
                  (CAST(ABS(ROUND(c_acctbal * 100)) AS BIGINT) + 5) // 10 AS tenths FROM customer)
SELECT c_custkey,
       c_name || ' (' || CASE WHEN below THEN '-' ELSE '' END || tenths // 10 || '.' || tenths % 10 || ')' AS label
FROM c""")
def labels(spark, folder):
    """Halves are rounded away from zero, which the SQL spells out in whole numbers."""
    return table(spark, folder, "customer").select(
        "c_custkey", label_with_value(F.col("c_name"), F.col("c_acctbal")).alias("label")
    )


@query("arr_ops", """
SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(source || ' ' || lang || ' ' || source, ' '))), ',')
       AS parts
FROM documents""")
def array_functions(spark, folder):
    words = F.split(F.concat_ws(" ", "source", "lang", "source"), " ")
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(F.sort_array(F.array_distinct(words)), ",").alias("parts")
    )


# --- data quality ------------------------------------------------------------

@query("dq_route_quality", QUALITY)
def quality_of_routes(spark, folder):
    return route_quality(routes(spark, folder))


@query("dq_longest_outliers", f"""
WITH {ROUTE_TABLES}
SELECT src_id, src_iata, dst_id, dst_iata, ROUND(distance_km) AS km, COUNT(*) AS routes
FROM distances GROUP BY ALL ORDER BY km DESC, src_id, dst_id LIMIT 6""")
def longest_routes(spark, folder):
    rounded = F.round("distance_km").alias("km")
    pairs = flown(spark, folder).groupBy("src_id", "src_iata", "dst_id", "dst_iata", rounded).agg(rows("routes"))
    return pairs.orderBy(F.desc("km"), "src_id", "dst_id").limit(6)


@query("dq_exclude_ids", f"""
WITH {ROUTE_TABLES}
SELECT COUNT(*) AS routes, ROUND(MIN(distance_km)) AS min_km, ROUND(AVG(distance_km)) AS avg_km,
       ROUND(MAX(distance_km)) AS max_km
FROM distances WHERE src_id NOT IN (3, 17) AND dst_id NOT IN (3, 17)""")
def without_broken(spark, folder):
    return distance_stats(exclude_airports(flown(spark, folder), BROKEN))


@query("dq_clean_routes", f"""
WITH {ROUTE_TABLES}
SELECT airline_id, src_id, dst_id, codeshare, ROUND(distance_km, 6) AS distance_km FROM distances""")
def clean_routes(spark, folder):
    return flown(spark, folder).select(
        "airline_id", "src_id", "dst_id", "codeshare", F.round("distance_km", 6).alias("distance_km")
    )


# --- groups ------------------------------------------------------------------

REACHED = """
around AS MATERIALIZED (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
reach AS (
    SELECT id, id AS root FROM vertices
    UNION
    SELECT n.b, r.root FROM reach r JOIN around n ON r.id = n.a WHERE r.root < n.b
),
sizes AS (SELECT component, COUNT(*) AS size FROM (SELECT id, MIN(root) AS component FROM reach GROUP BY id) GROUP BY component)"""


@query("filter_by_main_component", f"""
WITH RECURSIVE {LINKS}, {REACHED}
SELECT component, size FROM sizes
WHERE size >= 2 AND component <> (SELECT component FROM sizes ORDER BY size DESC, component LIMIT 1)""")
def all_but_largest(spark, folder):
    """Linked pages outside the main component."""
    sizes = keep(group_sizes(connected_components(links(spark, folder, reused=True)), "component", 2))
    return sizes.where(F.col("component") != F.lit(largest_group(sizes, "component")))
