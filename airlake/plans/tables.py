"""Registry and airline tables derived from the given ones, in Spark and in SQL.

Orders play the companies of a registry (customer = address, order key = code,
order status = state), nations the airports, suppliers the airlines, and every
line item a route from its supplier's nation to its customer's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The given tables. Stating them spares a job that looks into the files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def companies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("code"),
        F.col("o_custkey").alias("address"),
        F.col("o_orderstatus").alias("stan"),
        F.col("o_totalprice").alias("price"),
    )


COMPANIES = """
companies AS (
    SELECT o_orderkey AS code, o_custkey AS address, o_orderstatus AS stan, o_totalprice AS price
    FROM orders
)"""


def airports(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("City "), key.cast("string")).alias("city"),
        F.col("r_name").alias("country"),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("iata"),
        F.when(key >= 10, F.concat(F.lit("ICAO"), key.cast("string"))).alias("icao"),
        (key * 6 - 72).cast("double").alias("latitude"),
        (key * 14 - 168).cast("double").alias("longitude"),
    )


AIRPORTS = """
airports AS (
    SELECT n_nationkey AS id, n_name AS name, 'City ' || n_nationkey AS city, r_name AS country,
           CASE WHEN n_regionkey <> 0 THEN n_name END AS iata,
           CASE WHEN n_nationkey >= 10 THEN 'ICAO' || n_nationkey END AS icao,
           CAST(n_nationkey * 6 - 72 AS DOUBLE) AS latitude,
           CAST(n_nationkey * 14 - 168 AS DOUBLE) AS longitude
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def airlines(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("country")
    )


AIRLINES = """
airlines AS (
    SELECT s_suppkey AS id, s_name AS name, n_name AS country
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """Untaxed lines lack the airline, the most discounted ones the destination."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_tax", "l_discount", "l_returnflag"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    sellers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    # Always from the lines outwards, so that no join has the lines on its small side.
    return (
        lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.when(F.col("l_tax") > 0, F.col("l_suppkey")).alias("airline_id"),
            F.col("s_nationkey").alias("src_id"),
            F.when(F.col("l_discount") < 0.1, F.col("c_nationkey")).alias("dst_id"),
            F.when(F.col("l_returnflag") == "R", F.lit("Y")).alias("codeshare"),
        )
    )


ROUTES = """
routes AS (
    SELECT CASE WHEN l_tax > 0 THEN l_suppkey END AS airline_id,
           s_nationkey AS src_id,
           CASE WHEN l_discount < 0.1 THEN c_nationkey END AS dst_id,
           CASE WHEN l_returnflag = 'R' THEN 'Y' END AS codeshare
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""


def haversine_sql(a: str, b: str) -> str:
    """Distance between two rows with latitude and longitude, as SQL."""
    return f"""2 * 6371 * ASIN(SQRT(LEAST(1.0,
        POWER(SIN(RADIANS({b}.latitude - {a}.latitude) / 2), 2)
        + COS(RADIANS({a}.latitude)) * COS(RADIANS({b}.latitude))
        * POWER(SIN(RADIANS({b}.longitude - {a}.longitude) / 2), 2))))"""


DISTANCES = f"""
distances AS (
    SELECT r.airline_id, r.codeshare, r.src_id, r.dst_id, s.iata AS src_iata, d.iata AS dst_iata,
           s.country AS src_country, d.country AS dst_country,
           {haversine_sql("s", "d")} AS distance_km
    FROM routes r
    JOIN airports s ON r.src_id = s.id
    JOIN airports d ON r.dst_id = d.id
    WHERE r.src_id <> r.dst_id
)"""

ROUTE_TABLES = f"{AIRPORTS},{AIRLINES},{ROUTES},{DISTANCES}"
