"""Queries over sources, sinks and layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlake.functions.formats import bucket_number, format_bytes
from airlake.functions.text import clean_text
from airlake.operators.aggregates import row_counts
from airlake.operators.wordcount import word_counts
from airlake.plans.networks import ROUTE_EDGES, SHIPMENTS, route_edges, shipments
from airlake.plans.registry import query
from airlake.plans.tables import COMPANIES, ROUTES, companies, routes, table
from airlake.scratch import cut_lineage, keep, working_area
from airlake.sinks.delimited import write_quoted_csv
from airlake.sinks.tables import (
    analyze, column_statistics, join_depths, load_partitions, optimizing_session, overwrite_load, write_bucketed,
    write_partitioned, write_plain,
)
from airlake.sinks.wordcount import write_wordcount
from airlake.sources.catalog import describe_table, external_table, preview, register_view, with_input_file
from airlake.sources.delimited import QUOTED, read_headerless_csv, read_quoted_csv, strings, typed
from airlake.sources.layout import (
    bucket_of, bucket_report, bucket_sample, compare_layouts, file_sizes, layout_report, scan_work, split_report,
)
from airlake.sources.text import read_part_files, read_text_lines
from airlake.sources.xml import encode_text, flat_records, read_xml_records, record_schema
from pyspark.sql.types import IntegerType, LongType, StringType

BUCKETS = 10
STATE = "F"
CODE = 223

CLEAN = r"""trim(regexp_replace(replace(text, '\', '/'),
    '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ')"""

WORDS = r"""
counts AS (
    SELECT word, COUNT(*) AS count
    FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word
),
placed AS (
    SELECT reducers, CAST(CAST(concat('0x', substr(md5(word), 1, 8)) AS UBIGINT) % reducers AS INTEGER) AS part,
           word, count
    FROM counts CROSS JOIN (VALUES (1), (2), (4)) AS runs(reducers)
)"""


def _document_counts(spark: SparkSession, folder: str) -> DataFrame:
    return word_counts(table(spark, folder, "documents"), "text")


@query("read_quoted_csv", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, {CLEAN} AS text, lang, source FROM documents""")
def quoted_csv(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    with working_area(spark) as area:
        _, path = area.place("quoted")
        write_quoted_csv(documents.select("doc_id", clean_text(F.col("text")).alias("text"), "lang", "source"), path)
        return keep(read_quoted_csv(spark, path, strings("doc_id", "text", "lang", "source")))


@query("quoted_csv_round_trip", r"""
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE c_custkey % 5 WHEN 0 THEN '\N' WHEN 1 THEN '' WHEN 2 THEN '"' || c_name || '", and "'
            WHEN 3 THEN ' \ ' || c_name || ' ' ELSE 'NULL' END AS value
FROM customer""")
def awkward_values(spark, folder):
    """Marks of missing values, empty texts, quotes and backslashes come back as they were."""
    kind, name = F.col("c_custkey") % 5, F.col("c_name")
    value = (
        F.when(kind == 0, "\\N").when(kind == 1, "").when(kind == 2, F.concat(F.lit('"'), name, F.lit('", and "')))
        .when(kind == 3, F.concat(F.lit(" \\ "), name, F.lit(" "))).otherwise("NULL")
    )
    with working_area(spark) as area:
        _, path = area.place("quoted")
        write_quoted_csv(table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), value.alias("value")), path)
        return keep(read_quoted_csv(spark, path, strings("id", "value")))


@query("write_quoted_csv", """
SELECT '"' || c_custkey || '","' || c_name || '","' || c_nationkey || '","'
       || CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE '' END || '"' AS line
FROM customer""")
def quoted_csv_lines(spark, folder):
    customer = table(spark, folder, "customer")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment")
    header = '"c_custkey","c_name","c_nationkey","c_mktsegment"'
    with working_area(spark) as area:
        _, path = area.place("quoted")
        write_quoted_csv(customer.select("c_custkey", "c_name", "c_nationkey", segment), path)
        lines = read_text_lines(spark, path).withColumnRenamed("value", "line")
        return keep(lines.where(F.col("line") != header))


@query("external_table_csv", f"""
WITH {COMPANIES} SELECT CAST(code AS VARCHAR) AS code, CAST(address AS VARCHAR) AS address, stan FROM companies""")
def table_over_csv(spark, folder):
    """A table whose files are quoted CSV that was there before it."""
    with working_area(spark) as area:
        name, path = area.place("registry")
        write_quoted_csv(companies(spark, folder).select("code", "address", "stan"), path)
        external_table(spark, name, path, strings("code", "address", "stan"), "csv", **{k: str(v) for k, v in QUOTED.items()})
        return keep(spark.sql(f"SELECT code, address, stan FROM {name}"))


@query("read_headerless_csv", f"""
WITH {ROUTES}
SELECT airline_id, src_id, dst_id, codeshare, COUNT(*) AS routes FROM routes GROUP BY ALL""")
def headerless_csv(spark, folder):
    schema = typed(airline_id=LongType(), src_id=IntegerType(), dst_id=IntegerType(), codeshare=StringType())
    with working_area(spark) as area:
        _, path = area.place("headerless")
        routes(spark, folder).write.csv(path, nullValue="\\N")
        read = read_headerless_csv(spark, path, schema)
        return keep(read.groupBy(*read.columns).agg(F.count(F.lit(1)).alias("routes")))


@query("read_text_lines", r"""
SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS value FROM documents""")
def text_lines(spark, folder):
    with working_area(spark) as area:
        _, path = area.place("lines")
        table(spark, folder, "documents").select("text").write.text(path)
        return keep(read_text_lines(spark, path))


RECORD_TAGS = ["NAME", "EDRPOU", "ADDRESS", "FOUNDERS"]
RECORD_LISTS = {"FOUNDERS": "FOUNDER"}


def _registry_xml(spark: SparkSession, folder: str, area) -> DataFrame:
    """Customers as registry records: some without address, founders from two columns."""
    _, path = area.place("xml")
    customer = table(spark, folder, "customer")
    founders = F.struct(F.array("c_mktsegment", F.concat(F.lit("P\\Q  & <"), "c_name", F.lit("> "))).alias("FOUNDER"))
    customer.select(
        F.col("c_name").alias("NAME"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("EDRPOU"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("ADDRESS"),
        F.when(F.col("c_acctbal") < 9000, founders).alias("FOUNDERS"),
    ).write.format("xml").option("rowTag", "RECORD").option("rootTag", "DATA").save(path)
    return read_xml_records(spark, path, record_schema(RECORD_TAGS, RECORD_LISTS), charset="UTF-8")


@query("read_xml_records", """
SELECT c_name AS name, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS edrpou,
       CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS address,
       CASE WHEN c_acctbal < 9000 THEN 2 END AS founders
FROM customer""")
def xml_records(spark, folder):
    with working_area(spark) as area:
        founders = F.when(F.col("FOUNDERS").isNotNull(), F.size("FOUNDERS.FOUNDER"))
        return keep(_registry_xml(spark, folder, area).select(
            F.col("NAME").alias("name"), F.col("EDRPOU").alias("edrpou"), F.col("ADDRESS").alias("address"),
            founders.alias("founders"),
        ))


@query("xml_flatten_multivalue", """
SELECT c_name AS name, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS edrpou,
       CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS address,
       CASE WHEN c_acctbal < 9000 THEN c_mktsegment || ' | P/Q & <' || c_name || '>' ELSE '' END AS founders
FROM customer""")
def xml_flat(spark, folder):
    columns = {tag.lower(): tag for tag in RECORD_TAGS}
    with working_area(spark) as area:
        return keep(flat_records(_registry_xml(spark, folder, area), columns, RECORD_LISTS))


LATIN, CYRILLIC = "ABCDEFGHIKLMNOPRSTUVYZ", "АБЦДЕФГХІКЛМНОПРСТУВИЗ"


@query("xml_to_quoted_csv", f"""
SELECT translate(c_mktsegment, '{LATIN}', '{CYRILLIC}') || ' «' || c_custkey || '»' AS name,
       'Київ, буд. ' || c_nationkey AS address, 'є "1" | Ґ/' || c_nationkey AS founders
FROM customer""")
def registry_to_csv(spark, folder):
    """Records in Windows-1251 become quoted CSV, which is read back."""
    customer = table(spark, folder, "customer")
    name = F.concat(F.translate("c_mktsegment", LATIN, CYRILLIC), F.lit(" «"), "c_custkey", F.lit("»"))
    record = F.format_string(
        "<RECORD><NAME>%s</NAME><ADDRESS>Київ,\n  буд. %s</ADDRESS>"
        "<FOUNDERS><FOUNDER>є &quot;1&quot;</FOUNDER><FOUNDER>Ґ\\%s</FOUNDER></FOUNDERS></RECORD>",
        name, F.col("c_nationkey"), F.col("c_nationkey"),
    )
    tags = ["NAME", "ADDRESS", "FOUNDERS"]
    with working_area(spark) as area:
        (_, xml), (_, csv) = area.place("xml"), area.place("quoted")
        customer.select(encode_text(record, "windows-1251")).write.text(xml)
        records = read_xml_records(spark, xml, record_schema(tags, RECORD_LISTS), charset="windows-1251")
        write_quoted_csv(flat_records(records, {t.lower(): t for t in tags}, RECORD_LISTS), csv)
        return keep(read_quoted_csv(spark, csv, strings("name", "address", "founders")))


@query("clean_text", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def cleaned_documents(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", clean_text(F.col("text")).alias("text"))


@query("read_part_files", f"""
WITH {WORDS}
SELECT CAST(part AS VARCHAR) AS part, word, count FROM placed WHERE reducers = 4""")
def part_files(spark, folder):
    with working_area(spark) as area:
        _, path = area.place("wordcount")
        write_wordcount(_document_counts(spark, folder), path, 4)
        return keep(read_part_files(spark, path))


@query("write_wordcount", f"""
WITH {WORDS}
SELECT part, word || chr(9) || count AS line FROM placed WHERE reducers = 2""")
def wordcount_lines(spark, folder):
    with working_area(spark) as area:
        _, path = area.place("wordcount")
        write_wordcount(_document_counts(spark, folder), path, 2)
        return keep(spark.read.option("lineSep", "\n").text(path).select("part", F.col("value").alias("line")))


@query("scan_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def first_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return preview(orders, 10, [F.col("o_orderkey")])


@query("register_view", f"""
WITH {COMPANIES} SELECT stan, COUNT(*) AS companies FROM companies GROUP BY stan""")
def companies_view(spark, folder):
    register_view(companies(spark, folder), "airlake_companies")
    return spark.sql("SELECT stan, COUNT(*) AS companies FROM airlake_companies GROUP BY stan")


@query("describe_table", """
SELECT col_name, data_type FROM (VALUES
    ('code', 'bigint'), ('address', 'bigint'), ('stan', 'string'), ('price', 'double'),
    ('Type', 'EXTERNAL'), ('Provider', 'parquet'), ('Num Buckets', '10'), ('Bucket Columns', '[`code`]')
) AS facts(col_name, data_type)""")
def described(spark, folder):
    facts = ["code", "address", "stan", "price", "Type", "Provider", "Num Buckets", "Bucket Columns"]
    with working_area(spark) as area:
        name, _ = _bucketed(spark, folder, area)
        return keep(describe_table(spark, name).where(F.col("col_name").isin(*facts)).select("col_name", "data_type"))


@query("input_file_of", "SELECT COUNT(*) AS rows, COUNT(*) AS rows_in_their_bucket FROM orders")
def rows_and_files(spark, folder):
    expected = F.pmod(F.hash("code"), F.lit(BUCKETS)) + 1
    with working_area(spark) as area:
        name, _ = _bucketed(spark, folder, area)
        return keep(with_input_file(spark.table(name)).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(bucket_number(F.col("file")) == expected).alias("rows_in_their_bucket"),
        ))


PER_STATE = f"""
WITH {COMPANIES}
SELECT stan, COUNT(*) AS companies, MIN(code) AS first_code, MAX(code) AS last_code,
       COUNT(DISTINCT address) AS addresses
FROM companies GROUP BY stan"""


def _per_state(df: DataFrame) -> DataFrame:
    return df.groupBy("stan").agg(
        F.count(F.lit(1)).alias("companies"), F.min("code").alias("first_code"),
        F.max("code").alias("last_code"), F.count_distinct("address").alias("addresses"),
    )


def _plain(spark, folder, area) -> tuple[str, str]:
    name, path = area.place("plain")
    write_plain(companies(spark, folder), name, path)
    return name, path


def _partitioned(spark, folder, area) -> tuple[str, str]:
    name, path = area.place("partitioned")
    write_partitioned(companies(spark, folder), name, path, "stan")
    return name, path


def _bucketed(spark, folder, area) -> tuple[str, str]:
    name, path = area.place("bucketed")
    write_bucketed(companies(spark, folder), name, path, "code", BUCKETS)
    return name, path


@query("write_plain", PER_STATE)
def plain_copy(spark, folder):
    with working_area(spark) as area:
        return keep(_per_state(spark.table(_plain(spark, folder, area)[0])))


@query("write_partitioned", PER_STATE)
def partitioned_copy(spark, folder):
    with working_area(spark) as area:
        return keep(_per_state(spark.table(_partitioned(spark, folder, area)[0])))


@query("write_bucketed", PER_STATE)
def bucketed_copy(spark, folder):
    with working_area(spark) as area:
        return keep(_per_state(spark.table(_bucketed(spark, folder, area)[0])))


@query("overwrite_load", PER_STATE)
def loaded_twice(spark, folder):
    with working_area(spark) as area:
        (name, path), (_, by_state) = area.place("loaded"), area.place("by_state")
        overwrite_load(companies(spark, folder), name, path)
        load_partitions(companies(spark, folder), by_state, "stan")
        load_partitions(companies(spark, folder), by_state, "stan")
        return keep(_per_state(overwrite_load(spark.read.parquet(by_state), name, path)))


@query("drop_rebuild", PER_STATE)
def rebuilt(spark, folder):
    with working_area(spark) as area:
        name, path = area.place("rebuilt")
        write_plain(companies(spark, folder), name, path)
        return keep(_per_state(write_plain(companies(spark, folder), name, path)))


@query("analyze_stats", "SELECT COUNT(*) AS rows, TRUE AS bytes_of_files FROM orders")
def statistics(spark, folder):
    """The rows the optimizer knows, and whether its bytes are those of the files."""
    with working_area(spark) as area:
        name, path = _plain(spark, folder, area)
        stored = file_sizes(spark, path).agg(F.sum("bytes")).first()[0]
        return keep(analyze(spark, name, ["code", "stan"]).select("rows", (F.col("bytes") == stored).alias("bytes_of_files")))


@query("analyze_columns", """
SELECT 'code' AS column, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS nulls, TRUE AS distinct_known,
       CAST(MIN(o_orderkey) AS VARCHAR) AS least, CAST(MAX(o_orderkey) AS VARCHAR) AS most, TRUE AS histogram FROM orders
UNION ALL
SELECT 'address', COUNT(*) FILTER (WHERE o_custkey IS NULL), TRUE,
       CAST(MIN(o_custkey) AS VARCHAR), CAST(MAX(o_custkey) AS VARCHAR), TRUE FROM orders""")
def analyzed_columns(spark, folder):
    """Bounds, nulls and histograms of columns, and whether the distinct values are known within a tenth."""
    with working_area(spark) as area:
        name, _ = _plain(spark, folder, area)
        own = optimizing_session(spark)
        analyze(own, name, ["code", "address"])
        known = column_statistics(own, name, ["code", "address"]).collect()
        real = spark.table(name).agg(*(F.count_distinct(c).alias(c) for c in ("code", "address"))).first()
        rows = [(r.column, r.nulls, abs(r.distinct - real[r.column]) <= real[r.column] / 10, r.least, r.most, r.bins > 0) for r in known]
        return spark.createDataFrame(rows, "column STRING, nulls BIGINT, distinct_known BOOLEAN, least STRING, most STRING, histogram BOOLEAN")


@query("join_order_by_statistics", f"""
WITH {COMPANIES}
SELECT COUNT(*) AS lines, TRUE AS reordered FROM lineitem JOIN companies ON l_orderkey = code JOIN customer ON address = c_custkey
WHERE c_custkey < 20""")
def reordered_join(spark, folder):
    """A join of three tables, written largest first: with statistics the optimizer begins with the few customers."""
    with working_area(spark) as area:
        kept = {}
        for key, df in (("lines", table(spark, folder, "lineitem").select("l_orderkey")), ("companies", companies(spark, folder)),
                        ("customers", table(spark, folder, "customer").select("c_custkey", "c_nationkey"))):
            name, path = area.place(key)
            kept[key] = name
            write_plain(df, name, path)
        sql = (
            f"SELECT COUNT(*) AS lines FROM {kept['lines']} JOIN {kept['companies']} ON l_orderkey = code "
            f"JOIN {kept['customers']} ON address = c_custkey WHERE c_custkey < 20"
        )
        own = optimizing_session(spark)
        before = join_depths(own.sql(sql), kept)
        for key, columns in (("lines", ["l_orderkey"]), ("companies", ["code", "address"]), ("customers", ["c_custkey"])):
            analyze(own, kept[key], columns)
        after = own.sql(sql)
        reordered = before["lines"] > before["customers"] and join_depths(after, kept)["lines"] < join_depths(after, kept)["customers"]
        return spark.createDataFrame([(after.first().lines, reordered)], "lines BIGINT, reordered BOOLEAN")


@query("layout_report", """
SELECT 'stan=' || o_orderstatus AS folder, COUNT(*) AS rows, COUNT(*) AS rows_of_files FROM orders GROUP BY 1""")
def partition_sizes(spark, folder):
    """Folders of a partitioned table, with the rows of the table and those counted in the files listed."""
    with working_area(spark) as area:
        name, path = _partitioned(spark, folder, area)
        stored = spark.table(name)
        rows = stored.groupBy(F.concat(F.lit("stan="), "stan").alias("folder")).agg(F.count(F.lit(1)).alias("rows"))
        listed = file_sizes(spark, path).select(F.regexp_extract("path", "/(stan=[^/]*/[^/]*)$", 1).alias("file"))
        inside = stored.groupBy(F.regexp_extract("_metadata.file_path", "/(stan=[^/]*/[^/]*)$", 1).alias("file")).agg(
            F.count(F.lit(1)).alias("n")
        )
        of_files = listed.join(inside, "file").groupBy(F.substring_index("file", "/", 1).alias("folder")).agg(
            F.sum("n").alias("rows_of_files")
        )
        report = layout_report(spark, path).where("bytes > 0 AND files > 0")
        return keep(report.join(rows, "folder").join(of_files, "folder").select("folder", "rows", "rows_of_files"))


@query("bucket_report", f"SELECT CAST(b AS INTEGER) AS bucket, TRUE AS filled, (SELECT COUNT(*) FROM orders) AS rows FROM range(1, {BUCKETS + 1}) t(b)")
def bucket_sizes(spark, folder):
    """Every bucket has files, and their rows add up to the table's."""
    with working_area(spark) as area:
        name, path = _bucketed(spark, folder, area)
        rows = with_input_file(spark.table(name)).groupBy(bucket_number(F.col("file")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        )
        report = bucket_report(spark, path).join(rows, "bucket")
        total = report.agg(F.sum("n")).first()[0]
        return keep(report.select(
            F.col("bucket").cast("int").alias("bucket"), ((F.col("bytes") > 0) & (F.col("n") > 0)).alias("filled"),
            F.lit(total).alias("rows"),
        ))


@query("split_report", "SELECT COUNT(*) AS rows, TRUE AS several, CAST(0 AS BIGINT) AS gaps, TRUE AS whole FROM orders")
def orders_splits(spark, folder):
    """One text file in pieces: they follow each other without a gap and cover it."""
    own = spark.newSession()  # other queries keep their size of pieces
    own.conf.set("spark.sql.files.maxPartitionBytes", 16384)
    with working_area(spark) as area:
        (_, path), (_, report) = area.place("lines"), area.place("splits")
        companies(spark, folder).coalesce(1).write.csv(path)
        split_report(own.read.csv(path)).write.parquet(report)
        pieces = spark.read.parquet(report)
        end = F.lag(F.col("start") + F.col("length")).over(Window.partitionBy("file").orderBy("start"))
        placed = pieces.withColumn("gap", F.col("start") != F.coalesce(end, F.lit(0)))
        stored = file_sizes(spark, path).agg(F.sum("bytes")).first()[0]
        return keep(placed.agg(
            F.sum("rows").alias("rows"), (F.count(F.lit(1)) > 1).alias("several"), F.count_if("gap").alias("gaps"),
            (F.sum("length") == stored).alias("whole"),
        ))


GRAPH_SIZES = f"""
WITH {SHIPMENTS}
SELECT 'vertices' AS "table", COUNT(*) AS rows FROM vertices
UNION ALL SELECT 'edges', COUNT(*) FROM edges"""


@query("persist_shared", GRAPH_SIZES)
def cached_graph(spark, folder):
    """Both counts are taken from memory, which is free again afterwards."""
    graph = shipments(spark, folder).cache()
    try:
        sizes = graph.sizes()
        if "InMemoryTableScan" not in sizes._jdf.queryExecution().executedPlan().toString():
            raise RuntimeError("the graph was not read from the cache")
        return keep(sizes)
    finally:
        graph.unpersist()


@query("checkpoint_iter", f"""
WITH {ROUTE_EDGES}
SELECT src, COUNT(*) AS destinations, SUM(airlines)::BIGINT AS airlines FROM route_edges GROUP BY src""")
def checkpointed_edges(spark, folder):
    edges = cut_lineage(route_edges(spark, folder))
    return edges.groupBy("src").agg(
        F.count(F.lit(1)).alias("destinations"), F.sum("airlines").alias("airlines")
    )


@query("scan_partition_pruned", f"SELECT COUNT(*) AS companies FROM orders WHERE o_orderstatus = '{STATE}'")
def one_partition(spark, folder):
    with working_area(spark) as area:
        partitioned = spark.table(_partitioned(spark, folder, area)[0])
        return keep(partitioned.where(F.col("stan") == STATE).agg(F.count(F.lit(1)).alias("companies")))


POINT = f"""
WITH {COMPANIES} SELECT code, address, stan FROM companies WHERE code = {CODE}"""


@query("point_lookup_bucketed", POINT)
def one_bucket(spark, folder):
    with working_area(spark) as area:
        bucketed = spark.table(_bucketed(spark, folder, area)[0])
        return keep(bucketed.where(F.col("code") == CODE).select("code", "address", "stan"))


@query("bucket_sample", f"""
SELECT CAST(1 AS BIGINT) AS files_read, COUNT(*) AS wanted, CAST(0 AS BIGINT) AS strays FROM orders WHERE o_orderkey = {CODE}""")
def sampled_bucket(spark, folder):
    """The bucket of one code: one file is read, the code is there, and nothing of other buckets."""
    with working_area(spark) as area:
        bucketed = spark.table(_bucketed(spark, folder, area)[0])
        bucket = bucket_of(spark, CODE, "bigint", BUCKETS)
        sample = bucket_sample(bucketed, "code", bucket, BUCKETS, stored=True)
        files = scan_work(sample.select("code"))["files_read"]
        own = F.pmod(F.hash("code"), F.lit(BUCKETS)) == bucket - 1
        return keep(sample.agg(
            F.lit(files).cast("long").alias("files_read"), F.count_if(F.col("code") == CODE).alias("wanted"),
            F.count_if(~own).alias("strays"),
        ))


@query("bucket_sample_all", "SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS codes FROM orders")
def all_buckets_sampled(spark, folder):
    """Samples of all buckets, each read from its own files, add up to the table."""
    with working_area(spark) as area:
        bucketed = spark.table(_bucketed(spark, folder, area)[0])
        samples = [bucket_sample(bucketed, "code", b, BUCKETS, stored=True).select("code") for b in range(1, BUCKETS + 1)]
        return keep(reduce(DataFrame.union, samples).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("code").alias("codes")
        ))


@query("compare_layouts", f"""
WITH {COMPANIES},
found AS (
    SELECT 'filter' AS lookup, COUNT(*) AS answer FROM companies WHERE stan = '{STATE}'
    UNION ALL SELECT 'point', COUNT(*) FROM companies WHERE code = {CODE}
),
layouts AS (
    SELECT layout, lookup, answer,
           CASE WHEN layout = 'partitioned' AND lookup = 'filter' THEN (SELECT COUNT(DISTINCT stan) - 1 FROM companies)
                WHEN layout = 'bucketed' AND lookup = 'point' THEN {BUCKETS} - 1 ELSE 0 END AS files_skipped,
           CASE WHEN lookup = 'filter' AND layout IN ('csv', 'partitioned') THEN answer
                WHEN lookup = 'filter' THEN (SELECT COUNT(*) FROM companies) END AS rows_read
    FROM found CROSS JOIN (VALUES ('csv'), ('plain'), ('partitioned'), ('bucketed')) AS l(layout)
)
SELECT * FROM layouts""")
def layouts_compared(spark, folder):
    """A filter and a point lookup on four layouts, each with the files and rows its scan really took.

    CSV drops other rows while it parses all files; the rows a point lookup takes from
    Parquet depend on row groups and are left out.
    """
    source = companies(spark, folder)
    with working_area(spark) as area:
        _, csv = area.place("csv")
        write_quoted_csv(source, csv)
        stored = {"plain": _plain, "partitioned": _partitioned, "bucketed": _bucketed}
        placed = {layout: write(spark, folder, area) for layout, write in stored.items()}
        layouts = {"csv": read_quoted_csv(spark, csv, strings(*source.columns))}
        layouts |= {layout: spark.table(name) for layout, (name, _) in placed.items()}
        lookups = {"filter": F.col("stan") == STATE, "point": F.col("code") == CODE}
        report = compare_layouts(
            spark,
            {name: {layout: df.where(rule) for layout, df in layouts.items()} for name, rule in lookups.items()},
            {"csv": csv, **{layout: path for layout, (_, path) in placed.items()}},
        )
        return report.select(
            "layout", "lookup", "answer", (F.col("files") - F.col("files_read")).alias("files_skipped"),
            F.when(F.col("lookup") == "filter", F.col("rows_read")).alias("rows_read"),
        )


@query("format_bytes", """
SELECT doc_id, n_chars,
       CASE WHEN n_chars < 1024 THEN n_chars || ' B'
            WHEN n_chars < 1048576 THEN printf('%.1f KB', n_chars / 1024) ELSE printf('%.1f MB', n_chars / 1048576) END AS size
FROM documents""")
def document_sizes(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", "n_chars", format_bytes(F.col("n_chars")).alias("size")
    )


@query("file_bucket_number", f"""
SELECT CAST(b AS INTEGER) AS bucket, CAST(0 AS BIGINT) AS strays FROM range(1, {BUCKETS + 1}) t(b)""")
def buckets_by_name(spark, folder):
    """The number in each file's name, and the rows there that hash to another bucket."""
    with working_area(spark) as area:
        bucketed = spark.table(_bucketed(spark, folder, area)[0])
        number = bucket_number(F.col("_metadata.file_name")).cast("int").alias("bucket")
        strays = F.count_if(F.pmod(F.hash("code"), F.lit(BUCKETS)) + 1 != F.col("bucket")).alias("strays")
        return keep(bucketed.select(number, "code").groupBy("bucket").agg(strays))


@query("fill_null", f"""
WITH {ROUTES} SELECT COALESCE(codeshare, '') AS codeshare, COUNT(*) AS routes FROM routes GROUP BY 1""")
def filled(spark, folder):
    return routes(spark, folder).na.fill("", ["codeshare"]).groupBy("codeshare").agg(
        F.count(F.lit(1)).alias("routes")
    )
