"""Names, previews and metadata of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a DataFrame available to ``spark.sql`` and return it read back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def external_table(
    spark: SparkSession, name: str, path: str, schema: StructType, source: str = "csv", **options: str
) -> DataFrame:
    """Table over files that stay where they are when the table is dropped."""
    return spark.catalog.createTable(name, path=path, source=source, schema=schema, **options)


def preview(df: DataFrame, n: int = 10, order: list[Column] | None = None) -> DataFrame:
    """A few rows to look at; ordered when the same rows are wanted every time."""
    return (df.orderBy(*order) if order else df).limit(n)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns, type, location, format and buckets of a table, without NULLs."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").na.fill("")


def with_input_file(df: DataFrame, name: str = "file") -> DataFrame:
    """Add the name of the file each row was read from; apply right after a scan."""
    return df.withColumn(name, F.col("_metadata.file_name"))
