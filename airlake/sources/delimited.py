"""Delimited text with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# How the two kinds of input file spell things.
NULL_MARK = "\\N"
QUOTED = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    # These files know no missing values; a line end can be in no field, so nothing is taken for the mark.
    "nullValue": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def strings(*names: str) -> StructType:
    """An all-string schema: codes keep their leading zeros."""
    return StructType([StructField(name, StringType()) for name in names])


def typed(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D = StringType(), IntegerType(), DoubleType()

# The columns of the input files, in file order.
COMPANIES = strings("name", "edrpou", "address", "boss", "founders", "kved", "stan")
PROPRIETORS = strings("fio", "address", "kved", "stan")
AIRPORTS = typed(
    id=_I, name=_S, city=_S, country=_S, iata=_S, icao=_S, latitude=_D, longitude=_D,
    altitude=_I, timezone=_D, dst=_S, tz=_S, type=_S, source=_S,
)
AIRLINES = typed(id=_I, name=_S, alias=_S, iata=_S, icao=_S, callsign=_S, country=_S, active=_S)
ROUTES = typed(
    airline=_S, airline_id=_I, src=_S, src_id=_I, dst=_S, dst_id=_I, codeshare=_S, stops=_I, equipment=_S,
)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Quoted fields, a header per file, ``""`` for a quote, empty fields stay empty strings.

    One record per line, so large files are split between tasks.
    """
    return spark.read.csv(path, schema=schema, **QUOTED)


def read_headerless_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, nullValue=NULL_MARK)
