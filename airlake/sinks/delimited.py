"""Delimited output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.sinks.publish import publish
from airlake.sources.delimited import QUOTED


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """Header, every field quoted, UTF-8, LF; missing values as empty strings.

    A record is a line, so that large files can be split; a line break inside a value is
    an error. The files are written beside ``path`` and published whole by a rename: a write
    that fails leaves what was there.
    """
    def field(name: str):
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        broken = F.raise_error(F.lit(f"line break in column {name}; clean the text first")).cast("string")
        return F.when(value.rlike("[\r\n]"), broken).otherwise(value).alias(name)

    fields = df.select(*map(field, df.columns))
    publish(df.sparkSession, path, lambda staged: fields.write.csv(staged, quoteAll=True, lineSep="\n", **QUOTED))
