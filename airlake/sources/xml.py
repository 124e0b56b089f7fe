"""Registry records in XML, read in parallel from one large file."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from airlake.functions.text import clean_text
from airlake.sources.xml_pieces import whole_records

MULTI_VALUE_SEPARATOR = " | "


@lru_cache
def _upper_half(charset: str) -> tuple[str, str]:
    """Bytes 128–255 as Latin-1 and as the given charset, which must have one byte per character.

    A byte the charset leaves undefined becomes a replacement mark.
    """
    lower, codes = bytes(range(128)), [bytes([b]) for b in range(128, 256)]
    wanted = [c.decode(charset, "replace") for c in codes]
    single = sum(len(w) == 1 and w != "\ufffd" and w.encode(charset) == c for c, w in zip(codes, wanted))
    if lower.decode(charset, "replace") != lower.decode("ascii") or single < 100 or any(len(w) != 1 for w in wanted):
        raise ValueError(f"{charset} is neither UTF-8 nor a charset of one byte per character over ASCII")
    return "".join(c.decode("latin-1") for c in codes), "".join(wanted)


def _is_utf8(charset: str) -> bool:
    return charset.lower() in ("utf-8", "utf8")


def decode_bytes(column: Column, charset: str) -> Column:
    """Text of a column holding undecoded bytes, UTF-8 or any single-byte charset; an error for others."""
    if _is_utf8(charset):
        return column
    latin, wanted = _upper_half(charset)
    return F.translate(F.decode(column.cast("binary"), "iso-8859-1"), latin, wanted)


def encode_text(column: Column, charset: str) -> Column:
    """The bytes of a text in such a charset, as a column to be written by a text sink."""
    if _is_utf8(charset):
        return column
    latin, wanted = _upper_half(charset)
    defined = [(w, x) for w, x in zip(wanted, latin) if w != "\ufffd"]
    as_latin = F.translate(column, "".join(w for w, _ in defined), "".join(x for _, x in defined))
    return F.encode(as_latin, "iso-8859-1").cast("string")


def record_schema(tags: list[str], lists: dict[str, str] | None = None) -> StructType:
    """All-string leaf tags; ``lists`` maps a tag to the name of its repeated child."""
    lists = lists or {}
    fields = []
    for tag in tags:
        kind = StructType([StructField(lists[tag], ArrayType(StringType()))]) if tag in lists else StringType()
        fields.append(StructField(tag, kind))
    return StructType(fields)


def read_xml_records(
    spark: SparkSession, path: str, schema: StructType, row_tag: str = "RECORD", charset: str = "windows-1251"
) -> DataFrame:
    """One row per ``row_tag`` element.

    The closing tag is the line separator of a text scan, so one uncompressed file
    is cut into as many splits as its size asks for; each piece is then parsed by
    the built-in XML function. A closing tag inside a comment or a CDATA section is text: files with
    either are read once more beforehand, to put such pieces together (``whole_records``).
    """
    closing = f"</{row_tag}>"
    pieces = spark.read.option("lineSep", closing).text(path)
    if not pieces.where(F.col("value").contains("<!--") | F.col("value").contains("<![CDATA[")).isEmpty():
        pieces = whole_records(pieces, closing, row_tag)
    text = decode_bytes(F.col("value"), charset)
    element = F.concat(F.regexp_extract(text, rf"(?s)<{row_tag}[\s>].*", 0), F.lit(closing))
    return (
        pieces.where(F.col("value").rlike(rf"<{row_tag}[\s>]"))
        .select(F.from_xml(element, schema).alias("record"))
        .select("record.*")
    )


def leaf_text(column: Column) -> Column:
    """A leaf tag as clean text, ``''`` when missing."""
    return F.coalesce(clean_text(column), F.lit(""))


def flatten_multivalue(children: Column) -> Column:
    """Repeated children as clean text joined by `` | ``, ``''`` when missing."""
    cleaned = F.transform(children, leaf_text)
    return F.coalesce(F.array_join(cleaned, MULTI_VALUE_SEPARATOR), F.lit(""))


def flat_records(records: DataFrame, columns: dict[str, str], lists: dict[str, str] | None = None) -> DataFrame:
    """Records as flat rows: ``columns`` maps an output column to its tag."""
    lists = lists or {}
    return records.select(
        *(
            (flatten_multivalue(F.col(f"{tag}.{lists[tag]}")) if tag in lists else leaf_text(F.col(tag))).alias(name)
            for name, tag in columns.items()
        )
    )
