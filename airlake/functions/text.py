"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words of a count, and what counts as white space when cleaning.
WORD_SEPARATORS = r"[ \t\n\r\f]+"
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def clean_text(column: Column) -> Column:
    """Backslashes become slashes, white-space runs one space, ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(column, "\\", "/"), WHITE_SPACE, " "))


def words(column: Column) -> Column:
    """Array of the white-space separated words, as they are written."""
    return F.array_remove(F.split(column, WORD_SEPARATORS), "")


def hash_part(word: Column, parts: Column | int) -> Column:
    """Output part of a word, 0 … parts-1, the same on every engine (from MD5)."""
    number = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(parts) if isinstance(parts, int) else parts).cast("int")
