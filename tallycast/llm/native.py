"""Column expressions shared by the operators that use built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\u000b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def no_strings() -> Column:
    return F.expr("cast(array() as array<string>)")


def split_words(text: Column) -> Column:
    """Words of a text in order; none for null and blank texts."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(no_strings())


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_share(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of a key as text leaves ``part`` when divided by ``parts``; false for null."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))
