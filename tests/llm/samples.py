"""Small documents with the awkward cases, and columns whose names operators use inside."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(name, T.StringType()) for name in (
        "key", "n", "row", "rest", "cuts", "size", "parts", "turn", "label", "blob", "ids", "lang_pred", "share",
        "number", "taken", "kept_id", "words", "failures")]])
EXTRA = len(SCHEMA) - 5


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def frame(spark, rows):
    """Documents from (doc_id, text[, lang, source]) tuples."""
    full = []
    for doc_id, text, *others in rows:
        lang, source = [*others, "en", "src1"][:2] if len(others) < 2 else others
        full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * EXTRA))
    return spark.createDataFrame(full, SCHEMA)


def awkward():
    """Nulls, empty and blank texts, a very long word and a long text, repeated rows, ties."""
    long = prose(9, 20_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "x" * 100_000), (6, long), (7, prose(1, 120)), (7, prose(1, 120)),
        (8, prose(1, 120)), (None, prose(2, 60)), (None, None), (9, "same " * 300), (10, "a\n\nb\n\n\n\n\n\n"),
        (11, "ünïcode     \U0001f600 \u0001 text"), (12, prose(3, 90), None, None), (13, prose(4, 40), "de", None)]
