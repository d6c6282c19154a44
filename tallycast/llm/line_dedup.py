"""Removal of line passages that occur earlier in the corpus.

Overlapping windows of three consecutive lines are hashed and found globally.
The first place of a window, by document id and line, stays; every line that a
later occurrence covers goes.  Covered lines are merged into intervals, and the
text is put together from the lines between them.

Windows are compared by two independent 64-bit hashes.  A window without any
word never counts, so blank lines stay.  Null and empty texts and texts of
fewer than three lines come back as they are.  Rows with one document id and one
text are one document.  Different texts under one id are different documents at the
same places: each is cut by its own lines alone, and a window that they hold at the
same line stays in all of them.  Rows without an id come back as they are, and an
empty table gives no rows.

The first places are a grouping with map-side combining, so a passage that a
third of all documents share is one row per task there; the join that brings
them back moves only windows that occur twice, and its other side is a plain
table, so adaptive execution can split a hot window.  What is grouped by
document is bounded by the lines of that document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.native import WORD
from tallycast.llm.storage import cut_shuffled, packed, unpacked

LINES = 3
# Places are document id times this plus the line, as a decimal that holds any id.
PLACES = 10_000_000_000


def _windows(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """One row per window with a word: ``doc_id``, ``copy`` (a hash of the text), ``line``,
    two hashes."""
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("copy"),
        F.split(text, "\n").alias("lines")).where(F.size("lines") >= width)
    rows = rows.select(
        "doc_id", "copy",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("one"),
        F.transform("lines", lambda line: F.xxhash64(F.lit(1), line)).alias("two"),
        F.transform("lines", lambda line: line.rlike(WORD)).alias("full"))
    at = lambda name, i: [F.get(name, i + k) for k in range(width)]
    found = F.transform(F.sequence(F.lit(0), F.size("one") - width), lambda i: F.struct(
        i.alias("line"), F.xxhash64(*at("one", i)).alias("one"), F.xxhash64(F.lit(1), *at("two", i)).alias("two"),
        F.greatest(*at("full", i)).alias("full")))
    return rows.select("doc_id", "copy", F.inline(found)).where("full").drop("full")


def _place(doc_id: str, line: str) -> Column:
    return (F.col(doc_id).cast("decimal(20,0)") * PLACES + F.col(line)).cast("decimal(38,0)")


def covered_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = LINES,
) -> DataFrame:
    """``doc_id``, ``copy`` and ``cuts``: the merged intervals of lines to remove, as an array
    of (first, past) in order.  Documents without any have no row."""
    windows = _windows(docs, doc_id, text, width).withColumn("place", _place("doc_id", "line"))
    first = windows.groupBy("one", "two").agg(
        F.min("place").alias("first_place"), F.max("place").alias("last_place"))
    repeated = cut_shuffled(first.where("first_place < last_place").drop("last_place"))
    later = windows.join(repeated, ["one", "two"]).where("place > first_place")
    # Sorted starts become intervals wherever the next window begins past the end.
    starts = later.groupBy("doc_id", "copy").agg(F.array_sort(F.collect_set("line")).alias("at"))
    edges = starts.select(
        "doc_id", "copy", "at",
        F.filter("at", lambda line, i: F.coalesce(line > F.get("at", i - 1) + width, F.lit(True))).alias("opens"),
        F.transform(
            F.filter("at", lambda line, i: F.coalesce(line + width < F.get("at", i + 1), F.lit(True))),
            lambda line: line + width).alias("closes"))
    return edges.select("doc_id", "copy", F.arrays_zip(
        F.col("opens").alias("first"), F.col("closes").alias("past")).alias("cuts"))


def dedup_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = LINES,
) -> DataFrame:
    """``docs`` with the covered lines taken out of the text.  Three columns are
    added, and replace any of these names: ``n_lines``, ``n_removed`` and ``cuts``."""
    found = covered_lines(docs, doc_id=doc_id, text=text, width=width).select(
        F.col("doc_id").alias("cut_id"), "copy", "cuts")
    joined = packed(docs, doc_id, text).join(
        found, (F.col(doc_id) == F.col("cut_id")) & (F.xxhash64(text) == F.col("copy")), "left")
    # Lines are split and joined again only where something goes.
    joined = joined.withColumn("lines", F.when(F.col("cuts").isNotNull(), F.split(text, "\n")))
    starts = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda cut: cut["past"]))
    ends = F.concat(F.transform("cuts", lambda cut: cut["first"]), F.array(F.size("lines")))
    between = F.arrays_zip(starts.alias("first"), ends.alias("past"))
    stay = F.flatten(F.transform(
        between, lambda part: F.slice("lines", part["first"] + 1, part["past"] - part["first"])))
    removed = F.aggregate("cuts", F.lit(0), lambda total, cut: total + cut["past"] - cut["first"])
    breaks = F.regexp_count(text, F.lit("\n"))
    added = {
        "n_lines": F.when(F.length(text) > 0, breaks + 1).otherwise(0).cast("long"),
        "n_removed": F.coalesce(removed, F.lit(0)).cast("long"), "cuts": F.col("cuts")}
    cleaned = F.when(F.col("cuts").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    own = [cleaned.alias(name) if name == text else column
           for name, column in zip(docs.columns, unpacked(docs, doc_id, text)) if name not in added]
    return joined.select(*own, *[column.alias(name) for name, column in added.items()])
