"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps one bit for each
rule that failed and the measurements behind it; policies are sets of rules
with a version, applied to the bits later, and ablations are counted from the
bits alone.  All of it is built-in functions in one pass without a shuffle;
only the ablation report groups, by bit pattern.

Null, empty and blank texts have no words: all measurements are 0 and the rule
``few_words`` fails.  Repeated rows get one result each.  Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.native import WORD, no_strings, split_words

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


@dataclass(frozen=True)
class Rule:
    """A named SQL condition on the measurements; true means failure."""

    name: str
    failed: str


# The order gives the bits; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("capitals", "100 * n_upper > 50 * word_chars"),
)
BASE = ("few_words", "repeated_words")
# Policies by version: the rules that reject a document.
POLICIES = {
    "base-1": BASE,
    "full-1": tuple(rule.name for rule in RULES),
}
CURRENT = "full-1"


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    places = {rule.name: place for place, rule in enumerate(rules)}
    return reduce(lambda mask, name: mask | 1 << places[name], names, 0)


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document with all measurements.

    Steps are separate projections, since a lambda would compute again for
    each element whatever is not a column.
    """
    lines = F.filter(F.split(F.coalesce("_text", F.lit("")), "\n"), lambda line: line.rlike(WORD))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = rows.select(
        "doc_id", split_words(F.col("_text")).alias("_words"), lines.alias("_lines"),
        F.coalesce(F.regexp_count("_text", F.lit("[#*$%&|<>]")), F.lit(0)).alias("n_symbols"),
        F.coalesce(F.regexp_count("_text", F.lit(r"\p{Lu}")), F.lit(0)).alias("n_upper"))
    rows = rows.select(
        "doc_id", "n_symbols", "n_upper",
        F.size("_words").alias("n_words"), F.length(F.array_join("_words", "")).alias("word_chars"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"))
    runs = F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])))
    rows = rows.withColumn("_runs", runs)
    # Sorting happens only in the texts that hold some run twice.
    pairs = F.when(
        F.size(F.array_distinct("_runs")) < F.size("_runs"),
        F.sort_array(F.transform("_runs", lambda run, i: F.struct(run.alias("run"), i.alias("at")))))
    rows = rows.withColumn("_pairs", pairs)
    places = F.array_sort(F.transform(
        F.filter("_pairs", lambda pair, i: F.coalesce(pair["run"] == F.get("_pairs", i - 1)["run"], F.lit(False))
                 | F.coalesce(pair["run"] == F.get("_pairs", i + 1)["run"], F.lit(False))),
        lambda pair: pair["at"]))
    rows = rows.withColumn("_places", places)
    # Windows overlap: each adds the words up to the next one, the last all of its own.
    steps = F.transform("_places", lambda at, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - at, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda total, step: total + step), F.lit(0))
    rows = rows.withColumn("n_repeat_words", covered).select(
        "doc_id", *[F.col(name).cast("long").alias(name) for name in MEASURES],
        F.monotonically_increasing_id().alias("_number"))
    # The row number keeps filters above the steps: pushed down, a condition would be
    # written out over the text, with every step repeated wherever it is used.
    return rows.withColumn("n_repeat_words", F.when(F.col("_number") >= 0, F.col("n_repeat_words"))).drop("_number")


def ledger(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``doc_id``, the measurements and ``failures``, a bit for each failed rule."""
    bits = reduce(
        lambda total, bit: total.bitwiseOR(bit),
        [F.when(F.expr(rule.failed), F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
         for place, rule in enumerate(rules)])
    return _measured(docs, doc_id, text).withColumn("failures", bits)


def passes(policy: str = CURRENT, failures: Column | str = "failures") -> Column:
    """Whether no rule of a policy failed."""
    column = F.col(failures) if isinstance(failures, str) else failures
    return column.bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail nothing else, and
    that the policy would keep without it.  Documents are counted by bit pattern
    first, so that what is compared afterwards is at most two to the rules."""
    patterns = rows.groupBy("failures").agg(F.count("*").alias("n"))
    mask = mask_of(POLICIES[policy], rules)
    each = F.explode(F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << place).cast("long").alias("bit"))
        for place, rule in enumerate(rules) if mask >> place & 1]))
    found = F.col("failures").bitwiseAND(F.lit(mask).cast("long"))
    opened = patterns.select("n", found.alias("found"), each.alias("of")).select("n", "found", "of.*")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return opened.groupBy("rule").agg(
        total(F.col("found").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(F.col("found") == F.col("bit")).alias("failing_alone"),
        total(F.col("found").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"))


def kept_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` whose text passes a policy, with the columns they had.
    The text decides, so rows without an id are judged like any other."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"), F.col("text"))
    judged = ledger(packed, doc_id="row")
    return judged.where(passes(policy)).select(*[F.col("doc_id")[name].alias(name) for name in names])
