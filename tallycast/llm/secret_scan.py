"""Secret scans over a ledger of blobs.

Texts are content-addressed: a blob is the SHA-256 of a text.  A scan takes the
distinct blobs, leaves out every pair of blob and rule version that the ledger
already holds, and appends one row per blob it had to open: the rules it ran
and the spans it found, also when there are none.  Findings are joined back to
every path (row) with that content, so copies and unchanged versions cost a
hash and never a second scan.  Changing a rule's version scans the blobs again
with that rule only.

Spans are counted in code points, the end exclusive; within one rule matches
are leftmost and do not overlap.  A null text counts as the empty text, which
has no findings.  Rows without an id and repeated rows each get the findings
of their content.

Everything is built-in functions.  Spans come from a text in which each match
is put between marks; the lengths of the parts are the places.  Only texts
that match at all are marked.  Copies collapse before the shuffle, since
distinct blobs are a grouping with map-side combining; the way back is a plain
join on the blob, which adaptive execution splits where one blob is hot.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks around matches; a mark that a text itself holds is exchanged for another
# character of the same length that no rule can match.
MARK, OTHER = "\u0001", "\u0002"
STEP = 256
FINDING = "struct<start:int,kind:int,end:int>"


@dataclass(frozen=True)
class Rule:
    """A pattern of one kind; matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their order.  A run of the last two kinds is always
# taken whole, so the shortest accepted length can stand in the pattern.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
RULES = BASE_RULES + (
    Rule("key_block", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("login_url", 1, r"[a-z]{3,12}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._-]{4,64}@[A-Za-z0-9]"),
)


def no_findings() -> Column:
    return F.expr(f"cast(array() as array<{FINDING}>)")


def _rows_of_parts(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``parts_N``: the text between and inside the matches of rule N, in turn; null without a match."""
    def parts(rule: Rule) -> Column:
        plain = F.translate("text", MARK, OTHER)
        marked = F.regexp_replace(plain, rule.pattern, f"{MARK}$0{MARK}")
        wanted = F.col("text").rlike(rule.pattern) & ~F.array_contains("done", F.lit(rule.key))
        return F.when(wanted, F.split(marked, MARK))

    return blobs.select("blob", "done", *[parts(rule).alias(f"parts_{n}") for n, rule in enumerate(rules)])


def _lengths(parts: str) -> Column:
    return F.transform(parts, lambda part: F.length(part))


def _sums(lengths: str) -> Column:
    """Sums of every STEP lengths, so that a place needs few additions in long texts too."""
    return F.transform(
        F.sequence(F.lit(0), (F.size(lengths) / STEP).cast("int")),
        lambda k: F.aggregate(F.slice(lengths, k * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, b: a + b))


def _findings(rule: Rule, place: int, n: int) -> Column:
    total = lambda array: F.aggregate(array, F.lit(0), lambda a, b: a + b)

    def span(part: Column, i: Column) -> Column:
        full = (i / STEP).cast("int")
        start = total(F.slice(f"sums_{n}", F.lit(1), full)) + total(
            F.slice(f"lengths_{n}", full * STEP + 1, i - full * STEP))
        good = (i % 2 == 1) & (F.length(F.regexp_extract(part, rule.pattern, rule.group)) >= rule.least)
        return F.when(good, F.struct(
            start.alias("start"), F.lit(place).alias("kind"), (start + F.length(part)).alias("end")))

    found = F.filter(F.transform(f"parts_{n}", span), lambda one: one.isNotNull())
    return F.coalesce(found.cast(f"array<{FINDING}>"), no_findings())


def _scanned(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    rows, numbers = _rows_of_parts(blobs, rules), range(len(rules))
    rows = rows.withColumns({f"lengths_{n}": _lengths(f"parts_{n}") for n in numbers})
    rows = rows.withColumns({f"sums_{n}": _sums(f"lengths_{n}") for n in numbers})
    every = F.array(*[F.lit(rule.key) for rule in rules])
    found = F.concat(*[_findings(rule, n, n) for n, rule in enumerate(rules)])
    return rows.select(
        "blob", F.array_except(every, "done").alias("rules"), F.sort_array(found).alias("findings"))


def address(text: Column) -> Column:
    """The blob of a text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, *, text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """New ledger rows: ``blob``, ``rules`` run on it now, ``findings``.

    ``ledger`` holds such rows of earlier scans; blobs on which every rule has
    run are not opened.  Kinds in findings are places in ``rules``.
    """
    none = F.expr("cast(array() as array<string>)")
    contents = docs.select(address(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("text"))
    if ledger is None:
        return _scanned(contents.dropDuplicates(["blob"]).withColumn("done", none), rules)
    known = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("done"))
    every = F.array(*[F.lit(rule.key) for rule in rules])
    finished = known.where(F.size(F.array_except(every, "done")) == 0).select("blob")
    unseen = contents.join(finished, "blob", "left_anti").dropDuplicates(["blob"])
    unseen = unseen.join(known, "blob", "left").withColumn("done", F.coalesce("done", none))
    return _scanned(unseen, rules)


def findings_by_path(
    docs: DataFrame, ledger: DataFrame, *, doc_id: str = "doc_id", text: str = "text", one_scan: bool = False,
) -> DataFrame:
    """``doc_id`` and ``findings`` of every row; ``one_scan`` says that each blob has one ledger row."""
    per_blob = ledger.select("blob", "findings")
    if not one_scan:
        per_blob = per_blob.groupBy("blob").agg(
            F.sort_array(F.flatten(F.collect_list("findings"))).alias("findings"))
    paths = docs.select(F.col(doc_id).alias("doc_id"), address(F.col(text)).alias("blob"))
    return paths.join(per_blob, "blob", "left").select(
        "doc_id", F.coalesce("findings", no_findings()).alias("findings"))


def span_text(findings: str, kinds: tuple[int, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of the findings of some kinds, in order, joined by commas."""
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    chosen = F.filter(findings, lambda one: one["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda one: F.concat_ws(
        ":", F.get(names, one["kind"]), one["start"].cast("string"), one["end"].cast("string"))), ",")


def count_of(findings: str, kind: int) -> Column:
    return F.size(F.filter(findings, lambda one: one["kind"] == kind)).cast("long")
