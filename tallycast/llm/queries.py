"""Registered queries of the operators, and the SQL of those that SQL can express.

Each query applies its operator to the whole table with production parameters
and derives the columns of its contract from the operator's result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import (
    byte_bpe, compression_quality, fill_middle, language_id, lexical_search, line_dedup, mixing, near_dedup, passages,
    quality_rules, secret_scan, toxicity, vector_dedup)
from tallycast.llm.native import crc_share
from tallycast.session import ensure_checkpoint_dir


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_collinear_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that share fuzzy passages of 50 words or more, by class."""
    return passages.passage_classes(documents(spark, sf))


def op2_line_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the three-line windows that occur earlier."""
    return line_dedup.dedup_lines(documents(spark, sf)).select(
        "doc_id", "n_lines", "n_removed", "text")


def op3_compression_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document; a third of the ids is held out of fitting."""
    docs = documents(spark, sf).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(~crc_share(F.col("doc_id"), 3, 1))
    model = compression_quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = compression_quality.score(docs, model)
    return scored.select(
        "doc_id", crc_share(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def _ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and digests of the ids of each text and of what they decode to."""
    path, pattern = _ranks()
    return byte_bpe.round_trip(docs.select("doc_id", "text"), path, pattern).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    return bpe_digests(documents(spark, sf))


def op5_rule_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the current policy."""
    rows = quality_rules.ledger(documents(spark, sf))
    base = ~quality_rules.passes("base-1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & quality_rules.passes()).alias("kept"), "failures")


def op6_weighted_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dedup.near_classes(documents(spark, sf)).drop("standing")


def op7_string_kernel(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; a quarter of the ids is held out of fitting."""
    docs = documents(spark, sf)
    held_out = crc_share(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.where(~held_out).select("doc_id", "text", F.col("lang").alias("label")))
    scored = language_id.classify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixed_documents(documents(spark, sf)).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op9_cross_polytope(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of the vectors of each label."""
    return vector_dedup.vector_classes(spark.read.parquet(f"{sf}/embeddings.parquet"))[0]


def op10_secret_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document, from a ledger of two scans: half of the documents by the
    base rules, then all of them by all rules, which opens what the ledger lacks."""
    docs = documents(spark, sf).select("doc_id", "text")
    ensure_checkpoint_dir(spark)
    ledger = f"{spark.sparkContext.getCheckpointDir()}/secrets-{uuid.uuid4().hex}"
    first = docs.where(crc_share(F.col("doc_id"), 2, 0))
    secret_scan.scan(first, rules=secret_scan.BASE_RULES).write.parquet(f"{ledger}/scan=1")
    secret_scan.scan(docs, spark.read.parquet(f"{ledger}/scan=1")).write.parquet(f"{ledger}/scan=2")
    found = secret_scan.findings_by_path(docs, spark.read.parquet(ledger))
    base = tuple(range(len(secret_scan.BASE_RULES)))
    return found.select(
        "doc_id", *[secret_scan.count_of("findings", kind).alias(f"n_{secret_scan.RULES[kind].kind}") for kind in base],
        F.sha2(secret_scan.span_text("findings", base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text("findings", tuple(range(len(secret_scan.RULES)))).alias("spans"))


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every text arranged for filling in the middle, and rebuilt from that, as digests."""
    rows = fill_middle.transform(documents(spark, sf).select("doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op12_subword_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the ids is held out of fitting."""
    docs = documents(spark, sf).select("doc_id", "text")
    held_out = crc_share(F.col("doc_id"), 5, 0)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(~held_out)
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op13_lemp_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


QUERIES = {query.__name__: query for query in (
    op1_collinear_passages, op2_line_windows, op3_compression_quality, op4_byte_bpe, op5_rule_ledger,
    op6_weighted_minhash, op7_string_kernel, op8_mixture, op9_cross_polytope, op10_secret_ledger,
    op11_fill_middle, op12_subword_toxicity, op13_lemp_search)}

LINES_SQL = """
WITH cut AS (
  SELECT doc_id, text, CASE WHEN length(text) > 0 THEN string_split(text, chr(10)) ELSE [] END AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS line FROM cut WHERE len(lines) >= 3
),
shown AS (
  SELECT doc_id, line, lines[line + 1:line + 3] AS w FROM windows
  WHERE regexp_matches(array_to_string(lines[line + 1:line + 3], ' '), '[^\\x20\\x09-\\x0D]')
),
later AS (
  SELECT doc_id, line FROM (
    SELECT doc_id, line, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS turn FROM shown)
  WHERE turn > 1
),
covered AS (SELECT DISTINCT doc_id, unnest([line, line + 1, line + 2]) AS line FROM later),
gone AS (SELECT doc_id, list(line) AS gone FROM covered GROUP BY doc_id)
SELECT c.doc_id, CAST(len(c.lines) AS BIGINT) AS n_lines, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed,
       CASE WHEN g.gone IS NULL THEN c.text ELSE array_to_string(
         [x FOR x, i IN c.lines IF NOT list_contains(g.gone, i - 1)], chr(10)) END AS text
FROM cut c LEFT JOIN gone g ON c.doc_id = g.doc_id
"""

RULES_SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents
),
windows AS (
  SELECT row, words[i:i + 7] AS w, i FROM (
    SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM cut WHERE len(words) > 8)
),
twice AS (SELECT row, unnest(list(i)) AS i FROM windows GROUP BY row, w HAVING count(*) > 1),
repeated AS (
  SELECT row, count(*) AS n FROM (SELECT DISTINCT row, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY row
),
counted AS (
  SELECT c.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(t, '\\p{Lu}')) AS BIGINT) AS n_upper
  FROM cut c LEFT JOIN repeated r ON c.row = r.row
),
judged AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
    + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT
    + 32 * (100 * n_upper > 50 * word_chars)::INT AS BIGINT) AS failures FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) > 0 AS base_failed, failures = 0 AS kept, failures FROM judged
"""


def _secrets_sql() -> str:
    """Matches between marks, places from the lengths of the parts, one rule after another."""
    parts = []
    for n, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT row, {n} AS kind, list_sum([length(x) FOR x IN parts[:i - 1]]) AS start, length(parts[i]) AS size
  FROM (SELECT row, parts, unnest(range(2, len(parts), 2)) AS i FROM (
    SELECT row, string_split(regexp_replace(replace(t, chr(1), chr(2)), '{pattern}', chr(1) || '\\0' || chr(1), 'g'),
                             chr(1)) AS parts FROM cut) WHERE len(parts) > 1)
  WHERE length(regexp_extract(parts[i], '{pattern}', {rule.group})) >= {rule.least}""")
    names = ", ".join(f"'{rule.kind}'" for rule in secret_scan.RULES)
    counts = ", ".join(f"count(*) FILTER (f.kind = {n}) AS n_{rule.kind}" for n, rule in enumerate(secret_scan.BASE_RULES))
    one = f"([{names}])[f.kind + 1] || ':' || f.start || ':' || (f.start + f.size)"
    return f"""
WITH cut AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}
)
SELECT c.doc_id, {counts},
       sha256(coalesce(string_agg({one}, ',' ORDER BY f.start, f.kind) FILTER (f.kind < 3), '')) AS base_sha256,
       coalesce(string_agg({one}, ',' ORDER BY f.start, f.kind) FILTER (f.kind IS NOT NULL), '') AS spans
FROM cut c LEFT JOIN (SELECT row, kind, CAST(start AS BIGINT) AS start, size FROM found) f ON c.row = f.row
GROUP BY c.row, c.doc_id
"""


MIDDLE_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
drawn AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS c,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) AS d FROM cut
),
formed AS (
  SELECT doc_id, t, n, least(a, b) AS lo, greatest(a, b) AS hi,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c % 100 >= 90 THEN 'plain'
              WHEN d % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
),
parts AS (
  SELECT *, substring(t, 1, lo) AS p, substring(t, lo + 1, hi - lo) AS m, substring(t, hi + 1, n - hi) AS s FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
),
totals AS (
  SELECT count(*) AS d, CAST(sum(len(terms)) AS BIGINT) AS l FROM docs WHERE len(terms) > 0
),
counted AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
),
weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * d + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY 1), totals
),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
),
scored AS (
  SELECT a.item_id, c.row, c.doc_id, CAST(sum(
    a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * c.n * t.d) // t.l)))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON a.term = c.term JOIN weighted w ON a.term = w.term, totals t GROUP BY 1, 2, 3
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 10
"""


ORACLE = {
    "op2_line_windows": LINES_SQL,
    "op5_rule_ledger": RULES_SQL,
    "op10_secret_ledger": _secrets_sql(),
    "op11_fill_middle": MIDDLE_SQL,
    "op13_lemp_search": SEARCH_SQL,
}
