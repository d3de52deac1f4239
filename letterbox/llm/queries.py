"""The operators' queries over the whole given tables, and their SQL where SQL can state the answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    conversations,
    exact_dedup,
    language_gru,
    licenses,
    line_dedup,
    mixing,
    packing,
    quality_knn,
    quality_rules,
    simhash,
    spelling,
    token_counts,
    toxicity,
)
from .common import ID, held_out, saved
from .license_digests import DIGESTS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each pass a document takes part in."""
    docs, mix = table(spark, sf_dir, "documents"), mixing.Mix(entropy=0.999, max_passes=2.0)
    taken = mixing.passes(docs, mixing.plan_table(docs, mix), mix)
    return taken.select(
        F.col("lb_row.doc_id").alias("doc_id"),
        F.col("lb_source").alias("source"),
        F.col("lb_tokens").alias("tokens"),
        F.col("lb_pass").cast("long").alias("pass"),
        F.col("lb_place").alias("place"),
        F.round("exponent", 6).alias("exponent"),
        F.round("weight", 9).alias("weight"),
        "budget",
    )


ORACLES["op1_temperature_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, n, substr(md5('mix:' || source || ':' || h[1:3]), 1, 16) || h AS place
  FROM (SELECT doc_id, coalesce(source, '') AS source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h,
               len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n
        FROM documents)
), s AS (
  SELECT source, sum(n)::BIGINT AS n, sum(sum(n)) OVER ()::DOUBLE AS whole FROM d GROUP BY source
), size AS (
  SELECT count(*) AS sources, min(n)::DOUBLE AS least, max(n)::DOUBLE AS most FROM s WHERE n > 0
), by_entropy(step, k, full_k) AS (
  SELECT 21, 0, false
  UNION ALL
  -- The first step asks whether the plain shares will do; the others build the largest exponent bit by bit.
  SELECT step - 1,
         CASE WHEN bool_or(full_k) THEN any_value(k)
              WHEN ln(sum(pow(n / whole, (k + pow(2, step - 1)) / 1048576)))
                   - sum(pow(n / whole, (k + pow(2, step - 1)) / 1048576)
                         * ln(pow(n / whole, (k + pow(2, step - 1)) / 1048576)))
                     / sum(pow(n / whole, (k + pow(2, step - 1)) / 1048576))
                   >= 0.999 * ln(any_value(sources))
              THEN any_value(k) + pow(2, step - 1)::INT ELSE any_value(k) END,
         step = 21 AND ln(sum(n / whole)) - sum(n / whole * ln(n / whole)) / sum(n / whole)
                       >= 0.999 * ln(any_value(sources)) OR bool_or(full_k)
  FROM by_entropy, s, size WHERE step > 0 AND n > 0 GROUP BY step, k
), limited AS (
  -- Passes differ by at most (most / least) ** (1 - exponent).
  SELECT greatest(k, CASE WHEN pow(most / least, 1 - k / 1048576.0) > 2
                          THEN least(floor((1 - ln(2) / ln(most / least)) * 1048576) + 1, 1048576) ELSE 0 END)
         / 1048576.0 AS x
  FROM by_entropy, size WHERE step = 0
), w AS (
  SELECT source, n, x, pow(n / whole, x) / sum(pow(n / whole, x)) OVER () AS weight FROM s, limited
), b AS (
  SELECT source, n, x, weight, floor(weight / n / min(weight / n) OVER () * n)::BIGINT AS budget FROM w
), taken AS (
  SELECT doc_id, d.source, d.n AS tokens, place, x, weight, budget, budget // b.n AS whole_passes,
         budget % b.n > 0
         AND sum(d.n) OVER (PARTITION BY d.source ORDER BY place, lpad(d.n::VARCHAR, 20, '0')) <= budget % b.n AS more
  FROM d JOIN b USING (source)
)
SELECT doc_id, source, tokens, unnest(range(whole_passes + more::INT)) AS pass, place,
       round(x, 6) AS exponent, round(weight, 9) AS weight, budget
FROM taken
"""


def fit_quality(docs: DataFrame, labels: DataFrame) -> quality_knn.Model:
    usable = ~held_out(F.col(ID), 5, 0)
    return quality_knn.fit(docs, labels, "quality", usable, max_labelled=4096, dimensions=64, neighbours=15)


@query
def op2_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality_knn.score(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col(ID).alias("doc_id"),
        held_out(F.col(ID), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_gru.fit(docs, usable=~held_out(F.col(ID), 4, 2))
    found = language_gru.language(docs, net)
    return found.select(F.col(ID).alias("doc_id"), held_out(F.col(ID), 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's verdicts under two policies, and how many rows v1 would keep without the rule that alone rejects one."""
    rows = saved(quality_rules.ledger(table(spark, sf_dir, "documents")), "ledger")
    # One row per rule.
    effects = quality_rules.ablation(rows, "v1").select(
        F.col("rule").alias("lone_rule"), F.col("alone").alias("lone_rule_rows")
    )
    judged = rows.withColumn("lone_rule", quality_rules.lone_rule("v1")).join(F.broadcast(effects), "lone_rule", "left")
    return judged.select(
        F.col(ID).alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.fails("base").alias("base_failed"),
        (~quality_rules.fails("base") & ~quality_rules.fails("v1")).alias("kept"),
        "failed",
        (~quality_rules.fails("v2")).alias("kept_v2"),
        "lone_rule",
        "lone_rule_rows",
    )


ORACLES["op4_rule_ledger"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), threes AS (
  SELECT r, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM threes WHERE c IS NOT NULL
), repeats AS (
  SELECT r, count(DISTINCT i + shift) AS n_repeat_words
  FROM windows, (SELECT unnest(range(3)) AS shift) WHERE times > 1 GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters,
         len(regexp_extract_all(t, '[!?]')) AS n_marks
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
), f AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
            + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars > 14 * n_words)::INT
            + 32 * (word_chars < 2 * n_words)::INT + 64 * (2 * n_upper > n_letters)::INT
            + 128 * (5 * n_marks > n_words)::BIGINT AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed, failed & 95 = 0 AS kept_v2,
       CASE failed WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols'
         WHEN 8 THEN 'duplicate_lines' WHEN 16 THEN 'long_words' WHEN 32 THEN 'short_words'
         WHEN 64 THEN 'shouting' WHEN 128 THEN 'exclamations' END AS lone_rule,
       CASE WHEN bit_count(failed) = 1 THEN count(*) OVER (PARTITION BY failed) END AS lone_rule_rows FROM f
"""


@query
def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col(ID).alias("doc_id"),
        "text_digest",
        "license",
        F.array_join("line_licenses", ",").alias("line_licenses"),
        "license_lines",
    )


def _license_sql() -> str:
    """The rule line by line: statements go from the block of blank lines, titles and statements before the wording."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"

    def spelled(form: str, pairs: list[tuple[str, str]]) -> str:
        for old, new in pairs:
            form = f"replace({form}, {quoted(old)}, {quoted(new)})"
        return form

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licenses.NOTICES + licenses.TEXTS)
    fixed = ", ".join(f"({quoted(n)}, '{d}')" for n, digests in DIGESTS.items() for d in digests)
    form = spelled(
        r"replace(regexp_replace(chr(10) || bare, '[^\p{L}\p{N}\n]+', ' ', 'g'), chr(10), ' ' || chr(10) || ' ')",
        licenses.SPELLINGS,
    )
    parted = [pair for pair in licenses.SPELLINGS if " " in pair[0].strip()]
    words = spelled("regexp_replace(form, '[ \\n]+', ' ', 'g')", parted)
    sign, gap = r"(?:\(c\)|©|&copy;)", r"^[^\p{L}\p{N}]*copyright\b[^\p{L}\p{N}]*"
    return rf"""
WITH src AS (
  SELECT row_number() OVER () AS r, * FROM (
    SELECT NULL AS license, doc_id, lower(coalesce(text, '')) AS t, true AS asked FROM documents
    UNION ALL SELECT license, NULL, lower(text), false FROM (VALUES {known}) v(license, text))
), line AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM src
), kind AS (
  SELECT *, regexp_matches(line, '^[^\p{{L}}\p{{N}}]*{sign}.*[\p{{L}}\p{{N}}]')
         OR regexp_matches(line, '{gap}(?:{sign}|\p{{N}})')
         OR regexp_matches(line, '{gap}\p{{L}}') AND NOT regexp_matches(line, '{gap}{licenses._NO_HOLDER}') AS stated,
         regexp_matches(line, '^.{{0,60}}licen[cs]e.{{0,30}}$')
         AND NOT regexp_matches(line, 'gnu|general public') AS titled,
         NOT regexp_matches(line, '[\p{{L}}\p{{N}}]') AS blank
  FROM line
), gap AS (
  SELECT *, sum(stated::INT) OVER (PARTITION BY r ORDER BY i) AS past FROM kind
), block AS (
  SELECT *, NOT (stated OR blank OR titled
                 AND sum((titled AND NOT stated)::INT) OVER (PARTITION BY r, past ORDER BY i) <= 3) AS wording
  FROM gap
), cut AS (
  SELECT r, i, CASE WHEN stated AND NOT bool_or(wording) OVER (PARTITION BY r ORDER BY i) THEN '' ELSE line END AS line
  FROM block
), formed AS (
  SELECT r, {form} AS form FROM (SELECT r, string_agg(line, chr(10) ORDER BY i) AS bare FROM cut GROUP BY r)
), digested AS (
  SELECT src.*, form, sha256(trim({words})) AS digest FROM src JOIN formed USING (r)
), known AS (
  SELECT digest, min(license) AS license
  FROM (SELECT digest, license FROM digested WHERE NOT asked
        UNION ALL SELECT digest, license FROM (VALUES {fixed}) f(license, digest)) GROUP BY digest
), lines AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS license_lines
  FROM (SELECT r, unnest(string_split(form, chr(10))) AS line FROM digested WHERE asked)
  JOIN known ON digest = sha256(trim(line)) GROUP BY r
)
SELECT doc_id, digested.digest AS text_digest, known.license, coalesce(line_licenses, '') AS line_licenses,
       coalesce(license_lines, 0) AS license_lines
FROM digested LEFT JOIN lines USING (r) LEFT JOIN known ON known.digest = digested.digest WHERE asked
"""


ORACLES["op5_license_digests"] = _license_sql()


def vocabulary() -> str:
    """The vocabulary file, which every worker has at the same place."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())
    return found.select(F.col(ID).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)
    return found.select(F.col(ID).alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", usable=~held_out(F.col(ID), 5, 0))
    return toxicity.score(docs, model).select(
        F.col(ID).alias("doc_id"),
        held_out(F.col(ID), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("passages"),
    )


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary(), capacity=4096, end_id=1)
    return packing.pack(cut, capacity=4096).withColumnRenamed(ID, "doc_id")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4, seed=42)
    return found.select(F.col(ID).alias("doc_id"), "fingerprint", "component_id")


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(
        table(spark, sf_dir, "documents"), least_length=20, least_documents=3, batches=4
    )
    return found.select(
        F.col("lb_row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("lb_row.text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLES["op11_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), repeated AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3
), marked AS (
  SELECT k.*, last IS NOT NULL AND doc_id IS DISTINCT FROM last AS dropped FROM k LEFT JOIN repeated USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r
"""


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the agreed faults; ``lb_absent`` marks dropped rows."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = (
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(spaced("text"), ".!?", ""))
        .otherwise(spaced("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("lb_absent"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("lb_copy"),
    )


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.coded(damaged(table(spark, sf_dir, "conversations")), absent=F.col("lb_absent"))
    found = saved(conversations.audits(rows), "audits")
    closing = conversations.repaired(rows, found).filter(F.col("place").isNull())
    digests = closing.select(conversations.CONV, F.col("text").alias("repaired_sha256"))
    same = found[conversations.CONV].eqNullSafe(digests[conversations.CONV])
    return found.join(digests, same).select(
        found[conversations.CONV].alias("conv_id"),
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    )


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = spelling.word_counts(docs, least_length=6, least_count=5, modulus=199)
    return spelling.variants(words, ratio=5)
