"""The operators' queries over the given tables: thin calls that derive the contract's columns, and their SQL."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import quality_rules as quality
from gridmart.llm.common import ORACLES, QUERIES, ROW, query, staged, table
from gridmart.llm.conversations import repair, text_digests
from gridmart.llm.decontaminate import leaks
from gridmart.llm.jaccard import similar_documents
from gridmart.llm.licenses import license_scan
from gridmart.llm.line_dedup import line_dedup
from gridmart.llm.packing import pack
from gridmart.llm.pii import personal_data
from gridmart.llm.sentence_dedup import known_id, repeated_spans
from gridmart.llm.sharding import balanced_shards
from gridmart.llm.simhash import simhash_components
from gridmart.llm.vector_codes import SCALE, encode
from gridmart.llm.weak_quality import weak_quality

__all__ = ["ORACLES", "QUERIES"]

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
     lines AS (SELECT doc_id, generate_subscripts(s, 1) AS pos, unnest(s) AS line FROM split),
     keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM lines),
     common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
     marked AS (SELECT keyed.*, common.key IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op1_line_dedup", LINE_DEDUP_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup(docs, min_docs=10, min_chars=1, keep="none")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_SPACE = r"[\x20\x09-\x0D]+"


def _sized(sql: str, pattern: str) -> str:
    return f"length(regexp_replace({sql}, '{pattern}', '', 'g'))"


_QUOTED = {k: getattr(quality, k).replace("'", "''") for k in ("WORD", "NOT_SYMBOL", "NOT_ORNAMENT", "NOT_SEPARATOR", "SENTENCE_END", "GOES_ON", "BOILERPLATE")}
_BEFORE, _AFTER = (f"coalesce(s[i {by} 1], '')" for by in "-+")


def _alike(other: str) -> str:
    return f"(4 * length({other}) >= 3 * length(l) AND 3 * length({other}) <= 4 * length(l))"


_SQL_FAILS = f"""regexp_matches(l, '[^\\x20\\x09-\\x0D]') AND (
    NOT regexp_matches(l, '{_QUOTED["SENTENCE_END"]}') AND NOT (
        length(l) >= {quality.WRAPPED_CHARS} AND regexp_matches({_AFTER}, '[^\\x20\\x09-\\x0D]')
        AND (regexp_matches({_AFTER}, '{_QUOTED["GOES_ON"]}') OR {_alike(_AFTER)} OR {_alike(_BEFORE)}))
    OR (length(l) >= {quality.ORNAMENT_CHARS} AND {_sized("l", _QUOTED["NOT_ORNAMENT"])} > {quality.MAX_ORNAMENTS}::DOUBLE * length(l))
    OR {_sized("l", _QUOTED["NOT_SEPARATOR"])} > {quality.MAX_SEPARATORS}::DOUBLE * length(l)
    OR (length(l) <= {quality.BOILERPLATE_CHARS} AND regexp_matches(l, '{_QUOTED["BOILERPLATE"]}')))"""

#: Measures, cleaned text and verdict of a table of documents, for the query and the pipeline.
QUALITY_CTES = f"""
q_split AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_QUOTED["WORD"]}') AS w,
                   string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
q_windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], chr(10)) AS win
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM q_split WHERE len(w) >= 8)),
q_again AS (SELECT doc_id, unnest(places) AS i FROM (SELECT doc_id, list(i) AS places FROM q_windows GROUP BY doc_id, win HAVING count(*) > 1)),
q_covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM q_again) GROUP BY doc_id),
q_lines AS (SELECT doc_id, t, w, list_filter(s, lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS worded,
                   array_to_string(list_filter(s, lambda l, i: NOT ({_SQL_FAILS})), chr(10)) AS clean FROM q_split),
q_measured AS (
    SELECT doc_id, clean, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {_sized("t", _QUOTED["NOT_SYMBOL"])} AS n_symbols,
           len(worded) - len(list_distinct(worded)) AS n_dup_lines, coalesce(q_covered.n, 0) AS n_repeat_words
    FROM q_lines LEFT JOIN q_covered USING (doc_id)),
quality AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
           AND 1 - {_sized("clean", _SPACE)}::DOUBLE / word_chars <= {quality.MAX_LOST} AS kept
    FROM q_measured)
"""
QUALITY_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_quality_rules", f"WITH {QUALITY_CTES} SELECT {', '.join(QUALITY_COLUMNS)} FROM quality")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*QUALITY_COLUMNS)


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), shards=40)


@query("op6_ngram_jaccard")
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).drop(*ROW)


@query("op4_power_of_two_packing")
def op4_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), longest=2048, end_id=1, tokens=False)


@query("op7_template_decontamination")
def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(*ROW)


@query("op2_license_templates")
def op2_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op3_sentence_spans")
def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_spans(docs).select(known_id(*(F.col(c) for c in ROW)).alias("doc_id"), "start", "end", "first_doc_id")


@query("op9_pii_boosting")
def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans", (F.col("spans") != "").alias("found"))


@query("op5_weak_label_quality")
def op5_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op13_simhash_components")
def op13_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain Lloyd: every part against every entry in every round. All sums are whole numbers below 2^53."""
    assigned = """near{k} AS (
        SELECT p, id, x, min_by(e, d * 256 + e) AS e, min(d) AS d
        FROM (SELECT cut.p, cut.id, cut.x, c.e, list_dot_product(cut.x, cut.x) + list_dot_product(c.x, c.x) - 2 * list_dot_product(cut.x, c.x) AS d
              FROM cut JOIN book{k} c ON c.p = cut.p) GROUP BY p, id, x)"""
    moved = """sums{k} AS (SELECT p, e, pos, floor(sum(v) / count(*)) AS v
               FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM near{k}) GROUP BY p, e, pos),
    means{k} AS (SELECT p, e, list(v ORDER BY pos) AS x FROM sums{k} GROUP BY p, e),
    book{n} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN means{k} m ON m.p = b.p AND m.e = b.e)"""
    steps = [assigned.format(k=k) + (",\n    " + moved.format(k=k, n=k + 1) if k < rounds else "") for k in range(rounds + 1)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id AS id, label, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
    cut AS MATERIALIZED (SELECT p, id, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS x FROM kept, range({parts}) AS r(p)),
    book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, x FROM cut QUALIFY e < {entries}),
    {(","+chr(10)+"    ").join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
    coded AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY id),
    books AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(v AS BIGINT)), ','), ',' ORDER BY p, e)) AS sha FROM book{rounds})
    SELECT id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
    FROM coded JOIN kept USING (id), books
    """


@query("op11_vector_codes", _vector_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "embeddings"), carry=("label",))
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda a, x: a + x)
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    rows = found.rows.select("vec_id", "label", code.alias("code"), error.alias("error"))
    sums = staged(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    digest = hashlib.sha256(",".join(map(str, found.codebooks.reshape(-1).tolist())).encode()).hexdigest()
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults that a checksum of id and turn chooses."""
    space = F.lit(" ")
    place = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *place)) % 20
    text = F.coalesce("text", space)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", space))
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    left = conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).where("fault <> 0")
    return left.select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("col")


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = repair(damaged(conversations))
    digests = text_digests(repaired.messages).withColumnRenamed("sha256", "repaired_sha256")
    parts = conversations.select("conv_id").distinct().unionByName(repaired.report, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], *[F.coalesce(F.max(c), F.lit(x)).alias(c) for c, x in empty.items()]
    )
