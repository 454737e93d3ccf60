"""The thin queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, codes, fingerprint, mixing, ngram_join, quality_model, quality_rules, url_rules, warc
from .common import table

TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def trusted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents rated good and not toxic."""
    return table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, payloads = warc.write(table(spark, sf_dir, "pages"))
    out = warc.read(warc.records(headers, payloads))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.read(codes.write(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER)))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, grade): 0 bad, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return table(spark, sf_dir, "labels").where("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, ratings(spark, sf_dir))
    return quality_model.judge(docs.select("doc_id", "text"), model).select("doc_id", "rating.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"), trusted_labels(spark, sf_dir), buckets=quality_rules.EACH)
    return out.select("doc_id", "quality.*")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))
    return out.select("page_id", "host", "path", "rule", "verdict")


#: Schemas of the tools that conversations may call.
TOOLS = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string", "maxLength": 2000}, "limit": {"type": "integer", "minimum": 1}}, "additionalProperties": False},
    "calculate": {"type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}}},
}


def as_tool_use(conversations: DataFrame) -> DataFrame:
    """Every turn as a message of a chat with tools: what a user says is a call of a tool, with the turn as its limit,
    what the assistant says next is that call's result, and other roles stay plain text. Identifiers repeat within a
    conversation: there are four of them.
    """
    ident = lambda turn: F.concat(F.lit("call_"), F.pmod(F.floor(turn / 2), F.lit(4)))
    call = F.to_json(F.struct(F.array(F.struct(
        ident(F.col("turn")).alias("id"), F.lit("search").alias("name"), F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("query"), F.col("turn").alias("limit"))).alias("arguments"),
    )).alias("tool_calls")))
    result = F.to_json(F.struct(ident(F.col("turn") - 1).alias("tool_call_id"), F.coalesce("text", F.lit("")).alias("content")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return conversations.withColumn("text", text).withColumn("role", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_messages(as_tool_use(table(spark, sf_dir, "conversations")), TOOLS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_warc": op2_warc,
    "op3_order_minhash": op3_order_minhash,
    "op4_ngram_join": op4_ngram_join,
    "op5_mixing": op5_mixing,
    "op6_token_codes": op6_token_codes,
    "op7_quality_model": op7_quality_model,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_rules": op9_url_rules,
    "op10_chat": op10_chat,
}

ORACLES: dict[str, str] = {
    "op2_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
o AS (SELECT *, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS owner FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n < 1000 OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < 1000 OR page_id = owner THEN NULL ELSE owner END AS refers_to
FROM o""",
    "op5_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS rnd
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
r AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY source_size / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM w),
c AS (SELECT *, weight * rest >= 3 * source_size * share AS capped FROM r),
l AS (SELECT first(rest ORDER BY source_size / weight) AS rest, first(share ORDER BY source_size / weight) AS share FROM c WHERE NOT capped),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE (weight * l.rest)::DOUBLE / l.share::DOUBLE END AS target
  FROM c LEFT JOIN l ON true),
p AS (
  SELECT d.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY rnd, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken
FROM e""",
    "op9_url_rules": r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m AS (
  SELECT p.page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.verdict, length(r.h || r.p)) AS verdict
  FROM p JOIN r ON ('.' || host) LIKE ('%.' || r.h) AND starts_with(path, r.p) GROUP BY p.page_id)
SELECT p.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
}
