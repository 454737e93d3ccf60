"""The corpus pipeline: five stages, each an operator of sparkloom.llm on all that the stage before kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; the stages before the last return the columns of
``documents``. ``run`` writes each stage's result to the shared folder and reads it back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, mixing, ngram_join, quality_model, quality_rules
from sparkloom.llm.common import discard, table, written
from sparkloom.llm.queries import TOKENIZER, ratings, tokenizer_path, trusted_labels

#: Column of row keys, unique whatever ids the documents have.
ROW = "_p_row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row key, written once so that every use sees the same keys."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def plain(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[f"`{c}`" for c in columns])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: fitted on rated documents, keeps those whose top grade is likely enough."""
    model = quality_model.fit(docs, ratings(spark, sf_dir))
    return quality_model.judge(docs, model).where("rating.kept").select(docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: drops documents that fail the base rules or score too low against trusted text."""
    return quality_rules.judge(docs, trusted_labels(spark, sf_dir), buckets=quality_rules.EACH).where("quality.kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked rows exactly one stays, repeated rows and rows without an id included.

    It is the one with the smallest id (null last), then the smallest text digest. Rows, not ids, are linked: texts that
    share an id are judged each by itself, and a row that is linked with no other stays whatever its id.
    """
    rows = numbered(docs)
    groups = ngram_join.join(rows, ROW).select(F.col(ROW).alias("r"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.md5("text").alias("digest"), ROW)
    first = rows.select(ROW, order.alias("o")).join(groups, F.col(ROW) == F.col("r")).groupBy("component_id").agg(F.min("o").alias("o"))
    return plain(rows.join(first.select(F.col(f"o.{ROW}").alias(ROW)), ROW, "left_semi"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row stays if the mix takes any of its words, once for each epoch or part of one that takes it.

    Rows are told apart by a row key, so repeated and null ids get no more copies than others.
    """
    rows = numbered(docs)
    plan = mixing.mix(rows, row=ROW).where("taken > 0").selectExpr(ROW, "cast(ceil(taken / size) AS int) AS _p_times")
    return plain(rows.join(plan, ROW).withColumn("_p_time", F.explode(F.sequence(F.lit(1), "_p_times"))), docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: token ids of every text, and their number."""
    return bpe.encode(docs.select("doc_id", "source", "text"), tokenizer_path(TOKENIZER)).selectExpr("doc_id", "source", "size(ids) AS n_tokens", "ids")


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenise),
]
#: Hashed models and hash-random order can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = written(stage(spark, docs, sf_dir), name.replace(" ", "_").replace("-", "_"))
        discard(docs)
        docs = out
    return docs
