"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.llm import decontam, gam, jaccard, linededup
from tripmetrics.llm.common import fresh, materialize
from tripmetrics.llm.queries import bpe_digests, fold, table

#: No single SQL statement expresses the classifier, MinHash pruning or BPE.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go; rows with a null id are judged too."""
    model = gam.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    score = fresh(docs.columns, "score")
    return docs.withColumn(score, gam.scorer(spark, model)("text")).where(F.col(score) >= 0.7).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; ``n_chars`` follows the text."""
    out = linededup.dedup(docs, counts=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each linked group of texts the document with the smallest id stays
    (a null id last), once.  Rows are told apart by id and text, so different
    texts under one id, or under none, are documents of their own."""
    key, group, best = (fresh(docs.columns, c) for c in ("row_key", "row_class", "row_best"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    of = jaccard.join(keyed.select(key, "text"), key, "text").select(F.col("doc_id").alias(key), F.col("class_id").alias(group)).distinct()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key))
    keep = keyed.select(key, "doc_id").join(of, key).groupBy(group).agg(F.min(order).alias(best)).select(F.col(f"{best}.{key}").alias(key))
    return keyed.join(keep, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; judged by their text, so rows
    without an id, or with one that other texts have too, are judged as well."""
    key = fresh(docs.columns, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    found = decontam.contaminated(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), key, "text")
    return keyed.join(found.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the digest of what they decode to."""
    return bpe_digests(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
