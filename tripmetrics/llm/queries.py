"""One registered query per operator, with production parameters over whole
tables, and DuckDB SQL where SQL can express the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, gam, itq, jaccard, langid, linededup, packing, tokenfile, trie, urlfilter, warc, whitening
from .oracle import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public(name: str) -> tuple[str, str]:
    """(path, split pattern) of a public vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def fold(doc_id: str, of: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(of))


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive, index = warc.folders(spark)
    captures = warc.write_archives(pages, archive)
    level = warc.write_index(captures, index)
    found = warc.lookup(pages.select("url", "page_id"), level, index)
    read = warc.read_records(found, archive)
    own = F.col("record_type") == "response"
    return read.select("page_id", F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                       F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")


def op2_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op3_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op5_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold("doc_id", 5) != 0), "text", "lang", "doc_id")
    held = docs.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return langid.predict(held, model)


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_itq_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.link(table(spark, sf_dir, "embeddings"))


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    out = docs.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), gam.scorer(spark, model)("text").alias("score"))
    return out.select("*", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfile.token_folder(spark)
    manifest = tokenfile.write_ids(table(spark, sf_dir, "documents"), folder, *public("byte_bpe_50k.json"))
    return tokenfile.read_ids(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    out = bpe.encode_decode(docs.select("doc_id", "text"), *public("byte_bpe_multi_50k.tiktoken"))
    return out.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public("word_bpe_49k.json")[0])
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = trie.rebuild(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(rebuilt)


QUERIES = {f.__name__: f for f in (op1_warc_index, op2_url_words, op3_template_decontam, op4_jaccard_join, op5_language_bayes,
                                   op6_line_chunks, op7_itq_near_dup, op8_quality_gam, op9_token_files, op10_tree_bpe,
                                   op11_vector_packing, op12_whitening, op13_zfast_trie)}
