"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.llm import (
    byte_bpe,
    chat_format,
    decontamination,
    embedding_dedup,
    filter_audit,
    html_extract,
    language_id,
    lexical_search,
    lines,
    lm_scoring,
    mixing,
    near_dedup,
    suffix_dedup,
)
from tallgrove.sources.tables import load


def op1_embedding_dedup(spark: SparkSession, directory: str) -> DataFrame:
    vectors = load(spark, directory, "embeddings").select("vec_id", "embedding", "label")
    return embedding_dedup.duplicate_vectors(vectors).select("vec_id", *embedding_dedup.OUTPUT)


def op2_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    left = suffix_dedup.remove_repeats(docs)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    talks = load(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    words = r"\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", words), (-7, 1, "assistant", words)], talks.schema)
    return chat_format.read_back(chat_format.format_turns(talks.unionByName(hard)))


def op5_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", *mixing.OUTPUT)


def op6_lm_scoring(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", lm_scoring.held_out(F.col("doc_id")))
    model = lm_scoring.Model(docs.filter("not held_out"))
    return lm_scoring.score(docs, model).select("doc_id", "held_out", *lm_scoring.OUTPUT)


def op7_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.filter("not held_out"))
    return language_id.identify(docs.drop("lang"), model).select("doc_id", "held_out", *language_id.OUTPUT)


def op8_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, load(spark, directory, "benchmark"))
    return found.select("doc_id", *decontamination.OUTPUT)


def op9_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, directory, "documents").select("doc_id", "text"))


def op10_html_extract(spark: SparkSession, directory: str) -> DataFrame:
    pages = load(spark, directory, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", *html_extract.OUTPUT)


def op11_filter_audit(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, load(spark, directory, "labels"))


def op12_byte_bpe(spark: SparkSession, directory: str, ranks_file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    ranks = byte_bpe.read_ranks(public_tokenizers.path(ranks_file))
    coded = byte_bpe.encode(
        docs, ranks, public_tokenizers.PATTERN, keep_text=False, derive=byte_bpe.digests(ranks), **byte_bpe.DIGESTS
    )
    return coded.select("doc_id", *byte_bpe.DIGESTS)


def op13_lexical_search(spark: SparkSession, directory: str) -> DataFrame:
    docs = load(spark, directory, "documents").select("doc_id", "text")
    return lexical_search.search(docs, load(spark, directory, "benchmark"))


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_mixing": op5_mixing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_near_dedup": op9_near_dedup,
    "op10_html_extract": op10_html_extract,
    "op11_filter_audit": op11_filter_audit,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_lexical_search": op13_lexical_search,
}
