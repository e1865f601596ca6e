"""Registered queries of the operators, one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.llm import (
    bpe,
    chat,
    embedding_index,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    spelling,
    suffix_dedup,
    token_frames,
    url_filters,
)
from termscape.llm.common import read_table
from termscape.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("row_key")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(read_table(spark, sf_dir, "pages"))


def op3_ordinal_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    grades = quality_classifier.grades_of(read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, quality_classifier.fit(docs, grades))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_duplicates(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(read_table(spark, sf_dir, "documents"), keep_columns=["doc_id"])


def op8_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoding_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_index.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    turns = turns.unionByName(added).withColumn("parts", chat.text_part(F.col("text"))).drop("text")
    return chat.conversation_digests(chat.format_turns(turns))


def op11_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-frames")
    token_frames.write_tokens(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_frames.read_checksums(spark, folder)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("filter")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_temperature_mixing": op1_temperature_mixing,
    "op2_url_filters": op2_url_filters,
    "op3_ordinal_classifier": op3_ordinal_classifier,
    "op4_ngram_join": op4_ngram_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_compression_bands": op7_compression_bands,
    "op8_chunked_bpe": op8_chunked_bpe,
    "op9_pivot_index": op9_pivot_index,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_token_frames": op11_token_frames,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling_variants": op13_spelling_variants,
}
