"""Documents to training rows, stage by stage.

Each stage works on all that the one before it kept. What a stage returns is written as Parquet in
the shared folder and read again, so that a lost executor costs no earlier stage.

1. Quality rules: documents that fail the base rules or the compression bands go.
2. N-gram Jaccard join: of each group of near copies the document with the smallest id stays.
3. Suffix-array dedup: strings of 200 bytes that stand elsewhere too are cut out of the texts.
4. Mixing: documents are read as often as their source's target weight asks, once at least, and are
   written in the order of the plan: by block, and by position in it.
5. BPE: token ids of each reading, and whether decoding them gives the text back.

Defined cases, for every stage: columns beyond those of documents stay, whatever their names; an empty table
gives an empty one. Null and empty texts fail the base rules, so they end at stage 1. Of rows equal in id and text one
is left by stage 2, and ties between documents of one size go to the smallest id, null ids last. A null source is a
source of its own. Very long texts go through whole, one at a time in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscape.llm import bpe, mixing, ngram_join, quality_rules, suffix_dedup
from termscape.session import scratch_path

#: The public vocabulary whose path ``public_tokenizers`` knows.
VOCABULARY = "byte_bpe_50k.json"


def reject_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text."""
    return suffix_dedup.cut_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mixing.mix(docs, key_columns=docs.columns)
    return mixing.apply_plan(docs, plan, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", reject_by_quality),
    ("n-gram jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe encoding", encode),
]

#: zstandard, suffix arrays and byte-pair encoding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
