"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

#: Rows of one Arrow batch. Whole texts are rows here, so batches are kept far below Spark's default.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send at most ``BATCH_ROWS`` rows at once to Python workers."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def salted_join(big: DataFrame, small: DataFrame, key: str, spread_by: Column, salts: int = 32) -> DataFrame:
    """Left join of ``big`` to ``small`` (one row per key), null keys matching null keys.

    Each row of ``small`` is repeated ``salts`` times and the rows of ``big`` are dealt over the
    copies by ``spread_by``, so that a key with a third of all rows reaches ``salts`` tasks. Spark
    still broadcasts ``small`` where its size is below the session's threshold.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = right.withColumnRenamed(key, "_key").withColumnRenamed("_salt", "_salt_r")
    on = left[key].eqNullSafe(right["_key"]) & (left["_salt"] == right["_salt_r"])
    return left.join(right, on, "left").drop("_salt", "_salt_r", "_key")
