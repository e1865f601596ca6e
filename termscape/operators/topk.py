"""Top-k inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest k for which Spark limits a ranked window before its shuffle (its default threshold).
PUSHED_LIMIT = 1000


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group with their 1-based rank.

    For a k up to ``PUSHED_LIMIT`` Spark keeps at most k rows per group in every task before the
    shuffle, so a group of any size is reduced where it lies. Beyond that the same is done in two
    rounds: k rows per group and salt, then k rows per group.
    """
    if k > PUSHED_LIMIT:
        salt = "_salt"
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        others = [c for c in df.columns if c not in group]
        salted = df.withColumn(salt, F.pmod(F.xxhash64(*others), F.lit(salts)))
        first = Window.partitionBy(*group, salt).orderBy(*order)
        df = (
            salted.withColumn(rank, F.row_number().over(first))
            .where(F.col(rank) <= k)
            .drop(salt, rank)
        )
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
