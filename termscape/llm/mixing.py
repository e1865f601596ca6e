"""Mixing sources to target weights by temperature.

A source's share ``p`` of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they
come) and normalised. The exponent is bisected: the mixture should reach a target entropy, yet no source may
be read more often than a repetition limit allows. Weights are realised as a sequence of blocks of
equal token budget: in each epoch a source's documents are permuted by a hash, their running token count
says in which block a document falls, so each block holds the sources in proportion to their weights, and
inside a block the documents are permuted again. The last, partial epoch takes the documents whose start
lies within the quota.

Without a budget the smallest one is taken that reads every source at least once, so nothing is left out.

All DataFrame functions. The texts are read once, into a narrow table of token counts. Running counts come
in two steps, over 4096 hash ranges of each source and epoch and inside each range, so no task orders a
whole source. The driver sees totals, never the list of sources.

Defined cases: a null source is a source of its own; null texts have no tokens; a source without
tokens has weight 0 and its documents come once; rows with equal or null ids are separate rows, and equal
rows stand side by side in the permutation; an empty table gives an empty plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscape.llm.common import WORD, salted_join
from termscape.session import Scratch, frozen

#: Share of the entropy of even weights that the mixture should reach.
TARGET_ENTROPY = 0.98
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 18
SEED = 17
#: Bits of the exponent that are bisected, ``STEP_BITS`` of them in each job.
EXPONENT_BITS = 40
STEP_BITS = 5
RANGE_DIGITS = 3


@dataclass(frozen=True)
class Target:
    """``entropy``: share of the largest possible; ``repeats``: largest epochs of a source; ``budget``: tokens or None."""

    entropy: float = TARGET_ENTROPY
    repeats: float = MAX_REPEATS
    budget: int | None = None


def row_key(columns: list[Column]) -> Column:
    """Digest of a row's values, null and empty told apart. A separator inside a value is doubled."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.replace(c.cast("string"), F.lit("\x1f"), F.lit("\x1f\x1f"))), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def token_counts(docs: DataFrame, id_column: str, text_column: str, source_column: str, key_columns: list[str]) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        row_key([F.col(f"`{c}`") for c in key_columns]).alias("row_key"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )


def _section(holds, lo: float, hi: float) -> tuple[float, float]:
    """Narrow ``lo``..``hi`` to where ``holds`` (false, then true) turns, by ``2 ** STEP_BITS`` sections."""
    parts = 1 << STEP_BITS
    points = [lo + (hi - lo) * i / parts for i in range(1, parts)]
    flags = [*holds(points), True]
    first = flags.index(True)
    edges = [lo, *points, hi]
    return edges[first], edges[first + 1]


def exponent(totals: DataFrame, target: Target) -> float:
    """The smallest exponent that keeps the repetition limit, and the largest that has the entropy beyond that.

    ``totals`` has one row per source with ``tokens`` > 0. The result is the larger of the two bounds'
    answers: repetition is a limit, entropy a wish.
    """
    whole = totals.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("all"), F.max("tokens").alias("most"), F.min("tokens").alias("least")).first()
    if not whole["n"] or whole["n"] == 1:
        return 1.0
    share = F.col("tokens") / F.lit(float(whole["all"]))
    wanted = target.entropy * math.log(whole["n"])

    def entropy_is_short(points: list[float]) -> list[bool]:
        # entropy of p^a / z is ln z - a * sum(p^a ln p) / z
        sums = [F.sum(F.pow(share, F.lit(a))).alias(f"z{i}") for i, a in enumerate(points)]
        logs = [F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"l{i}") for i, a in enumerate(points)]
        row = totals.agg(*sums, *logs).first()
        return [math.log(row[f"z{i}"]) - a * row[f"l{i}"] / row[f"z{i}"] < wanted for i, a in enumerate(points)]

    def repeats_fit(points: list[float]) -> list[bool]:
        if target.budget is None:
            return [(whole["most"] / whole["least"]) ** (1 - a) <= target.repeats for a in points]
        row = totals.agg(*[F.sum(F.pow(share, F.lit(a))).alias(f"z{i}") for i, a in enumerate(points)]).first()
        smallest = whole["least"] / whole["all"]
        return [smallest**a / row[f"z{i}"] * target.budget / whole["least"] <= target.repeats for i, a in enumerate(points)]

    bounds = []
    for holds, upper in ((entropy_is_short, False), (repeats_fit, True)):
        if holds([0.0])[0]:
            bounds.append(0.0)
            continue
        lo, hi = 0.0, 1.0
        for _ in range(EXPONENT_BITS // STEP_BITS):
            lo, hi = _section(holds, lo, hi)
        bounds.append(hi if upper else lo)
    return max(bounds)


def quotas(totals: DataFrame, target: Target) -> tuple[DataFrame, int]:
    """``source, tokens, weight, quota, epochs`` and the budget."""
    a = exponent(totals.where("tokens > 0"), target)
    whole = totals.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most")).first()
    total = float(whole["all"] or 0)
    raised = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(a))).otherwise(F.lit(0.0))
    z = totals.agg(F.sum(raised)).first()[0] or 1.0
    budget = target.budget
    if budget is None:  # what the source that is read least needs for one epoch
        budget = whole["most"] / ((whole["most"] / total) ** a / z) if total else 0.0
    weighed = totals.select("source", "tokens", (raised / F.lit(z)).alias("weight"))
    weighed = weighed.withColumn("quota", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    if target.budget is None:
        weighed = weighed.withColumn("quota", F.greatest("quota", "tokens"))
    epochs = F.greatest(F.ceil(F.col("quota") / F.greatest("tokens", F.lit(1))).cast("int"), F.lit(1))
    return weighed.withColumn("epochs", epochs), int(round(budget))


def _permuted(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), *[p.cast("string") for p in parts]))


def mix(
    docs: DataFrame,
    target: Target = Target(),  # noqa: B008
    block_tokens: int = BLOCK_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    key_columns: list[str] | None = None,
) -> DataFrame:
    """The sequence: doc_id, source, row_key, n_tokens, epoch, block, position in the block. One row per reading."""
    with Scratch(docs.sparkSession) as scratch:
        counted = token_counts(docs, id_column, text_column, source_column, key_columns or [id_column, text_column])
        counted = scratch.table(counted, "mix-tokens")
        totals = scratch.table(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
        weighed, budget = quotas(totals, target)
        n_blocks = max(1, -(-budget // block_tokens))
        drawn = salted_join(counted, weighed.select("source", "tokens", "quota", "epochs"), "source", F.col("row_key"))
        drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
        drawn = drawn.withColumn("order", _permuted(F.col("epoch"), F.col("row_key")))
        drawn = drawn.withColumn("range", F.substring("order", 1, RANGE_DIGITS))
        # running tokens of the ranges of a source and epoch, at most 16 ** RANGE_DIGITS rows each
        ranges = drawn.groupBy("source", "epoch", "range").agg(F.sum("n_tokens").alias("held"))
        earlier = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ranges.select(
            F.col("source").alias("source_r"), F.col("epoch").alias("epoch_r"), F.col("range").alias("range_r"),
            F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        )
        on = drawn["source"].eqNullSafe(ranges["source_r"]) & (drawn["epoch"] == ranges["epoch_r"]) & (drawn["range"] == ranges["range_r"])
        inside = Window.partitionBy("source", "epoch", "range").orderBy("order", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
        placed = drawn.join(ranges, on).withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        placed = placed.withColumn("start", F.col("epoch") * F.col("tokens") + F.col("before") + F.col("inside"))
        read = placed.where((F.col("start") < F.col("quota")) | ((F.col("n_tokens") == 0) & (F.col("epoch") == 0)))
        at = F.col("start").cast("double") / F.greatest("quota", F.lit(1)).cast("double") * F.lit(float(n_blocks))
        read = read.withColumn("block", F.least(F.floor(at), F.lit(n_blocks - 1)).cast("long"))
        shuffled = Window.partitionBy("block").orderBy(_permuted(F.col("block"), F.col("epoch"), F.col("row_key")), "doc_id", "n_tokens")
        plan = read.select("doc_id", "source", "row_key", "n_tokens", "epoch", "block", F.row_number().over(shuffled).alias("position"))
        return frozen(plan.withColumnRenamed("doc_id", id_column), "mix-plan")


def apply_plan(docs: DataFrame, plan: DataFrame, key_columns: list[str]) -> DataFrame:
    """The rows of ``docs``, once for each reading, with their own columns, in the order of the plan: by block, and
    by position in the block.

    A row travels in a struct, so its columns may have any names. Written as files, the rows stay in that order.
    """
    key = row_key([F.col(f"`{c}`") for c in key_columns])
    rows = docs.select(key.alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    read = rows.dropDuplicates(["row_key"]).join(plan.select("row_key", "block", "position"), "row_key")
    return read.repartitionByRange("block", "position").sortWithinPartitions("block", "position").select("row.*")
