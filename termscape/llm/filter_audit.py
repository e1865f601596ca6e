"""What each filter of a chain removes, for every order of the filters, without running any order.

A document is, for this question, the set of filters that it fails: its mask. Documents are counted by part and
mask once, so what follows has at most 2^k rows per part, however many documents there are.

Orders are ranked lexicographically (their Lehmer codes). A document with mask M goes at step s by filter f in
exactly those orders that begin with s - 1 filters outside M and then f. All orders with one beginning stand
together in rank, so such a beginning is an interval of (k - s)! ranks. The counts of the mask are added at
the interval's first rank and taken off after its last; one prefix sum over the ranks turns these differences into
the removals of all k! orders at once. The intervals follow from k alone: 325 beginnings for five filters.

Defined cases: a null part is the empty string. Null flags of a filter count as passed, null labels as neither
good nor toxic. Repeated rows count each. An empty table gives no rows. Texts: null is empty, an empty text has no
words (it fails A, and not B); very long ones are read in the JVM like others. ``fails_copy``: a row whose id is greater
than the smallest id with an identical text; rows with a null id are not copies and make no others. Of several
labels for an id the marked one counts. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscape.llm.common import WORD
from termscape.operators.terms import computed
from termscape.session import frozen

#: The filters of ``text_failures`` and ``audit_documents``, in the order of their bits.
FILTERS = "ABCDE"

#: Most filters: the report has k! * k rows per part.
MAX_FILTERS = 8


def lehmer_rank(beginning: Sequence[int], k: int) -> int:
    """Rank of the first order of ``range(k)`` that begins so."""
    return sum(
        sum(other < item and other not in beginning[:at] for other in range(k)) * factorial(k - 1 - at)
        for at, item in enumerate(beginning)
    )


def removal_intervals(k: int) -> list[tuple[int, int, int, int, int]]:
    """``(mask, step, filter, first rank, rank after the last)`` for every mask and beginning that removes it."""
    found = []
    for step in range(1, k + 1):
        for beginning in permutations(range(k), step):
            first, last = lehmer_rank(beginning, k), beginning[-1]
            free = [1 << f for f in range(k) if f not in beginning]
            for n in range(len(free) + 1):
                for others in combinations(free, n):
                    found.append(((1 << last) + sum(others), step, last, first, first + factorial(k - step)))
    return found


def audit(counted: DataFrame, filters: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Report on ``counted(part, mask, n, *measures)``, rows of counts of documents; several for one mask add up.

    One row per part, order and step: ``part``, ``filter_order`` (names joined), ``step``, ``filter``, ``kept``
    after the step, ``removed`` by it, ``redundant`` (failing its filter, gone before), ``unique_fails`` (failing
    its filter alone), ``<measure>_lost`` (removed by it), ``shapley`` (its filter's removals over all orders).
    """
    k = len(filters)
    if not 1 <= k <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {k}")
    spark = counted.sparkSession
    sums = ["n", *measures]
    by_mask = counted.groupBy(F.coalesce("part", F.lit("")).alias("part"), "mask").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
    by_mask = frozen(by_mask, "audit-masks")
    intervals = spark.createDataFrame(removal_intervals(k), "mask int, step int, filter int, first int, past int")

    # the difference array: counts at both ends of each interval
    ends = F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("past").alias("rank"), F.lit(-1).alias("sign")))
    steps = by_mask.join(F.broadcast(intervals), "mask").select("part", "step", F.explode(ends).alias("end"), *sums)
    steps = steps.groupBy("part", "step", "end.rank").agg(*[F.sum(F.col(c) * F.col("end.sign")).alias(c) for c in sums])

    # every rank and step of every part, then the prefix sum
    bits = range(k)
    totals = by_mask.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(1 << f) > 0, F.col("n")).otherwise(0)) for f in bits]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0)) for f in bits]).alias("alone"),
    )
    grid = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    placed = grid.join(steps, ["part", "step", "rank"], "left")
    over_ranks = Window.partitionBy("part", "step").orderBy("rank")
    summed = placed.select("part", "step", "rank", "total", "fails", "alone", *[F.coalesce(F.sum(c).over(over_ranks), F.lit(0)).alias(c) for c in sums])

    orders = [
        (rank, step + 1, f, "".join(filters[i] for i in order))
        for rank, order in enumerate(permutations(bits)) for step, f in enumerate(order)
    ]
    named = spark.createDataFrame(orders, "rank int, step int, filter int, filter_order string")
    gone = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step"))
    own = F.sum("n").over(Window.partitionBy("part", "filter"))
    names = F.array(*[F.lit(f) for f in filters])
    return summed.join(F.broadcast(named), ["rank", "step"]).select(
        "part", "filter_order", "step", F.get(names, F.col("filter")).alias("filter"),
        (F.col("total") - gone).alias("kept"), F.col("n").alias("removed"),
        (F.get("fails", F.col("filter")) - F.col("n")).alias("redundant"),
        F.get("alone", F.col("filter")).alias("unique_fails"),
        *[F.col(m).alias(f"{m}_lost") for m in measures],
        own.alias("shapley"),
    )


def mask_of(*fails: Column) -> Column:
    """Bit i is set where condition i holds."""
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0)).cast("int")


def text_failures(text: Column, words: Column) -> list[Column]:
    """Filters A to D on a text and the array of its words: few words, few distinct words, many capitals, symbols."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("bigint") > 10 * F.length(text).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]


def counted_masks(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)`` of documents under the five filters.

    Texts are read once; what moves is a digest and a few numbers a document. The smallest id of a text is found by
    its digest with partial sums, and met by digest and id together, so copies are never in one place.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(part_column), F.lit("")).alias("part"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    split = computed(plain, ["doc_id", "part", "text"], words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    read = split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_key"), mask_of(*text_failures(F.col("text"), F.col("words"))).alias("mask"))
    rows = frozen(read.groupBy("doc_id", "part", "text_key", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    first = rows.where("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    own = rows.where("doc_id is not null").join(first, ["text_key", "doc_id"], "left")
    copy_bit = 1 << FILTERS.index("E")
    own = own.withColumn("mask", F.when(F.col("is_first"), F.col("mask")).otherwise(F.col("mask") + copy_bit))
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    marked = own.join(marks, "doc_id", "left").select("part", "mask", "n", "is_good", "is_toxic")
    without_id = rows.where("doc_id is null").select("part", "mask", "n", F.lit(False).alias("is_good"), F.lit(False).alias("is_toxic"))
    lost = {m: F.sum(F.when(F.col(f"is_{m}"), F.col("n")).otherwise(0)).alias(m) for m in ("good", "toxic")}
    return marked.unionByName(without_id).groupBy("part", "mask").agg(F.sum("n").alias("n"), *lost.values())


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of ``audit`` on documents(doc_id, text, lang) and labels(doc_id, quality, toxic), by language."""
    return audit(counted_masks(docs, labels), FILTERS, ["good", "toxic"])
