"""Spelling variants: words one edit apart, each led to the most used form.

Words are counted where they stand; from then on only the distinct ones move. Two words within one inserted,
deleted or replaced code point agree at the start and at the end, up to the edit: with m the longer length,
common prefix and common suffix reach m - 1 together. So one of them is at least h = ceil((m - 1) / 2) long, and
the words of length m and m - 1 that agree in their first h code points, or in their last h, hold all pairs of
class m. Such a group is cut into blocks of ``BLOCK_CELLS`` code points and block meets block: a tile holds two
padded matrices of code points, one aligned left and one right, and common prefixes and suffixes of its pairs
come from comparing them. A tile's size is bounded whatever the group's; a pair that agrees at both ends
belongs to its prefix group. No pair leaves a tile but those one edit apart.

Following forms to the last is done by doubling: a step replaces each word's form by that form's own. Forms at least
double the count, so a chain has fewer links than a count has bits.

Defined cases: null and empty texts have no words; a null id is written as the empty string before the colon. A text or run
of any length is one row; long runs are fewer to a block. Repeated rows count each time. Ties for the most used
near word go to the smallest in code-point order. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import ascii_lower
from termscape.session import Scratch, frozen

#: Letters of a word: Latin letters up to U+00FF (with the two signs that stand among them).
RUN = r"[A-Za-zÀ-ÿ]+"

#: Words of fewer code points or occurrences are left out.
MIN_LENGTH, MIN_COUNT = 5, 3

#: A form is used so many times as often as the word it replaces, at least.
FORM_RATIO = 2

#: One word of a document in so many loses a code point.
SLIP = 97

#: Code points of a block's matrix, and pairs that are compared at once.
BLOCK_CELLS = 1 << 14
PAIR_CELLS = 1 << 20


def word_counts(docs: DataFrame, slip: int | None = SLIP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(word, n)`` of lower-cased letter runs.

    With ``slip``, a run whose crc32 under ``<id>:<run>`` it divides loses the code point at that number modulo its length.
    """
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(text_column, F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= MIN_LENGTH)
    runs = runs.select("doc_id", ascii_lower(F.col("run")).alias("run"))
    if slip:
        # equal runs of a document become the same word, so they are counted before the checksum
        h = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.select(F.when(F.pmod(h, F.lit(slip)) == 0, cut).otherwise(F.col("run")).alias("run"))
    counted = runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def _tiles(words: DataFrame) -> DataFrame:
    """``(m, at_end, key, low, high, own, word, n)``: each word once per block that its block meets."""
    sides = []
    for longer in (0, 1):
        m = F.length("word") + longer
        half = F.expr(f"(length(word) + {longer}) div 2").cast("int")
        sides += [
            F.struct(m.alias("m"), F.lit(False).alias("at_end"), F.substring("word", F.lit(1), half).alias("key")),
            F.struct(m.alias("m"), F.lit(True).alias("at_end"), F.substring("word", F.length("word") - half + 1, half).alias("key")),
        ]
    grouped = words.select("word", "n", F.explode(F.array(*sides)).alias("g")).select("word", "n", "g.*")
    size = F.greatest(F.expr(f"{BLOCK_CELLS} div m"), F.lit(1))
    large = grouped.groupBy("m", "at_end", "key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > size)
    large = large.withColumn("blocks", F.ceil(F.col("members") / size).cast("int")).drop("members")
    placed = grouped.join(large, ["m", "at_end", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("m", "at_end", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "word", "n")


NEAR_SCHEMA = "word string, near string, near_n bigint"


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; of a batch's last tile the rows are held until the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        starts = _tile_starts(table)
        if len(starts):
            yield from _near_pairs(table.slice(0, starts[-1]), starts)
            held = table.slice(starts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield from _near_pairs(held, np.array([0, held.num_rows]))


def _tile_starts(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, np.int64)
    turns = np.zeros(table.num_rows - 1, bool)
    for name in ("m", "at_end", "low", "high"):
        values = table.column(name).to_numpy()
        turns |= values[1:] != values[:-1]
    keys = np.array(table.column("key").to_pylist(), object)
    return np.concatenate([[0], np.flatnonzero(turns | (keys[1:] != keys[:-1])) + 1])


def _near_pairs(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``edges`` are the tiles' starts and the end of the last."""
    m, own = table.column("m").to_numpy(), table.column("own").to_numpy()
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    at_end = table.column("at_end").to_numpy()
    words = np.array(table.column("word").to_pylist(), object)
    n = table.column("n").to_numpy()
    lengths = np.array([len(w) for w in words], np.int64)
    first: list[np.ndarray] = []
    second: list[np.ndarray] = []
    waiting = 0

    def compared() -> Iterator[pa.RecordBatch]:
        nonlocal waiting
        i, j = np.concatenate(first), np.concatenate(second)
        first.clear()
        second.clear()
        waiting = 0
        i, j = _one_edit(words, lengths, i, j, int(m[i[0]]), at_end[i])
        if len(i):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([words[i], words[j]]), pa.string()), pa.array(np.concatenate([words[j], words[i]]), pa.string()), pa.array(np.concatenate([n[j], n[i]]), pa.int64())],
                names=["word", "near", "near_n"],
            )

    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if end - start < 2:
            continue
        if first and m[first[0][0]] != m[start]:
            yield from compared()
        rows = np.arange(start, end)
        if low[start] == high[start]:
            lefts, rights = rows[:-1], rows
        else:
            lefts, rights = rows[own[start:end] == low[start]], rows[own[start:end] == high[start]]
        step = max(1, PAIR_CELLS // int(m[start]) // max(len(rights), 1))
        for at in range(0, len(lefts), step):
            i, j = (x.ravel() for x in np.meshgrid(lefts[at : at + step], rights, indexing="ij"))
            # of two shorter words the class below takes care
            wanted = np.maximum(lengths[i], lengths[j]) == m[start]
            if low[start] == high[start]:
                wanted &= i < j
            if wanted.any():
                first.append(i[wanted])
                second.append(j[wanted])
                waiting += int(wanted.sum())
            if waiting * int(m[start]) >= PAIR_CELLS:
                yield from compared()
    if first:
        yield from compared()


def _one_edit(words: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray, m: int, at_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose common prefix and suffix reach ``m - 1`` together. Words are distinct."""
    rows, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = back[: len(i)], back[len(i) :]
    ahead = np.array(list(words[rows]), f"<U{m}").view("<u4").reshape(-1, m)
    shift = np.arange(m) + (lengths[rows] - m)[:, None]
    behind = np.where(shift >= 0, np.take_along_axis(ahead, np.maximum(shift, 0), axis=1), 0)
    prefix = (ahead[a] == ahead[b]).argmin(axis=1)
    suffix = (behind[a] == behind[b])[:, ::-1].argmin(axis=1)
    near = (prefix + suffix >= m - 1) & ~(at_end & (prefix >= m // 2))
    return i[near], j[near]


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)``: every ordered pair of ``words(word, n)``, distinct words, that are one edit apart."""
    tile = ["m", "at_end", "key", "low", "high"]
    return _tiles(words).repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_compare_tiles, NEAR_SCHEMA)


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` from ``(word, root)`` with each word's own form, by doubling."""
    links = scratch.table(links, "spelling-links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        longer = links.join(onward, "root", "left")
        if longer.where("onward is not null").isEmpty():
            return links
        links = scratch.table(longer.select("word", F.coalesce("onward", "root").alias("root")), "spelling-links")


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of ``words(word, n)``, distinct words.

    ``form`` is the near word of largest count if that is ``ratio`` times the word's or more, else null; ``root`` is
    where following forms ends.
    """
    with Scratch(words.sparkSession) as scratch:
        words = scratch.table(words, "spelling-words")
        best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
        found = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
        led = -F.col("best.minus_n") >= ratio * F.col("n")
        formed = words.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(led, F.col("best.near")).alias("form"), F.when(led, -F.col("best.minus_n")).alias("form_n"),
        )
        formed = scratch.table(formed, "spelling-forms")
        roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")), scratch)
        rooted = formed.join(roots, "word", "left")
        return frozen(rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-variants")
