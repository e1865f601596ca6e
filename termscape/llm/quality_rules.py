"""Quality rules: compression bands.

A text that zstandard shrinks far more than prose of its length is repetitive; one that it hardly
shrinks is noise. Ratios (bytes / compressed bytes) are taken over the whole text and over fixed
chunks of it; the limits depend on the length, because short texts always compress less.

No shuffle: a document is judged in the task that reads it.

Defined cases: null text is empty text; an empty text has no words and fails the base rules; equal
rows are judged alike, each on its own; a text of any length is judged whole; an empty table gives no rows; other
columns pass through untouched, and a column named as one of the results is replaced by ``judge_quality``, not by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termscape.llm.common import WORD_RE, bounded_batches

SYMBOLS = "#*$%&|<>"
WORD_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


@dataclass(frozen=True)
class Band:
    """Allowed ratios for texts of at most ``max_bytes`` bytes."""

    max_bytes: int
    lowest: float
    highest: float


#: Limits by length. Prose of a few hundred bytes reaches 1.3 to 2, long prose 2 to 3.
BANDS = (
    Band(200, 0.0, 2.2),
    Band(1_000, 1.05, 2.8),
    Band(4_000, 1.25, 3.4),
    Band(1 << 62, 1.4, 4.5),
)
CHUNK_BYTES = 2_048
CHUNK_BAND = Band(CHUNK_BYTES, 1.2, 3.4)
#: Share of the chunks that may lie outside the band for chunks.
MAX_ODD_CHUNKS = 0.3
LEVEL = 3

RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "ratio double, n_chunks bigint, n_odd_chunks bigint, kept boolean"
)


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words which the text holds twice or more."""
    count = len(words)
    if count <= window:
        return 0
    ids: dict[str, int] = {}
    single = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, count)
    if len(ids) == count:
        return 0
    # ranks of windows of 2, 4 and 5 words; each is exact, as ranks stay below the number of words
    rank = single
    for shift in (1, 2):
        _, rank = np.unique(rank[:-shift] * (count + 1) + rank[shift:], return_inverse=True)
    _, rank, times = np.unique(rank[:-1] * (count + 1) + single[4:], return_inverse=True, return_counts=True)
    twice = times[rank] > 1
    if not twice.any():
        return 0
    edges = np.zeros(count + 1, np.int64)
    starts = np.flatnonzero(twice)
    edges[starts] += 1  # starts are distinct
    np.subtract.at(edges, starts + window, 1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(WORD_SPACE)]
    return len(lines) - len(set(lines))


def band_of(n_bytes: int, bands: tuple[Band, ...] = BANDS) -> Band:
    return next(b for b in bands if n_bytes <= b.max_bytes)


def judge(text: str | None, compressor: zstandard.ZstdCompressor, bands: tuple[Band, ...] = BANDS) -> tuple:
    text = text or ""
    words = WORD_RE.findall(text)
    n_words, n_repeat = len(words), repeat_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    raw = text.encode()
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    band = band_of(len(raw), bands)
    # fixed chunks; a last piece shorter than a chunk has no band of its own and is left to the whole
    chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    odd = sum(not CHUNK_BAND.lowest <= CHUNK_BYTES / len(compressor.compress(c)) <= CHUNK_BAND.highest for c in chunks)
    in_band = band.lowest <= ratio <= band.highest and odd <= MAX_ODD_CHUNKS * len(chunks)
    symbols = sum(text.count(s) for s in SYMBOLS)
    return (n_words, sum(map(len, words)), symbols, duplicate_lines(text), n_repeat, base_failed, ratio, len(chunks), odd, not base_failed and in_band)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [c.split()[0] for c in RESULT.split(", ")]
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        # the text to judge comes last, whatever the other columns are called
        rows = [judge(text, compressor) for text in batch.column(batch.num_columns - 1).to_pylist()]
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        found = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
        own = range(batch.num_columns - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in own] + found, names=[batch.schema.names[i] for i in own] + names
        )


def judge_quality(docs: DataFrame, text: str = "text", keep_columns: list[str] | None = None) -> DataFrame:
    """Add the statistics and the verdict to each document.

    ``keep_columns`` names the columns that stay (all by default). Columns of the result's names are
    replaced.
    """
    bounded_batches(docs.sparkSession)
    result_names = [c.split()[0] for c in RESULT.split(", ")]
    columns = [c for c in (docs.columns if keep_columns is None else keep_columns) if c not in result_names]
    own = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("text to judge"))
    return own.mapInArrow(_judged, T.StructType([*own.schema.fields[:-1], *T.StructType.fromDDL(RESULT).fields]))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns and values only, whatever they are called."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return judge_quality(docs.select(row, F.col(f"`{text}`").alias("text")), keep_columns=["row"]).where("kept").select("row.*")
