"""Which hashes of a document occur elsewhere: the exchange that three operators share.

Documents are dealt into shards of a few MB by a hash of their row. A shard computes the hashes of its
documents (shingles, anchors, chunks), sorts the distinct ones and sends them, packed, to the counters,
each of which owns a range of the hash space. A counter answers each shard with the hashes
that have company, and how much. The shard meets the answer in a cogroup and goes on from there.

What is exchanged for a hash is about three bytes: within a counter's range only the 32 bits below the
range's own are told apart. The number of counters grows with the input, and so does what their
numbers tell apart. Two different hashes that agree there are counted together, so a count may be too
high, never too low. Callers use it as a filter or an order and settle equality on full values.

The rows of the exchange grow with the input, not with shards times counters. A shard writes to at most
``2 ** FAN_BITS`` ranges. Where there are more counters, relays stand between: a relay owns one range of a group of
shards, as many as it has finer ranges to write to, merges their sorted lists, and passes the merged one on. The answers come
back the same way: the relay meets its lists once more and answers each shard of its group. So each step sends at most
``2 ** FAN_BITS`` rows per shard, a relay holds no more hashes than a shard has, and the steps grow with the logarithm of
the counters: one up to 256 counters, two up to 65,536, three up to 16 million.

A hash with a third of all documents behind it is one entry per shard, and then one per group of shards.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text per shard. A task holds one shard at a time.
SHARD_BYTES = 4 << 20

#: Distinct hashes that a counter is meant to hold.
COUNTER_HASHES = 2 << 20

#: A shard or relay writes to at most two to the power of so many ranges.
FAN_BITS = 8

Hasher = Callable[[pa.Table], np.ndarray]


def dealt(
    docs: DataFrame, id_column: str, text_column: str, carried: list[str] | None = None, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, int]:
    """``(shard, doc_id, text, row_key)`` and the number of shards. Equal rows share a shard.

    ``row_key`` is a hash of id and text. ``carried`` columns come along in a struct of that name.
    """
    plain = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in carried]).alias("carried")] if carried else []),
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    return plain.withColumn("shard", F.pmod(F.col("row_key"), F.lit(shards)).cast("int")), shards


def in_order(table: pa.Table) -> pa.Table:
    """The shard's rows in an order that only their values fix."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def steps_of(bits: int) -> tuple[int, ...]:
    """``bits`` dealt over as few steps as ``FAN_BITS`` allows, as evenly as can be, the larger ones first."""
    n_steps = max(1, -(-bits // FAN_BITS))
    return tuple(bits // n_steps + (i < bits % n_steps) for i in range(n_steps))


def counter_steps(shards: int, hashes_per_shard: int) -> tuple[int, ...]:
    """Bits of the hash that choose the counter, by steps of the exchange."""
    return steps_of(max(4, int(np.ceil(np.log2(max(1, shards * hashes_per_shard / COUNTER_HASHES))))))


def pack(sorted_values: np.ndarray) -> bytes:
    """Sorted numbers as gaps, byte plane by byte plane, which the shuffle's codec then shrinks; their width first."""
    gaps = np.diff(sorted_values.astype("<u8"), prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + gaps.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def unpack(blob: bytes, dtype: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(blob[0], -1)
    gaps = np.zeros((planes.shape[1], np.dtype(dtype).itemsize), np.uint8)
    gaps[:, : blob[0]] = planes.T
    return np.cumsum(gaps.view(dtype).ravel(), dtype=dtype)


def slots(hashes: np.ndarray, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct slots of 64-bit hashes, their counts, and where each range of the first step begins; the inverse map.

    A slot is the hash's upper bits, those of all steps and 32 more.
    """
    upper = hashes >> np.uint64(32 - sum(steps))
    found, inverse, times = np.unique(upper, return_inverse=True, return_counts=True)
    return found, inverse, times, _edges(found, steps[0], sum(steps[1:]))


def _edges(sorted_slots: np.ndarray, step: int, rest: int) -> np.ndarray:
    """Where each of the ``2 ** step`` ranges begins, below which ``rest`` bits choose finer ranges."""
    ranges = (sorted_slots >> np.uint64(32 + rest)).astype(np.int64)
    return np.searchsorted(ranges, np.arange((1 << step) + 1))


QUESTION_SCHEMA = "counter int, asker int, slots binary, times binary"


def _questions(found: np.ndarray, times: np.ndarray, edges: np.ndarray, rest: int, above: int, asker: int) -> pa.Table:
    """A row for each range that holds slots. ``above`` is the number of the range that these are parts of."""
    low = found & np.uint64((1 << (32 + rest)) - 1)
    times = np.minimum(times, 0xFFFFFFFF).astype("<u4")
    full = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "counter": pa.array(full + above * (len(edges) - 1), pa.int32()),
            "asker": pa.array(np.full(len(full), asker), pa.int32()),
            "slots": pa.array([pack(low[edges[c] : edges[c + 1]]) for c in full], pa.binary()),
            "times": pa.array([times[edges[c] : edges[c + 1]].tobytes() for c in full], pa.binary()),
        }
    )


def _ask(hasher: Hasher, steps: tuple[int, ...]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        found, _, times, edges = slots(hasher(in_order(table)), steps)
        return _questions(found, times, edges, sum(steps[1:]), 0, key[0].as_py())

    return run


def _met(table: pa.Table, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct slots of all questions and how often each occurs; the inverse map, and where each question's slots end."""
    asked = [unpack(b, dtype) for b in table.column("slots").to_pylist()]
    times = np.concatenate([np.frombuffer(b, "<u4") for b in table.column("times").to_pylist()])
    found, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, inverse, times)
    return found, total, inverse, np.cumsum([len(a) for a in asked])


ANSWER_SCHEMA = "asker int, counter int, company binary, total binary"


def _answers(table: pa.Table, own: np.ndarray, ends: np.ndarray) -> pa.Table:
    """For each question: a bit per slot, set if it occurs twice or more, and the counts of those."""
    pieces = np.split(np.minimum(own, 0xFFFFFFFF).astype("<u4"), ends[:-1])
    return pa.table(
        {
            "asker": table.column("asker").cast(pa.int32()),
            "counter": table.column("counter").cast(pa.int32()),
            "company": pa.array([np.packbits(p > 1).tobytes() for p in pieces], pa.binary()),
            "total": pa.array([p[p > 1].tobytes() for p in pieces], pa.binary()),
        }
    )


def _answer(table: pa.Table) -> pa.Table:
    _, total, inverse, ends = _met(table, np.uint32)
    return _answers(table, total[inverse], ends)


def _relay(step: int, rest: int):
    """Passes on what a group of askers asks about one range, as one question to each of its parts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        counter, node = (k.as_py() for k in key)
        found, total, _, _ = _met(table, np.uint64)
        return _questions(found, total, _edges(found, step, rest), rest, counter, node)

    return run


def _return(step: int, rest: int):
    """Answers each asker of a group from the answers that their relay got."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        found, _, inverse, ends = _met(table, np.uint64)
        total = _totals(_edges(found, step, rest), answers, key[0].as_py() << step)
        return _answers(table, total[inverse], ends)

    return run


def _totals(edges: np.ndarray, answers: pa.Table, first_counter: int = 0) -> np.ndarray:
    """The counts of all slots (1: no company), of which ``edges`` tells where each counter's begin."""
    total = np.ones(edges[-1], np.int64)
    for counter, company, counts in zip(
        answers.column("counter").to_pylist(), answers.column("company").to_pylist(), answers.column("total").to_pylist(), strict=True
    ):
        first, last = edges[counter - first_counter], edges[counter - first_counter + 1]
        mask = np.unpackbits(np.frombuffer(company, np.uint8), count=last - first).astype(bool)
        total[first:last][mask] = np.frombuffer(counts, "<u4")
    return total


def answered(asked: DataFrame, steps: tuple[int, ...]) -> DataFrame:
    """Answers to questions; ``steps`` are those that the questions have not taken yet."""
    if not steps:
        return asked.groupBy("counter").applyInArrow(_answer, ANSWER_SCHEMA)
    step, rest = steps[0], sum(steps[1:])
    groups = asked.withColumn("node", F.shiftright("asker", step)).groupBy("counter", "node")
    answers = answered(groups.applyInArrow(_relay(step, rest), QUESTION_SCHEMA), steps[1:])
    answers = answers.withColumn("above", F.shiftright("counter", step)).groupBy("above", "asker")
    return groups.cogroup(answers).applyInArrow(_return(step, rest), ANSWER_SCHEMA)


def shared_counts(shard_docs: DataFrame, hasher: Hasher, steps: tuple[int, ...]) -> DataFrame:
    """One row per shard and range of the first step: which slots have company, and the counts. Read with ``counts_of``."""
    asked = shard_docs.groupBy("shard").applyInArrow(_ask(hasher, steps), QUESTION_SCHEMA)
    return answered(asked, steps[1:]).withColumnRenamed("asker", "shard")


def counts_of(hashes: np.ndarray, steps: tuple[int, ...], answers: pa.Table) -> np.ndarray:
    """Number of occurrences over all documents of each hash (1: nowhere else)."""
    _, inverse, _, edges = slots(hashes, steps)
    return _totals(edges, answers)[inverse]
