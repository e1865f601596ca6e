"""Suffix-array dedup: removes every byte of a 200-byte string that also starts anywhere else.

A full suffix array of 100 TB is 100 trillion rows. This one is sparse and exact: it holds only
suffixes at anchors, chosen by content so that every 200-byte window has one at the same place in each
of its copies.

1. Anchors: of the ``GRAM``-byte grams that start in a window, those with the smallest hash. Shards count
   the anchors' gram hashes over all documents (``termscape.llm.shards``); an anchor whose gram occurs once
   cannot lie in a repeated window and goes no further.
2. Suffix runs: a shard cuts the suffixes at the anchors left to the 200 bytes that matter, with the
   bytes before the anchor beside them, collapses equal ones to one entry with a count, sorts them and
   front-codes the sorted run (length of the prefix shared with the entry before, and the tail). Runs are
   exchanged by ranges of the gram hash: equal windows have equal grams and meet in one merger. A shard writes at
   most 256 runs. Where there are more mergers, relays merge the runs of a group of shards by the same
   loser trees, collapse equal entries, and write the merged order as runs of finer ranges; so runs stay long and
   their number grows with the input, not with its square. Answers come back through the relays.
3. Merge: a loser tree over the runs keeps with each loser the length of its common prefix with the winner.
   Where two such lengths differ they decide; only equal ones are compared, and from there on. The lengths
   of the merged order fall out.
4. In the merged order, the suffixes that share the next ``200 - d`` bytes are neighbours; of these, the ones
   that also share the ``d`` bytes before the anchor are copies of one window. Each shard gets back, per
   entry, for which ``d`` the window has company.
5. The shard covers these windows and hashes what is left.

All comparisons that decide are on bytes. Hashes choose anchors and route entries; inside a shard or a relay a
64-bit hash of an entry's bytes finds it again.

Windows that occur in a third of all documents are one entry per shard, and one per relay further on. A gram of 128 to 199 bytes in
different surroundings everywhere stays as many entries as surroundings.

Defined cases: null is empty; texts under 200 bytes lose nothing; rows with equal or null ids, and equal
rows, are separate documents that hold copies of each other's windows. A text longer than a shard is a shard of
its own size, held whole by one task. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termscape.llm import shards
from termscape.llm.rolling import blocks, gram_hashes, mixed, row_hashes, sliding

LENGTH = 200
GRAM = 128
#: An anchor lies at most so many bytes behind the start of its window.
REACH = LENGTH - GRAM
#: Anchors to expect in a shard, for the number of counters: two per window of ``REACH + 2`` grams.
ANCHORS_PER_SHARD = 2 * shards.SHARD_BYTES // (REACH + 2)


class Buffer:
    """The bytes of a shard's documents, one after the other."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        self.data = b"".join(raw)
        self.bytes = np.frombuffer(self.data, np.uint8)
        sizes = np.array([len(r) for r in raw], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the smallest grams of all windows, and their hashes."""
        places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for first, last in blocks(self.ends):
            start, end = self.starts[first], self.ends[last - 1]
            if end - start < LENGTH:
                continue
            grams = gram_hashes(self.bytes[start:end], GRAM)
            low = (grams >> np.uint64(33)).astype(np.int32)
            least = sliding(low, REACH + 1, np.minimum)
            # a window that would cross into the next document does not count
            inside = np.zeros(len(least), bool)
            for s, e in zip(self.starts[first:last] - start, self.ends[first:last] - start, strict=True):
                inside[s : max(s, e - LENGTH + 1)] = True
            padded = np.full(len(low) + REACH, -1, np.int32)
            padded[REACH : REACH + len(least)] = np.where(inside, least, -1)
            # a place is an anchor if some window that starts up to REACH before has its hash as the smallest
            own = np.flatnonzero(sliding(padded, REACH + 1, np.maximum) == low)
            places.append(own + start)
            hashes.append(mixed(grams[own]))  # anew, as the smallest of many crowd at the lower end
        return np.concatenate(places), np.concatenate(hashes)

    def bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte before each anchor and end of its suffix, both within the anchor's document."""
        owner = np.searchsorted(self.ends, places, side="right")
        return np.maximum(places - REACH, self.starts[owner]), np.minimum(places + LENGTH, self.ends[owner])

    def entry_keys(self, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of each anchor's suffix and of the bytes before it, told apart by the place between."""
        digest, data = xxhash.xxh3_64_intdigest, self.data
        spans = zip((places - first).tolist(), first.tolist(), last.tolist(), strict=True)
        return np.array([digest(data[f:e], seed=before) for before, f, e in spans], np.uint64)


def _shard_hashes(table: pa.Table) -> np.ndarray:
    return Buffer(table.column("text").to_pylist()).anchors()[1]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    size = min(len(a), len(b)) - known
    if size <= 0:
        return known
    differ = int.from_bytes(a[known : known + size]) ^ int.from_bytes(b[known : known + size])
    return known + size - (differ.bit_length() + 7) // 8


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs (strings, common prefix of each with the one before in its run).

    Returns, in merged order, the run and the place in it of each string, and the common prefix with
    the string before. A tree of losers: each inner node keeps the loser of its match and the length
    of its common prefix with the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [0] * len(runs)
    gone = -1  # common prefix of a run that has ended; it loses against everything
    string: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    prefix = [0 if s is not None else gone for s in string]
    loser = [0] * k
    from_run: list[int] = []
    at: list[int] = []
    shared: list[int] = []

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; both prefixes refer to the same string, the loser's then to the winner."""
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        if prefix[a] == gone:
            return a, b
        x, y = string[a], string[b]
        known = common_prefix(x, y, prefix[a])
        if known == len(x) or (known < len(y) and x[known] < y[known]):
            prefix[b] = known
            return a, b
        prefix[a] = known
        return b, a

    winners = list(range(k))
    node = k // 2
    while len(winners) > 1:
        following = []
        for i in range(0, len(winners), 2):
            win, lose = match(winners[i], winners[i + 1])
            loser[node + i // 2] = lose
            following.append(win)
        winners, node = following, node // 2
    winner = winners[0]
    while prefix[winner] != gone:
        from_run.append(winner)
        at.append(heads[winner])
        shared.append(prefix[winner])
        heads[winner] += 1
        strings, prefixes = runs[winner]
        if heads[winner] < len(strings):
            string[winner], prefix[winner] = strings[heads[winner]], prefixes[heads[winner]]
        else:
            string[winner], prefix[winner] = None, gone
        node = (winner + k) // 2
        while node:
            winner, loser[node] = match(winner, loser[node])
            node //= 2
    return from_run, at, shared


RUN_SCHEMA = "merger int, asker int, prefixes binary, sizes binary, tails binary, before_sizes binary, before binary, times binary, keys binary"


class _Runs:
    """Rows of front-coded runs."""

    def __init__(self, asker: int):
        self.asker = asker
        self.rows: dict[str, list] = {c.split()[0]: [] for c in RUN_SCHEMA.split(", ")}

    def add(self, merger: int, strings: list[bytes], prefixes: np.ndarray, before: list[bytes], times: np.ndarray, keys: np.ndarray) -> None:
        rows = self.rows
        rows["merger"].append(merger)
        rows["asker"].append(self.asker)
        rows["prefixes"].append(prefixes.astype("<u2").tobytes())
        rows["sizes"].append(np.array([len(x) for x in strings], "<u2").tobytes())
        rows["tails"].append(b"".join(x[p:] for x, p in zip(strings, prefixes.tolist(), strict=True)))
        rows["before_sizes"].append(np.array([len(x) for x in before], np.uint8).tobytes())
        rows["before"].append(b"".join(before))
        rows["times"].append(np.minimum(times, 0xFFFFFFFF).astype("<u4").tobytes())
        rows["keys"].append(keys.astype("<u8").tobytes())

    def table(self) -> pa.Table:
        kinds = {"merger": pa.int32(), "asker": pa.int32()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in self.rows.items()})


def _runs(count_steps: tuple[int, ...], merge_steps: tuple[int, ...]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = shards.in_order(docs)
        runs = _Runs(docs.column("shard")[0].as_py() if docs.num_rows else 0)
        buffer = Buffer(docs.column("text").to_pylist())
        places, grams = buffer.anchors()
        if answers.num_rows and len(places):
            company = shards.counts_of(grams, count_steps, answers) > 1
            places, grams = places[company], grams[company]
            first, last = buffer.bounds(places)
            keys = buffer.entry_keys(places, first, last)
            keys, index, times = np.unique(keys, return_index=True, return_counts=True)
            places, grams, first, last = places[index], grams[index], first[index], last[index]
            merger = (grams >> np.uint64(64 - merge_steps[0])).astype(np.int64)
            for m in np.unique(merger):
                chosen = np.flatnonzero(merger == m)
                entries = sorted((buffer.data[places[i] : last[i]], i) for i in chosen.tolist())
                order = np.array([i for _, i in entries])
                strings = [string for string, _ in entries]
                prefixes = np.array([0] + [common_prefix(a, b, 0) for a, b in zip(strings, strings[1:], strict=False)])
                before = [buffer.data[first[i] : places[i]][::-1] for i in order]
                runs.add(int(m), strings, prefixes, before, times[order], keys[order])
        return runs.table()

    return run


def decode_run(prefixes: np.ndarray, sizes: np.ndarray, tails: bytes) -> list[bytes]:
    strings, end, previous = [], 0, b""
    for prefix, size in zip(prefixes.tolist(), sizes.tolist(), strict=True):
        start, end = end, end + size - prefix
        previous = previous[:prefix] + tails[start:end]
        strings.append(previous)
    return strings


def repeated_windows(sizes: np.ndarray, shared: np.ndarray, before: np.ndarray, before_sizes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For entries in merged order: whether the window that starts ``d`` bytes before has a copy, for each ``d``."""
    found = np.zeros((len(sizes), REACH + 1), bool)
    rank = np.zeros(len(sizes), np.int64)
    for d in range(REACH + 1):
        if d:
            _, rank = np.unique(rank * 256 + before[:, d - 1].astype(np.int64), return_inverse=True)
        group = np.cumsum(shared < LENGTH - d)
        whole = np.flatnonzero((sizes >= LENGTH - d) & (before_sizes >= d))
        if not len(whole):
            continue
        _, window = np.unique(group[whole] * (len(sizes) + 1) + rank[whole], return_inverse=True)
        copies = np.bincount(window, weights=times[whole])
        found[whole, d] = copies[window] > 1
    return found


class _Merged:
    """The entries of some runs, one after the other (``offset`` tells where each run's begin), and their merged order."""

    def __init__(self, table: pa.Table):
        columns = {c: table.column(c).to_pylist() for c in ("prefixes", "sizes", "tails", "before_sizes", "before", "times", "keys")}
        prefixes = [np.frombuffer(b, "<u2") for b in columns["prefixes"]]
        sizes = [np.frombuffer(b, "<u2") for b in columns["sizes"]]
        runs = [(decode_run(p, s, t), p.tolist()) for p, s, t in zip(prefixes, sizes, columns["tails"], strict=True)]
        from_run, at, self.shared = (np.array(x, np.int64) for x in merge_runs(runs))
        self.offset = np.cumsum([0] + [len(s) for s in sizes])
        self.order = self.offset[from_run] + at  # place of each entry of the merged order
        self.strings = [string for strings, _ in runs for string in strings]
        self.sizes = np.concatenate(sizes).astype(np.int64)
        self.before_sizes = np.concatenate([np.frombuffer(b, np.uint8) for b in columns["before_sizes"]]).astype(np.int64)
        self.before = b"".join(columns["before"])
        self.times = np.concatenate([np.frombuffer(b, "<u4") for b in columns["times"]])
        self.keys = np.concatenate([np.frombuffer(b, "<u8") for b in columns["keys"]])


MASK_SCHEMA = "merger int, asker int, keys binary, masks binary"
MASK_BYTES = (REACH + 8) // 8


def _masks(runs: pa.Table, offset: np.ndarray, keys: np.ndarray, masks: np.ndarray) -> pa.Table:
    """For each run the keys and masks of those of its entries that have a window with company."""
    some = masks.any(axis=1)
    answer: dict[str, list] = {c.split()[0]: [] for c in MASK_SCHEMA.split(", ")}
    for r, (merger, asker) in enumerate(zip(runs.column("merger").to_pylist(), runs.column("asker").to_pylist(), strict=True)):
        own = np.arange(offset[r], offset[r + 1])
        own = own[some[own]]
        if len(own):
            answer["merger"].append(merger)
            answer["asker"].append(asker)
            answer["keys"].append(keys[own].tobytes())
            answer["masks"].append(masks[own].tobytes())
    kinds = {"merger": pa.int32(), "asker": pa.int32()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in answer.items()})


def _merge(table: pa.Table) -> pa.Table:
    entries = _Merged(table)
    order = entries.order
    left = np.zeros((len(order), REACH), np.uint8)
    filled = np.arange(REACH) < entries.before_sizes[:, None]
    left[filled] = np.frombuffer(entries.before, np.uint8)
    found = repeated_windows(entries.sizes[order], entries.shared, left[order], entries.before_sizes[order], entries.times[order])
    masks = np.zeros((len(order), MASK_BYTES), np.uint8)
    masks[order] = np.packbits(found, axis=1)
    return _masks(table, entries.offset, entries.keys, masks)


def _relay(done: int, step: int):
    """Passes on the runs of a group of askers as one run for each part of the range, whose first ``done`` bits are fixed."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        merger, node = (k.as_py() for k in key)
        entries, runs = _Merged(table), _Runs(node)
        keys = entries.keys[entries.order]
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        times = np.bincount(inverse, weights=entries.times[entries.order])[inverse].astype(np.int64)
        kept = np.sort(first)  # of equal entries the first of the merged order
        strings = [entries.strings[i] for i in entries.order[kept].tolist()]
        grams = np.frombuffer(b"".join(x[:GRAM] for x in strings), np.uint8).reshape(-1, GRAM)
        part = (mixed(row_hashes(grams)) << np.uint64(done)) >> np.uint64(64 - step)
        ends = np.cumsum(entries.before_sizes)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            at = kept[own]
            # what two entries share is the least of what neighbours between them share
            prefixes = np.minimum.reduceat(entries.shared[: at[-1] + 1], at[:-1] + 1) if len(at) > 1 else []
            places = entries.order[at]
            before = [entries.before[ends[i] - entries.before_sizes[i] : ends[i]] for i in places.tolist()]
            runs.add((merger << step) | int(p), [strings[i] for i in own.tolist()], np.concatenate([[0], prefixes]).astype(np.int64), before, times[at], keys[at])
        return runs.table()

    return run


def _return(runs: pa.Table, answers: pa.Table) -> pa.Table:
    """Gives each run of a group what its relay was told of the run's entries."""
    lists = [np.frombuffer(b, "<u8") for b in runs.column("keys").to_pylist()]
    offset = np.cumsum([0] + [len(x) for x in lists])
    keys = np.concatenate([np.zeros(0, "<u8"), *lists])
    masks = np.zeros((len(keys), MASK_BYTES), np.uint8)
    if answers.num_rows:
        known, told = _told(answers)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        masks[hit] = told[at[hit]]
    return _masks(runs, offset, keys, masks)


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their masks."""
    keys = np.concatenate([np.frombuffer(b, "<u8") for b in answers.column("keys").to_pylist()])
    masks = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, MASK_BYTES) for b in answers.column("masks").to_pylist()])
    order = np.argsort(keys)
    return keys[order], masks[order]


def merged_masks(runs: DataFrame, steps: tuple[int, ...], done: int) -> DataFrame:
    """What runs are told; ``steps`` are those that the runs have not taken yet, ``done`` the bits that choose their mergers."""
    if not steps:
        return runs.groupBy("merger").applyInArrow(_merge, MASK_SCHEMA)
    step = steps[0]
    groups = runs.withColumn("node", F.shiftright("asker", step)).groupBy("merger", "node")
    masks = merged_masks(groups.applyInArrow(_relay(done, step), RUN_SCHEMA), steps[1:], done + step)
    masks = masks.withColumn("above", F.shiftright("merger", step)).groupBy("above", "asker")
    return groups.cogroup(masks).applyInArrow(_return, MASK_SCHEMA)


def covered(buffer: Buffer, answers: pa.Table) -> np.ndarray:
    """Which bytes of the shard lie in a repeated window."""
    flags = np.zeros(len(buffer.data) + 1, np.int32)
    if answers.num_rows:
        keys, masks = _told(answers)
        places, _ = buffer.anchors()
        own = buffer.entry_keys(places, *buffer.bounds(places))
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        hit = keys[at] == own
        places, at = places[hit], at[hit]
        for i in range(0, len(places), 1 << 14):  # bounds the matrix of windows
            windows = np.unpackbits(masks[at[i : i + (1 << 14)]], axis=1, count=REACH + 1)
            anchor, d = np.nonzero(windows)
            flags[places[i + anchor] - d] = 1
    begun = np.cumsum(flags[:-1], dtype=np.int32)
    ended = np.zeros_like(begun)
    ended[LENGTH:] = begun[:-LENGTH] if len(begun) > LENGTH else 0
    return begun > ended


REMOVED_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _remains(docs: pa.Table, answers: pa.Table):
    """The shard's rows in order; per row its bytes, what is left of them, and the number of removed runs."""
    docs = shards.in_order(docs)
    buffer = Buffer(docs.column("text").to_pylist())
    cover = covered(buffer, answers)
    rows = []
    for start, end in zip(buffer.starts, buffer.ends, strict=True):
        own = cover[start:end]
        if own.any():
            rows.append((int(end - start), buffer.bytes[start:end][~own].tobytes(), int(own[0]) + int((own[1:] & ~own[:-1]).sum())))
        else:
            rows.append((int(end - start), buffer.data[start:end], 0))
    return docs, rows


def _digests(docs: pa.Table, answers: pa.Table) -> pa.Table:
    docs, rows = _remains(docs, answers)
    return pa.table(
        {
            "doc_id": docs.column("doc_id").cast(pa.int64()),
            "n_bytes": pa.array([n for n, _, _ in rows], pa.int64()),
            "n_removed": pa.array([n - len(kept) for n, kept, _ in rows], pa.int64()),
            "n_spans": pa.array([spans for _, _, spans in rows], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(kept).hexdigest() for _, kept, _ in rows], pa.string()),
        }
    )


def _texts(docs: pa.Table, answers: pa.Table) -> pa.Table:
    docs, rows = _remains(docs, answers)
    texts = pa.array([kept.decode("utf-8", "ignore") for _, kept, _ in rows], pa.string())
    cut = pa.array([len(kept) < n for n, kept, _ in rows], pa.bool_())
    return pa.table({"carried": docs.column("carried"), "kept_text": texts, "was_cut": cut})


def _remove(docs: DataFrame, id_column: str, text_column: str, carried: list[str] | None, function, schema: str | T.StructType) -> DataFrame:
    shard_docs, n_shards = shards.dealt(docs, id_column, text_column, carried)
    count_steps = shards.counter_steps(n_shards, ANCHORS_PER_SHARD)
    merge_steps = shards.steps_of(max(4, n_shards.bit_length()))
    answers = shards.shared_counts(shard_docs, _shard_hashes, count_steps)
    by_shard = shard_docs.groupBy("shard")
    runs = by_shard.cogroup(answers.groupBy("shard")).applyInArrow(_runs(count_steps, merge_steps), RUN_SCHEMA)
    masks = merged_masks(runs, merge_steps[1:], merge_steps[0]).withColumnRenamed("asker", "shard")
    return by_shard.cogroup(masks.groupBy("shard")).applyInArrow(function, schema)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, bytes, bytes and runs removed, digest of the bytes that are left."""
    return _remove(docs, id_column, text_column, None, _digests, REMOVED_SCHEMA).withColumnRenamed("doc_id", id_column)


def cut_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with the repeats cut out of their texts.

    Characters of which a cut took some bytes go as a whole. Rows of which nothing but white space
    is left by a cut are dropped; a null text stays null.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"))
    schema = T.StructType([*row.schema.fields, *T.StructType.fromDDL("kept_text string, was_cut boolean").fields])
    found = _remove(docs, id_column, text_column, docs.columns, _texts, schema)
    found = found.where(~F.col("was_cut") | F.col("kept_text").rlike(r"\S"))
    own = [
        F.when(F.col("was_cut"), F.col("kept_text")).otherwise(F.col("carried")[c]).alias(c) if c == text_column else F.col("carried")[c].alias(c)
        for c in docs.columns
    ]
    return found.select(*own)
