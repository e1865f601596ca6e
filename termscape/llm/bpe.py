"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last bytes says so, hence alike wherever the same passage
stands. Shards count the chunks over all documents (``termscape.llm.shards``). A chunk that occurs
elsewhere is encoded once, for all, and its ids return to the shards that hold it; the
stretches between such chunks are encoded where they are.

Joins are then repaired: a window around the join is encoded again, and its ids must agree with those on both
sides over a whole word; until they do, the window grows, to the whole text if need be. The window
begins and ends between a visible ASCII character and a space or line feed. There the pre-tokenizer always
ends a piece, whatever stands further away, so agreement there is agreement everywhere.

The vocabulary is a tokenizers file, given by path and read once per worker. Its merges are run by tiktoken,
which gives the same ids at several times the speed. That needs the merges in the order of the ids
and the byte-level pre-tokenizer without a normalizer; a file that is not so is refused.
Special tokens in a text become their ids, as the tokenizers library does by default.

Defined cases: null is empty and has no ids; rows with equal or null ids are encoded each. A text of any length is
encoded whole by one task. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame


from termscape.llm import shards
from termscape.llm.common import bounded_batches
from termscape.llm.rolling import blocks, gram_hashes

#: Bytes that the rolling hash looks at, mean and limits of a chunk's size.
ROLL = 32
MEAN_CHUNK = 1024
MIN_CHUNK = 256
MAX_CHUNK = 8192
CHUNKS_PER_SHARD = shards.SHARD_BYTES // MEAN_CHUNK

#: Fixed value: the pre-tokenizer of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Byte-level files write a byte as a printable character: itself, or the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        vocabulary, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = frozenset(added)
        self.strings = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if t not in added}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        plain = spec["pre_tokenizer"] == spec["pre_tokenizer"] | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if spec.get("normalizer") or not plain or merged != sorted(merged):
            raise ValueError(f"{path}: not a byte-level vocabulary with merges in the order of ids")
        self._encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={s: i for i, s in self.strings.items()}, special_tokens=added)
        self.strings |= {i: t.encode() for t, i in added.items()}
        self._sizes = np.zeros(max(self.strings) + 1, np.int64)
        for i, s in self.strings.items():
            self._sizes[i] = len(s)
        self.id_type = "<u2" if max(self.strings) < 1 << 16 else "<u4"
        self._decimal = [str(i) for i in range(len(self._sizes))]

    def encode(self, raw: bytes) -> np.ndarray:
        return self._encoding.encode_to_numpy(raw.decode(), allowed_special=self.special)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Bytes up to the end of each token."""
        return np.cumsum(self._sizes[ids])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self._decimal.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def chunk_ends(raws: list[bytes]) -> list[list[int]]:
    """Ends of each text's chunks. A cut depends on the bytes before it and on the cut before."""
    found: list[list[int]] = []
    for first, last in blocks(np.cumsum([len(r) for r in raws], dtype=np.int64)):
        found.extend(_block_ends(raws[first:last]))
    return found


def _block_ends(raws: list[bytes]) -> list[list[int]]:
    data = np.frombuffer(b"".join(raws), np.uint8)
    wanted = np.flatnonzero(gram_hashes(data, ROLL) < np.uint64((1 << 64) // (MEAN_CHUNK - MIN_CHUNK))) + ROLL
    at_letter = np.append((data & 0xC0) != 0x80, True)
    wanted = wanted[at_letter[wanted]]
    found, start = [], 0
    for raw in raws:
        end = start + len(raw)
        cuts, last = [], start
        for cut in [*wanted[np.searchsorted(wanted, start + ROLL) : np.searchsorted(wanted, end)].tolist(), end]:
            while cut - last > MAX_CHUNK:
                forced = last + MAX_CHUNK
                while not at_letter[forced]:
                    forced -= 1
                cuts.append(forced - start)
                last = forced
            if cut - last >= MIN_CHUNK or cut == end:
                if cut > last:
                    cuts.append(cut - start)
                last = cut
        found.append(cuts)
        start = end
    return found


def _pieces(raw: bytes, cuts: list[int]) -> Iterator[bytes]:
    start = 0
    for cut in cuts:
        yield raw[start:cut]
        start = cut


def _hash_of(chunk: bytes) -> int:
    return xxhash.xxh3_64_intdigest(chunk)


def _shard_hashes(table: pa.Table) -> np.ndarray:
    raws = [t.encode() for t in table.column("text").to_pylist()]
    return np.array([_hash_of(c) for raw, cuts in zip(raws, chunk_ends(raws), strict=True) for c in _pieces(raw, cuts)], np.uint64)


SHARED_SCHEMA = "shard int, chunk_key binary, chunk binary"


def _shared(steps: tuple[int, ...]):
    """The distinct chunks of a shard that occur twice or more."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = shards.in_order(docs)
        raws = [t.encode() for t in docs.column("text").to_pylist()]
        chunks = [c for raw, cuts in zip(raws, chunk_ends(raws), strict=True) for c in _pieces(raw, cuts)]
        distinct: dict[bytes, bytes] = {}
        if chunks and answers.num_rows:
            counts = shards.counts_of(np.array([_hash_of(c) for c in chunks], np.uint64), steps, answers)
            distinct = {xxhash.xxh3_128_digest(chunks[i]): chunks[i] for i in np.flatnonzero(counts > 1)}
        shard = docs.column("shard")[0].as_py() if docs.num_rows else 0
        return pa.table(
            {
                "shard": pa.array([shard] * len(distinct), pa.int32()),
                "chunk_key": pa.array(list(distinct), pa.binary()),
                "chunk": pa.array(list(distinct.values()), pa.binary()),
            }
        )

    return run


ENCODED_SCHEMA = "shard int, chunk_key binary, ids binary"


def _encode_once(path: str):
    """Rows come sorted by chunk: the first of a chunk is encoded, the others take its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        last_key, ids = None, b""
        for batch in batches:
            found = []
            for key, chunk in zip(batch.column("chunk_key").to_pylist(), batch.column("chunk").to_pylist(), strict=True):
                if key != last_key:
                    last_key, ids = key, own.encode(chunk).astype(own.id_type).tobytes()
                found.append(ids)
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("chunk_key"), pa.array(found, pa.binary())], names=["shard", "chunk_key", "ids"])

    return run


def _is_safe(raw: bytes, place: int) -> bool:
    """Whether the pre-tokenizer ends a piece here whatever stands around."""
    return place in (0, len(raw)) or (raw[place] in b" \n" and 0x21 <= raw[place - 1] <= 0x7E)


def _safe_before(raw: bytes, place: int) -> int:
    while not _is_safe(raw, place):
        place = max(raw.rfind(b" ", 0, place), raw.rfind(b"\n", 0, place), 0)
    return place


def _safe_after(raw: bytes, place: int) -> int:
    while not _is_safe(raw, place):
        found = [p for p in (raw.find(b" ", place + 1), raw.find(b"\n", place + 1)) if p >= 0]
        place = min(found, default=len(raw))
    return place


class _Tokens:
    """Ids of the text from its start up to ``end``."""

    def __init__(self, own: Codec, start: int = 0, ids: np.ndarray | None = None):
        self.own = own
        self.ids = np.zeros(0, np.uint32) if ids is None else ids
        self.ends = start + own.ends(self.ids)
        self.start = start

    @property
    def end(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else self.start

    def place(self, byte: int) -> int | None:
        """Number of ids that end by ``byte``, if a token ends there."""
        if byte == self.start:
            return 0
        at = int(np.searchsorted(self.ends, byte))
        return at + 1 if at < len(self.ends) and self.ends[at] == byte else None


def stitch(raw: bytes, pieces: list[np.ndarray], own: Codec) -> np.ndarray:
    """Ids of ``raw`` from the ids of consecutive pieces of it, each encoded alone."""
    done: list[_Tokens] = []  # consecutive; what they hold is right but for the last word
    for ids in pieces:
        piece = _Tokens(own, done[-1].end if done else 0, ids)
        if not done:
            done.append(piece)
            continue
        join, reach = piece.start, 1
        while True:
            # the window, and the word inside each of its ends that has to agree
            first = _safe_before(raw, max(0, join - reach))
            left_word = _safe_after(raw, min(first + 1, join))
            last = _safe_after(raw, min(len(raw), join + reach))
            right_word = _safe_before(raw, max(last - 1, join))
            if last >= piece.end:  # past what this piece can vouch for
                last, right_word = piece.end, piece.end
            while len(done) > 1 and done[-1].start >= first:
                gone = done.pop()
                done[-1] = _Tokens(own, done[-1].start, np.concatenate([done[-1].ids, gone.ids]))
            window = _Tokens(own, first, own.encode(raw[first:last]))
            tail = done[-1]
            cut, cut_to = tail.place(first), tail.place(left_word) if left_word <= join else None
            whole_left = first == 0
            agree_left = whole_left or (
                cut is not None and cut_to is not None and (at := window.place(left_word)) is not None and np.array_equal(window.ids[:at], tail.ids[cut:cut_to])
            )
            from_, to = piece.place(right_word) if right_word >= join else None, piece.place(last)
            agree_right = last == piece.end or (
                from_ is not None and to is not None and (at := window.place(right_word)) is not None and np.array_equal(window.ids[at:], piece.ids[from_:to])
            )
            if agree_left and agree_right:
                if whole_left:
                    done = [_Tokens(own)]
                    tail, cut = done[0], 0
                done[-1] = _Tokens(own, tail.start, tail.ids[:cut])
                done.append(window)
                if last < piece.end:
                    done.append(_Tokens(own, last, piece.ids[to:]))
                break
            reach *= 4
    return np.concatenate([t.ids for t in done]) if done else np.zeros(0, np.uint32)


#: A place where the pre-tokenizer ends a piece whatever stands around.
_SAFE = re.compile(rb"[\x21-\x7e][ \n]")


def encode_text(raw: bytes, cuts: list[int], known: dict[bytes, np.ndarray], own: Codec) -> np.ndarray:
    """Ids of a text whose chunks may have known ids.

    A chunk without a safe place could not bound a window, so it is encoded with what stands around it.
    """
    pieces: list[np.ndarray] = []
    start = begun = 0  # ``begun``: start of the stretch without known chunks
    for cut in cuts:
        ids = known.get(xxhash.xxh3_128_digest(raw[start:cut])) if known else None
        if ids is not None and _SAFE.search(raw, start, cut):
            if begun < start:
                pieces.append(own.encode(raw[begun:start]))
            pieces.append(ids)
            begun = cut
        start = cut
    if begun < len(raw):
        pieces.append(own.encode(raw[begun:]))
    return pieces[0] if len(pieces) == 1 else stitch(raw, pieces, own)


def _finish(path: str, columns: Callable[[Codec, str, np.ndarray], tuple], names: list[str], types: list[pa.DataType]):
    def run(docs: pa.Table, encoded: pa.Table) -> pa.Table:
        own = codec(path)
        docs = shards.in_order(docs)
        known = {k: np.frombuffer(b, own.id_type).astype(np.uint32) for k, b in zip(encoded.column("chunk_key").to_pylist(), encoded.column("ids").to_pylist(), strict=True)}
        raws = [t.encode() for t in docs.column("text").to_pylist()]
        rows = []
        for raw, cuts in zip(raws, chunk_ends(raws), strict=True):
            ids = encode_text(raw, cuts, known, own)
            rows.append(columns(own, raw, ids))
        values = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        found = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
        doc_id = docs.column("doc_id").cast(pa.int64()) if rows else pa.array([], pa.int64())
        return pa.table(dict(zip(["doc_id", *names], [doc_id, *found], strict=True)))

    return run


def _with_known_chunks(docs: DataFrame, path: str, id_column: str, text_column: str, columns, names, types, schema: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    shard_docs, n_shards = shards.dealt(docs, id_column, text_column)
    steps = shards.counter_steps(n_shards, CHUNKS_PER_SHARD)
    answers = shards.shared_counts(shard_docs, _shard_hashes, steps)
    by_shard = shard_docs.groupBy("shard")
    shared = by_shard.cogroup(answers.groupBy("shard")).applyInArrow(_shared(steps), SHARED_SCHEMA)
    sorted_chunks = shared.repartition("chunk_key").sortWithinPartitions("chunk_key")
    encoded = sorted_chunks.mapInArrow(_encode_once(path), ENCODED_SCHEMA)
    found = by_shard.cogroup(encoded.groupBy("shard")).applyInArrow(_finish(path, columns, names, types), schema)
    return found.withColumnRenamed("doc_id", id_column)


def _with_ids(own: Codec, raw: bytes, ids: np.ndarray) -> tuple:
    return len(ids), ids.astype(np.int32), own.decode(ids).encode() == raw


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id column, the number of ids, the ids, and whether decoding them gives the text back."""
    names, types = ["n_tokens", "ids", "round_trip"], [pa.int64(), pa.list_(pa.int32()), pa.bool_()]
    schema = "doc_id bigint, n_tokens bigint, ids array<int>, round_trip boolean"
    return _with_known_chunks(docs, path, id_column, text_column, _with_ids, names, types, schema)


def decode(encoded: DataFrame, path: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """Replace a column of ids by the text they stand for (null ids: null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if ids is None else own.decode(np.array(ids, np.int64)) for ids in batch.column(ids_column).to_pylist()]
            others = [i for i, n in enumerate(batch.schema.names) if n != ids_column]
            names = [batch.schema.names[i] for i in others]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in others], pa.array(texts, pa.string())], names=[*names, text_column])

    bounded_batches(encoded.sparkSession)
    own = encoded.drop(text_column) if text_column != ids_column else encoded
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name != ids_column]
    return own.mapInArrow(run, ", ".join([*fields, f"`{text_column}` string"]))


def _digests(own: Codec, raw: bytes, ids: np.ndarray) -> tuple:
    ids_digest = hashlib.sha256(own.decimal(ids).encode()).hexdigest()
    return len(ids), ids_digest, hashlib.sha256(own.decode(ids).encode()).hexdigest()


def encoding_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode, decode, and return per document the number of ids and digests of the ids and of the decoded text."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _with_known_chunks(docs, path, id_column, text_column, _digests, names, [pa.int64(), pa.string(), pa.string()], schema)
