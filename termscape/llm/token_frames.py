"""Token ids in files of independent zstandard frames, with a seek table behind them.

Documents are put in order by Spark (range partitions by id, sorted inside), one file a partition. A task
encodes its documents as they come and writes each one's ids as frames of its own, so a
reader decompresses what it is asked for and nothing else. A file is, in this order:

1. Frames. A document's ids as little-endian numbers of 2 bytes (4 where the vocabulary needs them), at
   most ``FRAME_IDS`` to a frame: each a complete zstandard frame that needs no other.
2. The document index, a skippable frame: number of documents, bytes of a number, and
   then columns: ids, whether there is an id, numbers of token ids, numbers of frames.
3. The seek table, a skippable frame in the public seekable format: for each frame before it the compressed
   size, the size, and the lower 32 bits of the content's XXH64; the count; the closing magic number.

So any zstandard tool can decompress the file, and a reader opens it from its end. Checksums are compared
whenever a frame is read; a damaged frame is an error and spoils no other document.

What belongs to the collection is said by its ``index`` table, one row a document, which Spark commits: a
task that is lost or runs twice leaves a file that no row names. Files are written and read through
pyarrow's file systems (``file:``, ``hdfs:``, ``s3:``, ``gs:``), never through a path of one machine.

Defined cases: null text is empty; an empty text has the end id alone (no frame at all without an end id). Order
is by id, null ids first, then by a hash of the text; equal rows are documents of their own. A text
of any length is held by one task, its ids in as many frames as they need. An empty table gives an index
without rows and no file. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termscape.llm.bpe import codec
from termscape.llm.common import bounded_batches

#: Text that goes into one file, on average.
FILE_BYTES = 32 << 20

#: Ids in one frame at most.
FRAME_IDS = 1 << 20

#: Files whose sizes one task adds up.
FILES_PER_GROUP = 4096

#: Fixed values of the public formats: skippable frames, the seek table's end, its flag for checksums.
INDEX_MAGIC, SEEK_MAGIC, END_MAGIC, WITH_CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80

INDEX_SCHEMA = "doc_id bigint, file int, name string, place int, n_tokens bigint"


def _place(path: str) -> tuple[FileSystem, str]:
    """The file system and the path in it; Hadoop writes local folders as ``file:/x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return FileSystem.from_uri(path)


class FrameWriter:
    """One file, document by document. Holds a few numbers per document and frame."""

    def __init__(self, sink, width: int, level: int):
        self.sink, self.width = sink, width
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.n_ids: list[int] = []
        self.n_frames: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        before = len(self.frames)
        for start in range(0, len(ids), FRAME_IDS):
            raw = ids[start : start + FRAME_IDS].astype(f"<u{self.width}").tobytes()
            packed = self.compressor.compress(raw)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.sink.write(packed)
        self.doc_ids.append(doc_id)
        self.n_ids.append(len(ids))
        self.n_frames.append(len(self.frames) - before)

    def close(self) -> None:
        n = len(self.doc_ids)
        index = b"".join(
            [
                struct.pack("<QB", n, self.width),
                np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
                np.array([d is not None for d in self.doc_ids], np.uint8).tobytes(),
                np.array(self.n_ids, "<u8").tobytes(),
                np.array(self.n_frames, "<u4").tobytes(),
            ]
        )
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        # to the seek table the index is one more frame, without content
        entries = np.array([*self.frames, (len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)], "<u4")
        table = entries.tobytes() + struct.pack("<IBI", len(entries), WITH_CHECKSUMS, END_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.sink.close()


class FrameReader:
    """One file, opened from its end. ``ids`` reads the frames of one document."""

    def __init__(self, source):
        self.source, size = source, source.size()
        count, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != END_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        self.frames = np.frombuffer(self._bytes(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        index = self._bytes(int(self.offsets[-2]) + 8, int(self.frames[-1, 0]) - 8)
        n, self.width = struct.unpack_from("<QB", index)
        found, at = [], 9
        for kind in ("<i8", "u1", "<u8", "<u4"):
            found.append(np.frombuffer(index, kind, n, at))
            at += found[-1].nbytes
        self.doc_ids, self.has_id, self.n_ids, n_frames = found
        self.first_frame = np.concatenate([[0], np.cumsum(n_frames, dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(self.n_ids, dtype=np.int64)])
        self.decompressor = zstandard.ZstdDecompressor()

    def _bytes(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def doc_id(self, place: int) -> int | None:
        return int(self.doc_ids[place]) if self.has_id[place] else None

    def ids(self, place: int) -> np.ndarray:
        first, last = self.first_frame[place], self.first_frame[place + 1]
        packed, begun = self._bytes(int(self.offsets[first]), int(self.offsets[last] - self.offsets[first])), self.offsets[first]
        pieces = []
        for frame in range(first, last):
            at = int(self.offsets[frame] - begun)
            raw = self.decompressor.decompress(packed[at : at + int(self.frames[frame, 0])], max_output_size=int(self.frames[frame, 1]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[frame, 2]:
                raise ValueError(f"frame {frame} does not have its checksum")
            pieces.append(np.frombuffer(raw, f"<u{self.width}"))
        return np.concatenate(pieces).astype(np.uint32) if pieces else np.zeros(0, np.uint32)


def _encode_and_write(vocabulary: str, folder: str, end_id: int | None, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, writer, name, place = codec(vocabulary), None, "", 0
        file = TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], np.uint32)
        width = 2 if own.id_type == "<u2" and (end_id or 0) < 1 << 16 else 4
        for batch in batches:
            if writer is None and batch.num_rows:
                name = f"part-{file:08d}-{uuid.uuid4().hex}.zst"  # a second try has another name
                system, path = _place(f"{folder}/{name}")
                system.create_dir(path.rsplit("/", 1)[0])
                writer = FrameWriter(system.open_output_stream(path, compression=None), width, level)
            doc_ids, counts = batch.column("doc_id"), []
            for doc_id, text in zip(doc_ids.to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.concatenate([own.encode(text.encode()), end])
                writer.add(doc_id, ids)
                counts.append(len(ids))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array([file] * n, pa.int32()), pa.array([name] * n, pa.string()), pa.array(range(place, place + n), pa.int32()), pa.array(counts, pa.int64())],
                names=["doc_id", "file", "name", "place", "n_tokens"],
            )
            place += n
        if writer is not None:
            writer.close()

    return run


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 2, level: int = 3,
    file_bytes: int = FILE_BYTES, id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Encode ``docs`` with the vocabulary file into files below ``path``, in the order of ids.

    Equal rows are told apart by their place in the input, so that any number of them is dealt over
    files; give a table, whose places do not change when a task is run again.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = ["doc_id", "text_key", "at"]
    keyed = plain.withColumn("text_key", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(max(1, -(-total // file_bytes)), *key).sortWithinPartitions(*key)
    index = ordered.select("doc_id", "text").mapInArrow(_encode_and_write(vocabulary, f"{path}/data", end_id, level), INDEX_SCHEMA)
    index.write.mode("errorifexists").parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, file, name, place, n_tokens)``: where each document is."""
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def file_starts(index: DataFrame) -> DataFrame:
    """``(file, name, start)``: the number of ids in all files before.

    Summed inside groups of files and over the groups, so that one task holds a row for ``FILES_PER_GROUP`` files.
    """
    files = index.groupBy("file", "name").agg(F.sum("n_tokens").alias("tokens"))
    files = files.withColumn("bundle", F.expr(f"file div {FILES_PER_GROUP}"))
    bundles = files.groupBy("bundle").agg(F.sum("tokens").alias("tokens"))

    def before(window) -> Column:
        return F.coalesce(F.sum("tokens").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    bundles = bundles.select("bundle", before(Window.orderBy("bundle")).alias("so_far"))
    inside = files.withColumn("inside", before(Window.partitionBy("bundle").orderBy("file")))
    return inside.join(bundles, "bundle").select("file", "name", (F.col("so_far") + F.col("inside")).alias("start"))


#: Ids that a task hands over at once.
BATCH_IDS = 1 << 20

Columns = Callable[[np.ndarray], tuple]


def _read(folder: str, columns: Columns, types: list[pa.DataType], names: list[str]):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *zip(names, types, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _place(f"{folder}/{row['name']}")
                with system.open_input_file(path) as source:
                    file, rows, held = FrameReader(source), [], 0
                    places = range(len(file.n_ids)) if row["places"] is None else sorted(row["places"])
                    for place in places:
                        ids = file.ids(place)
                        rows.append((file.doc_id(place), row["start"] + int(file.starts[place]), len(ids), *columns(ids)))
                        held += len(ids)
                        if held >= BATCH_IDS:
                            yield _rows(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows, schema)

    def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _documents(spark: SparkSession, path: str, wanted: DataFrame | None, columns: Columns, names: list[str], types: list[pa.DataType], ddl: str) -> DataFrame:
    index = read_index(spark, path)
    files = file_starts(index)
    if wanted is None:
        asked = files.withColumn("places", F.lit(None).cast("array<int>"))
    else:
        found = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        asked = found.groupBy("file").agg(F.collect_list("place").alias("places")).join(files, "file")
    n_files = (index.agg(F.max("file")).first()[0] or 0) + 1
    tasks = asked.select("name", "start", "places").repartition(n_files)  # a file each
    return tasks.mapInArrow(_read(f"{path}/data", columns, types, names), f"doc_id bigint, start bigint, n_tokens bigint, {ddl}")


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ``start`` counts the ids of all documents before.

    ``wanted(doc_id)`` names the documents to read (repeated ones once, null none): only their files are
    opened and only their frames decompressed.
    """
    return _documents(spark, path, wanted, lambda ids: (ids.astype(np.int64),), ["ids"], [pa.list_(pa.int64())], "ids array<bigint>")


def read_checksums(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """As ``read_tokens``, with the crc32 of the ids as little-endian 32-bit numbers in place of the ids."""
    return _documents(spark, path, wanted, lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),), ["ids_crc32"], [pa.int64()], "ids_crc32 bigint")
