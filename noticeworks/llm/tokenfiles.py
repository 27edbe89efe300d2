"""Token-id files: independent zstandard frames, a trailing seek table, a checksum per frame.

A file holds, for documents in ascending doc_id order, frames of whole documents' ids (unsigned
16-bit, little-endian), then one frame with the index of its documents, then the seek table in
a skippable frame: compressed size, size and the low 32 bits of XXH64 of every frame, as in the
public zstandard seekable format. Files are named by their place in the order. A reader takes
the table and the index from the end of a file and decompresses only the frames it is asked for.

Defined results: a null text is an empty document of one id, the end id; null doc_ids come first;
repeated rows are documents of their own, ordered by their texts' hash; an empty table gives no
files and an empty table.
"""

from __future__ import annotations

import struct
import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import columns, stored
from noticeworks.llm.tokens import encoder
from noticeworks.session import shared_dir

END = 0                       # id that ends a document
FRAME_IDS = 1 << 16           # a frame is closed beyond that many ids; documents are not cut
FILE_CHARS = 32_000_000       # characters of text per file, about
# Fixed values of the public file format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


def _place(path: str):
    """File system and path of a folder; its scheme decides which."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Writer:
    """Writes one file to an open stream."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=3)
        self.table, self.index, self.ids, self.waiting = [], [], [], 0

    def _frame(self, data: bytes) -> None:
        import xxhash

        packed = self.compressor.compress(data)
        self.stream.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((doc_id is not None, doc_id or 0, len(self.table), self.waiting, len(ids) // 2))
        self.ids.append(ids)
        self.waiting += len(ids) // 2
        if self.waiting >= FRAME_IDS:
            self._close()

    def _close(self) -> None:
        if self.ids:
            self._frame(b"".join(self.ids))
            self.ids, self.waiting = [], 0

    def finish(self) -> None:
        self._close()
        self._frame(b"".join(struct.pack("<?qIQQ", *row) for row in self.index))
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        footer = struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(body) + len(footer)) + body + footer)


class Reader:
    """Random access to one open file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table")
        body = self._at(size - 9 - 12 * count, 12 * count)
        self.table, at = [], 0
        for packed, full, check in struct.iter_unpack("<III", body):
            self.table.append((at, packed, full, check))
            at += packed
        self.index = list(struct.iter_unpack("<?qIQQ", self.frame(count - 1)))

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def frame(self, i: int) -> bytes:
        import xxhash
        import zstandard

        at, packed, full, check = self.table[i]
        data = zstandard.ZstdDecompressor().decompress(self._at(at, packed), max_output_size=full)
        if len(data) != full or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} is damaged")
        return data

    def documents(self, wanted=None):
        """doc_id and ids of all documents, or of the wanted ones, in the order of the file."""
        import numpy as np

        held, data = -1, b""
        for there, doc_id, frame, start, n in self.index:
            key = doc_id if there else None
            if wanted is not None and key not in wanted:
                continue
            if frame != held:
                held, data = frame, self.frame(frame)
            yield key, np.frombuffer(data, "<u2", n, 2 * start)


def write(docs: DataFrame, vocabulary: str, folder: str) -> DataFrame:
    """Write the files; one row per file: file_no, file, n_documents, n_ids."""
    own = columns(docs, "doc_id", "text")
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(least, -(-size // FILE_CHARS))
    own = own.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of one id, null ids among them, are dealt on by their texts, and repeated rows by where they were read.
    keys = ["doc_id", F.xxhash64("text"), F.spark_partition_id()]
    ordered = own.repartitionByRange(files, *keys).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def task(batches):
        import numpy as np
        import pyarrow as pa

        context, writer, stream = TaskContext.get(), None, None
        where, base = _place(folder)
        number = context.partitionId()
        final = f"{base}/part-{number:06d}.ids.zst"
        draft = f"{base}/_{number:06d}-{context.taskAttemptId()}.part"
        tokens, total = encoder(vocabulary, True), 0
        end = np.array([END], "<u2").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if writer is None:
                    where.create_dir(base, recursive=True)
                    stream = where.open_output_stream(draft)
                    writer = Writer(stream)
                ids = tokens.encode(text.as_py() or "") + end
                writer.add(doc_id, ids)
                total += len(ids) // 2
        if writer is not None:
            # A file is whole or absent: a repeated task writes the same file again.
            writer.finish()
            stream.close()
            where.move(draft, final)
            yield pa.RecordBatch.from_pydict(
                {"file_no": [number], "file": [final], "n_documents": [len(writer.index)], "n_ids": [total]})

    out = ordered.mapInArrow(task, "file_no long, file string, n_documents long, n_ids long")
    return stored(out, "token_files")


def read(spark: SparkSession, files: DataFrame, folder: str, wanted: set[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the documents in the files, or of those wanted."""
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: this order is over as many rows as there were partitions.
    placed = files.select("file", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("file_start"))
    tasks = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")

    def task(batches):
        import pyarrow as pa

        where, _ = _place(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("file_start").to_pylist()):
                rows = []
                with where.open_input_file(file) as stream:
                    reader = Reader(stream)
                    starts, at = {}, start
                    for place, (_, _, frame, offset, n) in enumerate(reader.index):
                        starts[(frame, offset)] = at
                        at += n
                    spans = iter([(f, o) for t, d, f, o, _ in reader.index if wanted is None or (d if t else None) in wanted])
                    for doc_id, ids in reader.documents(wanted):
                        rows.append((doc_id, starts[next(spans)], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return tasks.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str, folder: str | None = None) -> DataFrame:
    """Write all documents to files and return what the files hold."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "token_ids")
    return read(spark, write(docs, vocabulary, folder), folder)
