"""Token files: independent zstandard frames, a document index and a trailing seek table with frame checksums.

A shard is one file in the public seekable zstandard form: frames of whole or partial documents, then a skippable
frame with the document index, then a skippable frame with the seek table. Any zstandard reader can decompress it;
a reader of some documents fetches the two tables and only the frames that it needs, and checks each frame.

Shards hold ascending ranges of ids (ties by text), so the files in shard order are the corpus in id order. A task
writes a range of ids, and begins another shard where one has reached its bytes; rows of one id share a shard. NULL ids
come first, NULL and empty texts consist of the end id alone. Repeated rows are written as often as they occur.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, settle, slices
from .pretokens import pretokenizer

#: Fixed values of the public seekable format: magic of skippable frames, of its footer, and the checksum flag.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 18


class ShardWriter:
    """Writes one shard; nothing but the current frame and the two tables is held in memory."""

    def __init__(self, out, width: int, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._frame, self._frames, self._docs, self.n_ids, self.size = bytearray(), [], [], 0, 0
        self.low: int | None = None

    def add(self, doc: int | None, ids: bytes) -> None:
        if self.low is None:
            self.low = doc
        self._docs.append((0 if doc is None else doc, doc is None, self.n_ids))
        self.n_ids += len(ids) // self.width
        self._frame += ids
        while len(self._frame) >= self.frame_bytes:
            self._flush(self.frame_bytes)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _flush(self, n: int) -> None:
        raw = bytes(self._frame[:n])
        del self._frame[:n]
        packed = self._zstd.compress(raw)
        self._frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self._write(packed)

    def close(self) -> None:
        if self._frame:
            self._flush(len(self._frame))
        docs, nulls, starts = zip(*self._docs) if self._docs else ((), (), ())
        index = self._zstd.compress(
            np.array(docs, "<i8").tobytes() + np.array([*starts, self.n_ids], "<i8").tobytes() + np.array(nulls, "<u1").tobytes()
        )
        index += struct.pack("<QBQ", len(docs), self.width, len(index))
        self._write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self._frames.append((8 + len(index), 0, 0))
        table = b"".join(struct.pack("<III", *f) for f in self._frames)
        footer = struct.pack("<IBI", len(self._frames), CHECKSUM_FLAG, FOOTER_MAGIC)
        self._write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)) + table + footer)


class ShardReader:
    """Reads documents of one shard by their ids; only the frames that hold them are fetched."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flag, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a token file")
        table = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self._packed = np.concatenate([[0], np.cumsum(table[:, 0])])
        self._raw = np.concatenate([[0], np.cumsum(table[:-1, 1])])
        self._sums = table[:, 2]
        at = int(self._packed[n - 1]) + 8
        data = file.read_at(int(table[n - 1, 0]) - 8, at)
        n_docs, self.width, length = struct.unpack("<QBQ", data[-17:])
        raw = zstandard.decompress(data[:length])
        self.docs = np.frombuffer(raw, "<i8", n_docs)
        self.starts = np.frombuffer(raw, "<i8", n_docs + 1, 8 * n_docs)
        self.nulls = np.frombuffer(raw, "<u1", n_docs, 16 * n_docs + 8)
        self.dtype = np.dtype(f"<u{self.width}")
        self._last: tuple[int, bytes] = (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = zstandard.decompress(self.file.read_at(int(self._packed[k + 1] - self._packed[k]), int(self._packed[k])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self._sums[k]:
                raise ValueError(f"checksum of frame {k} differs")
            self._last = (k, raw)
        return self._last[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the shard."""
        low, high = int(self.starts[i]) * self.width, int(self.starts[i + 1]) * self.width
        k, parts = int(np.searchsorted(self._raw, low, "right")) - 1, []
        while low < high:
            frame, base = self._frame(k), int(self._raw[k])
            parts.append(frame[low - base : high - base])
            low, k = base + len(frame), k + 1
        return np.frombuffer(b"".join(parts), self.dtype)

    def find(self, doc: int) -> list[int]:
        """Places of an id in the shard; documents stand in ascending order."""
        real = self.docs[int(self.nulls.sum()) :]
        skip = len(self.docs) - len(real)
        return list(range(skip + int(np.searchsorted(real, doc, "left")), skip + int(np.searchsorted(real, doc, "right"))))


def opened(path: str) -> ShardReader:
    store, inner = fs.FileSystem.from_uri(path)
    return ShardReader(store.open_input_file(inner))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text", rows_per_task: int = 4096,
    shard_bytes: int = 8 << 20,
) -> DataFrame:
    """Encode all texts into shards below ``folder`` (a URI that all executors reach); returns the manifest.

    Manifest: shard, path, n_docs, n_ids, n_bytes, low (smallest id), start (ids of all shards before). A shard is written under a
    name of its own try and counted only through the manifest, so repeated or lost tasks leave no double rows.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    tasks = max(1, -(-rows.count() // rows_per_task))
    # Rows without an id may be many; their texts tell where they are cut.
    own = F.when(F.col("doc").isNull(), F.col("text"))
    rows = rows.repartitionByRange(tasks, F.asc_nulls_first("doc"), own.asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokenizer(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)
        part, number, writer, stream, name, last = TaskContext.get().partitionId(), 0, None, None, "", None

        def done() -> pa.RecordBatch:
            writer.close()
            stream.close()
            return pa.RecordBatch.from_pylist(
                [{"shard": (part << 32) + number, "path": f"{folder}/{name}", "n_docs": len(writer._docs), "n_ids": writer.n_ids, "n_bytes": writer.size, "low": writer.low}], schema=manifest
            )

        for batch in slices(batches):
            ids = encoder.encode(batch.column(1).to_pylist())
            for doc, data in zip(batch.column(0).to_pylist(), ids):
                if writer is not None and writer.n_ids * encoder.dtype.itemsize >= shard_bytes and (doc is None or doc != last):
                    yield done()
                    writer, number = None, number + 1
                if writer is None:
                    name = f"shard-{part:06d}-{number:06d}-{uuid.uuid4().hex}.zst"
                    stream = store.open_output_stream(f"{inner}/{name}", compression=None)
                    writer = ShardWriter(stream, encoder.dtype.itemsize)
                writer.add(doc, data + end)
                last = doc
        if writer is not None:
            yield done()

    manifest = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("low", pa.int64())])
    written = settle(
        rows.sortWithinPartitions(F.asc_nulls_first("doc"), F.asc_nulls_first("text")).mapInArrow(
            write, "shard long, path string, n_docs long, n_ids long, n_bytes long, low long"
        ),
        "manifest",
    )
    # One row per shard: the only place where all shards meet.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = opened(row["path"])
                if len(shard.docs) != row["n_docs"]:
                    raise ValueError(f"{row['path']} has {len(shard.docs)} documents, not {row['n_docs']}")
                sums = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in range(len(shard.docs))]
                yield pa.record_batch(
                    [
                        pa.array(shard.docs, pa.int64(), mask=shard.nulls.astype(bool)),
                        pa.array(shard.starts[:-1] + row["start"], pa.int64()),
                        pa.array(np.diff(shard.starts), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    [id, "start", "n_tokens", "ids_crc32"],
                )

    # A task for every shard, dealt in turn: rows of the manifest are small, what they stand for is not.
    spread = manifest.select("path", "n_docs", "start").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, f"{id} long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame, wanted: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, ids) of the wanted ids (one row per distinct id and copy); other frames are not decompressed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = opened(row["path"])
                got = [(doc, shard.ids(i)) for doc in sorted(set(row["docs"])) for i in shard.find(doc)]
                yield pa.record_batch(
                    [pa.array([d for d, _ in got], pa.int64()), pa.array([x.tolist() for _, x in got], pa.list_(pa.int64()))], [id, "ids"]
                )

    # One value per shard of some megabytes.
    shards = manifest.select("low", "path").where("low is not null").orderBy("shard").collect()
    if not shards:
        return manifest.sparkSession.createDataFrame([], f"{id} long, ids array<long>")
    doc = F.col(id).cast("long")
    place = F.get(F.lit([s.path for s in shards]), bucket_of(doc, [s.low for s in shards][1:]))
    keys = wanted.select(doc.alias("doc"), place.alias("path")).where("doc is not null").distinct()
    return keys.groupBy("path").agg(F.collect_list("doc").alias("docs")).mapInArrow(read, f"{id} long, ids array<long>")
