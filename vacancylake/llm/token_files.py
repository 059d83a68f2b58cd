"""Token-ID files: independent zstandard frames, a document index, and a trailing seek table with a checksum per frame.

Layout of a file, front to back:

* data frames, each the zstandard compression of at most ``FRAME_IDS`` ids as little-endian unsigned integers of 2 bytes
  (4 where the vocabulary needs it). Documents follow one another without regard to frames, so a long one spans several;
* a skippable frame with the document index: an Arrow stream (compressed) of (doc_id, first id in the file, number of ids);
* a skippable frame with the seek table of the public seekable format: per data frame its compressed size, its plain size
  and the low 32 bits of XXH64 of the plain bytes, then the number of frames, a flag byte and the closing magic number.

Plain decompressors see the ids alone. A reader fetches the two tables from the file's end, then only the frames that hold
the documents it wants, and compares each with its checksum.

Cases: a null text is an empty one (its end id alone); equal doc_ids stay apart, in any order among themselves; a null
doc_id sorts first; no rows give no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancylake.llm.texts import read_documents
from vacancylake.llm.token_ids import encoded, word_encoder
from vacancylake.session import new_shared_path, ship_package

FRAME_IDS = 1 << 16
LEVEL = 3
# Fixed values of the public zstandard and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
_HEADER = struct.Struct("<II")


class TokenFileWriter:
    """Appends documents in the order given; holds one frame of ids and the index, never the file."""

    def __init__(self, out, id_type: pa.DataType, wide: bool = False, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.id_type = out, id_type
        self.kind = np.dtype("<u4" if wide else "<u2")
        self.frame_ids = frame_ids
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = 0
        self.frames: list[bytes] = []
        self.keys: list[pa.Array] = []
        self.starts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def append(self, keys: pa.Array, ids: np.ndarray, at: np.ndarray) -> None:
        """Documents ``keys`` with ids ``ids[at[k]:at[k + 1]]``."""
        self.keys.append(keys)
        self.starts.append(at[:-1] + self.n_ids)
        self.sizes.append(np.diff(at))
        self.n_ids += int(at[-1])
        if len(ids) and int(ids.max()) > np.iinfo(self.kind).max:
            raise ValueError(f"id {int(ids.max())} needs more than {self.kind.itemsize} bytes")
        ids = ids.astype(self.kind)
        while self.n_pending + len(ids) >= self.frame_ids:
            cut = self.frame_ids - self.n_pending
            self.pending.append(ids[:cut])
            ids = ids[cut:]
            self._flush()
        if len(ids):
            self.pending.append(ids)
            self.n_pending += len(ids)

    def _flush(self) -> None:
        plain = np.concatenate(self.pending).tobytes()
        packed = self.compressor.compress(plain)
        self.out.write(packed)
        self.frames.append(_ENTRY.pack(len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.pending, self.n_pending = [], 0

    def close(self) -> None:
        if self.n_pending:
            self._flush()
        index = pa.table({
            "doc_id": pa.chunked_array(self.keys, self.id_type),
            "start": pa.chunked_array([pa.array(x, pa.int64()) for x in self.starts], pa.int64()),
            "n_ids": pa.chunked_array([pa.array(x, pa.int64()) for x in self.sizes], pa.int64()),
        }).replace_schema_metadata({"width": str(self.kind.itemsize), "frame_ids": str(self.frame_ids)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        body = zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())
        self.out.write(_HEADER.pack(SKIPPABLE_INDEX, len(body)) + body)
        table = b"".join(self.frames)
        self.out.write(_HEADER.pack(SKIPPABLE_SEEK_TABLE, len(table) + _FOOTER.size) + table)
        self.out.write(_FOOTER.pack(len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC))


class TokenFile:
    """Random access to one file; ``source`` seeks and reads."""

    def __init__(self, source):
        self.source = source
        size = source.size() if hasattr(source, "size") else source.seek(0, os.SEEK_END)
        n, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - _FOOTER.size - n * _ENTRY.size
        self.frames = list(_ENTRY.iter_unpack(self._at(table_at, n * _ENTRY.size)))
        self.frame_at = np.concatenate([[0], np.cumsum([x[0] for x in self.frames], dtype=np.int64)]).astype(np.int64)
        index_at = int(self.frame_at[-1])
        body = self._at(index_at + _HEADER.size, table_at - _HEADER.size - index_at - _HEADER.size)
        index = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()
        self.kind = np.dtype(f"<u{index.schema.metadata[b'width'].decode()}")
        self.frame_ids = int(index.schema.metadata[b"frame_ids"])
        self.keys = index["doc_id"].combine_chunks()
        self.starts, self.sizes = (index[c].to_numpy() for c in ("start", "n_ids"))
        self.frames_read = 0
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, self.kind))

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        """Ids of frame ``k``; the last one asked for is kept, so reading in order decompresses each once."""
        if self._last[0] != k:
            packed, plain, checksum = self.frames[k]
            data = zstandard.ZstdDecompressor().decompress(self._at(int(self.frame_at[k]), packed), max_output_size=plain)
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} does not match its checksum")
            self.frames_read += 1
            self._last = (k, np.frombuffer(data, self.kind))
        return self._last[1]

    def ids(self, k: int) -> np.ndarray:
        """Ids of the ``k``-th document of the file."""
        start, end = int(self.starts[k]), int(self.starts[k] + self.sizes[k])
        parts = []
        for f in range(start // self.frame_ids, -(-end // self.frame_ids)):
            base = f * self.frame_ids
            parts.append(self.frame(f)[max(0, start - base) : end - base])
        return np.concatenate(parts) if parts else np.zeros(0, self.kind)

    def find(self, doc_ids: Iterable) -> list[int]:
        """Positions of all documents with these ids; the file is in ascending order of ids, nulls first."""
        keys, nulls = self.keys.drop_null().to_pylist(), self.keys.null_count
        found = []
        for d in doc_ids:
            lo, hi = bisect.bisect_left(keys, d), bisect.bisect_right(keys, d)
            found += range(nulls + lo, nulls + hi)
        return sorted(found)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, wide: bool | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as files in ascending order of doc_id, and return the list of files.

    ``wide`` is 4 bytes an id instead of 2; by default the vocabulary and the end id decide. An id that does not fit raises ValueError.
    The list (part, file, n_docs, n_ids) is itself stored beside the files; a repeated task writes under another name, and
    only files in the list count. ``folder`` must be one that all executors share.
    """
    spark = docs.sparkSession
    ship_package(spark)
    if wide is None:
        wide = max(word_encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) > np.iinfo("<u2").max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = name = None
        n_docs = 0
        for part, ids, at in encoded(batches, tokenizer, end_id):
            if writer is None:
                store, path = fs.FileSystem.from_uri(folder)
                store.create_dir(path, recursive=True)
                name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.ids.zst"
                out = store.open_output_stream(f"{path}/{name}", compression=None)
                writer = TokenFileWriter(out, pa.int64(), wide)
            writer.append(part.column(0), ids, at)
            n_docs += part.num_rows
        if writer is not None:
            writer.close()
            out.close()
            row = {"part": TaskContext.get().partitionId(), "file": name, "n_docs": n_docs, "n_ids": writer.n_ids}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    files = (
        docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(write, "part long, file string, n_docs long, n_ids long")
    )
    files.write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (as ``<u4`` bytes)."""
    ship_package(spark)
    files = spark.read.parquet(f"{folder}/files")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    yield from _rows(TokenFile(source), row["before"])

    # One row per file, so this window is over as many rows as there were writing tasks.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = files.withColumn("before", before).repartition(max(1, files.count()))  # tiny rows, large files: a task for each
    return listed.mapInArrow(read, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ]))


def _rows(file: TokenFile, before: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """All documents of a file in batches of about ``most`` ids."""
    n, k = len(file.keys), 0
    while k < n:
        rows, size, at = [], 0, k
        while k < n and size < most:
            ids = file.ids(k).astype("<u4")
            rows.append(ids.tobytes())
            size += len(ids)
            k += 1
        yield pa.RecordBatch.from_arrays(
            [file.keys.slice(at, k - at), pa.array(file.starts[at:k] + before), pa.array(file.sizes[at:k]), pa.array(rows, pa.binary())],
            ["doc_id", "start", "n_tokens", "ids"],
        )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token-ID files and read back: where each starts, its number of ids and their checksum."""
    import public_tokenizers

    folder = new_shared_path(spark, "token-ids")
    write_token_files(read_documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op3_token_files": (op3_token_files, None)}
