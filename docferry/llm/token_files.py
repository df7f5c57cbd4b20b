"""Token ids in files: fixed-width bit packing in blocks, read back by numpy, whole or at any place.

One file holds the documents of one range of ids, in order::

    magic "DFTOKEN1"
    blocks     each of BLOCK_IDS ids, ``bits`` bits an id, least significant bit first; the last may be shorter
    footer     int64: byte offset of each block and of their end, then ids before each document and after the last,
               then the document ids, then one byte a document: 1 where the id is null
    tail       int64: bits, ids, documents, byte offset of the footer

``bits`` is the least width that holds every id of the vocabulary. As all widths are fixed, id k stands in block
k // BLOCK_IDS, and a range of ids needs only the blocks that it touches.

Files are written by tasks under names of their own; a table of those that count is written by Spark, so that files of
a lost or repeated task are never read.

Defined results: null text is empty (only the end id); a null id comes first; repeated ids keep all their rows, ordered
by text; other columns of the input do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docferry.llm.bpe import codec
from docferry.llm.common import file_system, make_folder, shuffle_partitions, slices
from docferry.session import scratch_dir

MAGIC = b"DFTOKEN1"
BLOCK_IDS = 8192
TAIL_BYTES = 32
#: Ids read at once.
READ_IDS = 1 << 20


def id_bits(vocabulary: int) -> int:
    """The least number of bits that holds ids 0 to ``vocabulary`` - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids side by side, ``bits`` bits each; 64 of them fill ``bits`` words of 64 bits."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups, 64), dtype=np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, bits + 1), dtype=np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words[:, :bits].astype("<u8").tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of what ``pack`` made."""
    groups = -(-n // 64)
    words = np.zeros((groups, bits + 1), dtype=np.uint64)
    words[:, :bits] = np.frombuffer(data[: groups * bits * 8].ljust(groups * bits * 8, b"\0"), "<u8").reshape(groups, bits)
    lanes = np.empty((groups, 64), dtype=np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        lanes[:, lane] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[:, lane] |= words[:, word + 1] << np.uint64(64 - shift)
    return (lanes.reshape(-1)[:n] & np.uint64((1 << bits) - 1)).astype(np.uint32)


class TokenFileWriter:
    """Writes one file, block by block."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.at, self.offsets, self.starts = len(MAGIC), [], [0]
        self.doc_ids: list[int | None] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"id {int(ids.max())} needs more than {self.bits} bits")
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 16 * BLOCK_IDS:
            self._flush(self.n_waiting // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for start in range(0, n, BLOCK_IDS):
            block = pack(ids[start : min(start + BLOCK_IDS, n)], self.bits)
            self.offsets.append(self.at)
            self.at += self.stream.write(block) or len(block)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_waiting)
        nulls = np.asarray([d is None for d in self.doc_ids], np.uint8)
        numbers = np.asarray([*self.offsets, self.at, *self.starts, *(d or 0 for d in self.doc_ids)], "<i8")
        self.stream.write(numbers.tobytes() + nulls.tobytes())
        self.stream.write(np.asarray([self.bits, self.starts[-1], len(self.doc_ids), self.at], "<i8").tobytes())
        self.stream.close()


class TokenFile:
    """Reads one file; ``f`` is seekable."""

    def __init__(self, f):
        self.f = f
        size = f.seek(0, io.SEEK_END) if not hasattr(f, "size") else f.size()
        self.bits, self.n_ids, self.n_docs, footer = np.frombuffer(self._read(size - TAIL_BYTES, TAIL_BYTES), "<i8").tolist()
        n_blocks = -(-self.n_ids // BLOCK_IDS)
        numbers = np.frombuffer(self._read(footer, size - TAIL_BYTES - footer)[: 8 * (n_blocks + 2 + 2 * self.n_docs)], "<i8")
        nulls = self._read(size - TAIL_BYTES - self.n_docs, self.n_docs)
        self.offsets, self.starts = numbers[: n_blocks + 1], numbers[n_blocks + 1 : n_blocks + 2 + self.n_docs]
        self.doc_ids = [None if null else int(d) for d, null in zip(numbers[n_blocks + 2 + self.n_docs :], nulls, strict=True)]

    def _read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` - 1 of the file, from the blocks they stand in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, (stop - 1) // BLOCK_IDS
        data = self._read(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        n = min(self.n_ids, (last + 1) * BLOCK_IDS) - first * BLOCK_IDS
        return unpack(data, self.bits, n)[start - first * BLOCK_IDS : stop - first * BLOCK_IDS]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the file."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document in order: id, ids before it in the file, its ids."""
        k = 0
        while k < self.n_docs:
            stop = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + READ_IDS, side="right")) - 1)
            ids, base = self.ids(int(self.starts[k]), int(self.starts[stop])), int(self.starts[k])
            for i in range(k, stop):
                yield self.doc_ids[i], int(self.starts[i]), ids[int(self.starts[i]) - base : int(self.starts[i + 1]) - base]
            k = stop


FILES = "part int, path string, n_docs long, n_ids long"


def write_token_files(df: DataFrame, tokenizer: str, folder: str, *, end_id: int | None, doc_id: str = "doc_id", text: str = "text", n_files: int | None = None) -> DataFrame:
    """Encode ``text`` of every row into files of ascending ``doc_id``; returns the table of files (part, path, n_docs, n_ids).

    The table is kept in ``folder`` too (``files``). Rows are dealt by ranges of (id, hash of the text), so rows that
    share an id are dealt as well.
    """
    make_folder(f"{folder}/ids")

    def write(batches):
        tokens = codec(tokenizer)
        end = np.asarray([] if end_id is None else [end_id], np.uint32)
        part, path, writer = TaskContext.get().partitionId(), f"{folder}/ids/{uuid.uuid4().hex}.ids", None
        for batch in slices(batches, "text"):
            if writer is None:
                fs, at = file_system(path)
                writer = TokenFileWriter(fs.open_output_stream(at), id_bits(max(tokens.size, (end_id or 0) + 1)))
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                writer.add(key, np.concatenate([tokens.encode(value or ""), end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_docs": len(writer.doc_ids), "n_ids": writer.starts[-1]}], pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    salted = rows.withColumn("salt", F.xxhash64("text"))
    dealt = salted.repartitionByRange(n_files or shuffle_partitions(df.sparkSession), "doc_id", "salt")
    ordered = dealt.sortWithinPartitions("doc_id", "salt", "text").drop("salt")
    ordered.mapInArrow(write, FILES).write.mode("overwrite").parquet(f"{folder}/files")
    return token_files(df.sparkSession, folder)


def token_files(spark, folder: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(f"{folder}/files")


def read_token_files(files: DataFrame, schema: str, use) -> DataFrame:
    """Rows that ``use(file_row, TokenFile)`` yields as dicts, for every file; a task reads one file after another."""
    spark, arrow = files.sparkSession, to_arrow_schema(StructType.fromDDL(schema))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = file_system(row["path"])
                with fs.open_input_file(at) as f:
                    found = []
                    for out in use(row, TokenFile(f)):
                        found.append(out)
                        if len(found) == 4096:
                            yield pa.RecordBatch.from_pylist(found, arrow)
                            found = []
                    yield pa.RecordBatch.from_pylist(found, arrow)

    return files.repartition(shuffle_partitions(spark), "path").mapInArrow(read, schema)


def document_checksums(files: DataFrame) -> DataFrame:
    """From the files alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as 32 bits)."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def use(row, file):
        for key, start, ids in file.documents():
            yield {"doc_id": key, "start": row["before"] + start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}

    # one row a file: the running sum over them is small whatever the documents hold
    return read_token_files(files.withColumn("before", before), "doc_id long, start long, n_tokens long, ids_crc32 long", use)


def encode_and_check(df: DataFrame, tokenizer: str, *, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write a table as token files in the shared folder and return what they hold, a row per document."""
    folder = scratch_dir(df.sparkSession, "tokens")
    return document_checksums(write_token_files(df, tokenizer, folder, end_id=end_id, doc_id=doc_id, text=text))
