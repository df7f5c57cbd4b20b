"""Helpers of the operators here: Arrow batches as byte blocks, word hashes, files in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import pathlib
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.naming import quote

#: Bytes of text that one step of a task works on; a longer single text is a step of its own.
BLOCK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes between words: blank and 0x09 to 0x0D.
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(names: list[str]) -> list[Column]:
    """Columns by their whole names, dots and back-ticks included."""
    return [F.col(quote(n)) for n in names]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of at most ``limit`` bytes of ``column`` or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Hand freed memory to the system; else it stays with this process, beside the JVM, until it ends."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do without
        ctypes.CDLL(None).malloc_trim(0)


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and where each row starts (and the last ends); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, rows: np.ndarray, between: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each row (and at the end)."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~between[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a row's end also ends a word
    cuts = np.unique(rows[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[(inside[cuts + 1] == 1) & (inside[cuts] == 1)]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    return _powers(base, 1 << max(10, (n + 1).bit_length()))[:n]


def running_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes (one more than bytes), for windows and short ranges; some long ones collide."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def sums_of(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of values, ranges in order and apart: a sum of mixed (value, place in the range).

    A polynomial modulo 2 ** 64 would give some different ranges of 1,024 values one hash, whatever its base.
    """
    sizes = ends - starts
    before = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(before[-1]) - np.repeat(before[:-1], sizes)
    own = values[place + np.repeat(starts, sizes)]
    mixed = mix64(own + mix64((place.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return mix64(total[before[1:]] - total[before[:-1]] + sizes.astype(np.uint64) * np.uint64(BASE))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; equal bytes have equal hashes wherever they stand."""
    return sums_of(_BYTE_VALUES[data], starts, ends)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every lower-cased word (blanks between), and the number of words before each row."""
    data, rows = utf8_bytes(column)
    data = LOWER[data]
    starts, ends, words = word_bounds(data, rows)
    return range_hashes(data, starts, ends), words


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as tasks open it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def make_folder(path: str) -> None:
    fs, at = file_system(path)
    fs.create_dir(at, recursive=True)


#: By application, the folder of the archive that its tasks fetch; it goes when the driver ends.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Make this library importable in the tasks, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory()
    archive = f"{folder.name}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
