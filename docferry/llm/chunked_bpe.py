"""BPE by content-defined chunks: chunks that documents share are encoded once, joins are encoded anew.

A rolling hash over the last WINDOW bytes cuts a text wherever the hash is in one of every ``1 / 2**CUT_BITS`` values,
so equal passages are cut alike whatever stands around them. A chunk's ids are kept under its bytes. At a join, the end
of one chunk and the beginning of the next are encoded anew together: the stretch grows to both sides until it ends at
borders where the tokenizer's pattern always ends a token group, whatever the context, so the ids on either side agree
exactly with those of the whole text. Such borders are found in any script: before white space, between letters and
digits, and between either of them and punctuation, apart from an apostrophe before a letter. No group goes on over one, as only
the first character of a group can be a blank before another kind, and the pattern never looks back; it looks ahead
within white space alone, and no border has white space on its left. Chunks without a border become part of
the stretch. Stretches are kept under their bytes too, so copies encode nothing anew.

Documents that resemble each other are brought to the same tasks first: rows are dealt by ranges of (least window hash
of the text, mixed once more as long texts have smaller least hashes; hash of the id), so that copies share a task's chunks,
and a large group of copies is still dealt over many tasks; only rows equal in id and text cannot be told apart and share one. No row leaves its order of work to another; the ids of a text depend on that text alone.

Defined results: null text is empty (no ids); repeated and null ids keep their rows; empty tables give no rows; other
columns of the input do not matter.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docferry.llm.bpe import Codec, codec
from docferry.llm.common import give_back, mix64, named, powers, running_hash, shuffle_partitions, slices, utf8_bytes

WINDOW = 24
#: A chunk has 2 ** CUT_BITS bytes on average.
CUT_BITS = 9
#: Bytes of chunks that a task keeps; when full, it starts anew.
KEEP_BYTES = 24 << 20
#: Sets the order in which texts are dealt apart from the size of their least window hash.
SECOND_MIX = np.uint64(0x9E3779B97F4A7C15)

# Characters whose class is the same in every version of Unicode that a tokenizer may know.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-яЁё一-龥ぁ-ゖァ-ヺ가-힣"
_DIGITS = "0-9"
_MARKS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~，。！？；：、（）「」《》“”…—"
_SPACES = r" \t\r\n"
_BORDER = (
    rf"(?:(?<=[{_LETTERS}{_DIGITS}])(?=[{_SPACES}'{_MARKS}])|(?<=[{_MARKS}])(?=[{_LETTERS}{_DIGITS}{_SPACES}])"
    rf"|(?<=[{_LETTERS}])(?=[{_DIGITS}])|(?<=[{_DIGITS}])(?=[{_LETTERS}]))"
)
_FIRST, _LAST = re.compile(_BORDER), re.compile(f".*{_BORDER}", re.DOTALL)


def window_hashes(data: np.ndarray, running: np.ndarray | None = None) -> np.ndarray:
    """A hash of the WINDOW bytes that end before each place from WINDOW on."""
    if len(data) < WINDOW:
        return np.zeros(0, np.uint64)
    running = running_hash(data) if running is None else running
    return mix64((running[WINDOW:] - running[:-WINDOW]) * powers(len(running), inverse=True)[: len(running) - WINDOW])


def cut_points(data: np.ndarray) -> np.ndarray:
    """Places in a UTF-8 text where a chunk ends, chosen by the bytes before them; never inside a character."""
    hashes = window_hashes(data)
    at = np.flatnonzero(hashes >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


class ChunkEncoder:
    """Encodes texts; keeps what chunks gave for the texts that follow."""

    def __init__(self, tokens: Codec, keep_bytes: int = KEEP_BYTES):
        self.tokens, self.keep_bytes = tokens, keep_bytes
        self.known: dict[bytes, tuple[bytes, np.ndarray | None, bytes]] = {}
        self.joins: dict[bytes, np.ndarray] = {}
        self.kept = self.n_chunks = self.n_reused = 0
        #: Characters that went through the tokenizer.
        self.n_encoded = 0

    def _keep(self, kept: dict, key: bytes, value: object) -> None:
        size = 3 * len(key) + 500
        if self.kept + size > self.keep_bytes:
            self.known.clear()
            self.joins.clear()
            self.kept = 0
        if size <= self.keep_bytes:
            self.kept += size
            kept[key] = value

    def _anew(self, text: str) -> np.ndarray:
        self.n_encoded += len(text)
        return self.tokens.ordinary(text)

    def chunk(self, chunk: bytes) -> tuple[bytes, np.ndarray | None, bytes]:
        """Bytes before the first border, ids from there to the last one, bytes after it; ids None: no border."""
        self.n_chunks += 1
        found = self.known.get(chunk)
        if found is not None:
            self.n_reused += 1
            return found
        text = chunk.decode()
        first = _FIRST.search(text)
        if first is None:
            found = (chunk, None, b"")
        else:
            start, stop = first.end(), _LAST.match(text).end()
            found = (text[:start].encode(), self._anew(text[start:stop]), text[stop:].encode())
        self._keep(self.known, chunk, found)
        return found

    def join(self, stretch: bytes) -> np.ndarray:
        """Ids of what lies between the chunks' own ids, from border to border."""
        found = self.joins.get(stretch)
        if found is None:
            found = self._anew(stretch.decode())
            self._keep(self.joins, stretch, found)
        return found

    def ordinary(self, text: str) -> list[np.ndarray]:
        """Ids of a text without special strings, in pieces."""
        data = text.encode()
        cuts = [0, *cut_points(np.frombuffer(data, np.uint8)).tolist(), len(data)]
        out, stretch = [], []
        for start, stop in zip(cuts, cuts[1:], strict=False):
            head, ids, tail = self.chunk(data[start:stop])
            stretch.append(head)
            if ids is not None:
                out += [self.join(b"".join(stretch)), ids]
                stretch = [tail]
        return [*out, self.join(b"".join(stretch))]

    def encode(self, text: str) -> np.ndarray:
        if self.tokens.fast is None:
            return self.tokens.encode(text)
        pieces = []
        for i, part in enumerate(self.tokens.segments(text)):
            pieces += [np.asarray([self.tokens.specials[part]], np.uint32)] if i % 2 else self.ordinary(part)
        return np.concatenate(pieces)


def similar_together(df: DataFrame, text: str, salt: str, n: int | None = None) -> DataFrame:
    """The rows, dealt so that texts with the same least window hash are neighbours, and no value fills a task."""

    def least(batches):
        for batch in slices(batches, text):
            data, rows = utf8_bytes(batch.column(text))
            keys = np.zeros(batch.num_rows, np.uint64)
            hashes = window_hashes(data)
            for i, (start, stop) in enumerate(zip(rows, rows[1:], strict=False)):
                own = hashes[start : stop - WINDOW + 1]
                keys[i] = own.min() if stop - start >= WINDOW else 0
            keys = mix64(keys ^ SECOND_MIX)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], [*batch.schema.names, "_alike"])
        give_back()

    schema = StructType([*df.schema, StructField("_alike", LongType())])
    keyed = df.mapInArrow(least, schema)
    dealt = keyed.repartitionByRange(n or shuffle_partitions(df.sparkSession), "_alike", F.xxhash64(salt))
    return dealt.sortWithinPartitions("_alike").drop("_alike")


def encode_documents(df: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", gather: bool = True, keep_ids: bool = True) -> DataFrame:
    """doc_id, ids (array<int>, if ``keep_ids``), n_tokens, ids_sha256, decoded_sha256 of every row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def encode(batches):
        tokens = codec(tokenizer)
        encoder, decimal = ChunkEncoder(tokens), [str(i) for i in range(tokens.size)]
        for batch in slices(batches, "text"):
            ids = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
            listed = [hashlib.sha256(",".join(map(decimal.__getitem__, i.tolist())).encode()).hexdigest() for i in ids]
            decoded = [hashlib.sha256(tokens.decode(i).encode()).hexdigest() for i in ids]
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(i) for i in ids], pa.int64()), "ids_sha256": pa.array(listed, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            if keep_ids:
                columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        del encoder
        give_back()

    dealt = similar_together(rows, "text", "doc_id") if gather else rows
    return dealt.mapInArrow(encode, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def decode_documents(df: DataFrame, tokenizer: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text that their ids stand for; null ids give null."""
    names = [c for c in df.columns if c.lower() != text.lower()]

    def decode(batches):
        tokens = codec(tokenizer)
        for batch in batches:
            texts = [None if i is None else tokens.decode(np.asarray(i, np.uint32)) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, text])

    base = df.select(*named(names))
    return base.mapInArrow(decode, StructType([*base.schema, StructField(text, StringType())]))
