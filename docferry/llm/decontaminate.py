"""Benchmark passages in documents, by Wu-Manber search over words.

An item's windows are its runs of ``window`` words (an item of fewer words is one window). Words are symbols, blocks are
SUFFIX consecutive words. For windows of one length, a table says how far the search may move on when it sees a
block: a block that no window holds lets it skip almost a whole window. Where the shift is 0, the block ends some window;
the hash of that block selects the windows that end so, and they are compared word by word.

Tables of all windows go to every task while the benchmark has at most ``table_bytes`` of text. A larger one is
searched in parts of that size, one pass after another over the same rows, each adding what it finds to the rows; no
join or shuffle of documents is needed in either case.

Words are runs of letters and digits of ASCII, lower-cased, and of bytes from 0x80 on.

Defined results: null text has no words; items that are null or without words have no window; repeated items
count once per item id; items without an id mark words but are not counted; empty tables give no hits or no rows; other
columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import give_back, named, slices

WINDOW = 10
#: Words of a block.
SUFFIX = 2
#: Bytes of benchmark text whose tables go to the tasks together.
TABLE_BYTES = 8 << 20

#: Lower-cases A-Z and makes every byte between words a blank.
_CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_CLEAN).split() if text else []


class WuManber:
    """Finds windows of one length in sequences of word numbers (0: a word of no window)."""

    def __init__(self, windows: dict[tuple[int, ...], set], length: int):
        self.length, self.size = length, min(SUFFIX, length)
        self.far = length - self.size + 1
        self.shift: dict = {}
        self.ending: dict = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.size, length + 1):
                block = window[end - self.size : end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.ending[window[-self.size :]].append((window, items))

    def search(self, words: list[int]):
        """(start, items) of every occurrence."""
        length, size, shift, ending, far = self.length, self.size, self.shift.get, self.ending, self.far
        end, n = length, len(words)
        if size == 2:
            while end <= n:
                second = words[end - 1]
                if not second:  # no window holds this word: the next one starts after it
                    end += length
                    continue
                block = (words[end - 2], second)
                move = shift(block, far)
                if move:
                    end += move
                    continue
                start = end - length
                for window, items in ending[block]:
                    if tuple(words[start:end]) == window:
                        yield start, items
                end += 1
        else:
            for start, word in enumerate(words):
                if word and (word,) in ending:
                    for _, items in ending[(word,)]:
                        yield start, items


class Searcher:
    """All windows of a set of items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            length = min(window, len(words))
            for start in range(len(words) - length + 1 if length else 0):
                by_length[length][tuple(words[start : start + length])].add(item)
        self.tables = [WuManber(windows, length) for length, windows in sorted(by_length.items())]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit ranges of words, joined and in order, and the ids of the items that occur."""
        known = self.numbers
        numbers = [known.get(w, 0) for w in words]
        ranges, items = [], set()
        for table in self.tables:
            for start, found in table.search(numbers):
                ranges.append((start, start + table.length))
                items |= found
        return _joined(ranges), items


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _parts(benchmark: DataFrame, item_id: str, text: str, table_bytes: int) -> list[DataFrame]:
    """The items, in as many parts as the bytes of their texts need."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // table_bytes))
    if n == 1:
        return [items]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(part == i) for i in range(n)]


HITS = "array<struct<start: int, stop: int>>"


def find_passages(df: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows with n_words, hits (ranges of hit words) and items (ids as text, sorted) of every whole text.

    Input columns of those names are replaced.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c.lower() not in ("n_words", "hits", "items")]
    base = df.select(*named(names))
    out = base.select("*", F.lit(0).cast("long").alias("n_words"), F.expr(f"CAST(array() AS {HITS})").alias("hits"), F.expr("CAST(array() AS array<string>)").alias("items"))
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for part in _parts(benchmark, item_id, item_text, table_bytes):
        tables = spark.sparkContext.broadcast([(r.item, r.text) for r in part.collect()])

        def search(batches, tables=tables):
            searcher = Searcher(tables.value, window)
            for batch in slices(batches, text):
                n_words, hits, items = [], [], []
                before = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)
                for value, (old_hits, old_items) in zip(batch.column(text).to_pylist(), before, strict=True):
                    words = words_of(value)
                    own, found = searcher.find(words)
                    n_words.append(len(words))
                    if old_hits:
                        own = _joined(own + [(h["start"], h["stop"]) for h in old_hits])
                    hits.append([{"start": a, "stop": b} for a, b in own])
                    items.append(sorted({*(i for i in found if i is not None), *old_items}))
                kept = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(hits, ranges), pa.array(items, pa.list_(pa.string()))], [*names, "n_words", "hits", "items"])
            give_back()

        out = out.mapInArrow(search, out.schema)
    return out


def contamination(df: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    found = find_passages(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def without_passages(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows whose text holds no window of the benchmark, with their own columns."""
    text = options.get("text", "text")
    found = find_passages(df.select(F.struct(*named(df.columns)).alias("row"), F.col(text).alias("text")), benchmark, **{**options, "text": "text"})
    return found.where(F.size("hits") == 0).select("row.*")

