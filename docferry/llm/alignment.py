"""Token alignment of two tokenizers: where their tokens end together, and which ids stand for the same bytes.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model. Both see a blank and the text. Byte offsets
where a token of A and one of B end are cuts; the tokens between two cuts are a group, and all A-B pairs of a group are
links. Cuts are found in lockstep: one state vector holds the two token pointers of all lanes of a batch, a step moves
in every lane the pointer whose token ends first (both where they end together, which emits a cut and so the links of a
group), and lanes that are done leave the vector. A text is one lane per LANE_BYTES of it, so that a long text takes
no more steps than a short one: whether a place is a cut depends on the tokens that end there alone.

Very long texts are encoded in stretches that end before a blank after a character other than white space. No token
of either side crosses such a place (A's pattern never matches past it; whether B has a piece with a blank inside is
checked when the file is read), so that the ids are those of the whole text.

Counts of id pairs are over all documents: pairs of a document are unfolded and counted by Spark. The most frequent
pairs (KNOWN_PAIRS at most) are sent to the tasks; documents' other pairs, none of them frequent, meet their counts in
a shuffled join.

Defined results: texts that are null or empty, or whose joined token bytes on a side differ from blank + text, have no
tokens and zeros everywhere. Repeated rows and ids are documents of their own; null ids stay; an empty table gives no
rows; other columns of the input do not matter, whatever their names. Very long texts are lanes of a batch of their own.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.bpe import byte_letters, codec
from docferry.llm.common import slices
from docferry.session import written

LANE_BYTES = 2048
#: Characters of a text that are encoded in one call, at least.
STRETCH = 1 << 18
#: Pairs whose counts are sent to all tasks (16 bytes each).
KNOWN_PAIRS = 1 << 19

#: Before a blank that follows a character other than white space.
_PLACE = re.compile(r"(?<=\S)(?= )")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
BLANK_MARK = "▁"


class ByteSide:
    """A byte-level BPE file: ids of texts that begin with the added blank."""

    def __init__(self, path: str):
        own = codec(path)
        self.fast = own.fast
        if self.fast is not None:
            self.pieces, self.splits = own.pieces, True
        else:
            self.library = tokenizers.Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = True
            letters = byte_letters()
            named = sorted(self.library.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
            self.splits, self.pieces = False, [b""] * (1 + max(i for _, i in named))
            for piece, i in named:
                self.pieces[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()

    def encode(self, texts: list[str]) -> list:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]


class PieceSide:
    """A sentencepiece model: ids of texts that begin with the blank the model itself adds."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        whole = [_BYTE.fullmatch(n) if self.model.is_byte(i) else None for i, n in enumerate(names)]
        self.pieces = [bytes([int(m[1], 16)]) if m else n.replace(BLANK_MARK, " ").encode() for n, m in zip(names, whole, strict=True)]
        self.splits = not any(BLANK_MARK in n.lstrip(BLANK_MARK) for n in names)

    def encode(self, texts: list[str]) -> list:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


class Sides:
    """Both tokenizers, read once per worker."""

    def __init__(self, a: str, b: str):
        self.sides = (ByteSide(a), PieceSide(b))
        self.splits = all(side.splits for side in self.sides)
        self.lengths = [np.asarray([len(p) for p in side.pieces], np.int64) for side in self.sides]

    def stretches(self, text: str) -> list[str]:
        """The text, a long one in stretches that no token crosses; all begin with a blank."""
        if len(text) <= STRETCH or not self.splits:
            return [text]
        cuts, at = [0], STRETCH
        while at < len(text) and (place := _PLACE.search(text, at)):
            cuts.append(place.start())
            at = place.start() + STRETCH
        return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)], strict=True)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts, and tokens before each (and in all), per side; none where a side's bytes are not blank + text."""
        parts = [self.stretches(" " + t) if t else [] for t in texts]
        flat = [p for own in parts for p in own]
        rows = np.concatenate([[0], np.cumsum([len(own) for own in parts], dtype=np.int64)])
        found = [side.encode(flat) for side in self.sides]
        wrong = np.zeros(len(flat) + 1, np.int64)
        for i, data in enumerate(map(str.encode, flat)):
            wrong[i + 1] = any(b"".join(map(side.pieces.__getitem__, ids[i])) != data for side, ids in zip(self.sides, found, strict=True))
        usable = np.diff(np.cumsum(wrong)[rows]) == 0
        keep = np.repeat(usable, np.diff(rows))
        ids, before = [], []
        for k in range(2):
            mine = [np.asarray(i, np.int32) if use else np.zeros(0, np.int32) for i, use in zip(found[k], keep, strict=True)]
            ids.append(np.concatenate([np.zeros(0, np.int32), *mine]))
            before.append(np.concatenate([[0], np.cumsum([len(i) for i in mine], dtype=np.int64)])[rows])
        return ids, before


@dataclass
class Alignment:
    """Tokens and groups of a batch of texts, those of one text after the other."""

    ids: list[np.ndarray]  # of A, of B
    rows: list[np.ndarray]  # tokens before each text (and in all), of A, of B
    cuts: list[np.ndarray]  # tokens before the end of each group, of A, of B
    groups: np.ndarray  # groups before each text (and in all)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, A id, B id and number of links, a row for each different id pair of a group.

        A group's tokens are counted by id before they meet, as a long stretch without a cut can hold many equal ones.
        """
        sides = []
        for ids, cut in zip(self.ids, self.cuts, strict=True):
            group = np.repeat(np.arange(len(cut)), np.diff(cut, prepend=0))
            keys, times = np.unique((group << 32) + ids, return_counts=True)
            at = np.searchsorted(keys >> 32, np.arange(len(cut) + 1))
            sides.append((keys & 0xFFFFFFFF, times, at))
        (ids_a, times_a, at_a), (ids_b, times_b, at_b) = sides
        n_b = np.diff(at_b)
        both = np.diff(at_a) * n_b
        group = np.repeat(np.arange(len(both)), both)
        place = np.arange(len(group)) - np.repeat(np.cumsum(both) - both, both)
        of_a, of_b = at_a[group] + place // n_b[group], at_b[group] + place % n_b[group]
        return np.searchsorted(self.groups, group, side="right") - 1, ids_a[of_a], ids_b[of_b], times_a[of_a] * times_b[of_b]


def lockstep(ends: list[np.ndarray], lanes: np.ndarray) -> list[np.ndarray]:
    """Numbers of the tokens of A and of B that end together; ``lanes`` are byte offsets between which lanes run."""
    first = [np.searchsorted(e, lanes[:-1], side="right") for e in ends]
    last = [np.searchsorted(e, lanes[1:], side="right") for e in ends]
    state = np.stack([first[0], first[1], last[0], last[1]])
    found: list[np.ndarray] = []
    while True:
        state = state[:, (state[0] < state[2]) & (state[1] < state[3])]
        if not state.shape[1]:
            break
        end_a, end_b = ends[0][state[0]], ends[1][state[1]]
        cut = end_a == end_b
        found.append(state[:2, cut])
        state[0] += end_a <= end_b
        state[1] += end_b <= end_a
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return list(both[:, np.argsort(both[0])])


@functools.lru_cache(maxsize=2)
def sides(a: str, b: str) -> Sides:
    return Sides(a, b)


def align(texts: list[str], a: str, b: str) -> Alignment:
    """Groups of the texts' tokens; texts that a side does not give back byte by byte have none."""
    both = sides(a, b)
    ids, rows = both.encode(texts)
    ends = [np.cumsum(lengths[i]) for lengths, i in zip(both.lengths, ids, strict=True)]
    bytes_at = np.concatenate([[0], ends[0]])[rows[0]]
    inner = np.arange(0, bytes_at[-1], LANE_BYTES)
    cuts = [c + 1 for c in lockstep(ends, np.union1d(bytes_at, inner))]
    return Alignment(ids, rows, cuts, np.searchsorted(cuts[0], rows[0], side="right"))


@functools.lru_cache(maxsize=2)
def _decimals(size: int) -> list[str]:
    return [f"{i}{mark}" for mark in ",|;" for i in range(size)]


def group_texts(found: Alignment, size: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every text: ids of A and of B of each group, groups in order; ``size`` is above all ids."""
    codes = [i.astype(np.int64) for i in found.ids]
    for code, cut, mark in zip(codes, found.cuts, (1, 2), strict=True):
        code[cut - 1] += mark * size
    # a group's tokens of A follow all of B before it, its tokens of B all of A up to its end
    n = [np.diff(c, prepend=0) for c in found.cuts]
    merged = np.empty(len(codes[0]) + len(codes[1]), np.int64)
    merged[np.arange(len(codes[0])) + np.repeat(found.cuts[1] - n[1], n[0])] = codes[0]
    merged[np.arange(len(codes[1])) + np.repeat(found.cuts[0], n[1])] = codes[1]
    words = list(map(_decimals(size).__getitem__, merged.tolist()))
    at = (found.rows[0] + found.rows[1]).tolist()
    return ["".join(words[start:stop])[:-1] for start, stop in zip(at, at[1:], strict=False)]


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))


def align_documents(df: DataFrame, a: str, b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a_ids, b_ids, and per group the number of tokens before its end (a_cuts, b_cuts) and its end in bytes (byte_cuts)."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            found = align([t or "" for t in batch.column("text").to_pylist()], a, b)
            own = [c - np.repeat(r[:-1], np.diff(found.groups)) for c, r in zip(found.cuts, found.rows, strict=True)]
            size = np.cumsum(sides(a, b).lengths[0][found.ids[0]])
            ends = size[found.cuts[0] - 1]
            ends -= np.repeat(np.concatenate([[0], size])[found.rows[0][:-1]], np.diff(found.groups))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "a_ids": _lists(found.ids[0], found.rows[0]), "b_ids": _lists(found.ids[1], found.rows[1]),
                "a_cuts": _lists(own[0], found.groups), "b_cuts": _lists(own[1], found.groups), "byte_cuts": _lists(ends, found.groups),
            })

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, a_ids array<int>, b_ids array<int>, a_cuts array<long>, b_cuts array<long>, byte_cuts array<long>")


def _linked(df: DataFrame, a: str, b: str, doc_id: str, text: str) -> DataFrame:
    """Digests of every document's alignment; its different id pairs (A id * 2 ** 32 + B id) and how many links each has."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            found = align([t or "" for t in batch.column("text").to_pylist()], a, b)
            doc, of_a, of_b, times = found.links()
            pair = (of_a << 32) + of_b
            order = np.lexsort((pair, doc))
            doc, pair, times = doc[order], pair[order], times[order]
            new = np.ones(len(pair), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
            first = np.flatnonzero(new)
            at = np.searchsorted(doc[first], np.arange(batch.num_rows + 1))
            times = np.add.reduceat(times, first) if len(first) else times
            total = np.concatenate([[0], np.cumsum(times)])[at]
            listed = group_texts(found, max(map(len, sides(a, b).lengths)))
            said = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in listed]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_a": pa.array(np.diff(found.rows[0])), "n_b": pa.array(np.diff(found.rows[1])),
                "n_groups": pa.array(np.diff(found.groups)), "n_links": pa.array(np.diff(total)),
                "groups_sha256": pa.array(said, pa.string()), "pairs": _lists(pair[first], at),
                "times": _lists(times, at),
            })

    kind = dict(rows.dtypes)["doc_id"]
    made = rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")
    return made.withColumn("row", F.monotonically_increasing_id())


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, docs (how many documents hold it linked), best (no pair of its A id has more)."""
    counts = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = written(counts, "pair-counts")[0].withColumn("a", F.shiftright("pair", 32))
    # as many rows as A has ids
    most = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("most")))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment_links(df: DataFrame, a: str, b: str, *, doc_id: str = "doc_id", text: str = "text", known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    spark = df.sparkSession
    linked, _ = written(_linked(df, a, b, doc_id, text), "linked")
    counts, _ = written(pair_counts(linked), "pairs")
    n_pairs = counts.count()
    top = counts.orderBy(F.col("docs").desc(), "pair").limit(known_pairs).toArrow()
    keys = top.column("pair").to_numpy()
    order = np.argsort(keys)
    known = spark.sparkContext.broadcast((keys[order], top.column("docs").to_numpy()[order], top.column("best").to_numpy()[order]))

    def look_up(batches):
        keys, docs, best = known.value
        for batch in batches:
            at = np.asarray(batch.column("pairs").offsets, np.int64)
            pair = batch.column("pairs").values.to_numpy()[at[0] : at[-1]]
            times = batch.column("times").values.to_numpy()[at[0] : at[-1]]
            at = at - at[0]
            place = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            there = keys[place] == pair if len(keys) else np.zeros(len(pair), bool)
            total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[at])
            sums = [total(np.where(there, times * w[place], 0) if len(keys) else times * 0) for w in (best.astype(np.int64), docs)]
            rest = np.concatenate([[0], np.cumsum(~there)])[at]
            columns = [*(batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"))]
            columns += [pa.array(sums[0]), pa.array(sums[1]), _lists(pair[~there], rest), _lists(times[~there], rest)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "pairs", "times"])

    kind = dict(linked.dtypes)["doc_id"]
    shape = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<long>"
    met = linked.mapInArrow(look_up, shape)
    if n_pairs > known_pairs:
        rare = met.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        more = rare.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
        met = met.join(more, "row", "left")
        met = met.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return met.select(*RESULT)
