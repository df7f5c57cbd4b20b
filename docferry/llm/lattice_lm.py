"""Document probability under a unigram model of subwords, summed over all segmentations.

The pieces are those of an existing vocabulary file, and the most frequent training words (at most WORD_PIECES), which other
words often begin with. A word, with the blank before it, spans a lattice whose arcs are the
pieces that occur in it; the weight of a path is the product of its pieces' probabilities, and the sum over all paths
follows from the forward recursion in log space. A word that occurs in the training texts is an arc of its own lattice
too, from its beginning to its end. No piece crosses a blank, so a document's lattice is those of its words in a row,
closed by an arc for the end, and its marginal probability is their product.

Existing scores: a vocabulary lists its pieces by frequency, so they start from 1 / (RANK + rank), words after its own pieces. Then they are fitted to the
spelling of the training words: ``rounds`` times, the expected use of each piece (forward and backward recursion over all
distinct training words) replaces the scores, with PSEUDO added. What the driver gets is a number per piece. Word arcs have the score (count - d) / tokens; what the discount d leaves is shared out by the pieces, so
that the probabilities of all words and the end add up to 1. d comes from the numbers of words that occur once and twice.

Words are counted once for the whole corpus, and their probability is worked out once per distinct word. Documents meet it
in two ways: the most frequent words (at most FREQUENT, chosen by a histogram of counts) go to all tasks, the others
by a join on the word's hash, which no common word can skew.

Defined results: null text is empty (the end alone); rows without an id count as held out (crc32 of the empty text);
repeated rows are counted as often as they occur; without training tokens every base is log10(0.1 / 0.1) and words and
the end share the probability evenly; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.llm.bpe import Codec, codec
from docferry.llm.common import BASE, LOWER, give_back, id_remainder, mix64, powers, range_hashes, running_hash, slices, utf8_bytes, word_bounds
from docferry.session import written

RANK = 100.0
PSEUDO = 0.1
ROUNDS = 2
FREQUENT = 1 << 18
WORD_PIECES = 1 << 16
#: Longest word, in bytes, that is a piece.
PIECE_BYTES = 32
#: Bytes of text whose words are found together, of distinct words that a task counts before it hands them on, and of
#: those whose lattices are worked on together.
COUNT_BYTES = 1 << 18
HELD_BYTES = 8 << 20
LATTICE_BYTES = 1 << 17
#: Bits of the table that finds pieces.
TABLE_BITS = 18
LN10 = math.log(10)


class Pieces:
    """The pieces of a vocabulary, found by hash at any place of a byte buffer."""

    def __init__(self, tokens: Codec, words: list[bytes] = []):  # noqa: B006
        specials = set(tokens.specials.values())
        # no piece crosses a blank: one is allowed at the start only
        own = [(p, i) for i, p in enumerate(tokens.pieces) if p and i not in specials and not any(b in p[1:] for b in b" \t\n\v\f\r")]
        known = {p for p, _ in own}
        own += [(b" " + w, tokens.size + i) for i, w in enumerate(words) if b" " + w not in known]
        self.n = tokens.size + len(words)
        self.lengths = sorted({len(p) for p, _ in own})
        data = np.frombuffer(b"".join(p for p, _ in own), np.uint8)
        ends = np.cumsum([len(p) for p, _ in own])
        starts = ends - [len(p) for p, _ in own]
        keys = self._keys(running_hash(data), starts, ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.asarray([i for _, i in own])[order]
        slots = (self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.first = np.searchsorted(slots, np.arange((1 << TABLE_BITS) + 1))
        self.probes = int(np.diff(self.first).max())
        ranks = np.arange(self.n, dtype=np.float64)
        self.usable = np.zeros(self.n, bool)
        self.usable[self.ids] = True
        #: Probability of each piece as the vocabulary's order has it.
        weights = np.where(self.usable, 1 / (RANK + ranks), 0)
        self.prior = weights / weights.sum()

    @staticmethod
    def _keys(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        # pieces are short: none reaches the lengths at which polynomials of this kind collide
        raw = (running[ends] - running[starts]) * powers(len(running), inverse=True)[starts]
        return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(BASE))

    def find(self, running: np.ndarray, inverse: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the places ``at``, those where a piece of that length stands; and the pieces."""
        keys = mix64((running[at + length] - running[at]) * inverse[at] + np.asarray([length], np.uint64) * np.uint64(BASE))
        slots = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        first, last = self.first[slots], self.first[slots + 1]
        some = np.flatnonzero(last > first)
        at, keys, first, last = at[some], keys[some], first[some], last[some]
        ids = np.full(len(at), -1)
        for probe in range(self.probes):
            place = np.minimum(first + probe, len(self.keys) - 1)
            hit = (first + probe < last) & (self.keys[place] == keys)
            ids[hit] = self.ids[place[hit]]
        found = ids >= 0
        return at[found], ids[found]


@functools.lru_cache(maxsize=2)
def pieces(path: str, words: tuple[bytes, ...] = ()) -> Pieces:
    """The pieces of a vocabulary file and of some words, built once."""
    return Pieces(codec(path), list(words))


class Lattices:
    """The lattices of many words: arcs in order of the place (within its word) where they end."""

    def __init__(self, table: Pieces, words: list[bytes]):
        flat = b"".join(b" " + w for w in words)
        data = np.frombuffer(flat, np.uint8)
        sizes = np.asarray([len(w) + 1 for w in words], np.int64)
        ends = np.cumsum(sizes)
        self.starts, self.sizes = ends - sizes, sizes
        # places are numbered so that every word has one more than bytes
        shift = np.repeat(np.arange(len(words)), sizes)
        left = np.repeat(ends, sizes) - np.arange(len(data))
        offset = np.arange(len(data)) - np.repeat(self.starts, sizes)
        running = running_hash(data)
        inverse = powers(len(running), inverse=True)
        tails, heads, ids, reach = [], [], [], []
        at = np.arange(len(data))
        for length in table.lengths:
            at = at[left[at] >= length]
            if not len(at):
                break
            found, which = table.find(running, inverse, at, length)
            tails.append(found + shift[found])
            heads.append(tails[-1] + length)
            ids.append(which)
            reach.append(offset[found] + length)
        tails, heads, ids, reach = (np.concatenate(x) for x in (tails, heads, ids, reach))
        self.first = self.starts + np.arange(len(words))
        self.last = self.first + sizes
        self.n = len(data) + len(words)
        order = np.argsort(reach * self.n + heads)
        self.tails, self.heads, self.ids, self.reach = tails[order], heads[order], ids[order], reach[order]

    def _sweep(self, at: np.ndarray, source: np.ndarray, target: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> None:
        """Log sums into ``target`` places from ``source`` places, a group of arcs after another."""
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a == b:
                continue
            values, into = at[source[a:b]] + weights[a:b], target[a:b]
            starts = np.flatnonzero(np.r_[True, into[1:] != into[:-1]])
            top = np.maximum.reduceat(values, starts)
            total = np.add.reduceat(np.exp(values - np.repeat(top, np.diff(np.append(starts, len(into))))), starts)
            at[into[starts]] = top + np.log(total)

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log probability of every place's prefix, over all segmentations."""
        alpha = np.full(self.n, -1e300)
        alpha[self.first] = 0.0
        bounds = np.searchsorted(self.reach, np.arange(1, int(self.sizes.max()) + 2))
        self._sweep(alpha, self.tails, self.heads, bounds, log_p[self.ids])
        return alpha

    def probabilities(self, log_p: np.ndarray) -> np.ndarray:
        """Log probability of each word."""
        return self.forward(log_p)[self.last]

    def expected(self, log_p: np.ndarray) -> np.ndarray:
        """Expected use of each piece in the words."""
        alpha = self.forward(log_p)
        beta = np.full(self.n, -1e300)
        beta[self.last] = 0.0
        begins = self.reach - (self.heads - self.tails)
        order = np.argsort(-begins * self.n + self.tails)
        far = int(self.sizes.max())
        bounds = np.searchsorted(-begins[order], np.arange(-far, 2))
        self._sweep(beta, self.heads[order], self.tails[order], bounds, log_p[self.ids[order]])
        word = np.searchsorted(self.first, self.tails, side="right") - 1
        use = np.exp(alpha[self.tails] + log_p[self.ids] + beta[self.heads] - alpha[self.last][word])
        return np.bincount(self.ids, weights=use, minlength=len(log_p))


# --- counts ----------------------------------------------------------------------------------


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, hash of each word, the words before each row, and start and end of each word."""
    data, rows = utf8_bytes(column)
    data = LOWER[data]
    starts, ends, words = word_bounds(data, rows)
    return data, range_hashes(data, starts, ends), words, starts, ends


def _slices_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of byte ranges."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[place].tobytes())])


def _merged(counted: list[tuple[np.ndarray, pa.Array, np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Hash, word and count of several lists as one, each word once."""
    hashes = np.concatenate([h for h, _, _ in counted])
    hashes, first, where = np.unique(hashes, return_index=True, return_inverse=True)
    c = np.zeros(len(hashes), np.int64)
    np.add.at(c, where, np.concatenate([n for _, _, n in counted]))
    return hashes, pa.concat_arrays([w for _, w, _ in counted]).take(pa.array(first)), c


def _counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, c of many slices of text; some HELD_BYTES of words are held at once."""
    held, size = [], 0

    def out():
        _, words, c = _merged(held)
        for begin in range(0, len(c), 1 << 15):
            yield pa.RecordBatch.from_arrays([words.slice(begin, 1 << 15), pa.array(c[begin : begin + (1 << 15)])], ["word", "c"])

    for batch in parts:
        data, hashes, words, starts, ends = _words(batch.column("text"))
        weights = np.repeat(batch.column("training").to_numpy(zero_copy_only=False), np.diff(words))
        own, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        c = np.bincount(where, weights=weights, minlength=len(first)).astype(np.int64)
        held.append((own, _slices_of(data, starts[first], ends[first]), c))
        size += held[-1][1].nbytes
        if size > HELD_BYTES:
            held = [_merged(held)]
            size = held[0][1].nbytes
            if size > HELD_BYTES // 2:
                yield from out()
                held, size = [], 0
    if held:
        yield from out()


def count_words(df: DataFrame, text: str, training: Column) -> DataFrame:
    """word (binary, lower-cased), c: its count in the rows for which ``training`` holds; words of all rows."""

    def count(batches):
        yield from _counted(slices(batches, "text", COUNT_BYTES))
        give_back()

    rows = df.select(F.col(text).alias("text"), training.cast("long").alias("training"))
    return rows.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def expected_use(words: DataFrame, table: Pieces, log_p: np.ndarray) -> np.ndarray:
    """Expected use of each piece in the spelling of all ``words``."""
    # tasks get the table: they would keep the whole vocabulary to build it
    shared = words.sparkSession.sparkContext.broadcast((table, log_p))

    def use(batches):
        table, log_p = shared.value
        total = np.zeros(len(log_p))
        for batch in slices(batches, "word", LATTICE_BYTES):
            total += Lattices(table, batch.column("word").to_pylist()).expected(log_p)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "used"])
        give_back()

    # a row per piece at most
    sums = words.select("word").mapInArrow(use, "piece long, used double").groupBy("piece").agg(F.sum("used").alias("used")).toArrow()
    out = np.zeros(len(log_p))
    out[sums.column("piece").to_numpy()] = sums.column("used").to_numpy()
    return out


def fit_pieces(words: DataFrame, table: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Log probability of each piece after ``rounds`` over the training words."""
    p = table.prior
    for _ in range(rounds):
        used = np.where(table.usable, expected_use(words.where("c > 0"), table, _log(p)) + PSEUDO, 0)
        p = used / used.sum()
    return _log(p)


def _log(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-300))


@dataclasses.dataclass(frozen=True)
class Mixture:
    """How probability is shared out between words seen in training, spelling and the end."""

    tokens: int
    ends: int
    types: int
    discount: float

    def word(self, c: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 probability of words from their counts and the log probability of their spelling."""
        whole = np.maximum(np.asarray(c) - self.discount, 0) / (self.tokens + PSEUDO)
        rest = (self.discount * self.types + PSEUDO / 2) / (self.tokens + PSEUDO)
        return np.logaddexp(_log(whole), math.log(rest) + spelled) / LN10

    def end(self) -> float:
        return math.log10((self.ends + PSEUDO / 2) / (self.tokens + PSEUDO))


# --- documents -------------------------------------------------------------------------------


def _word_table(words: DataFrame, table: Pieces, log_p: np.ndarray, mixture: Mixture) -> DataFrame:
    """hash, c, lattice (log10 probability) of each word."""
    shared = words.sparkSession.sparkContext.broadcast((table, log_p))

    def weigh(batches):
        table, log_p = shared.value
        for batch in slices(batches, "word", LATTICE_BYTES):
            data, rows = utf8_bytes(batch.column("word"))
            hashes = range_hashes(data, rows[:-1], rows[1:])
            spelled = Lattices(table, batch.column("word").to_pylist()).probabilities(log_p)
            values = mixture.word(batch.column("c").to_numpy(), spelled)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column("c"), pa.array(values)], ["hash", "c", "lattice"])
        give_back()

    return words.mapInArrow(weigh, "hash long, c long, lattice double")


def _frequent(table: DataFrame, most: int) -> pa.Table:
    """The most frequent words, as many as a histogram of their counts allows."""
    step = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    sizes = sorted(((r.step, r.n) for r in table.where("c > 0").groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for at, n in sizes:
        total += n
        if total > most:
            break
        least = at
    if least is None:
        return table.where("false").toArrow()
    return table.where((F.col("c") > 0) & (step >= least)).toArrow()


DOC = "row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, lattice double, rare array<struct<hash: long, n: long>>"


def _documents(rows: DataFrame, kind: str, frequent: pa.Table, base_of) -> DataFrame:
    """One row per document with the sums over frequent words, and its other words."""
    order = np.argsort(frequent.column("hash").to_numpy().view(np.uint64))
    hashes = frequent.column("hash").to_numpy().view(np.uint64)[order]
    c, lattice = frequent.column("c").to_numpy()[order], frequent.column("lattice").to_numpy()[order]
    shared = rows.sparkSession.sparkContext.broadcast((hashes, base_of(c), lattice))

    def add(batches):
        known, base, lattice = shared.value
        n = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", COUNT_BYTES):
            _, own, words, _, _ = _words(batch.column("text"))
            counts = np.diff(words)
            doc = np.repeat(np.arange(batch.num_rows), counts)
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            hit = known[at] == own if len(known) else np.zeros(len(own), bool)
            sums = [np.bincount(doc[hit], weights=w, minlength=batch.num_rows) for w in (np.ones(hit.sum()), base[at[hit]], lattice[at[hit]])] if len(known) else [np.zeros(batch.num_rows)] * 3
            # other words: each once per document, with its count
            rare, of = own[~hit], doc[~hit]
            order = np.lexsort((rare, of))
            rare, of = rare[order], of[order]
            first = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (of[1:] != of[:-1])]) if len(rare) else np.zeros(0, np.int64)
            pairs = pa.StructArray.from_arrays([pa.array(rare[first].view(np.int64)), pa.array(np.diff(np.append(first, len(rare))).astype(np.int64))], ["hash", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of[first], np.arange(batch.num_rows + 1)).astype(np.int32)), pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, n + batch.num_rows)), batch.column("doc_id"), batch.column("held_out"), pa.array(counts.astype(np.int64) + 1),
                 pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), lists],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "lattice", "rare"],
            )
            n += batch.num_rows
        give_back()

    return rows.mapInArrow(add, DOC.format(kind=kind))


def score_documents(df: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT, word_pieces: int = WORD_PIECES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; ``vocabulary`` is a byte-level BPE file."""
    held_out = id_remainder(doc_id, 10) == 0
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    ends = rows.where("NOT held_out").count()
    words, _ = written(count_words(df, text, ~held_out), "lm-words")
    once, twice = (F.count(F.when(F.col("c") == k, 1)) for k in (1, 2))
    total, distinct, n1, n2 = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), once, twice).first()
    n, v = total + ends, distinct + (ends > 0)

    def base_of(c):
        return np.log10((np.asarray(c) + 0.1) / (n + 0.1 * (v + 1)))

    mixture = Mixture(n, ends, distinct, n1 / (n1 + 2 * n2) if n1 else 0.5)
    common = _frequent(words.where(F.octet_length("word") <= PIECE_BYTES), word_pieces)
    order = np.lexsort((common.column("word").to_numpy(), -common.column("c").to_numpy()))
    known = tuple(common.column("word")[int(i)].as_py() for i in order)
    found = pieces(vocabulary, known)
    log_p = fit_pieces(words, found, rounds)
    table, _ = written(_word_table(words, found, log_p, mixture), "lm-table")
    docs, _ = written(_documents(rows, dict(rows.dtypes)["doc_id"], _frequent(table, frequent), base_of), "lm-documents")

    rare = docs.select("row", F.explode("rare").alias("w")).select("row", "w.hash", "w.n").join(table, "hash")
    base = F.log10((F.col("c") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    other = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * base).alias("more_base"), F.sum(F.col("n") * F.col("lattice")).alias("more_lattice")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return docs.drop("rare").join(other, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("more") + int(ends > 0)).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") + float(base_of(ends))).alias("base_score"), (F.col("lattice") + zero("more_lattice") + mixture.end()).alias("score"),
    )
