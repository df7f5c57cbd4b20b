"""Near duplicates by exact Jaccard similarity of word shingles, found with signature trees.

Documents with the same word sequence form a class; the class's least id stands for them from then on.

1. *Stars.* Classes that agree in MinHash values are compared with the most typical class of their bucket; true pairs (exact
   sets are compared) give the first components. This decides nothing but how much work is left.
2. *Buckets.* Two sets of similarity 0.75 or more share a shingle among the first ``n - ceil(0.75 n) + 1`` of each, in any
   order common to all documents. The order is by hash, very frequent shingles last. Buckets of such shingles that
   hold classes of more than one component are kept, no other pair can be missing.
3. *Signature trees.* Within a bucket, classes become the leaves of a tree whose nodes hold the OR of their bitmaps of
   tokens, the range of their sizes and of their components, and how many tokens share bits. A traversal of the tree against
   itself drops pairs of nodes whose largest possible overlap is too small for the smallest sizes below them, or that lie
   in one component. A pair of leaves that remains puts its two components into one group, and they count as one
   for the rest of the traversal; so a bucket gives less rows than it has members, whatever its pairs.
   The most promising pair of classes of each such two components is verified with their sets, components are joined,
   and the buckets that still hold several are traversed again, as long as a quarter of the pairs link.
   Buckets of more than PART members are dealt in parts of that size: alone at first, in the last round each part with each
   other (parts of one component that fills several do not meet).
4. *Exact comparison.* What then remains is compared in full: members of a group's components are dealt in blocks of about
   BLOCK, and each two blocks meet in a task with their exact sets (blocks of one large component do not meet each other).
   A tree with wide bitmaps finds the pairs that may link, their sets decide, and pairs within what is already joined are
   skipped: again less links than members.

No step collects documents, links or components on the driver; buckets are dealt by their shingle and read in
its order, so a task holds one bucket, or two parts of one, at a time. Frequent shingles (at least one of 1000 documents, the
most frequent FREQUENT of them) are the only broadcast besides id tables below a checked number of rows; any choice of
them gives the same links.

Hashes have 64 bits (classes 128) and mix every byte with its place: two different shingles fall together by chance alone, 2 ** -64.

Defined results: a document without words has no shingle and no link; rows that share an id are one document, with
the links of all its rows; a null id has no links and a null component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import BASE, give_back, mix64, slices, sums_of, unused, word_hashes
from docferry.session import written

WORDS = 5
#: Bytes of text whose shingles are taken together; they take some 100 times as much.
TEXT_BYTES = 1 << 18
#: Links need 4 * overlap >= 3 * union: 75 of 100.
PARTS = 3
WHOLE = 4
MINHASHES = 16
#: MinHash values that must agree for a comparison in step 1.
ALIKE = 9
#: Very frequent shingles that come last in the order.
FREQUENT = 1 << 17
#: Shingles that are counted together to find frequent ones, and documents of a thousand that make one frequent.
COUNT_ROWS = 1 << 21
PER_MILLE = 1
#: Widest bitmap, in bits.
WIDEST = 8192
#: Members of a bucket up to which it needs no tree.
SMALL = 12
#: Members of a bucket that a task holds at once; larger buckets are dealt in parts.
PART = 1 << 14
#: Another round of steps 2 and 3 follows where one of so many candidates linked.
PROGRESS = 4
#: Salts of a frequent shingle where the components of its bucket are compared.
SALTS = 64
#: Members of a block in exact comparison, and bits for each token there.
BLOCK = 256
WIDE = 8
#: Node pairs worked on at once, and 64-bit words of their bitmaps.
FRONTIER = 100_000
AT_ONCE = 1 << 20
#: Rows of an id table that goes to all tasks; larger ones are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Rows of an id table that one task writes.
ID_ROWS = 100_000

_SEEDS = mix64(np.arange(1, MINHASHES + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def needed(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of n with any set that it links to."""
    return (PARTS * n + WHOLE - 1) // WHOLE


def links(overlap, n, m):
    """Whether sets of n and m elements with this overlap link."""
    return WHOLE * overlap >= PARTS * (n + m - overlap)


# --- shingles --------------------------------------------------------------------------------


def shingles(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in text order, the row of each, and the words' hashes and first word of each row."""
    words, rows = word_hashes(column)
    counts = np.diff(rows)
    doc = np.repeat(np.arange(len(counts)), counts)
    n = max(len(words) - WORDS + 1, 0)
    hashes = mix64(words[:n] + np.uint64(WORDS))
    for k in range(1, WORDS):
        hashes = mix64(hashes * np.uint64(BASE) + words[k : n + k])
    inside = doc[:n] == doc[WORDS - 1 :] if n else np.zeros(0, bool)
    hashes, of = hashes[inside], doc[:n][inside]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        whole = counts[short].astype(np.uint64)
        for k in range(WORDS - 1):
            has = counts[short] > k
            whole[has] = mix64(whole[has] * np.uint64(BASE) + words[rows[short[has]] + k])
        hashes, of = np.concatenate([hashes, whole]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        hashes, of = hashes[order], of[order]
    return hashes, of, words, rows


def shingle_sets(column) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    hashes, of, _, rows = shingles(column)
    bounds = np.searchsorted(of, np.arange(len(rows)))
    return [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _sequence_keys(words: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each row's word sequence."""
    out = []
    for values in (words, mix64(words ^ _SECOND)):
        out.append(sums_of(values, rows[:-1], rows[1:]).view(np.int64))
    return out


def bitmap(hashes: np.ndarray, per_token: int = 1, widest: int = WIDEST) -> bytes:
    """Bits of a set: ``per_token`` to twice as many for each token, a power of two in all."""
    width = min(widest, max(64, 1 << (per_token * len(hashes) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


INFO = "doc_id long, n long, key1 long, key2 long, least array<long>, bits binary, often array<struct<hash: long, n: long>>"
_OFTEN = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))


def _describe(batches) -> Iterator[pa.RecordBatch]:
    """INFO of every row, and rows without id that tell which shingles are frequent here."""
    pending: list[np.ndarray] = []
    n_pending = 0

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(parts), return_counts=True)
        often = pa.StructArray.from_arrays([pa.array(values[n > 2].view(np.int64)), pa.array(n[n > 2])], ["hash", "n"])
        empty = [pa.array([None], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())]
        return pa.RecordBatch.from_arrays([*empty, pa.ListArray.from_arrays(pa.array([0, len(often)], pa.int32()), often)], _NAMES)

    for batch in slices(batches, "text", TEXT_BYTES):
        hashes, of, words, rows = shingles(batch.column("text"))
        key1, key2 = _sequence_keys(words, rows)
        bounds = np.searchsorted(of, np.arange(batch.num_rows + 1))
        sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        full = bounds[:-1] < bounds[1:]
        least = np.zeros((batch.num_rows, MINHASHES), np.uint64)
        if full.any():
            for r, seed in enumerate(_SEEDS):
                least[full, r] = np.minimum.reduceat(hashes * seed, bounds[:-1][full])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * MINHASHES), pa.array(least.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(key1), pa.array(key2), lists,
             pa.array([bitmap(s) for s in sets], pa.binary()), pa.nulls(batch.num_rows, _OFTEN)], _NAMES,
        )
        # prefixes lie in the lower part of the order
        pending += [s[s < np.uint64(1 << 63)] for s in sets]
        n_pending += sum(len(s) for s in sets) // 2
        if n_pending > COUNT_ROWS:
            yield counted(pending)
            pending, n_pending = [], 0
    if pending:
        yield counted(pending)
        del pending
    give_back()


_NAMES = ["doc_id", "n", "key1", "key2", "least", "bits", "often"]


# --- components ------------------------------------------------------------------------------


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has few rows, else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def id_files(df: DataFrame) -> int:
    """Files for a table of a few ids for each row of ``df``.

    Without this, each of the shuffle's tasks writes a file of some rows, and its buffers and the file system's calls add up.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ID_ROWS))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node that each node of the edges (a, b) reaches."""
    files = id_files(edges)
    both, _ = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges", files)
    labels, _ = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels", files)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("other"))
        hooked = labels.join(near, F.col("node") == F.col("at")).select("node", "label", F.least("label", "other").alias("next"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        moved, _ = written(hooked.join(jump, F.col("next") == F.col("to")).select("node", "label", F.least("next", "further").alias("next")), "labels", files)
        done = moved.where("label <> next").isEmpty()
        labels = moved.select("node", F.col("next").alias("label"))
        if done:
            return labels


def _relabel(components_: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components after more edges; the old labels count as edges."""
    if components_ is None:
        return components(edges)
    return components(edges.unionByName(components_.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))))


# --- exact comparison ------------------------------------------------------------------------


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, items: the sorted shingle hashes of the wanted documents."""

    def collect(batches):
        for batch in slices(batches, "text", TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], pa.binary())], ["id", "items"])
        give_back()

    return docs.join(small(ids.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi").mapInArrow(collect, "id long, items binary")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    ids, _ = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "pair-ids", id_files(pairs))
    sets, _ = written(_sets(docs, ids), "pair-sets")

    def compare(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                kept.append(bool(len(x) and len(y) and links(_overlap(x, y), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


# --- signature trees -------------------------------------------------------------------------


def _shared(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that the bitmaps of each pair share, AT_ONCE words of them at a time."""
    out, step = np.empty(len(a), np.int64), max(1, AT_ONCE // bits.shape[1])
    for start in range(0, len(a), step):
        x, y = a[start : start + step], b[start : start + step]
        out[start : start + step] = np.bitwise_count(bits[x] & bits[y]).sum(axis=1)
    return out


class Members:
    """Classes with sizes, components and bitmaps; bitmaps are folded to the width that two of them have in common."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, comps: np.ndarray, bits: list[bytes]):
        self.ids, self.sizes, self.comps, self.bits = ids, sizes, comps, bits
        self.widths = np.asarray([8 * len(b) for b in bits], np.int64)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of one width (zero for narrower ones), and tokens beyond one a bit."""
        if width not in self.folded:
            out = np.zeros((len(self.ids), width // 64), np.uint64)
            for own in np.unique(self.widths[self.widths >= width]):
                rows = np.flatnonzero(self.widths == own)
                whole = np.frombuffer(b"".join(self.bits[i] for i in rows), np.uint64).reshape(len(rows), own // width, width // 64)
                out[rows] = np.bitwise_or.reduce(whole, axis=1)
            self.folded[width] = out, self.sizes - np.bitwise_count(out).sum(axis=1).astype(np.int64)
        return self.folded[width]

    def candidates(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs of members, those whose largest possible overlap suffices; and that overlap."""
        low, high = np.minimum(self.sizes[a], self.sizes[b]), np.maximum(self.sizes[a], self.sizes[b])
        keep = (self.comps[a] != self.comps[b]) & (low >= needed(high))
        a, b = a[keep], b[keep]
        most = np.zeros(len(a), np.int64)
        width = np.minimum(self.widths[a], self.widths[b])
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            bits, beyond = self.at(int(w))
            most[rows] = _shared(bits, a[rows], b[rows]) + np.minimum(beyond[a[rows]], beyond[b[rows]])
        most = np.minimum(most, np.minimum(self.sizes[a], self.sizes[b]))
        keep = links(most, self.sizes[a], self.sizes[b])
        return a[keep], b[keep], most[keep]


class Unions:
    """Which components are one by now."""

    def __init__(self, comps: np.ndarray):
        self.names, self.number = np.unique(comps, return_inverse=True)
        self.parent = list(range(len(self.names)))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join_numbers(self, x: int, y: int) -> bool:
        """Whether these two components were two until now."""
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y

    def join(self, a: int, b: int) -> bool:
        """The same for the components of members a and b."""
        return self.join_numbers(self.number[a], self.number[b])

    def labels(self) -> np.ndarray:
        """The present component of every member."""
        return np.asarray([self.find(x) for x in range(len(self.parent))])[self.number]


class SignatureTree:
    """A binary tree over the members ``order``: OR of bitmaps, ranges of sizes and components per node."""

    def __init__(self, members: Members, order: np.ndarray):
        self.members, self.order = members, order
        bits, beyond = members.at(int(members.widths[order].min()))
        self.levels = [(bits[order], beyond[order], members.sizes[order], members.sizes[order])]
        while len(self.levels[-1][0]) > 1:
            joins = (np.bitwise_or, np.maximum, np.minimum, np.maximum)
            self.levels.append(self._above(self.levels[-1], joins))
        self.relabel(members.comps)

    @staticmethod
    def _above(level: tuple, joins: tuple) -> tuple:
        starts = np.arange(0, len(level[0]), 2)
        return tuple(f.reduceat(values, starts, axis=0) for f, values in zip(joins, level, strict=True))

    def relabel(self, comps: np.ndarray) -> None:
        """Use these components from now on."""
        self.comps = [(comps[self.order], comps[self.order])]
        while len(self.comps) < len(self.levels):
            self.comps.append(self._above(self.comps[-1], (np.minimum, np.maximum)))

    def _open(self, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Node pairs below which two members of different components may overlap enough."""
        (bits, beyond, low, high), (first, last) = self.levels[depth], self.comps[depth]
        one = (first[a] == last[a]) & (first[b] == last[b]) & (first[a] == first[b])
        sizes = (high[a] >= needed(low[b])) & (high[b] >= needed(low[a])) & ~one
        a, b = a[sizes], b[sizes]
        most = np.minimum(_shared(bits, a, b) + np.minimum(beyond[a], beyond[b]), np.minimum(high[a], high[b]))
        sizes[sizes] = links(most, low[a], low[b])
        return sizes

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members that the traversal could not rule out."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            depth, a, b = stack.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                stack += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
                continue
            keep = self._open(depth, a, b)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if depth == 0:
                apart = a != b
                yield self.order[a[apart]], self.order[b[apart]]
                continue
            n = len(self.levels[depth - 1][0])
            left = np.concatenate([2 * a, 2 * a, 2 * a + 1, (2 * a + 1)[a != b]])
            right = np.concatenate([2 * b, 2 * b + 1, 2 * b + 1, (2 * b)[a != b]])
            inside = (left < n) & (right < n)
            stack.append((depth - 1, left[inside], right[inside]))


def _in_order(members: Members, rows: np.ndarray) -> np.ndarray:
    """Members by size, those of components with several members first and together."""
    _, where, n = np.unique(members.comps[rows], return_inverse=True, return_counts=True)
    several = n[where] > 1
    return rows[np.lexsort((members.sizes[rows], np.where(several, members.comps[rows], 0), ~several))]


def _likeness(members: Members, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The largest similarity that pairs of members may have."""
    return most / np.maximum(members.sizes[a] + members.sizes[b] - most, 1)


def bucket_candidates(members: Members, buckets: np.ndarray, own: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    """Pairs of components that may link in some bucket, as many as join all that may, each with its most promising pair
    of members. ``buckets`` is sorted; members of one side (``own``) of a bucket that is not ``whole`` do not meet."""
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.append(starts, len(buckets)))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

    def met(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        across = whole[a] | (own[a] != own[b])
        a, b, most = members.candidates(a[across], b[across])
        return a, b, _likeness(members, a, b, most)

    for n in np.unique(sizes[sizes <= SMALL]):
        i, j = np.triu_indices(n, 1)
        mine = starts[sizes == n]
        for part in np.array_split(mine, max(1, -(-len(mine) * len(i) // FRONTIER))):
            found.append(met((part[:, None] + i).reshape(-1), (part[:, None] + j).reshape(-1)))
    for start, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        rows = np.arange(start, start + n)
        tree, unions = SignatureTree(members, _in_order(members, rows)), Unions(members.comps[rows])
        for a, b in tree.pairs():
            a, b, like = met(a, b)
            order = np.argsort(-like, kind="stable")
            x, y = unions.number[a - start][order], unions.number[b - start][order]
            _, first = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0, return_index=True)
            joined = [k for k in np.sort(first).tolist() if unions.join_numbers(x[k], y[k])]
            if joined:
                found.append(tuple(v[order[joined]] for v in (a, b, like)))
                labels = np.empty(len(members.ids), np.int64)
                labels[rows] = unions.labels()
                tree.relabel(labels)
    a, b, like = (np.concatenate(v) for v in zip(*found, strict=True))
    turned = members.comps[a] > members.comps[b]
    a, b = np.where(turned, b, a), np.where(turned, a, b)
    order = np.lexsort((-like, members.comps[b], members.comps[a]))
    a, b, like = a[order], b[order], like[order]
    low, high = members.comps[a], members.comps[b]
    best = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])][: len(a)]
    columns = (low, high, members.ids[a], members.ids[b], like)
    return pa.RecordBatch.from_arrays([pa.array(c[best]) for c in columns], ["low", "high", "a", "b", "like"])


def _groups_of(batches, *key: str) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut only where the key changes."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for k, values in zip(key, columns, strict=True):
            change[1:] |= values[1:] != values[:-1]
            change[0] |= bool(kept) and kept[-1].column(k)[-1].as_py() != values[0]
        cuts = np.flatnonzero(change)
        if kept and not len(cuts):
            kept.append(batch)
            continue
        last = int(cuts[-1]) if len(cuts) else 0
        if kept or last:
            yield pa.Table.from_batches([*kept, batch.slice(0, last)])
        kept = [batch.slice(last)]
    if kept:
        yield pa.Table.from_batches(kept)


def _traverse(batches) -> Iterator[pa.RecordBatch]:
    """Pairs of components from meetings in buckets (meeting, own, whole, id, comp, n, bits), which come in order."""
    for table in _groups_of(batches, "meeting"):
        members = Members(*(table.column(c).to_numpy() for c in ("id", "n", "comp")), table.column("bits").to_pylist())
        yield bucket_candidates(members, *(table.column(c).to_numpy() for c in ("meeting", "own", "whole")))


def _compare(batches) -> Iterator[pa.RecordBatch]:
    """Links from meetings of blocks (meeting, own: in the first block, whole: the blocks are one, id, comp, items), in order."""
    for table in _groups_of(batches, "meeting"):
        meetings = table.column("meeting").to_numpy()
        starts = np.flatnonzero(np.r_[True, meetings[1:] != meetings[:-1]])
        found = []
        for start, stop in zip(starts, np.append(starts[1:], len(meetings)), strict=True):
            found += _exact(table.slice(start, stop - start))
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def _exact(table: pa.Table) -> list[tuple[int, int]]:
    """As many links as join all of a meeting that link."""
    sets = [np.frombuffer(i, np.uint64) for i in table.column("items").to_pylist()]
    ids, comps, own = (table.column(c).to_numpy() for c in ("id", "comp", "own"))
    sizes = np.asarray([len(x) for x in sets], np.int64)
    members = Members(ids, sizes, comps, [bitmap(x, WIDE, WIDE * WIDEST) for x in sets])
    whole, unions, out = table.column("whole")[0].as_py(), Unions(comps), []
    rows = np.flatnonzero(sizes > 0)
    if len(rows) < 2:
        return out
    tree = None if len(rows) <= SMALL else SignatureTree(members, _in_order(members, rows))
    i, j = np.triu_indices(len(rows), 1) if tree is None else (None, None)
    for a, b in [(rows[i], rows[j])] if tree is None else tree.pairs():
        if not whole:
            across = own[a] != own[b]
            a, b = a[across], b[across]
        a, b, most = members.candidates(a, b)
        joined = False
        for k in np.argsort(-most / np.maximum(sizes[a] + sizes[b], 1), kind="stable").tolist():
            x, y = int(a[k]), int(b[k])
            if unions.find(unions.number[x]) != unions.find(unions.number[y]) and links(_overlap(sets[x], sets[y]), len(sets[x]), len(sets[y])):
                joined = unions.join(x, y)
                out.append((int(ids[x]), int(ids[y])))
        if joined and tree is not None:
            tree.relabel(unions.labels())
    return out


# --- the join --------------------------------------------------------------------------------


def _stars(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of classes with the most typical classes of their MinHash buckets (step 1)."""
    bands = classes.select("id", F.posexplode("least").alias("band", "value"))
    counts = bands.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared, _ = written(bands.join(counts, ["band", "value"]), "star-bands")
    # a class whose values are those of many is near the middle of its group
    typical = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    ranked = shared.drop("n").join(typical, "id")
    centers = ranked.groupBy("band", "value").agg(F.max(F.struct("weight", (-F.col("id")).alias("other"))).alias("top"))
    centers = centers.select("band", "value", (-F.col("top.other")).alias("center"), F.col("top.weight").alias("weight"))
    met = shared.drop("n").join(centers, ["band", "value"]).where("id <> center").groupBy("id", "center").agg(F.max("weight").alias("weight"))
    mine, theirs = classes.select("id", "least", "n"), classes.select(F.col("id").alias("center"), F.col("least").alias("other"), F.col("n").alias("m"))
    agree = F.aggregate(F.zip_with("least", "other", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    sized = F.least("n", "m") * WHOLE >= F.greatest("n", "m") * PARTS
    alike = met.join(mine, "id").join(theirs, "center").where(sized).select("id", "center", "weight", agree.alias("agree")).where(F.col("agree") >= ALIKE)
    best = alike.groupBy("id").agg(F.max(F.struct("weight", "center"))["center"].alias("first"), F.max(F.struct("agree", "center"))["center"].alias("best"))
    pairs = best.select(F.explode(F.array_distinct(F.array("first", "best"))).alias("a"), F.col("id").alias("b"))
    pairs, _ = written(pairs, "star-pairs", id_files(classes))
    return _verified(docs, pairs)


def _frequent(info: DataFrame) -> np.ndarray:
    """The most frequent shingles, by counts that each task made of its own rows."""
    n_docs = info.where("often IS NULL").count()
    counts = info.where("often IS NOT NULL").select(F.explode("often").alias("o")).groupBy("o.hash").agg(F.sum("o.n").alias("n"))
    least = max(20, n_docs * PER_MILLE // 1000)
    rows = counts.where(F.col("n") >= least).orderBy(F.col("n").desc(), "hash").limit(FREQUENT).select("hash").toArrow()
    return np.sort(rows.column("hash").to_numpy().view(np.uint64))


def _entries(docs: DataFrame, classes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """bucket, often, id, comp: the shingles of each class that a partner must share one of; and which are frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def first(batches):
        for batch in slices(batches, "text", TEXT_BYTES):
            buckets, marks, often = [], [np.zeros(0, bool)], shared.value
            for items in shingle_sets(batch.column("text")):
                n = len(items) - int(needed(len(items))) + 1 if len(items) else 0
                mark = np.zeros(n, bool)
                if len(often) and n:
                    at = np.searchsorted(often, items)
                    at[at == len(often)] = 0
                    last = often[at] == items
                    if last[:n].any():
                        items = np.concatenate([items[~last], items[last]])
                        mark[(~last).sum() :] = True
                buckets.append(items[:n])
                marks.append(mark)
            sizes = [len(b) for b in buckets]
            ids, comps = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("doc_id", "comp"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(buckets).view(np.int64)), pa.array(np.concatenate(marks)), pa.array(ids), pa.array(comps)], ["bucket", "often", "id", "comp"])
        give_back()

    mine = docs.join(small(classes.select(F.col("id").alias("doc_id"), "comp")), "doc_id")
    return mine.select("doc_id", "text", "comp").mapInArrow(first, "bucket long, often boolean, id long, comp long")


def _mixed(docs: DataFrame, classes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """grp, id, comp: buckets that hold classes of several components (step 2).

    The bucket of a frequent shingle is dealt by a salt; what its salts hold is put together by a table of those shingles.
    """
    salt = F.when(F.col("often"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0))
    bucket = Window.partitionBy("bucket", "salt")
    entries = _entries(docs, classes, frequent).withColumn("salt", salt)
    ranged = entries.withColumn("low", F.min("comp").over(bucket)).withColumn("high", F.max("comp").over(bucket))
    kept, _ = written(ranged.where("often OR low <> high").select(F.col("bucket").alias("grp"), "often", "id", "comp", "low", "high"), "bucket-entries")
    often = kept.where("often").groupBy("grp").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most").select("grp")
    # at most FREQUENT rows
    return kept.where("NOT often").select("grp", "id", "comp").unionByName(kept.where("often").join(F.broadcast(often), "grp", "left_semi").select("grp", "id", "comp"))


def _still_mixed(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """The buckets that hold several components by now."""
    labelled, _ = written(mixed.select("grp", "id").join(classes.select("id", "comp"), "id").select("grp", "id", "comp"), "bucket-components")
    several = labelled.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("grp")
    return written(labelled.join(several, "grp", "left_semi"), "buckets")[0]


def _meetings(rows: DataFrame, limit: int, deep: bool = True) -> DataFrame:
    """meeting, own, whole, id of rows (grp, id, comp): groups of more than ``limit`` members are dealt in blocks of about as many.

    Each two blocks meet (own: in the first one; whole: the two are one), but for two of one component that fills several.
    Unless ``deep``, blocks stay alone.
    """
    together = (F.lit(True).alias("own"), F.lit(True).alias("whole"), "id")
    totals, _ = written(rows.groupBy("grp").agg(F.count("*").alias("total")).where(F.col("total") > limit), "meeting-totals")
    if totals.isEmpty():
        return rows.select(F.xxhash64("grp").alias("meeting"), *together)
    if not deep:
        salt = F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("total", F.lit(1)) / limit))
        return rows.join(small(totals), "grp", "left").select(F.xxhash64("grp", salt).alias("meeting"), *together)
    alone = rows.join(small(totals), "grp", "left_anti").select(F.xxhash64("grp").alias("meeting"), *together)
    split = rows.join(small(totals), "grp")
    large, _ = written(split.groupBy("grp", "comp").agg(F.count("*").alias("n")).where(F.col("n") > limit), "meeting-large")
    filled = totals.join(large.groupBy("grp").agg(F.sum("n").alias("filled")), "grp", "left")
    rests, _ = written(filled.select("grp", (F.col("total") - F.coalesce("filled", F.lit(0))).alias("rest")), "meeting-rests")
    # tables of groups and components that fill a block: rows / limit at most, so no join moves a group to one task
    sized = split.drop("total").join(small(rests), "grp").join(small(large), ["grp", "comp"], "left")
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("n", "rest") / limit))
    of = F.when(F.col("n").isNotNull(), F.col("comp"))
    dealt, _ = written(sized.select("grp", "id", of.alias("of"), F.xxhash64("grp", F.coalesce(of, F.lit(-1)), salt).alias("block")), "meeting-blocks")
    blocks = dealt.select("grp", "block", "of").distinct()
    one, two = blocks.select("grp", F.col("block").alias("p"), F.col("of").alias("of_p")), blocks.select("grp", F.col("block").alias("q"), F.col("of").alias("of_q"))
    meet = one.join(two, "grp").where("p <= q AND NOT coalesce(of_p = of_q, false)").select("p", "q", F.xxhash64("grp", "p", "q").alias("meeting"))
    sides = meet.select(F.col("p").alias("block"), "meeting", F.lit(True).alias("own"), (F.col("p") == F.col("q")).alias("whole")).unionByName(
        meet.where("p <> q").select(F.col("q").alias("block"), "meeting", F.lit(False).alias("own"), F.lit(False).alias("whole"))
    )
    return alone.unionByName(dealt.select("block", "id").join(sides, "block").select("meeting", "own", "whole", "id"))


def _candidates(mixed: DataFrame, classes: DataFrame, deep: bool) -> DataFrame:
    """Pairs of components that may link, as many as join all that may, and of each the most promising pair of classes
    (step 3): low, high, a, b."""
    # bitmaps are too wide for a table that goes to all tasks
    full = _meetings(mixed, PART, deep).join(classes.select("id", "comp", "n", "bits").hint("merge"), "id").select("meeting", "own", "whole", "id", "comp", "n", "bits")
    pairs = full.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(_traverse, "low long, high long, a long, b long, like double")
    best = pairs.groupBy("low", "high").agg(F.max(F.struct("like", "a", "b")).alias("best"))
    return best.select("low", "high", "best.a", "best.b")


def _group_links(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) within groups (id, grp) of classes, as many as join all that link (step 4)."""
    labelled = classes.select("id", "comp").join(small(groups), "id").select("grp", "id", "comp")
    several = labelled.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("grp")
    members, _ = written(labelled.join(several, "grp", "left_semi"), "group-members")
    met = _meetings(members, BLOCK).join(members.select("id", "comp"), "id")
    rows = met.join(_sets(docs, members.select("id").distinct()), "id").select("meeting", "own", "whole", "id", "comp", "items")
    return rows.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(_compare, "a long, b long")


def _bucket_links(docs: DataFrame, classes: DataFrame, labels: DataFrame | None, frequent: np.ndarray) -> DataFrame:
    """The classes with their last component, once no two components hold classes that link (steps 2 to 4)."""
    named, _ = written(_with_component(classes, labels), "shingle-classes")
    mixed, deep, files = _mixed(docs, named, frequent), False, id_files(named)
    while True:
        pairs, _ = written(_candidates(mixed, named, deep), "candidates", files)
        n_pairs, n_new, before = pairs.count(), 0, named
        if n_pairs:
            new, _ = written(_verified(docs, pairs.select("a", "b")), "links")
            n_new = new.count()
        if n_new:
            labels = _relabel(labels, new)
            named = _with_component(classes, labels)
        if n_new * PROGRESS >= n_pairs > 0:
            mixed = _still_mixed(mixed, named)
            continue
        if not deep and not mixed.groupBy("grp").count().where(F.col("count") > PART).isEmpty():
            mixed, deep = _still_mixed(mixed, named), True
            continue
        if not n_pairs:
            return named
        tied = components(pairs.select(F.col("low").alias("a"), F.col("high").alias("b"))).select(F.col("node").alias("comp"), F.col("label").alias("grp"))
        groups, _ = written(before.select("id", "comp").join(small(tied), "comp").select("id", "grp"), "groups")
        new, _ = written(_group_links(docs, named, groups), "links")
        return named if new.isEmpty() else _with_component(classes, _relabel(labels, new))


def _with_component(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return classes.withColumn("comp", F.col("id"))
    named = labels.select(F.col("node").alias("id"), "label")
    return classes.join(named, "id", "left").withColumn("comp", F.coalesce("label", "id")).drop("label")


def near_duplicates(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    info, _ = written(docs.mapInArrow(_describe, INFO), "shingle-info")
    rows = info.where("often IS NULL").drop("often")
    full = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes, _ = written(full.groupBy("key1", "key2").agg(F.min("doc_id").alias("id"), F.min("n").alias("n"), F.first("least").alias("least"), F.first("bits").alias("bits")), "shingle-classes")
    # an id with several texts is one document
    joined = full.select("key1", "key2", "doc_id").join(classes.select("key1", "key2", "id"), ["key1", "key2"])
    torn = full.groupBy("doc_id").agg(F.min("key1").alias("low"), F.max("key1").alias("high")).where("low <> high").select("doc_id")
    same = joined.join(torn, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b")

    edges, _ = written(_stars(docs, classes).unionByName(same), "star-links")
    labels = None if edges.isEmpty() else components(edges)

    found = _bucket_links(docs, classes, labels, _frequent(info)).select("key1", "key2", F.col("comp").alias("found"))
    return rows.join(found, ["key1", "key2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("found"))).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with the least id of each group of near duplicates, with their own columns; rows without an id stay."""
    name = unused(df, "_dropped")
    dropped = near_duplicates(df, doc_id=doc_id, text=text).where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    return df.join(dropped, F.col(doc_id).cast("long") == F.col(name), "left_anti")
