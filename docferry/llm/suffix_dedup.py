"""Repeated byte strings, found by suffix arrays and longest-previous-factor arrays.

A place of a text is repeated if the LENGTH bytes from it also start elsewhere, in another text or the same one; what
such strings cover is removed, either all of it or all but the first copy.

1. **Anchors.** Of the hashes of all strings of LENGTH / 4 bytes, the least within each string of LENGTH bytes is its anchor, so
   that equal strings have equal anchors at the same place. Neighbouring starts share an anchor; their bytes together are
   a context, known by its MD5. Anchors thus deal the starts of all suffixes into buckets, and no text leaves its task.
2. **Contexts** are counted (partial sums first). A bucket with one context is settled by its count: from two on, all its
   starts are repeated, otherwise none is.
3. **Suffix arrays.** Buckets with several contexts get the bytes of one occurrence of each. A task sorts the suffixes of
   many buckets, cut at LENGTH bytes, in text order of their contexts; the previous and next smaller positions in suffix
   order, with the least common prefix on the way, give the longest previous factor of each start; with positions
   mirrored, the longest next one. From LENGTH on there is an earlier (later) copy.
4. A bucket of more than MOST contexts splits on more of the bytes around its anchor, again and again where it must: its
   contexts, not their occurrences, become smaller ones, every start stays in exactly one bucket, and at LENGTH bytes
   all contexts of a bucket are equal and one. What is found for the parts is put together again.
5. **Back to texts.** Occurrences meet what was found for their context. Contexts with over one in HEAVY of all
   occurrences, at most HEAVY by that, are broadcast; the rest is a shuffled join without a large key.

Texts are written once, without a shuffle, and known by (part, row) of that table; tasks read the parts again for
the bytes of contexts and for the result.

Defined results: null text is empty; texts shorter than the length repeat nothing; repeated rows are copies of each other.
"First" is by id (null first), then by place in the table. Very long texts are worked on in pieces of PIECE places.
Empty tables give no rows; other columns of the input do not matter, whatever their names.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import file_system, mix64, powers, running_hash, shuffle_partitions, slices, utf8_bytes
from docferry.session import scratch_dir, written

LENGTH = 400
#: Places of a text that are worked on at once; below 2 ** 24, as places share 64 bits with a hash.
PIECE = 1 << 22
#: Bytes of text whose anchors are found together.
ANCHOR_BYTES = 1 << 18
#: Contexts of a bucket that one suffix array takes.
MOST = 512
#: Bytes of contexts in one suffix array, or one bucket.
BLOCK = 1 << 19
#: Suffixes that are laid side by side to be compared.
LCP_ROWS = 1 << 11
HEAVY = 2000

_PLACE = np.uint64((1 << 24) - 1)


def anchor_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes the place of its anchor; and the hash of every place."""
    k = max(1, length // 4)
    width = length - k + 1
    running = running_hash(data)
    hashes = mix64((running[k:] - running[:-k]) * powers(len(running), inverse=True)[: len(running) - k])
    n = len(hashes)
    keys = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    keys[:n] = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    # the least of every window: the end of one block of keys and the beginning of the next
    blocks = keys.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[width - 1 : n]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[: n - width + 1]
    return (np.minimum(ahead, behind) & _PLACE).astype(np.int64), hashes


def _occurrences(batch: pa.RecordBatch, length: int) -> dict:
    """Runs of starts with one anchor in every text of a batch."""
    data, rows = utf8_bytes(batch.column("text"))
    # starts whose string ends in their own text
    edge = np.zeros(len(data) + 1, np.int8)
    long = np.diff(rows) >= length
    edge[rows[:-1][long]] += 1
    edge[rows[1:][long] - length + 1] -= 1
    within = np.cumsum(edge, dtype=np.int8).view(bool)
    found = []
    for begin in range(0, max(1, len(data) - length + 1), PIECE):
        piece = data[begin : begin + PIECE + length - 1]
        if len(piece) < length:
            break
        place, hashes = anchor_runs(piece, length)
        inside = within[begin : begin + len(place)]
        # a run goes on where the next start is inside too and has its anchor at the same place
        on = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
        at = np.flatnonzero(inside & np.r_[True, ~on])
        last = np.flatnonzero(inside & np.r_[~on, True])
        found.append((at + begin, last - at + 1, place[at] - at, hashes[place[at]].view(np.int64)))
    first, starts, lo, bucket = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    text = np.searchsorted(rows, first, side="right") - 1
    whole = data.tobytes()
    digests = [hashlib.md5(whole[i:j]).digest() for i, j in zip(first.tolist(), (first + starts + length - 1).tolist(), strict=True)]
    return {"text": text, "first": first - rows[text], "starts": starts, "lo": lo, "bucket": bucket, "ctx": digests}


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """All occurrences: bytes [first, first + starts + length - 1) of a text, with the anchor ``lo`` bytes after the first."""
    kind = dict(texts.dtypes)["id"]

    def run(batches):
        for batch in slices(batches, "text", ANCHOR_BYTES):
            o = _occurrences(batch, length)
            pick = pa.array(o["text"])
            columns = [batch.column(c).take(pick) for c in ("id", "part", "row")]
            columns += [pa.array(o["first"]), pa.array(o["starts"].astype(np.int32)), pa.array(o["lo"].astype(np.int32)), pa.array([b.to_bytes(8, "big", signed=True) for b in o["bucket"].tolist()], pa.binary()), pa.array(o["ctx"], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "part", "row", "first", "starts", "lo", "bucket", "ctx"])

    return texts.mapInArrow(run, f"id {kind}, part int, row long, first long, starts int, lo int, bucket binary, ctx binary")


def counted_join(left: DataFrame, right: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join with a side of different keys that says how many rows of the other side each has (``n``).

    Keys with more than one in HEAVY of those rows, fewer than HEAVY, are broadcast.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    is_heavy = F.col(n) * HEAVY > F.lit(total)
    heavy = F.broadcast(right.where(is_heavy))
    rest = left.join(heavy.select(*keys), keys, "left_anti").join(right.where(~is_heavy), keys)
    return left.join(heavy, keys).unionByName(rest)


def _parts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by part, one table per part."""
    held: list[pa.RecordBatch] = []
    for batch in rows:
        if not batch.num_rows:
            continue
        part = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and held[0].column("part")[0].as_py() != int(part[i]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _texts_of(path: str, columns: list[str]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of a part's rows, each with the number of its first row."""
    fs, at = file_system(path)
    with fs.open_input_file(at) as f:
        row = 0
        for batch in slices(pq.ParquetFile(f).iter_batches(batch_size=256, columns=columns), "text"):
            yield row, batch
            row += batch.num_rows


class Texts:
    """The texts, written once; ``rows`` has id, text, part and row, ``files`` a row per part."""

    def __init__(self, df: DataFrame, doc_id: str, text: str):
        spark = df.sparkSession
        self.path = scratch_dir(spark, "repeats-texts")
        base = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
        base.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(self.path)
        part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("part")
        read = spark.read.schema(base.schema).parquet(self.path)
        self.rows = read.select("id", "text", part, F.col("_metadata.row_index").alias("row"))
        self.files = read.select(part, F.col("_metadata.file_path").alias("path")).distinct()
        self.kind = dict(base.dtypes)["id"]

    def visit(self, asked: DataFrame, run, schema: str, every: bool = False) -> DataFrame:
        """Call ``run(path, rows)`` in a task for every part that is asked for (or every part), rows sorted by row and first."""
        # each part's first row brings its path
        paths = self.files.select("part", F.lit(-1).cast("long").alias("row"), "path")
        rows = asked.withColumn("path", F.lit(None).cast("string")).unionByName(paths, allowMissingColumns=True)
        dealt = rows.repartition(shuffle_partitions(asked.sparkSession), "part").sortWithinPartitions("part", "row", "first")

        def each(batches):
            for part in _parts(batches):
                if every or part.num_rows > 1:
                    yield from run(part.column("path")[0].as_py(), part.slice(1))

        return dealt.mapInArrow(each, schema)


def _with_bytes(path: str, part: pa.Table, length: int) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Rows of a part with the bytes of their contexts."""
    row, first, starts = (part.column(c).to_numpy() for c in ("row", "first", "starts"))
    for begin, batch in _texts_of(path, ["text"]):
        i, j = np.searchsorted(row, [begin, begin + batch.num_rows])
        if i == j:
            continue
        data, at = utf8_bytes(batch.column("text"))
        whole = data.tobytes()
        places = (at[row[i:j] - begin] + first[i:j]).tolist()
        yield part.slice(i, j - i), [whole[p : p + n + length - 1] for p, n in zip(places, starts[i:j].tolist(), strict=True)]


def _split(texts: Texts, contexts: DataFrame, length: int) -> DataFrame:
    """Contexts of buckets that are too large, each as one or two of other buckets, by more of the bytes around the anchor.

    ``known`` bytes from ``lo`` on are the same in the whole bucket. Starts at least ``back`` bytes before it go by
    those bytes and the known ones, the others by the known ones and those that the latest of them still covers.
    """

    def run(path, part):
        for rows, data_of in _with_bytes(path, part, length):
            out = {c: [] for c in ("pick", "offset", "first", "starts", "lo", "known", "bucket", "ctx")}
            columns = [rows.column(c).to_pylist() for c in ("first", "starts", "lo", "known", "bucket")]
            for i, (data, first, starts, lo, known, bucket) in enumerate(zip(data_of, *columns, strict=True)):
                back = (length - known + 1) // 2
                far = min(starts, max(0, lo - back + 1))  # starts 0 .. lo - back reach back far enough
                for side, begin, n, common in ((b"<", 0, far, (lo - back, lo + known)), (b">", far, starts - far, (lo, lo - back + 1 + length))):
                    if n <= 0:
                        continue
                    own = data[begin : begin + n + length - 1]
                    for k, v in zip(out, (i, begin, first + begin, n, common[0] - begin, common[1] - common[0], hashlib.md5(bucket + side + data[common[0] : common[1]]).digest(), hashlib.md5(own).digest()), strict=True):
                        out[k].append(v)
            pick = pa.array(out["pick"], pa.int64())
            columns = [rows.column(c).combine_chunks().take(pick) for c in ("bucket", "ctx", "n", "id", "part", "row")]
            columns += [pa.array(out[c], t) for c, t in (("offset", pa.int32()), ("first", pa.int64()), ("starts", pa.int32()), ("lo", pa.int32()), ("known", pa.int32()), ("bucket", pa.binary()), ("ctx", pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["of_bucket", "of_ctx", "n", "id", "part", "row", "offset", "first", "starts", "lo", "known", "bucket", "ctx"])

    asked = contexts.select("bucket", "ctx", "n", "since.*", "starts", "lo", "known")
    made = texts.visit(asked, run, f"of_bucket binary, of_ctx binary, n long, id {texts.kind}, part int, row long, offset int, first long, starts int, lo int, known int, bucket binary, ctx binary")
    return made.select("of_bucket", "of_ctx", "n", F.struct("id", "part", "row", "first").alias("since"), "offset", "starts", "lo", "known", "bucket", "ctx")


def longest_previous(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For every position the longest prefix that an earlier position begins with too.

    ``order`` has the positions in suffix order, ``lcp[r]`` what ranks r - 1 and r have in common. The previous smaller
    position of each rank is found by pointers that jump over larger ones, keeping the least ``lcp`` passed; the next
    smaller one likewise from the other end.
    """
    n = len(order)
    best = np.zeros(n, np.int64)
    for positions, common in ((order, lcp), (order[::-1], np.concatenate([[0], lcp[:0:-1]]) if n else lcp)):
        before, least = np.arange(n) - 1, common.astype(np.int64)
        open_ = np.flatnonzero(before >= 0)
        while len(open_):
            open_ = open_[(before[open_] >= 0) & (least[open_] > 0)]
            open_ = open_[positions[before[open_]] > positions[open_]]
            to = before[open_]
            least[open_] = np.minimum(least[open_], least[to])
            before[open_] = before[to]
        smaller = (before >= 0) & (least > 0)
        np.maximum.at(best, positions[smaller], least[smaller])
    return best


def _in_common(data: bytes, length: int) -> np.ndarray:
    """How many bytes each row of ``length`` bytes has in common with the row before it."""
    wide = 8 if length % 8 == 0 else 1
    words = np.frombuffer(data, f"<u{wide}").reshape(-1, length // wide)
    differ = words[1:] != words[:-1]
    at = differ.argmax(axis=1)
    rows = np.arange(len(at))
    # the first byte of the first word that differs
    odd = (words[1:][rows, at] ^ words[:-1][rows, at]).view(np.uint8).reshape(-1, wide)
    return np.where(differ[rows, at], at * wide + (odd != 0).argmax(axis=1), length)


def suffix_factors(contexts: list[bytes], starts: list[int], length: int, buckets: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor, cut at ``length``, of every start of the contexts, in their order.

    ``buckets``: how many contexts in a row have a suffix array of their own; else all share one.
    """
    suffixes = [c[i : i + length] for c, n in zip(contexts, starts, strict=True) for i in range(n)]
    last = np.cumsum([0, *starts])[np.cumsum(buckets if buckets is not None else [len(contexts)])].tolist()
    sorted_ = [sorted(range(i, j), key=suffixes.__getitem__) for i, j in zip([0, *last], last, strict=False)]
    order = np.fromiter(itertools.chain.from_iterable(sorted_), np.int64, len(suffixes))
    lcp = np.zeros(len(order), np.int64)
    for begin in range(1, len(order), LCP_ROWS):
        ranks = order[begin - 1 : begin + LCP_ROWS].tolist()
        lcp[begin : begin + len(ranks) - 1] = _in_common(b"".join(map(suffixes.__getitem__, ranks)), length)
    lcp[last[:-1]] = 0
    last = len(order) - 1
    return longest_previous(order, lcp), longest_previous(last - order, lcp)[::-1]


FOUND = "bucket binary, ctx binary, n long, since struct<id:{kind},part:int,row:long,first:long>, earlier string, any string"


def _text(flags: np.ndarray) -> str:
    return (flags + np.uint8(48)).tobytes().decode()


def _factors(texts: Texts, contexts: DataFrame, length: int) -> DataFrame:
    """Which starts of every context have an earlier copy, and which any other, as texts of 0 and 1."""

    def run(path, part):
        for rows, data in _with_bytes(path, part, length):
            yield from rows.drop_columns(["path"]).append_column("data", pa.array(data, pa.binary())).combine_chunks().to_batches()

    held = texts.visit(contexts.select("bucket", "ctx", "n", "since.*", "starts"), run, f"bucket binary, ctx binary, n long, id {texts.kind}, part int, row long, first long, starts int, data binary")

    def settle(rows: list[dict]) -> list[dict]:
        rows.sort(key=lambda r: (r["bucket"], r["id"] is not None, r["id"] if r["id"] is not None else 0, r["part"], r["row"], r["first"]))
        starts = [r["starts"] for r in rows]
        buckets = list(collections.Counter(r["bucket"] for r in rows).values())
        previous, following = suffix_factors([r["data"] for r in rows], starts, length, buckets)
        at = np.cumsum(starts)[:-1]
        out = []
        for r, before, after in zip(rows, np.split(previous >= length, at), np.split(following >= length, at), strict=True):
            anywhere = np.ones(r["starts"], bool) if r["n"] > 1 else before | after
            since = {k: r[k] for k in ("id", "part", "row", "first")}
            out.append({"bucket": r["bucket"], "ctx": r["ctx"], "n": r["n"], "since": since, "earlier": _text(before), "any": _text(anywhere)})
        return out

    def arrays(batches):
        rows, size, arrow = [], 0, None
        for batch in batches:
            if arrow is None:
                since = pa.struct([(c, batch.schema.field(c).type) for c in ("id", "part", "row", "first")])
                arrow = pa.schema([("bucket", pa.binary()), ("ctx", pa.binary()), ("n", pa.int64()), ("since", since), ("earlier", pa.string()), ("any", pa.string())])
            for r in batch.to_pylist():
                if size > BLOCK and rows[-1]["bucket"] != r["bucket"]:
                    yield pa.RecordBatch.from_pylist(settle(rows), arrow)
                    rows, size = [], 0
                rows.append(r)
                size += len(r["data"])
        if rows:
            yield pa.RecordBatch.from_pylist(settle(rows), arrow)

    dealt = held.repartition(shuffle_partitions(held.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(arrays, FOUND.format(kind=texts.kind))


def _settle(texts: Texts, contexts: DataFrame, length: int) -> DataFrame:
    """FOUND of all contexts with repeated starts; no flags: all starts are, but for the first occurrence's ``earlier``."""
    buckets = contexts.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("n_bucket")).where("n_bucket > 1")
    buckets, _ = written(buckets, "repeats-buckets")
    shared = counted_join(contexts, buckets.select("bucket", "m"), ["bucket"], "m")
    nothing = F.lit(None).cast("string")
    single = shared.where("m = 1").select("bucket", "ctx", "n", "since", nothing.alias("earlier"), nothing.alias("any"))
    found = single.unionByName(_factors(texts, shared.where(f"m > 1 AND m <= {MOST}"), length))
    large = shared.where(F.col("m") > MOST)
    if not buckets.where(F.col("m") > MOST).isEmpty():
        parts, _ = written(_split(texts, large, length), "repeats-split")
        below = parts.groupBy("bucket", "ctx").agg(F.sum("n").alias("n"), F.min("since").alias("since"), *(F.first(c).alias(c) for c in ("starts", "lo", "known")), F.count("*").alias("held"))
        below, _ = written(below, "repeats-contexts")
        settled = _settle(texts, below, length).withColumnsRenamed({"since": "part_since", "n": "part_n"})
        met = counted_join(parts, settled.join(below.select("bucket", "ctx", "held"), ["bucket", "ctx"]), ["bucket", "ctx"], "held")
        # what is not found below is repeated nowhere
        met = parts.select("of_bucket", "of_ctx", "n", "since", "offset", "starts", "bucket", "ctx").join(met.select("of_bucket", "of_ctx", "offset", "part_since", "earlier", "any"), ["of_bucket", "of_ctx", "offset"], "left")
        none, every = F.expr("repeat('0', starts)"), F.expr("repeat('1', starts)")
        earlier = F.when(F.col("part_since").isNull(), none).when(F.col("part_since") == F.col("since"), F.coalesce("earlier", none)).otherwise(every)
        anywhere = F.when(F.col("part_since").isNull(), none).otherwise(F.coalesce("any", every))
        sides = F.sort_array(F.collect_list(F.struct("offset", earlier.alias("earlier"), anywhere.alias("any"), "since")))
        joined = lambda c: F.concat_ws("", F.col(f"sides.{c}")).alias(c)
        whole = met.groupBy(F.col("of_bucket").alias("bucket"), F.col("of_ctx").alias("ctx")).agg(F.first("n").alias("n"), sides.alias("sides"))
        found = found.unionByName(whole.select("bucket", "ctx", "n", F.col("sides")[0]["since"].alias("since"), joined("earlier"), joined("any")))
    return written(found, "repeats-found")[0]


def repeated(texts: Texts, length: int) -> DataFrame:
    """part, row, first, starts, earlier, any of every occurrence with repeated starts; no flags: all of them."""
    occurrences, _ = written(_anchors(texts.rows, length), "repeats-anchors")
    since = F.struct("id", "part", "row", "first")
    contexts = occurrences.groupBy("bucket", "ctx").agg(F.count("*").alias("n"), F.min(since).alias("since"), *(F.first(c).alias(c) for c in ("starts", "lo")))
    contexts, _ = written(contexts, "repeats-contexts")
    settled = _settle(texts, contexts.withColumn("known", F.lit(max(1, length // 4))), length)
    met = counted_join(occurrences, settled, ["bucket", "ctx"], "n")
    # a context that is alone in its bucket has no earlier copy where it stands first
    earlier = F.when(F.col("since") == since, F.coalesce("earlier", F.lit("")))
    return met.select("part", "row", "first", "starts", earlier.alias("earlier"), "any")


def _flags(listed: list, starts: np.ndarray) -> np.ndarray:
    """Flags of all starts; None means that all are set, an empty text that none is."""
    whole = "".join("1" * n if t is None else t or "0" * n for t, n in zip(listed, starts.tolist(), strict=True))
    return np.frombuffer(whole.encode(), np.uint8) == 49


def remove_repeats(df: DataFrame, *, length: int = LENGTH, keep: str = "first", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (removed byte ranges, maximal) and kept (the remaining bytes) of every row.

    ``keep``: "first" leaves the first copy of every repeated string, "none" removes all of them.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"unknown keep {keep!r}")
    texts = Texts(df, doc_id, text)
    flags = "earlier" if keep == "first" else "any"
    marks = repeated(texts, length).select("part", "row", "first", "starts", F.col(flags).alias("flags"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(path, part):
        row, first, starts = (part.column(c).to_numpy() for c in ("row", "first", "starts"))
        flags = part.column("flags").to_pylist()
        for begin, batch in _texts_of(path, ["id", "text"]):
            data, at = utf8_bytes(batch.column("text"))
            i, j = np.searchsorted(row, [begin, begin + batch.num_rows])
            n = starts[i:j].astype(np.int64)
            places = np.repeat(at[row[i:j] - begin] + first[i:j] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            # a byte goes if one of the last ``length`` starts up to it is marked
            marked = np.zeros(len(data) + 1, bool)
            marked[places[_flags(flags[i:j], n)] + 1] = True
            seen = np.cumsum(marked)
            gone = seen[1:] > np.concatenate([np.zeros(min(length, len(data)), np.int64), seen[1 : max(1, len(data) - length + 1)]])
            kept, spans = [], []
            for s, e in zip(at.tolist(), at[1:].tolist(), strict=False):
                own = gone[s:e]
                edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
                spans.append([{"start": x, "stop": y} for x, y in zip(edges[::2], edges[1::2], strict=True)])
                kept.append(data[s:e][~own].tobytes() if edges else data[s:e].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(at)), pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return texts.visit(marks, run, f"doc_id {texts.kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary", every=True)
