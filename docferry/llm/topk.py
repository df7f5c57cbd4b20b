"""Exact top-k by inner product: global histograms of the scores locate each query's k-th best value.

Vectors are packed into blocks, a block of queries meets every block of candidates, and a task scores the two by one
matrix product. Each round sends, per query, how many scores fall into each bin of the query's present range (from
the best bin down to where a block alone has k); the sums over all blocks tell the bin of the k-th score, which is the
range of the next round. When bins are one score wide, the k-th score is known; a last round returns what reaches it,
ties by the smaller id. Nothing but counts and the final rows leaves the tasks; scores are never stored.

Components are floor(scale * x), so that scores are integers and sums do not depend on any order.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
if filled up with zeros; repeated rows are candidates once per row, but a query is asked once per id (of several
vectors under one id, the least); candidates with the query's own id are left out; null ids take no part; an empty
table gives no rows. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import shuffle_partitions
from docferry.session import written

BINS = 4096
#: Rows of a block of candidates, and about as many of a block of queries.
BLOCK_ROWS = 2048
QUERY_ROWS = 512

RESULT = "query_id long, rank int, vec_id long, score long"


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id and the integer components of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    usable = F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.forall(x, finite)
    return df.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))).alias("v"))


def _packed(rows: DataFrame, dim: int) -> DataFrame:
    """Blocks of candidates: ids and components as binary, numbered."""

    def pack(batches):
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                yield pa.RecordBatch.from_pydict({"block": [(task << 32) + n], "ids": [_ids(part.column("vec_id"))], "data": [_matrix(part.column("v"), dim).tobytes()]}, pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())]))
                n += 1

    return rows.mapInArrow(pack, "block long, ids binary, data binary")


def _ids(column) -> bytes:
    return column.to_numpy(zero_copy_only=False).astype("<i8").tobytes()


def _matrix(column, dim: int) -> np.ndarray:
    """A list column as rows of ``dim`` numbers, filled up with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    values = column.flatten().to_numpy(zero_copy_only=False).astype("<i8")
    if (lengths == dim).all():
        return values.reshape(len(column), dim)
    out = np.zeros((len(column), dim), "<i8")
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def _scores(queries: np.ndarray, candidates: np.ndarray, exact: bool) -> np.ndarray:
    """All inner products; by floating point where every partial sum is an exact integer."""
    if exact:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


class _Meeting:
    """Scores of one query block against one candidate block."""

    def __init__(self, row: dict, dim: int, exact: bool):
        self.query_ids = np.asarray([q["vec_id"] for q in row["queries"]], np.int64)
        self.low = np.asarray([q["low"] for q in row["queries"]], np.int64)
        self.need = np.asarray([q["need"] for q in row["queries"]], np.int64)
        self.ids = np.frombuffer(row["ids"], "<i8")
        vectors = np.zeros((len(self.query_ids), dim), np.int64)
        for i, q in enumerate(row["queries"]):
            vectors[i, : len(q["v"])] = q["v"]
        self.scores = _scores(vectors, np.frombuffer(row["data"], "<i8").reshape(len(self.ids), dim), exact)
        self.other = self.query_ids[:, None] != self.ids[None, :]

    def best(self, at: np.ndarray, k: int) -> np.ndarray:
        """Of the places ``at``, those not below the k-th best of their query in this block."""
        if self.scores.shape[1] <= k:
            return at
        least = np.iinfo(np.int64).min
        kth = np.partition(np.where(at, self.scores, least), -k, axis=1)[:, -k]
        return at & (self.scores >= kth[:, None])


def _histograms(meetings: DataFrame, k: int, dim: int, exact: bool, span: int, width: int) -> DataFrame:
    """query_id, bin, n: scores of each bin of the present ranges (``span`` scores from ``low``, bins of ``width``)."""

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                m = _Meeting(row, dim, exact)
                at = m.other & (m.scores >= m.low[:, None]) & (m.scores - m.low[:, None] < span)
                query, place = np.nonzero(m.best(at, k))
                bins = (m.scores[query, place] - m.low[query]) // width
                keys, n = np.unique(query * np.int64(span // width + 1) + bins, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(m.query_ids[keys // (span // width + 1)]), pa.array(keys % (span // width + 1)), pa.array(n.astype(np.int64))], ["query_id", "bin", "n"])

    return meetings.mapInArrow(count, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))


def _reaching(meetings: DataFrame, k: int, dim: int, exact: bool) -> DataFrame:
    """query_id, vec_id, score: per block the best k (ties by id) of the scores that reach ``low``."""

    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                m = _Meeting(row, dim, exact)
                query, place = np.nonzero(m.best(m.other & (m.scores >= m.low[:, None]), k))
                ids, scores = m.ids[place], m.scores[query, place]
                order = np.lexsort((ids, -scores, query))
                query, ids, scores = query[order], ids[order], scores[order]
                first = np.searchsorted(query, query)
                kept = np.arange(len(query)) - first < k
                yield pa.RecordBatch.from_arrays([pa.array(m.query_ids[query[kept]]), pa.array(ids[kept]), pa.array(scores[kept])], ["query_id", "vec_id", "score"])

    return meetings.mapInArrow(pick, "query_id long, vec_id long, score long")


def exact_top_k(df: DataFrame, *, k: int, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of every query row (all, if there are fewer)."""
    spark = df.sparkSession
    asked = df.where(is_query)
    rows, queries = integer_vectors(df, vec_id, vector, scale), integer_vectors(asked, vec_id, vector, scale)
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    dim, norm, n_rows = rows.agg(F.max(F.size("v")), F.max(largest), F.count("*")).first()
    if not n_rows:
        return spark.createDataFrame([], RESULT)
    if norm >= 2.0**62:
        raise ValueError("scores of these vectors need more than 64 bits")
    bound, exact, dim = int(norm) + 1, norm < 2.0**52, max(dim, 1)
    blocks, _ = written(_packed(rows, dim), "topk-blocks")

    queries, _ = written(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    n_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    # copies of a query block, so that as many tasks as there are partitions can meet it
    copies = max(1, -(-shuffle_partitions(spark) // n_blocks))
    queries = queries.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    candidates = blocks.withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int")).withColumn("q", every)

    def meetings(state: DataFrame) -> DataFrame:
        asked = state.groupBy("q").agg(F.collect_list(F.struct("vec_id", "v", "low", "need")).alias("queries"))
        asked = asked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        return candidates.join(asked, ["q", "copy"]).select("ids", "data", "queries")

    state = queries.withColumn("low", F.lit(-bound).cast("long")).withColumn("need", F.lit(k).cast("long"))
    span = 2 * bound + 1
    while span > 1:
        width = -(-span // BINS)
        counts = _histograms(meetings(state), k, dim, exact, span, width)
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        reached = counts.withColumn("reached", F.sum("n").over(down))
        # the first bin from above at which ``need`` scores are reached; none if there are fewer
        hit = reached.join(state.select(F.col("vec_id").alias("query_id"), "need"), "query_id").where("reached >= need").groupBy("query_id")
        hit = hit.agg(F.max("bin").alias("bin"), F.min("reached").alias("reached"), F.max(F.struct("bin", "n"))["n"].alias("n"))
        state = state.join(hit, F.col("vec_id") == F.col("query_id"), "left").select(
            "vec_id", "v", "q",
            F.when(F.col("bin").isNotNull(), F.col("low") + F.col("bin") * width).otherwise(F.col("low")).alias("low"),
            F.when(F.col("bin").isNotNull(), F.col("need") - (F.col("reached") - F.col("n"))).otherwise(F.col("need")).alias("need"),
        )
        state, _ = written(state, "topk-state")
        span = width
    best = _reaching(meetings(state), k, dim, exact)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
