"""Shards and top-k against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docferry.llm import sharding, topk


def brute_shards(rows, limit):
    """Split (key, bytes) rows by the bits of their hash; buckets by prefix."""
    hashed = [(int(hashlib.md5(str("" if k is None else k).encode()).hexdigest()[:15], 16), b or 0) for k, b in rows]

    def split(part, depth, prefix):
        if sum(b for _, b in part) <= limit or len({h for h, _ in part}) == 1:
            return {prefix: part}
        out = {}
        for bit in "01":
            below = [(h, b) for h, b in part if f"{h:060b}"[depth] == bit]
            if below:
                out |= split(below, depth + 1, prefix + bit)
        return out

    return split(hashed, 0, "") if hashed else {}


def size():
    return F.octet_length(F.coalesce("text", F.lit("")))


@pytest.mark.parametrize("limit", [1, 300, 5000, 10**7])
def test_shards(spark, limit):
    rng = np.random.default_rng(limit)
    rows = [(k, "y" * int(rng.integers(0, 400)) if k % 7 else None, "clash") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard_id string")
    found = sharding.shard(df, key=F.col("doc_id"), size=size(), limit=limit).collect()
    want = brute_shards([(k, len(t or "")) for k, t, _ in rows], limit)
    assert len(found) == len(rows)
    assert {r.shard_id: (r.shard_depth, r.shard_bytes, r.shard_rows) for r in found} == {
        p: (len(p), sum(b for _, b in part), len(part)) for p, part in want.items()
    }


def test_repeated_keys_overflow(spark):
    rows = [("hot", "z" * (k % 50)) for k in range(500)] + [(None, "n"), ("cold", None), ("big", "b" * 5000)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    found = sharding.shard(df, key=F.col("doc_id"), size=size(), limit=200).collect()
    assert len(found) == len(rows)
    held = {}
    for r in found:
        held.setdefault(r.shard_id, []).append(r)
    for shard_id, part in held.items():
        held_bytes = sum(len(r.text or "") for r in part)
        assert part[0].shard_bytes == held_bytes and part[0].shard_rows == len(part)
        assert held_bytes <= 200 or len(part) == 1
    assert len({r.shard_part for r in found if r.doc_id == "hot"}) > 50


def test_no_rows_and_bad_limit(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(df, key=F.col("doc_id"), size=size(), limit=10).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(df, key=F.col("doc_id"), size=size(), limit=0)


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(k, "t" * 10) for k in range(40)], "doc_id long, text string")
    sharded = sharding.shard(df, key=F.col("doc_id"), size=size(), limit=100)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).where("n > 100").count() == 0 and back.count() == 40


def test_sharding_runs_no_python(spark):
    df = spark.createDataFrame([(k, "t" * k) for k in range(40)], "doc_id long, text string")
    plan = sharding.shard(df, key=F.col("doc_id"), size=size(), limit=100)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_top_k(vectors, k, query):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in usable:
        if query(i):
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 16)  # several rounds
    rng = np.random.default_rng(seed)
    vectors = [(k, rng.normal(0, 1, 5).round(1).tolist()) for k in range(120)]
    vectors += [(k, vectors[0][1]) for k in range(200, 260)]  # ties: one vector often
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5), (7, vectors[7][1]), (304, []), (305, [0.5])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("low", F.lit("clash")).withColumn("v", F.lit(1)).repartition(4)
    found = topk.exact_top_k(df, k=10, is_query=F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_top_k(vectors, 10, lambda i: i % 10 == 0)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.exact_top_k(df, k=10, is_query=F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 2, 0), (0, 2, 1, -1572864)]
    assert topk.exact_top_k(df.limit(0), k=10, is_query=F.lit(True)).count() == 0
    assert topk.exact_top_k(df, k=10, is_query=F.col("vec_id") == 99).count() == 0
    with pytest.raises(ValueError):
        topk.exact_top_k(df.selectExpr("vec_id", "transform(embedding, x -> x * 1e12D) AS embedding"), k=1, is_query=F.lit(True))


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, -1.0]), (2, [3e5, 2.0])], "vec_id long, embedding array<double>")
    found = topk.exact_top_k(df, k=2, is_query=F.col("vec_id") == 0).orderBy("rank").collect()
    x = 300000 * 1024
    assert [(r.vec_id, r.score) for r in found] == [(2, x * x + 2 * 1024 * 1024), (1, x * x - 1024 * 1024)]
