"""Equi joins against a side with one row per key, safe for hot keys on the other side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.values import field

# A key is hot when it holds this share of the rows; at most 1 / share keys can.
HOT_SHARE = 0.01
SAMPLE_ROWS = 200_000
NEVER_HOT = 1_000_000


def hot_keys(df: DataFrame, key: list[str], n_rows: int) -> list:
    """Keys that hold a large share of the rows, found in a sample of bounded expected size.

    A key missed here is only slower to join, so the sample need not be exact.
    """
    fraction = min(1.0, SAMPLE_ROWS / n_rows)
    counts = df.select(*map(field, key)).sample(fraction, seed=17).groupBy(*map(field, key)).count()
    threshold = int(n_rows * fraction * HOT_SHARE)
    return counts.where(F.col("count") > threshold).limit(int(2 / HOT_SHARE)).drop("count").collect()


def is_one_of(df: DataFrame, key: list[str], keys: list) -> Column:
    """True for rows whose key is one of a short list; never for a key with a NULL."""
    struct = F.struct(*(field(c) for c in key))
    wanted = [F.struct(*(F.lit(v).cast(df.schema[c].dataType) for c, v in zip(key, k))) for k in keys]
    return ~has_null(key) & (struct.isin(*wanted) if wanted else F.lit(False))


def has_null(key: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [field(c).isNull() for c in key])


def join_unique(df: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join ``df`` (left, left_semi or left_anti) with ``right``, which has one row per key.

    Small right sides are left to Spark's own size check, which broadcasts them. Rows of
    hot keys join the few right rows of just these keys, bounded by their number, so they are
    never gathered in one task; rows with a NULL in the key match nothing and go the same way.
    All other rows take the normal shuffled join.
    """
    n_rows = df.count()
    if n_rows < NEVER_HOT:
        return df.join(right, key, how)
    hot = [k for k in hot_keys(df, key, n_rows) if None not in k]
    apart = is_one_of(df, key, hot) | has_null(key)
    calm = df.where(~apart).join(right.where(~has_null(key) & ~is_one_of(right, key, hot)), key, how)
    return calm.unionByName(df.where(apart).join(F.broadcast(right.where(is_one_of(right, key, hot))), key, how))
