"""Shards by extendible hashing, with DataFrame operations only.

The hash of a row's key has HASH_BITS bits. A bucket is a prefix of them; the empty prefix is the first bucket. A bucket
that holds more bytes than the limit is split on its next bit, others stay, so the directory is as deep as it must be
in each place. Splitting ends too when a bucket holds a single hash, as no further bit could part it.

All splits are found at once: bytes are summed by a prefix that is a few bits longer than an even spread needs, the sums
of all shorter prefixes follow from those, and a bucket is the shortest prefix that may stay. Prefixes that are still
too large (a few at most, unless keys repeat) are summed again by the whole hash. Rows then look their bucket up in the
directory by an equality join.

Rows that share one hash and exceed the limit together (repeated keys) fill overflow parts, numbered by running
sums per task and the sums of the tasks before, so that such rows never meet in one task.

Defined results: a null key counts as the empty text; a null size as 0; a row larger than the limit is a part of its own;
an empty table gives no rows; input columns named like the output ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import named
from docferry.session import written

HASH_BITS = 60
#: Bits beyond an even spread that the first sums have.
SPARE_BITS = 4

OUTPUT = ("shard_id", "shard_depth", "shard_part", "shard_bytes", "shard_rows")


def key_hash(key: Column) -> Column:
    """The first HASH_BITS bits of the MD5 of a key's text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(hash_: Column, bits: Column | int) -> Column:
    shift = HASH_BITS - bits if isinstance(bits, int) else (F.lit(HASH_BITS) - bits)
    return F.call_function("shiftright", hash_, F.lit(shift) if isinstance(shift, int) else shift.cast("int"))


def _sums(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.max("most").alias("most"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _leaves(cells: DataFrame, first: int, bits: int, limit: int) -> DataFrame:
    """For each cell (a prefix of ``bits`` bits) the shortest prefix of at least ``first`` bits that may stay; depth null if none."""
    by_depth = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(bits)))).withColumn(
        "prefix", F.call_function("shiftright", F.col("cell"), (F.lit(bits) - F.col("depth")).cast("int"))
    )
    buckets = _sums(by_depth, "depth", "prefix").where((F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
    shortest = (
        by_depth.select("cell", "depth", "prefix")
        .join(buckets, ["depth", "prefix"])
        .groupBy("cell")
        .agg(F.min(F.struct("depth", "prefix", "bytes", "rows", "most")).alias("leaf"))
    )
    return cells.select("cell").join(shortest, "cell", "left").select("cell", "leaf.*")


def weights(df: DataFrame, key: Column, size: Column) -> DataFrame:
    """Hash and bytes of every row, in the shape that sums are made from."""
    bytes_ = F.coalesce(size.cast("long"), F.lit(0))
    rows = df.select(key_hash(key).alias("hash"), bytes_.alias("bytes"))
    return rows.select("hash", "bytes", F.lit(1).alias("rows"), F.col("bytes").alias("most"), F.col("hash").alias("low"), F.col("hash").alias("high"))


def directory(rows: DataFrame, limit: int) -> tuple[int, DataFrame, DataFrame | None]:
    """Bits of the directory's cells, the bucket of each cell, and by whole hash the buckets of cells that need more bits.

    ``rows`` are ``weights``.
    """
    if limit <= 0:
        raise ValueError("the limit is a positive number of bytes")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(max(total, 1) / limit))) + SPARE_BITS)
    cells = _sums(rows.withColumn("cell", _prefix(F.col("hash"), bits)), "cell")
    found, _ = written(_leaves(cells, 0, bits, limit), "shard-directory")
    open_cells = found.where("depth IS NULL").select("cell")
    if bits == HASH_BITS or open_cells.isEmpty():
        return bits, found, None
    rest = rows.withColumn("cell", _prefix(F.col("hash"), bits)).join(open_cells, "cell", "left_semi")
    deep, _ = written(_leaves(_sums(rest.drop("cell").withColumn("cell", F.col("hash")), "cell"), bits + 1, HASH_BITS, limit), "shard-directory")
    return bits, found.where("depth IS NOT NULL"), deep


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Numbers parts of at most ``limit`` bytes among the rows of one bucket, a task's rows after those of the tasks before."""
    step = F.greatest(F.lit(1).cast("long"), F.lit(limit) - F.col("leaf.most") + 1)
    rows, _ = written(rows.withColumn("at", F.monotonically_increasing_id()), "shard-overflow")
    rows = rows.withColumn("task", F.shiftright("at", 33))
    own = Window.partitionBy("leaf.prefix", "task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(F.col("leaf.prefix").alias("bucket"), "task").agg(F.sum("bytes").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("bucket", F.col("task").alias("of_task"), "before")
    )
    placed = rows.withColumn("within", F.coalesce(F.sum("bytes").over(own), F.lit(0))).join(
        before, (F.col("leaf.prefix") == F.col("bucket")) & (F.col("task") == F.col("of_task"))
    )
    parts = placed.withColumn("part", F.floor((F.col("before") + F.col("within")) / step).cast("long"))
    # sizes by part: sums per (bucket, part), each part has at most ``limit`` bytes
    sizes = parts.groupBy(F.col("leaf.prefix").alias("p_bucket"), F.col("part").alias("p_part")).agg(F.sum("bytes").alias("p_bytes"), F.count("*").alias("p_rows"))
    joined = parts.join(sizes, (F.col("leaf.prefix") == F.col("p_bucket")) & (F.col("part") == F.col("p_part")))
    return joined.select("row", "hash", "leaf", F.col("part").alias("part"), F.col("p_bytes").alias("part_bytes"), F.col("p_rows").alias("part_rows"))


def shard(df: DataFrame, *, key: Column, size: Column, limit: int) -> DataFrame:
    """The rows with shard_id (bits of the bucket, and ``.n`` for overflow part n), shard_depth (number of bits),
    shard_part (0 without overflow), shard_bytes and shard_rows (of the whole shard)."""
    sums, _ = written(weights(df, key, size), "shard-weights")
    bits, cells, deep = directory(sums, limit)
    leaf = F.struct("depth", "prefix", "bytes", "rows", "most")
    rows = df.select(F.struct(*named(df.columns)).alias("row"), key_hash(key).alias("hash"), F.coalesce(size.cast("long"), F.lit(0)).alias("bytes"))
    rows = rows.withColumn("cell", _prefix(F.col("hash"), bits))
    found = rows.join(cells.select(F.col("cell").alias("of"), leaf.alias("leaf")), F.col("cell") == F.col("of"), "left").drop("of", "cell")
    if deep is not None:
        found = found.join(deep.select(F.col("cell").alias("of"), leaf.alias("deeper")), (F.col("hash") == F.col("of")) & F.col("leaf").isNull(), "left")
        found = found.select("row", "hash", "bytes", F.coalesce("leaf", "deeper").alias("leaf"))
    full = (F.col("leaf.bytes") > limit) & (F.col("leaf.rows") > 1)
    whole = (cells if deep is None else cells.unionByName(deep)).where((F.col("bytes") > limit) & (F.col("rows") > 1))
    plain = [F.lit(0).cast("long").alias("part"), F.col("leaf.bytes").alias("part_bytes"), F.col("leaf.rows").alias("part_rows")]
    if whole.isEmpty():
        parted = found.select("row", "hash", "leaf", *plain)
    else:
        parted = found.where(~full).select("row", "hash", "leaf", *plain).unionByName(_overflow(found.where(full), limit))
    name = F.substring(F.lpad(F.bin("hash"), HASH_BITS, "0"), F.lit(1), F.col("leaf.depth"))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in OUTPUT]
    overflow = (F.col("leaf.bytes") > limit) & (F.col("leaf.rows") > 1)
    return parted.select(
        *kept,
        F.when(overflow, F.concat(name, F.lit("."), F.col("part").cast("string"))).otherwise(name).alias("shard_id"),
        F.col("leaf.depth").cast("int").alias("shard_depth"),
        F.col("part").alias("shard_part"),
        F.col("part_bytes").alias("shard_bytes"),
        F.col("part_rows").alias("shard_rows"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard below ``path`` (``shard=s`` and its id); a shard's rows meet in one task, which its byte limit bounds."""
    named = sharded.withColumn("shard", F.concat(F.lit("s"), "shard_id"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
