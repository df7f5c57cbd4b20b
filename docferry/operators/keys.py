"""Dense surrogate keys 1..n in key order, without ordering everything in one task.

Rows are split into buckets by fixed bounds over the whole order key, tie-break included, so a
hot value of the leading column is split like any other. One pass samples the bounds, one counts
the buckets, and the rows themselves are shuffled once.

Only rows equal in the whole order key cannot be split that way. A bucket that holds far more
than its share consists of those: its rows are collapsed to one row with a count, numbered by
running total, and unfolded again in chunks spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.values import field

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 16_384
SAMPLES_PER_BUCKET = 20
HOT_BUCKET = 2.5
CHUNK = 1_000_000

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Names of the helper columns while keys are assigned.
TIE, KEY, BUCKET = "_tie", "_order_key", "_bucket"


def _with_tie(df: DataFrame, order_by: list[str], unique: bool) -> tuple[DataFrame, list[Column]]:
    """The rows and the columns they are ordered by; a hash of the other columns breaks ties, and is the order if there is no other."""
    rest = [c for c in df.columns if c not in order_by]
    order = [field(c) for c in order_by]
    if unique or not rest:
        return df, order
    return df.withColumn(TIE, F.xxhash64(*map(field, rest))), [*order, F.col(TIE)]


def _bounds(keys: DataFrame, n_rows: int, buckets: int) -> list[str]:
    """Upper bounds of all buckets but the last, as JSON, from a sample of bounded expected size."""
    fraction = min(1.0, buckets * SAMPLES_PER_BUCKET / n_rows)
    sample = keys if fraction == 1.0 else keys.sample(fraction, seed=17)
    ordered = [r[0] for r in sample.orderBy(KEY).select(F.to_json(KEY, JSON_OPTIONS)).collect()]
    picked = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []
    return [k for i, k in enumerate(picked) if i == 0 or k != picked[i - 1]]


def _bucket_of(key: Column, bounds: list[str], key_type: T.StructType) -> Column:
    """Number of bounds below the key, by binary search; the bounds are one constant array.

    They are sorted once more as values, so the search holds whatever the way through JSON did to them.
    """
    size = len(bounds)
    limits = F.sort_array(F.from_json(F.lit(f"[{','.join(bounds)}]"), T.ArrayType(key_type), JSON_OPTIONS))
    strides = F.array(*(F.lit(1 << s) for s in range(size.bit_length() - 1, -1, -1)))

    def search(one_key: Column) -> Column:
        def step(below: Column, stride: Column) -> Column:
            probe = below + stride
            return F.when((probe <= size) & (F.try_element_at(limits, probe) < one_key), probe).otherwise(below)

        return F.aggregate(strides, F.lit(0), step)

    # Going through an array evaluates the key once, not once per step.
    return F.element_at(F.transform(F.array(key), search), 1)


def add_surrogate_key(
    df: DataFrame,
    order_by: str | list[str],
    name: str = "id",
    *,
    unique: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Put a dense key 1..n first, numbering rows by ``order_by`` (NULLs first); without any, by a hash of the row,
    so that the bounds are 64 bits wide whatever the rows hold.

    ``unique`` says that ``order_by`` has no duplicates; the two passes that prepare the keys
    then read its columns alone, otherwise all columns, as these break ties. ``df`` is read three
    times: cut its lineage first when it is costly to compute. Its rows must be the same each time.
    """
    spark = df.sparkSession
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    if name in df.columns:
        raise ValueError(f"there is already a column {name!r}")
    tied, order = _with_tie(df, order_by, unique)
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    keys = tied.select(key.alias(KEY))
    n_rows = df.count()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = min(MAX_BUCKETS, max(-(-n_rows // rows_per_bucket), min(parts, -(-n_rows // 1000))))
    bounds = _bounds(keys, n_rows, buckets) if buckets > 1 else []
    if not bounds:
        return _finish(tied.withColumn(name, F.row_number().over(W.orderBy(*order))), df, name)

    bucket = _bucket_of(key, bounds, keys.schema[KEY].dataType)
    placed = tied.withColumn(BUCKET, bucket)
    counts = {r[BUCKET]: r["count"] for r in placed.groupBy(BUCKET).count().collect()}
    offsets, total = [], 0
    for b in range(len(bounds) + 1):
        offsets.append(total)
        total += counts.get(b, 0)
    hot = [b for b, n in counts.items() if n > HOT_BUCKET * max(1, n_rows // buckets)]

    offset = F.element_at(F.lit(offsets), F.col(BUCKET) + 1).cast("long")
    calm = placed.where(~F.col(BUCKET).isin(hot)) if hot else placed
    calm = calm.repartitionById(len(offsets), F.col(BUCKET))
    within = W.partitionBy(BUCKET).orderBy(*order)
    out = _finish(calm.withColumn(name, offset + F.row_number().over(within)), df, name)
    if hot:
        parts = min(MAX_BUCKETS, max(parts, sum(counts[b] for b in hot) // CHUNK))
        copies = placed.where(F.col(BUCKET).isin(hot))
        out = out.unionByName(_number_copies(copies, df, order, offset, name, parts))
    return out


def _number_copies(
    rows: DataFrame, df: DataFrame, order: list[Column], offset: Column, name: str, parts: int
) -> DataFrame:
    """Number buckets made up of equal rows: collapse, running total, unfold in chunks.

    The chunks are few and small before they unfold, so the number of tasks is set and not left
    to be worked out from their size.
    """
    groups = rows.groupBy(*map(field, rows.columns)).agg(F.count(F.lit(1)).alias("_copies"))
    before = W.partitionBy(BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    first = offset + F.coalesce(F.sum("_copies").over(before), F.lit(0)) + 1
    ranged = groups.withColumn("_first", first).withColumn("_last", F.col("_first") + F.col("_copies") - 1)
    chunks = ranged.withColumn("_start", F.explode(F.sequence("_first", "_last", F.lit(CHUNK).cast("long"))))
    spread = chunks.repartition(parts, F.col("_start"))
    ids = F.sequence("_start", F.least(F.col("_start") + CHUNK - 1, F.col("_last")))
    return _finish(spread.withColumn(name, F.explode(ids)), df, name)


def _finish(numbered: DataFrame, df: DataFrame, name: str) -> DataFrame:
    return numbered.select(F.col(name).cast("long").alias(name), *map(field, df.columns))
