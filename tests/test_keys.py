import pytest
from pyspark.sql import functions as F

from docferry.operators import add_surrogate_key


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def in_order(df, *cols):
    """Rows by id, as the tuples the order is made of."""
    return [tuple(r) for r in df.orderBy("id").select(*cols).collect()]


@pytest.mark.parametrize("n", [0, 1, 7, 999, 20_000])
def test_dense_and_ordered(spark, n):
    df = spark.range(n).select(F.expr("hash(id)").alias("k"), F.col("id").alias("v"))
    out = add_surrogate_key(df, ["k", "v"])
    assert out.columns == ["id", "k", "v"] and out.schema["id"].dataType.simpleString() == "bigint"
    assert ids(out) == list(range(1, n + 1))
    rows = in_order(out, "k", "v")
    assert rows == sorted(rows)


def test_no_single_partition_window(spark):
    out = add_surrogate_key(spark.range(20_000).toDF("k"), "k")
    assert "Exchange SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_nulls_come_first(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    rows = in_order(add_surrogate_key(df, ["k", "v"]), "k", "v")
    assert rows == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_hot_leading_value_is_split_by_the_tie_break(spark):
    """Two thirds of the rows share the only order column: they spread over the tasks all the same."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v"))
    out = add_surrogate_key(df, "k")
    assert ids(out) == list(range(1, 30_001))
    keys = [r[0] for r in in_order(out, "k")]
    assert keys == sorted(keys)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 10_000


@pytest.mark.parametrize("share", [3, 1])
def test_exact_copies(spark, share):
    """A third (or all) of the rows are copies of one row."""
    df = spark.range(30_000).select(F.when(F.col("id") % share == 0, -5).otherwise(F.col("id")).cast("long").alias("k"))
    out = add_surrogate_key(df, "k")
    assert ids(out) == list(range(1, 30_001))
    keys = [r[0] for r in in_order(out, "k")]
    assert keys == sorted(keys)


def test_copies_unfold_in_chunks(spark, monkeypatch):
    monkeypatch.setattr("docferry.operators.keys.CHUNK", 1000)
    df = spark.range(30_000).select(F.lit("same").alias("k"), F.lit(None).cast("int").alias("n"))
    out = add_surrogate_key(df, "k")
    assert ids(out) == list(range(1, 30_001))
    assert out.groupBy(F.spark_partition_id()).count().count() > 1


def test_text_keys(spark):
    df = spark.range(5000).select(F.concat(F.lit("é"), F.expr("hash(id)")).alias("k"))
    rows = in_order(add_surrogate_key(df, "k"), "k")
    assert rows == sorted(rows)


def test_name_taken(spark):
    with pytest.raises(ValueError, match="id"):
        add_surrogate_key(spark.range(3), "id")


def test_rows_without_a_key_do_not_share_a_bucket(spark):
    rows = spark.range(40_000).selectExpr("if(id % 2 = 0, NULL, id) AS k", "id AS v", "repeat('x', 2000) AS wide")
    numbered = add_surrogate_key(rows, "k", rows_per_bucket=2000)
    per_task = numbered.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).head()[0]
    assert per_task < 15_000
    ids = numbered.agg(F.countDistinct("id"), F.min("id"), F.max("id"), F.max(F.when(F.col("k").isNull(), F.col("id")))).head()
    assert tuple(ids) == (40_000, 1, 40_000, 20_000)


def test_order_by_nothing_is_by_hash(spark):
    rows = spark.range(5000).selectExpr("id AS v", "repeat('x', 2000) AS wide")
    numbered = add_surrogate_key(rows, [], rows_per_bucket=500)
    assert numbered.agg(F.countDistinct("id"), F.max("id")).head()[:] == (5000, 5000)
    assert "array<struct<k0:string" not in numbered._jdf.queryExecution().toString()
