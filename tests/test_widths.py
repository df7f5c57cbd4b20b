import pytest
from pyspark.sql import functions as F

from docferry.functions import varchar_type, widen

T5 = {0: "TEXT", 1: 25, 24: 25, 25: 50, 49: 50, 50: 75, 975: 1000, 999: 1000, 1000: 1000, 1001: "TEXT", None: "TEXT"}

WIDEN = [
    ("VARCHAR(50)", 50, 50, "VARCHAR(50)"),
    ("VARCHAR(25)", 60, 60, "VARCHAR(100)"),
    ("VARCHAR(25)", 801, 801, "TEXT"),
    ("VARCHAR(25)", 800, 800, "VARCHAR(800)"),
    ("VARCHAR(500)", 1000, 1000, "VARCHAR(1000)"),
    ("VARCHAR(625)", 700, 700, "TEXT"),
    ("VARCHAR(255)", 300, 300, "VARCHAR(510)"),
    ("VARCHAR(24)", 25, 25, "VARCHAR(48)"),
    ("VARCHAR(25)", 70_000, 70_000, "MEDIUMTEXT"),
    ("VARCHAR(25)", None, None, "VARCHAR(25)"),
    ("TEXT", 65_535, 65_535, "TEXT"),
    ("TEXT", 65_536, 65_536, "MEDIUMTEXT"),
    ("TEXT", 10, 16_777_216, "LONGTEXT"),
    ("MEDIUMTEXT", 10, 16_777_216, "LONGTEXT"),
    ("MEDIUMTEXT", 10, 10, "MEDIUMTEXT"),
    ("LONGTEXT", 10, 10, "LONGTEXT"),
    ("INT", 99, 99, "INT"),
    ("BLOB", None, 65_535, "BLOB"),
    ("BLOB", None, 65_536, None),
]


def test_varchar_type(spark):
    df = spark.createDataFrame([(n,) for n in T5], "n int")
    got = {r.n: r.t for r in df.select("n", varchar_type("n").alias("t")).collect()}
    assert got == {n: t if t == "TEXT" else f"VARCHAR({t})" for n, t in T5.items()}


def test_widen(spark):
    df = spark.createDataFrame(WIDEN, "start string, chars int, bytes int, expected string")
    for r in df.withColumn("got", widen("start", "chars", "bytes")).collect():
        assert r.got == r.expected, r


@pytest.mark.parametrize("start", [24, 25, 50, 255])
def test_doubling_step_by_step(spark, start):
    """The closed form against doubling one step at a time, for every length."""

    def stepwise(n, longest):
        while n < longest:
            n *= 2
            if n > 1000:
                return "TEXT"
        return f"VARCHAR({n})"

    df = spark.range(1, 1100).select(F.col("id").cast("int").alias("n"))
    got = df.select("n", widen(F.lit(f"VARCHAR({start})"), F.col("n"), F.col("n")).alias("t")).collect()
    assert all(r.t == stepwise(start, r.n) for r in got)
