import pytest
from pyspark.sql import functions as F

from docferry.operators import apply_patches, delete, delete_keys, deleted_count, find, joins, modified_count, update

SCHEMA = "_id int, name string, age int, address struct<zip:string>, tags array<string>"
ROWS = [
    (1, "ann", 30, ("X",), ["a", "b"]),
    (2, "bob", None, ("Y",), []),
    (3, "cid", 40, None, None),
    (4, "ann", 50, ("X",), ["b"]),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize(
    "query,ids",
    [
        ({}, [1, 2, 3, 4]),
        ({"name": "ann"}, [1, 4]),
        ({"name": "ann", "age": 50}, [4]),
        ({"address.zip": "X"}, [1, 4]),
        ({"age": {"$gt": 30}}, [3, 4]),
        ({"age": {"$gte": 30, "$lt": 50}}, [1, 3]),
        ({"age": {"$lte": 30}}, [1]),
        ({"age": {"$ne": 30}}, [2, 3, 4]),
        ({"age": {"$in": [30, 40]}}, [1, 3]),
        ({"age": {"$in": [30, None]}}, [1, 2]),
        ({"age": None}, [2]),
        ({"age": {"$exists": True}}, [1, 3, 4]),
        ({"age": {"$exists": False}}, [2]),
        ({"missing": {"$exists": True}}, []),
        ({"missing": None}, [1, 2, 3, 4]),
        ({"tags": "b"}, [1, 4]),
        ({"tags": ["b"]}, [4]),
        ({"tags": {"$in": ["a"]}}, [1]),
        ({"$or": [{"name": "bob"}, {"age": {"$gt": 45}}]}, [2, 4]),
        ({"$and": [{"name": "ann"}, {"$or": [{"age": 30}, {"age": 40}]}]}, [1]),
        ({"address": {"$exists": False}}, [3]),
    ],
)
def test_find(people, query, ids):
    assert sorted(r._id for r in find(people, query).collect()) == ids


@pytest.mark.parametrize("query", [{"age": {"$near": 1}}, {"$nor": [{}]}])
def test_unknown_operators(people, query):
    with pytest.raises(ValueError, match="unknown"):
        find(people, query)


@pytest.mark.parametrize(
    "query,pushed", [({"o_orderkey": {"$gt": 5}}, "GreaterThan(o_orderkey,5)"), ({"o_orderstatus": "F"}, "EqualTo(o_orderstatus,F)")]
)
def test_find_reaches_the_scan(spark, small, query, pushed):
    df = find(spark.read.parquet(f"{small}/orders.parquet"), query).select("o_custkey")
    assert pushed in df._jdf.queryExecution().executedPlan().toString()


def test_update_first_and_all(people):
    first = {r._id: r.age for r in update(people, {"name": "ann"}, {"age": 1}).collect()}
    assert first == {1: 1, 2: None, 3: 40, 4: 50}
    last = {r._id: r.age for r in update(people, {"name": "ann"}, {"age": 1}, order_by="age").collect()}
    assert last == {1: 1, 2: None, 3: 40, 4: 50}
    every = {r._id: r.age for r in update(people, {"name": "ann"}, {"age": 1}, first_only=False).collect()}
    assert every == {1: 1, 2: None, 3: 40, 4: 1}


def test_update_adds_a_field_and_counts_changes(people):
    rows = {r._id: r.seen for r in update(people, {"name": "ann"}, {"seen": True}).collect()}
    assert rows == {1: True, 2: None, 3: None, 4: None}
    assert modified_count(people, {"name": "ann"}, {"age": 1}) == 1
    assert modified_count(people, {"name": "ann"}, {"age": 30}) == 0
    assert modified_count(people, {"name": "nobody"}, {"age": 30}) == 0
    assert modified_count(people, {"name": "ann"}, {"age": 30}, first_only=False) == 1


def test_update_of_a_member(people):
    rows = {r._id: r.address and r.address.zip for r in update(people, {"age": {"$gte": 40}}, {"address.zip": "Z"}, first_only=False).collect()}
    assert rows == {1: "X", 2: "Y", 3: "Z", 4: "Z"}
    assert modified_count(people, {"name": "ann"}, {"address.zip": "X"}, first_only=False) == 0
    with pytest.raises(ValueError, match="member"):
        update(people, {}, {"name.first": "x"})


def test_delete(people):
    assert sorted(r._id for r in delete(people, {"name": "ann"}).collect()) == [2, 3, 4]
    assert sorted(r._id for r in delete(people, {"name": "ann"}, first_only=False).collect()) == [2, 3]
    assert delete(people, {"name": "nobody"}).count() == 4
    assert deleted_count(people, {"name": "ann"}) == 1 and deleted_count(people, {"name": "ann"}, first_only=False) == 2


def test_patches(spark, people):
    patches = spark.createDataFrame([(1, None, 31, "n"), (4, "dan", None, None), (9, "zed", 1, None)], "_id int, name string, age int, note string")
    rows = {r._id: (r["name"], r.age, r.note) for r in apply_patches(people, patches, "_id").collect()}
    assert rows == {1: ("ann", 31, "n"), 2: ("bob", None, None), 3: ("cid", 40, None), 4: ("dan", 50, None)}


def test_later_patches_win(spark, people):
    patches = spark.createDataFrame([(1, 99, 1), (1, 31, 2), (1, None, 3)], "_id int, age int, at int")
    assert find(apply_patches(people, patches, "_id", order_by="at"), {"_id": 1}).head().age == 31


def test_delete_keys(spark, people):
    keys = spark.createDataFrame([(1,), (1,), (None,), (9,)], "_id int")
    assert sorted(r._id for r in delete_keys(people, keys, "_id").collect()) == [2, 3, 4]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_hot_keys_take_their_own_way_to_the_same_rows(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "NEVER_HOT", 10)
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("v")
    )
    right = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(spark.createDataFrame([(None, 5)], "k long, w long"))
    hot = joins.hot_keys(df, ["k"], 9000)
    assert {r.k for r in hot} == {7, None}
    joined = joins.join_unique(df, right, ["k"], how)
    monkeypatch.setattr(joins, "NEVER_HOT", 10**9)
    plain = joins.join_unique(df, right, ["k"], how)
    assert joined.exceptAll(plain).count() == 0 and joined.count() == plain.count()


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_hot_keys_of_several_columns_with_nulls(spark, monkeypatch, how):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, 1).cast("long").alias("a"), F.when(F.col("id") % 2 > 0, F.col("id") % 5).alias("b"), F.col("id").alias("v")
    )
    right = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (None, 1, "z"), (1, None, "w")], "a long, b long, w string")
    plain = joins.join_unique(df, right, ["a", "b"], how)
    monkeypatch.setattr(joins, "NEVER_HOT", 10)
    split = joins.join_unique(df, right, ["a", "b"], how)
    assert split.exceptAll(plain).count() == 0 and split.count() == plain.count()


STORED = ['{"_id":1,"a":5}', '{"_id":2,"a":"5"}', '{"_id":3,"a":[5,6]}', '{"_id":4,"a":true}', '{"_id":5,"a":{"$numberLong":"5"}}', '{"_id":6,"a":1}', '{"_id":7}', '{"_id":10,"o":{"x":1}}']


def stored_ids(docs):
    return sorted(r[0] for r in docs.selectExpr("try_variant_get(doc, '$._id', 'int')").collect())


@pytest.mark.parametrize(
    ("query", "ids"),
    [
        ({"a": 5}, [1, 3, 5]), ({"a": "5"}, [2]), ({"a": True}, [4]), ({"a": 1}, [6]), ({"a": {"$gte": 2}}, [1, 3, 5]), ({"a": [5, 6]}, [3]), ({"a": None}, [7, 10]),
        ({"o.x": 1}, [10]), ({"doc.a": 5}, [1, 3, 5]), ({"a": {"$exists": False}}, [7, 10]), ({"a": {"$ne": 5}}, [2, 4, 6, 7, 10]), ({"a": {"$in": [1, "5"]}}, [2, 6]),
    ],
)
def test_stored_values_keep_their_kind(docs_of, query, ids):
    assert stored_ids(find(docs_of(STORED), query)) == ids


def test_stored_documents_change(spark, docs_of, tmp_path):
    docs = docs_of(STORED)
    changed = update(docs, {"a": 5}, {"a": 7, "o.y": "z"})
    assert sorted(r[0] for r in changed.selectExpr("to_json(doc)").collect()) == sorted(['{"_id":1,"a":7,"o":{"y":"z"}}', *STORED[1:]])
    assert modified_count(docs, {"a": 5}, {"a": 7}) == 1 and modified_count(docs, {"a": 5}, {"a": 5}, first_only=False) == 2
    assert deleted_count(docs, {"a": 5}, first_only=False) == 3 and stored_ids(delete(docs, {"a": 5})) == [2, 3, 4, 5, 6, 7, 10]


def test_documents_go_back_to_the_store(spark, tmp_path):
    from docferry.sources import DocumentStore, read_collection, replace_collection, write_collection

    store = DocumentStore(str(tmp_path / "store"))
    write_collection(spark.createDataFrame([(1, "x"), (2, "y")], "_id int, s string"), store, "things")
    docs = read_collection(spark, store, "things", as_variant=True)
    replace_collection(update(docs, {"_id": 2}, {"s": "z"}), store, "things")
    assert sorted((r._id, r.s) for r in read_collection(spark, store, "things").collect()) == [(1, "x"), (2, "z")]


def test_ties_change_one_matching_row(spark):
    rows = spark.createDataFrame([(1, "F"), (1, "O"), (1, "F"), (2, "F")], "k int, s string")
    assert sorted(map(tuple, update(rows, {"s": "F"}, {"s": "X"}, order_by="k").collect())) == [(1, "F"), (1, "O"), (1, "X"), (2, "F")]
    assert sorted(map(tuple, delete(rows, {"s": "F"}, order_by="k").collect())) == [(1, "F"), (1, "O"), (2, "F")]


def test_one_of_many_equal_rows(spark, monkeypatch):
    """Equal rows are counted and unfolded in chunks; no window gathers them."""
    monkeypatch.setattr("docferry.operators.mutate.COPIES", 3)
    df = spark.createDataFrame([(1, "a", None)] * 8 + [(1, "b", None), (2, "a", 5)], "k int, `x.y` string, z int").repartition(4)
    gone = delete(df, {"k": 1}, order_by="k")
    assert "Window" not in gone._jdf.queryExecution().optimizedPlan().toString()
    left = sorted(map(repr, gone.collect()))
    assert len(left) == 9
    changed = update(df, {"k": 1}, {"z": 9}, order_by="k")
    assert sorted(r.z for r in changed.collect() if r.k == 1 and r.z) == [9]
    assert changed.count() == 10
    assert delete(df, {"k": 7}, order_by="k").count() == 10


def test_find_of_another_kind(spark):
    df = spark.createDataFrame([(1, "a", True, [1, 2])], "n int, t string, b boolean, l array<int>")
    for query in ({"n": "1"}, {"t": 1}, {"b": 1}, {"n": True}, {"l": "x"}, {"t": {"$gt": 0}}, {"n": {"$in": ["1", False]}}, {"n": {"$lt": "9"}}):
        assert find(df, query).isEmpty()
    assert find(df, {"n": {"$ne": "1"}, "t": {"$in": [1, "a"]}, "l": 2}).count() == 1
