"""Stores, tables over JDBC (embedded database, in process) and folders, CSV, jobs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docferry.plans import plan_columns, plan_documents
from docferry.plans.jobs import (
    load_csv_to_collection,
    load_csv_to_table,
    load_json_to_collection,
    migrate_collections,
    migrate_table,
    migrate_tables,
)
from docferry.sources import (
    DocumentStore,
    FileTables,
    JdbcConnection,
    archive_csv,
    create_table,
    describe_table,
    list_collections,
    list_tables,
    read_collection,
    read_csv,
    read_table,
    reset_target,
    sample_document,
    write_collection,
    write_table,
)
from docferry.sources.tables import catalog


def derby(path, schema=None):
    return JdbcConnection(f"jdbc:derby:{path}/embedded;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", schema=schema)


@pytest.fixture(params=["jdbc", "files"])
def conn(request, tmp_path):
    return derby(tmp_path) if request.param == "jdbc" else FileTables(str(tmp_path / "tables"))


ROWS = [(i, f"n{i}", i * 1.5, None if i % 4 else datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(40)]
SCHEMA = "k long, nameText string, v double, at timestamp_ntz"


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_write_and_read(spark, conn):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_table(df, conn, "t")
    write_table(df.where("k < 5"), conn, "t")
    assert read_table(spark, conn, "t").count() == 45
    write_table(df, conn, "t", mode="overwrite")
    assert same(read_table(spark, conn, "t"), df)
    write_table(df.where("k < 5"), conn, "other", staged=True)
    write_table(df.where("k < 9"), conn, "other", staged=True)
    assert list_tables(spark, conn) == ["other", "t"]
    assert read_table(spark, conn, "other").count() == 9


def test_create_from_a_plan(spark, conn):
    df = spark.createDataFrame(ROWS, "k int, s string, v double, at timestamp_ntz")
    ddl = create_table(plan_columns(df, key=None), conn, "planned")
    assert ddl == "CREATE TABLE IF NOT EXISTS `planned` (`at` DATETIME, `k` INT, `s` VARCHAR(25), `v` DOUBLE);"
    assert read_table(spark, conn, "planned").count() == 0
    create_table(plan_columns(df, key=None), conn, "planned")
    write_table(df.select("at", "k", "s", "v"), conn, "planned")
    assert read_table(spark, conn, "planned").count() == 40
    types = {r["name"]: r.type for r in describe_table(spark, conn, "planned").collect()}
    assert list(types) == ["at", "k", "s", "v"] and types["k"] == "int" and types["at"] == "timestamp_ntz"


def test_jdbc_sizes_are_kept_and_enforced(spark, tmp_path):
    conn = derby(tmp_path)
    create_table(plan_columns(spark.createDataFrame([("x",)], "s string"), key=None), conn, "t")
    assert describe_table(spark, conn, "t").head().type == "varchar(25)"
    with pytest.raises(Exception, match="truncation"):
        write_table(spark.createDataFrame([("x" * 80,)], "s string"), conn, "t")
    assert read_table(spark, conn, "t").count() == 0


def test_jdbc_read_splits_and_pushes_down(spark, tmp_path):
    conn = derby(tmp_path)
    write_table(spark.createDataFrame(ROWS, SCHEMA), conn, "t")
    split = read_table(spark, conn, "t", partition_on="k", partitions=4)
    assert split.rdd.getNumPartitions() == 4 and split.count() == 40
    text = split.where("k > 30").select("nameText")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,30)" in text and "struct<nameText:string>" in text
    write_table(spark.createDataFrame([], SCHEMA), conn, "empty")
    assert read_table(spark, conn, "empty", partition_on="k").count() == 0


def test_reset_is_for_the_named_schema(spark, tmp_path):
    conn = derby(tmp_path, "app_one")
    reset_target(spark, conn)
    write_table(spark.createDataFrame(ROWS, SCHEMA), conn, "t")
    assert list_tables(spark, conn) == ["t"]
    reset_target(spark, conn)
    assert list_tables(spark, conn) == []
    with pytest.raises(ValueError, match="schema"):
        reset_target(spark, derby(tmp_path))


def test_secrets_stay_out_of_repr(spark):
    conn = JdbcConnection("jdbc:x://h/db?password=hidden", user="someone", password="hidden")
    store = DocumentStore("db", "mongodb", {"connection.uri": "hidden"})
    assert "hidden" not in repr(conn) + repr(store) and "someone" not in repr(conn)
    assert "hidden" not in catalog(spark, conn)


def test_collections(spark, tmp_path):
    store = DocumentStore(str(tmp_path / "db"))
    assert list_collections(spark, store) == []
    write_collection(spark.createDataFrame(ROWS, SCHEMA), store, "people")
    write_collection(spark.createDataFrame(ROWS[:2], SCHEMA), store, "people")
    write_collection(spark.createDataFrame([], SCHEMA), store, "nothing")
    assert list_collections(spark, store) == ["nothing", "people"]
    assert read_collection(spark, store, "people").count() == 42
    assert read_collection(spark, store, "people", as_variant=True).count() == 42
    assert read_collection(spark, store, "nothing", as_variant=True).count() == 0
    assert read_collection(spark, store, "nothing").count() == 0
    with pytest.raises(ValueError, match="names"):
        list_collections(spark, DocumentStore("db", "mongodb"))


def test_collections_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("docferry.sources.documents.LINES_PER_FILE", 1000)
    tables, store = FileTables(str(tmp_path / "tables")), DocumentStore(str(tmp_path / "db"))
    rows = spark.range(4000, numPartitions=1).select("id", F.lit("é").alias("textOfName"), (F.col("id") / 3).alias("third"))
    write_table(rows, tables, "things")
    assert migrate_table(spark, tables, "things", store)[2:5] == ("migrated", 4000, 4000)
    files = [f for f in (tmp_path / "db" / "things").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4
    text = sum(len(json.dumps({"id": {"$numberLong": str(i)}, "textOfName": "é", "third": i / 3})) for i in range(4000))
    assert sum(f.stat().st_size for f in files) < text / 3
    # lines that somebody else left there as plain text are read with them
    (tmp_path / "db" / "things" / "more.json").write_text('{"id": 4000, "textOfName": "x", "third": 0.5}\n')
    docs = read_collection(spark, store, "things", as_variant=True)
    found = docs.selectExpr("coalesce(try_variant_get(doc, '$.id[\"$numberLong\"]', 'long'), try_variant_get(doc, '$.id', 'long')) AS id", "variant_get(doc, '$.textOfName', 'string') AS t", "variant_get(doc, '$.third', 'double') AS v")
    assert sorted(map(tuple, found.collect())) == [*((i, "é", i / 3) for i in range(4000)), (4000, "x", 0.5)]


def test_sample_document(spark, docs_of):
    df = spark.createDataFrame([(None, 1), (3, 2), (2, 3)], "_id int, v int")
    assert sample_document(df).head().v == 3
    assert sample_document(df.where("false")).head() is None
    docs = docs_of(['{"_id":"a","v":1}', '{"_id":10,"v":2}', '{"_id":9,"v":3}', '{"v":4}'])
    assert sample_document(docs).select(F.try_variant_get("doc", "$.v", "int")).head()[0] == 3


CSV = 'code,text,empty\n007,"a, ""quoted"" one",\n008,é,x\n'


def test_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    df = read_csv(spark, str(tmp_path / "in.csv"))
    assert [tuple(r) for r in df.collect()] == [("007", 'a, "quoted" one', None), ("008", "é", "x")]
    archive_csv(df, str(tmp_path / "out"))
    assert same(read_csv(spark, str(tmp_path / "out")), df)


def test_csv_loads(spark, conn, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    load_csv_to_table(spark, str(tmp_path / "in.csv"), conn, "codes")
    load_csv_to_table(spark, str(tmp_path / "in.csv"), conn, "codes")
    assert sorted(r.code for r in read_table(spark, conn, "codes").collect()) == ["007", "008"]
    store = DocumentStore(str(tmp_path / "db"))
    load_csv_to_collection(spark, str(tmp_path / "in.csv"), store, "codes")
    load_csv_to_collection(spark, str(tmp_path / "in.csv"), store, "codes")
    assert read_collection(spark, store, "codes").count() == 4


def test_json_load_keeps_values_as_they_are(spark, tmp_path):
    line = {"_id": {"$oid": "abc"}, "n": {"$numberDecimal": "1.5"}, "a": [1, {"b": None}]}
    (tmp_path / "in.json").write_text(json.dumps(line) + "\n")
    store = DocumentStore(str(tmp_path / "db"))
    load_json_to_collection(spark, str(tmp_path / "in.json"), store, "c")
    back = read_collection(spark, store, "c", as_variant=True).select(F.to_json("doc")).head()[0]
    assert json.loads(back) == line


def people_store(spark, tmp_path):
    path = tmp_path / "db"
    (path / "People").mkdir(parents=True)
    lines = [{"_id": i, "userName": f"u{i}", "address": {"zipCode": str(i)}, "tags": [i]} for i in range(30)]
    lines[7]["extraField"] = "late"
    (path / "People" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    (path / "emptyOne").mkdir()
    return DocumentStore(str(path))


def test_migrate_collections(spark, conn, tmp_path):
    store = people_store(spark, tmp_path)
    report = migrate_collections(spark, store, conn, archive=str(tmp_path / "archive"), concurrency=2)
    assert sorted(tuple(r)[:6] for r in report.collect()) == [
        ("People", "people", "migrated", 30, 30, 6),
        ("emptyOne", "empty_one", "skipped_empty", 0, 0, 0),
    ]
    rows = read_table(spark, conn, "people").orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 31)) and [r._id for r in rows] == list(range(30))
    assert rows[7].extra_field == "late" and rows[8].extra_field is None
    assert rows[3].address_zip_code == "3" and rows[3].tags == "[3]" and rows[3].user_name == "u3"
    assert read_csv(spark, str(tmp_path / "archive" / "people")).count() == 30


def test_migrating_twice_replaces_the_tables(spark, conn, tmp_path):
    store = people_store(spark, tmp_path)
    for _ in range(2):
        migrate_collections(spark, store, conn, mode="sample")
    assert read_table(spark, conn, "people").count() == 30


def test_migrate_tables_and_back(spark, conn, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    write_table(df, conn, "first")
    write_table(df.limit(0), conn, "second")
    store = DocumentStore(str(tmp_path / "docs"))
    report = {r.source: r for r in migrate_tables(spark, conn, store, partition_on={"first": "k"}).collect()}
    assert report["first"].rows_out == 40 and report["first"].columns == 4
    assert report["second"].status == "skipped_empty" and report["second"].rows_out == 0
    assert migrate_table(spark, conn, "first", store)[3:5] == (40, 40)
    docs = read_collection(spark, store, "first", as_variant=True)
    types = {r["column"]: r.sql_type for r in plan_documents(docs, key=None).collect()}
    assert types == {"at": "DATETIME", "k": "BIGINT", "name_text": "VARCHAR(25)", "v": "DOUBLE"}


def test_migrate_table_by_map(spark, conn, tmp_path):
    write_table(spark.createDataFrame(ROWS, SCHEMA), conn, "t")
    store = DocumentStore(str(tmp_path / "docs"))
    migrate_table(spark, conn, "t", store, mapping={"label": 1, "key": 0}, target="labels")
    assert set(read_collection(spark, store, "labels").columns) == {"label", "key"}
    with pytest.raises(IndexError):
        migrate_table(spark, conn, "t", store, mapping={"label": 9})
