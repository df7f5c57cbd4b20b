"""Types that meet, and second loads into a table that is there."""

import json
from datetime import datetime

import pytest

from docferry.plans.evolve import ADD, MODIFY, evolve_plan, render_changes, wider
from docferry.plans.infer import plan_documents
from docferry.plans.jobs import append_collection, migrate_collections, read_rejects
from docferry.sources import DocumentStore, FileTables, read_table


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("INT", "INT", "INT"),
        ("BOOLEAN", "BIGINT", "BIGINT"),
        ("INT", "DOUBLE", "DOUBLE"),
        ("BIGINT", "DOUBLE", "VARCHAR(24)"),
        ("BIGINT", "DECIMAL(38, 3)", "DECIMAL(38, 3)"),
        ("DECIMAL(38, 20)", "DECIMAL(38, 3)", "VARCHAR(41)"),
        ("DECIMAL(38, 3)", "DOUBLE", "VARCHAR(41)"),
        ("VARCHAR(25)", "VARCHAR(50)", "VARCHAR(50)"),
        ("VARCHAR(25)", "DATETIME", "VARCHAR(26)"),
        ("VARCHAR(25)", "MEDIUMTEXT", "MEDIUMTEXT"),
        ("TEXT", "INT", "TEXT"),
        ("DATETIME", "INT", "VARCHAR(26)"),
    ],
)
def test_types_meet(a, b, both):
    assert wider(a, b) == both
    assert wider(b, a) == both
    assert wider(both, a) == both


def test_nothing_holds_bytes_and_numbers():
    with pytest.raises(ValueError, match="BLOB"):
        wider("BLOB", "INT")


def test_statements(spark, docs_of):
    plan = plan_documents(docs_of([json.dumps({"_id": 1, "name": "x" * 60, "size": 5_000_000_000, "newField": True, "gone": None})]))
    existing = {"id": "INT", "_id": "INT", "name": "VARCHAR(25)", "size": "INT", "gone": "DOUBLE", "old": "DATETIME"}
    evolved, changes = evolve_plan(plan, existing)
    assert changes == [(MODIFY, "name", "VARCHAR(75)"), (ADD, "new_field", "BOOLEAN"), (MODIFY, "size", "BIGINT")]
    assert render_changes(changes, "people") == [
        "ALTER TABLE `people` MODIFY COLUMN `name` VARCHAR(75);",
        "ALTER TABLE `people` ADD COLUMN `new_field` BOOLEAN;",
        "ALTER TABLE `people` MODIFY COLUMN `size` BIGINT;",
    ]
    assert {r["column"]: r.sql_type for r in evolved.collect()}["gone"] == "DOUBLE"
    with pytest.raises(ValueError, match="key"):
        evolve_plan(plan, {"_id": "INT"})


def store_of(path, **collections):
    store = DocumentStore(str(path))
    for name, docs in collections.items():
        folder = path / name
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("".join(json.dumps(d) + "\n" for d in docs))
    return store


def test_second_and_third_load(spark, tmp_path):
    conn = FileTables(str(tmp_path / "tables"))
    loads = [
        [{"_id": 1, "at": {"$date": "2024-01-31T23:59:59.5Z"}, "ok": True}, {"_id": 2, "ok": False}],
        [{"_id": "b", "at": "soon", "ok": 7}, {"_id": "a", "more": [1]}],
        [],
    ]
    found = [append_collection(spark, store_of(tmp_path / f"s{i}", things=docs), "things", conn) for i, docs in enumerate(loads)]
    assert [f[0][2:5] for f in found] == [("migrated", 2, 2), ("migrated", 2, 2), ("skipped_empty", 0, 0)]
    assert (ADD, "more", "TEXT") in found[1][1]
    rows = sorted(tuple(r) for r in read_table(spark, conn, "things").select("id", "_id", "at", "ok", "more").collect())
    assert rows == [(1, "1", "2024-01-31 23:59:59", 1, None), (2, "2", None, 0, None), (3, "a", None, None, "[1]"), (4, "b", "soon", 7, None)]


def test_a_failing_collection_does_not_end_the_others(spark, tmp_path):
    store = store_of(tmp_path / "s", a=[{"_id": 1, "userName": 1, "user_name": 2}], b=[{"_id": 1}])
    report = migrate_collections(spark, store, FileTables(str(tmp_path / "t"))).orderBy("source").collect()
    assert [(r.source, r.status, r.rows_out) for r in report] == [("a", "failed: ValueError", 0), ("b", "migrated", 1)]
    with pytest.raises(ValueError, match="user_name"):
        migrate_collections(spark, store, FileTables(str(tmp_path / "u")), on_failure="raise")
    with pytest.raises(ValueError, match="on_failure"):
        migrate_collections(spark, store, FileTables(str(tmp_path / "u")), on_failure="ignore")


def test_values_that_do_not_fit_go_to_the_quarantine(spark, tmp_path):
    conn, rejects = FileTables(str(tmp_path / "tables")), str(tmp_path / "rejects")
    first = [{"_id": 1, "n": 1, "big": 1.5, "ok": True, "at": {"$date": "2024-01-31T23:59:59Z"}, "o": {"a": 1}, "_rejected": "x"}]
    second = [
        {"_id": "b", "n": 1.5, "big": 9007199254740993, "ok": "true", "at": 5, "o": {"a": "x"}, "_rejected": 3},
        {"_id": "c", "n": 7, "big": {"$numberDouble": "NaN"}, "ok": False, "at": "2024-05-06", "o": 4, "added": "new"},
        {"n": None},
    ]
    reports = []
    for i, docs in enumerate((first, second, [])):
        report, changes = append_collection(spark, store_of(tmp_path / f"s{i}", things=docs), "things", conn, on_misfit="reject", rejects=rejects)
        reports.append((report[2:5], report[-1]))
        assert all(kind == ADD for kind, _, _ in changes)
    assert reports[0] == (("migrated", 1, 1), 0) and reports[2] == (("skipped_empty", 0, 0), 0)
    kept = read_rejects(spark, rejects)
    found = {(r.document, r["column"], r.value) for r in kept.collect()}
    assert reports[1] == (("migrated", 3, 3), kept.count())
    assert {f for f in found if f[0] == '"b"'} == {
        ('"b"', "_id", "b"), ('"b"', "n", "1.5"), ('"b"', "big", "9007199254740993"), ('"b"', "ok", "true"), ('"b"', "at", "5"), ('"b"', "o_a", "x")
    }
    rows = {(r.n, str(r.big), r.ok, r.added) for r in read_table(spark, conn, "things").where("id > 1").collect()}
    assert rows == {(None, "None", None, None), (7, "nan", False, "new")}
    with pytest.raises(ValueError, match="folder"):
        append_collection(spark, store_of(tmp_path / "s9", things=first), "things", conn, on_misfit="reject")


def test_a_full_plan_rejects_nothing(spark, tmp_path):
    store = store_of(tmp_path / "s", a=[{"_id": 1, "v": 1}, {"_id": 2, "v": "x"}, {"_id": 3, "v": {"w": 2}}], b=[])
    report = migrate_collections(spark, store, FileTables(str(tmp_path / "t")), rejects=str(tmp_path / "r")).collect()
    assert {(r.source, r.status, r.rejected) for r in report} == {("a", "migrated", 0), ("b", "skipped_empty", 0)}
    assert read_rejects(spark, str(tmp_path / "r")).count() == 0
