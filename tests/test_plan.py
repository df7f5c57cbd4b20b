"""Profile, plan and rows of schemaless documents."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docferry.operators import profile
from docferry.operators.profile import map_paths, profile_documents
from docferry.plans import apply_plan, collect_profile, diff_schema, infer_plan, plan_columns, plan_documents, reject_rows, render_additions, render_ddl

OID = "64b000000000000000000%03x"


def person(i, **more):
    return json.dumps({"_id": {"$oid": OID % i}, **more})


PEOPLE = [
    person(
        1,
        _class="Person",
        userName="A" * 25,
        age=30,
        score=1.5,
        visits={"$numberLong": "5"},
        active=True,
        joinedAt={"$date": "2024-01-01T00:00:07.179Z"},
        tags=[1, 2],
        photo={"$binary": {"base64": "AAEC", "subType": "00"}},
        note=None,
        address={"zipCode": "X", "geo": {"lat": 1.5, "lon": 2.5}},
    ),
    person(2, userName="Ünï" * 20, age="n/a", active=False, tags=[{"a": 1}], note="hi", address={}),
    person(3, age=3_000_000_000, extraField="new", joinedAt={"$date": {"$numberLong": "1704067207999"}}, tags=[]),
    json.dumps({"_id": "plain", "score": {"$numberDecimal": "2.25"}, "joinedAt": "soon", "amount": 7}),
]


def types(plan):
    return {r["column"]: r.sql_type for r in plan.collect()}


def test_profile_counts_every_path_and_kind(docs_of):
    rows = {(".".join(r.path), r.type_tag): r for r in profile_documents(docs_of(PEOPLE)).collect()}
    assert rows["_id", "OBJECT_ID"].n_docs == 3 and rows["_id", "OBJECT_ID"].max_chars == 24
    assert rows["_id", "STRING"].max_chars == 5
    assert rows["userName", "STRING"].n_docs == 2
    assert rows["userName", "STRING"].max_chars == 60 and rows["userName", "STRING"].max_bytes == 100
    assert rows["age", "INT"].n_docs == 2 and rows["age", "INT"].n_wide_int == 1
    assert rows["age", "STRING"].n_bad_int == 1
    assert rows["score", "DOUBLE"].n_docs == 1 and rows["score", "DECIMAL"].n_docs == 1
    assert rows["visits", "LONG"].n_docs == 1
    assert rows["active", "BOOLEAN"].n_docs == 2
    assert rows["joinedAt", "DATE"].n_docs == 2 and rows["joinedAt", "STRING"].n_bad_date == 1
    assert rows["tags", "LIST"].n_docs == 3
    assert rows["photo", "BINARY"].max_bytes == 3
    assert rows["note", "NULL"].n_null == 1
    assert rows["address.geo.lat", "DOUBLE"].n_docs == 1
    assert rows["address", "EMPTY"].n_docs == 1
    assert ("address", "OBJECT") not in rows


def test_full_plan_types_from_all_documents(docs_of):
    plan = plan_documents(docs_of(PEOPLE))
    assert types(plan) == {
        "id": "INT",
        "_class": "VARCHAR(25)",
        "_id": "VARCHAR(25)",
        "active": "BOOLEAN",
        "address_geo_lat": "DOUBLE",
        "address_geo_lon": "DOUBLE",
        "address_zip_code": "VARCHAR(25)",
        "age": "VARCHAR(25)",
        "amount": "INT",
        "extra_field": "VARCHAR(25)",
        "joined_at": "VARCHAR(25)",
        "note": "VARCHAR(25)",
        "photo": "BLOB",
        "score": "DECIMAL(38, 3)",
        "tags": "TEXT",
        "user_name": "VARCHAR(75)",
        "visits": "BIGINT",
    }


def test_sample_plan_starts_from_the_first_document(docs_of):
    plan = plan_documents(docs_of(PEOPLE), "sample")
    assert types(plan) == {
        "id": "INT",
        "_class": "TEXT",
        "_id": "VARCHAR(24)",
        "active": "BOOLEAN",
        "address_geo_lat": "FLOAT",
        "address_geo_lon": "FLOAT",
        "address_zip_code": "VARCHAR(25)",
        "age": "VARCHAR(25)",
        "amount": "INT",
        "extra_field": "VARCHAR(25)",
        "joined_at": "VARCHAR(25)",
        "note": "TEXT",
        "photo": "BLOB",
        "score": "DECIMAL(38, 3)",
        "tags": "TEXT",
        "user_name": "VARCHAR(100)",
        "visits": "BIGINT",
    }


def test_sample_mode_types_added_fields_by_their_converted_value(docs_of):
    docs = docs_of(
        [
            person(1, a=1),
            person(2, when={"$date": "2024-01-01T00:00:00Z"}, flag=True, gone=None, many=[1, 2, 3], ref={"$oid": "a" * 24}),
        ]
    )
    got = types(plan_documents(docs, "sample"))
    assert got["when"] == "VARCHAR(25)" and got["flag"] == "INT" and got["gone"] == "VARCHAR(25)"
    assert got["many"] == "VARCHAR(25)" and got["ref"] == "VARCHAR(25)"


EVOLUTION = [
    (1, "n/a", "VARCHAR(25)"),
    (1, "x" * 30, "VARCHAR(50)"),
    (1, 2_147_483_648, "BIGINT"),
    (1, 2_147_483_647, "INT"),
    (1, "77", "INT"),
    (1, 1.5, "FLOAT"),
    (1.5, "2.25", "FLOAT"),
    (1.5, "x", "VARCHAR(25)"),
    (True, 5, "INT"),
    ({"$date": "2024-01-01T00:00:00Z"}, "x" * 30, "VARCHAR(50)"),
    ({"$date": "2024-01-01T00:00:00Z"}, "soon", "VARCHAR(25)"),
    ({"$date": "2024-01-01T00:00:00Z"}, "2024-02-03 04:05:06", "DATETIME"),
    ("x" * 10, "y" * 60, "VARCHAR(100)"),
    ("x" * 10, "y" * 801, "TEXT"),
    ("x" * 10, "é" * 40_000, "MEDIUMTEXT"),
    (None, "x", "TEXT"),
]


def test_sample_evolution(docs_of):
    docs = docs_of([person(i, **{f"f{n}": case[i - 1] for n, case in enumerate(EVOLUTION)}) for i in (1, 2)])
    got = types(plan_documents(docs, "sample"))
    assert [got[f"f{n}"] for n in range(len(EVOLUTION))] == [case[2] for case in EVOLUTION]


def test_null_text_demotes_as_any_bad_value(docs_of):
    docs = docs_of([person(1, n=1, s="abc"), person(2, n=None, s=None)])
    plan = plan_documents(docs, "sample", null_text="NULL")
    assert types(plan)["n"] == "VARCHAR(25)"
    rows = sorted(apply_plan(docs, plan, "NULL").select("n", "s").collect())
    assert [tuple(r) for r in rows] == [("1", "abc"), ("NULL", "NULL")]
    assert types(plan_documents(docs, "sample"))["n"] == "INT"


def test_rows_of_the_planned_table(docs_of):
    docs = docs_of(PEOPLE)
    rows = {r._id: r for r in apply_plan(docs, plan_documents(docs)).collect()}
    one = rows[OID % 1]
    assert one.user_name == "A" * 25 and one.age == "30" and one.score == Decimal("1.500") and one.visits == 5
    assert one.active is True and one.joined_at == "2024-01-01 00:00:07" and json.loads(one.tags) == [1, 2]
    assert bytes(one.photo) == b"\x00\x01\x02" and one.note is None
    assert (one.address_zip_code, one.address_geo_lat) == ("X", 1.5)
    three = rows[OID % 3]
    assert three.age == "3000000000" and three.joined_at == "2024-01-01 00:00:07" and three.extra_field == "new"
    plain = rows["plain"]
    assert plain.joined_at == "soon" and plain.score == Decimal("2.250") and plain.amount == 7


def test_dates_keep_utc_wall_time_in_any_session_zone(spark, docs_of):
    docs = docs_of([person(1, d={"$date": "2024-03-10T02:30:00.9Z"}), person(2, d={"$date": "2024-03-10T09:30:00.9+07:00"})])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = apply_plan(docs, plan_documents(docs)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {r.d for r in rows} == {datetime(2024, 3, 10, 2, 30)}


def test_fields_that_differ_by_case_or_hold_odd_characters(docs_of):
    docs = docs_of([json.dumps({"_id": 1, "a.b": 1, "it's": 2, "what?": 3, "x": {"y.z": 4, "": 5}})])
    row = apply_plan(docs, plan_documents(docs)).head()
    assert row.asDict() == {"_id": 1, "a.b": 1, "it's": 2, "what?": 3, "x_y.z": 4, "x_": 5}


def test_collision(docs_of):
    docs = docs_of([person(1, userName="a"), person(2, user_name="b"), person(3, userName="c", user_name="d")])
    with pytest.raises(ValueError, match="user_name"):
        plan_documents(docs)
    rows = apply_plan(docs, plan_documents(docs, on_collision="last")).collect()
    assert sorted(r.user_name for r in rows) == ["a", "b", "d"]


def test_deep_nesting_is_followed_to_the_end(docs_of):
    inner = {"leaf": 1}
    for _ in range(20):
        inner = {"k": inner}
    docs = docs_of([json.dumps({"_id": 1, **inner})])
    assert "OBJECT" in {r.type_tag for r in profile_documents(docs, 6).collect()}
    plan = plan_documents(docs)
    assert "_".join(["k"] * 20 + ["leaf"]) in types(plan)
    assert apply_plan(docs, plan).head()[1] == 1 or apply_plan(docs, plan).head()[0] == 1


HOIST = {"_id": 1, "profile": {"type": {"a": "type", "homeTown": "X", "geo": {"lat": 1.5}}}}


def test_hoist(docs_of):
    docs = docs_of([json.dumps(HOIST), json.dumps({"_id": 2, "profile": {"type": {"a": "other"}}})])
    got = types(plan_documents(docs, "sample", hoist="sample"))
    assert got == {
        "id": "INT",
        "_id": "INT",
        "profile_a": "VARCHAR(25)",
        "profile_home_town": "VARCHAR(25)",
        "profile_geo": "VARCHAR(255)",
        "profile_geo_lat": "FLOAT",
    }
    plan = plan_documents(docs, hoist="any")
    first = apply_plan(docs, plan).where("_id = 1").head()
    assert first.profile_geo == '{"lat":1.5}' and first.profile_geo_lat == 1.5 and first.profile_a == "type"
    never = set(types(plan_documents(docs)))
    assert never == {"id", "_id", "profile_type_a", "profile_type_home_town", "profile_type_geo_lat"}


def test_sample_decides_the_hoist(docs_of):
    docs = docs_of([json.dumps({"_id": 0, "profile": {"type": {"a": "other"}}}), json.dumps(HOIST)])
    assert "profile_type_a" in types(plan_documents(docs, "sample", hoist="sample"))
    assert "profile_a" in types(plan_documents(docs, "sample", hoist="any"))


def test_keep_parent(docs_of):
    docs = docs_of([person(1, address={"zip": "X"}), person(2, address="at home")])
    plan = plan_documents(docs, keep_parent=True)
    rows = {r._id: r for r in apply_plan(docs, plan).collect()}
    assert rows[OID % 1].address == '{"zip":"X"}' and rows[OID % 1].address_zip == "X"
    assert rows[OID % 2].address == "at home" and rows[OID % 2].address_zip is None


def test_scalar_where_others_have_an_object(docs_of):
    docs = docs_of([person(1, address={"zip": "X"}), person(2, address="at home")])
    rows = {r._id: r for r in apply_plan(docs, plan_documents(docs)).collect()}
    assert rows[OID % 1].address is None and rows[OID % 2].address == "at home"


@pytest.mark.parametrize("doc,has_key", [({"a": 1}, True), ({"id": 1}, False), ({"ID": 1}, False), ({"id": {"a": 1}}, True)])
def test_surrogate_key_only_without_an_id(docs_of, doc, has_key):
    plan = plan_documents(docs_of([json.dumps({"_id": 1, **doc})]))
    assert ("key" in {r.role for r in plan.collect()}) is has_key


def test_ddl(docs_of):
    plan = plan_documents(docs_of([json.dumps({"_id": 1, "userName": "x", "odd`name": 2.5})]), "sample")
    assert render_ddl(plan, "people") == (
        "CREATE TABLE IF NOT EXISTS `people` (`id` INT AUTO_INCREMENT PRIMARY KEY, `_id` INT, "
        "`odd``name` FLOAT, `user_name` VARCHAR(25));"
    )


def test_blob_that_cannot_grow(docs_of):
    docs = docs_of([person(1, b={"$binary": {"base64": "QUFB" * 22_000, "subType": "00"}})])
    with pytest.raises(ValueError, match="BLOB"):
        plan_documents(docs)


def test_rejected_rows_under_an_older_plan(docs_of):
    plan = plan_documents(docs_of([person(1, n=1, d={"$date": "2024-01-01T00:00:00Z"}, s="x")]))
    later = docs_of([person(2, n=2, d="2024-05-06", s=5), person(3, n="n/a", d="soon"), person(4, n=None)])
    rows = reject_rows(later, plan).collect()
    assert {(r["column"], r["value"]) for r in rows} == {("n", "n/a"), ("d", "soon")} and len(rows) == 2
    assert reject_rows(later, plan_documents(later)).count() == 0


def test_diff_schema(docs_of, spark):
    plan = plan_documents(docs_of([person(1, a=1)]))
    added = diff_schema(plan, docs_of([person(2, a=1, newField="x", more={"deep": True})]))
    assert render_additions(added, "t") == [
        "ALTER TABLE `t` ADD COLUMN `more_deep` BOOLEAN;",
        "ALTER TABLE `t` ADD COLUMN `new_field` VARCHAR(25);",
    ]
    typed = spark.createDataFrame([(1, "x" * 30)], "a int, wide string")
    assert [tuple(r) for r in diff_schema(plan, typed).collect()] == [("wide", "VARCHAR(50)")]


def test_plan_of_typed_rows(spark):
    df = spark.createDataFrame(
        [(1, 2, "x" * 60, 1.5, True, datetime(2024, 1, 1), [1], Decimal("1.5"), None)],
        "a int, b long, c string, d double, e boolean, f timestamp_ntz, g array<int>, h decimal(10,2), i string",
    )
    assert [t for t in types(plan_columns(df)).values()] == [
        "INT", "INT", "BIGINT", "VARCHAR(75)", "DOUBLE", "BOOLEAN", "DATETIME", "TEXT", "DECIMAL(38, 3)", "TEXT",
    ]


def test_objects_used_as_maps_stay_whole(docs_of):
    docs = docs_of([json.dumps({"_id": i, "by": {f"k{i}": {"n": i}}, "o": {"m": {}}}) for i in range(30)])
    plan = plan_documents(docs, as_json=["by", "o.m"])
    assert types(plan) == {"id": "INT", "_id": "INT", "by": "VARCHAR(255)", "o_m": "VARCHAR(255)"}
    rows = {r._id: (json.loads(r.by), r.o_m) for r in apply_plan(docs, plan).collect()}
    assert rows == {i: ({f"k{i}": {"n": i}}, "{}") for i in range(30)}
    assert len(types(plan_documents(docs))) == 32


def test_objects_used_as_maps_are_found(docs_of, monkeypatch):
    lines = [json.dumps({"_id": i, "by": {f"k{i}": {f"n{i}": i}}, "o": {"m": {f"x{i}": {f"y{j}": 1 for j in range(9)}}, "few": {"a": i}}}) for i in range(30)]
    docs = docs_of(lines)
    for rows_at_once in (16_384, 8):  # on the driver, and in a table of the profile
        monkeypatch.setattr(profile, "ROWS_AT_ONCE", rows_at_once)
        plan = plan_documents(docs, max_keys=8)
        assert types(plan) == {"id": "INT", "_id": "INT", "by": "VARCHAR(255)", "o_few_a": "INT", "o_m": "VARCHAR(255)"}
        rows = {r._id: (json.loads(r.by), json.loads(r.o_m)) for r in apply_plan(docs, plan).collect()}
        assert rows == {d["_id"]: (d["by"], d["o"]["m"]) for d in map(json.loads, lines)}
        with pytest.raises(ValueError, match="more than 2 different fields"):
            plan_documents(docs, max_keys=2)
    found = profile_documents(docs, 9)
    assert map_paths(found, 8) == [["by"], ["o", "m"]] and map_paths(found, 30) == [["o", "m"]][:0]
    assert len(types(plan_documents(docs, max_keys=None))) == 2 + 30 + 1 + 30 * 9


def test_members_deepen_one_by_one(docs_of):
    """Empty objects, Extended JSON, nulls, arrays and odd keys at several levels of one document; no level is unfolded for leaves."""
    doc = {"a": 1, "b": {"c": {"d": {}, "e.f": None, "g`": {"$oid": "7"}}, "h": [{"x": 1}]}, "i": {}, "j": {"$date": "2024-01-01T00:00:00Z"}}
    docs = docs_of([json.dumps(doc)])
    rows = {(tuple(r.path), r.type_tag) for r in profile_documents(docs).collect()}
    assert rows == {
        (("a",), "INT"), (("b", "c", "d"), "EMPTY"), (("b", "c", "e.f"), "NULL"), (("b", "c", "g`"), "OBJECT_ID"),
        (("b", "h"), "LIST"), (("i",), "EMPTY"), (("j",), "DATE"),
    }
    cut = {(tuple(r.path), r.type_tag) for r in profile_documents(docs, 2).collect()}
    assert (("b", "c"), "OBJECT") in cut and (("b", "h"), "LIST") in cut
    assert profile.unfold(docs)._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 2


def test_deep_documents_are_profiled_to_the_end(docs_of):
    deep = {"v": 1}
    for k in range(300):
        deep = {f"l{k}": deep}
    rows = profile_documents(docs_of([json.dumps(deep)])).collect()
    assert [(len(r.path), r.type_tag) for r in rows] == [(301, "INT")]


@pytest.mark.parametrize(
    ("values", "sql_type"),
    [
        (["1", '"99999999999999999999"'], "DECIMAL(38, 0)"),
        (["1", '"' + "9" * 39 + '"'], "VARCHAR(50)"),
        (["9007199254740993", "1.5"], "DECIMAL(38, 1)"),
        (["9007199254740992", "1.5"], "DOUBLE"),
        (['{"$numberDecimal": "0.00001"}', "1.5E10"], "DECIMAL(38, 5)"),
        (['{"$numberDecimal": "1E-40"}', "1"], "VARCHAR(25)"),
        (['{"$numberDecimal": "1.5"}'], "DECIMAL(38, 3)"),
        (["9223372036854775807", "1"], "BIGINT"),
        (["9223372036854775808", "1"], "DECIMAL(38, 3)"),
    ],
)
def test_numbers_keep_every_digit(docs_of, values, sql_type):
    from decimal import Decimal as D

    docs = docs_of([f'{{"_id": {i}, "v": {v}}}' for i, v in enumerate(values)])
    plan = plan_documents(docs)
    assert types(plan)["v"] == sql_type
    exact = [D(v.replace('{"$numberDecimal": ', "").strip('"}')) for v in values]
    assert [D(str(r.v)) for r in apply_plan(docs, plan).orderBy("_id").collect()] == exact
    assert reject_rows(docs, plan).count() == 0


def test_profile_needs_no_python_and_shuffles_partial_sums(docs_of):
    df = profile_documents(docs_of(PEOPLE), 6)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "partial_max" in text


def test_infer_plan_refuses_a_sample_without_order(docs_of):
    with pytest.raises(ValueError, match="order_by"):
        infer_plan(collect_profile(docs_of(PEOPLE)), "sample")


def test_lone_pass_over_all_rows(spark, docs_of):
    docs = docs_of(PEOPLE)
    assert apply_plan(docs, plan_documents(docs)).select(F.count("*")).head()[0] == len(PEOPLE)
