import base64
import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docferry.functions import as_text, convert_values
from docferry.operators import align_schemas, flatten, map_fields, pack_documents, prune_metadata, schema_report

NESTED = "_id int, address struct<zipCode:string, geo:struct<lat:double, lon:double>, none:struct<>>, tags array<int>"


def test_flatten_names_and_values(spark):
    df = spark.createDataFrame([(1, ("X", (1.5, None), ()), [1]), (2, None, None)], NESTED)
    flat = flatten(df)
    assert flat.columns == ["_id", "address_zip_code", "address_geo_lat", "address_geo_lon", "tags"]
    assert [tuple(r) for r in flat.orderBy("_id").collect()] == [(1, "X", 1.5, None, [1]), (2, None, None, None, None)]


def test_flatten_is_one_projection(spark):
    df = spark.createDataFrame([(1, ("X", (1.5, None), ()), [1])], NESTED)
    text = flatten(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in text and "Generate" not in text


def test_flatten_keeps_parents_on_request(spark):
    df = spark.createDataFrame([(1, ("X", (1.5, None), ()), [1])], NESTED)
    row = flatten(df, keep_parent=True).head()
    assert json.loads(row.address) == {"zipCode": "X", "geo": {"lat": 1.5, "lon": None}, "none": {}}
    assert row.address_geo_lat == 1.5


def test_flatten_collision(spark):
    df = spark.createDataFrame([(("x",), "y")], "user struct<name:string>, user_name string")
    with pytest.raises(ValueError, match="user_name"):
        flatten(df)
    assert flatten(df, on_collision="last").head().user_name == "y"


def test_flatten_reads_extended_scalars(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id":{"$oid":"abc"},"n":{"$numberLong":"5"},"a":{"b":1}}\n')
    assert flatten(spark.read.json(str(tmp_path))).first().asDict() == {"_id": "abc", "a_b": 1, "n": "5"}


HOIST = "_id int, profile struct<type:struct<a:string, homeTown:string, geo:struct<lat:double>>>"


def test_hoist(spark):
    df = spark.createDataFrame([(1, (("other", "X", (1.5,)),)), (2, (("type", "Y", (2.5,)),))], HOIST)
    assert flatten(df).columns == ["_id", "profile_type_a", "profile_type_home_town", "profile_type_geo_lat"]
    hoisted = ["_id", "profile_a", "profile_home_town", "profile_geo", "profile_geo_lat"]
    assert flatten(df, hoist="any").columns == hoisted
    assert flatten(df, hoist="any").where("_id = 2").head().profile_geo == '{"lat":2.5}'
    assert flatten(df, hoist="sample").columns == flatten(df).columns
    assert flatten(df.where("_id = 2"), hoist="sample").columns == hoisted
    with pytest.raises(ValueError):
        flatten(df, hoist="sometimes")


def test_top_level_objects_are_never_hoisted(spark):
    df = spark.createDataFrame([(1, ("type",))], "_id int, type struct<a:string>")
    assert flatten(df, hoist="any").columns == ["_id", "type_a"]


def test_convert_values(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 7, 179575), [1, None], True, 2.5, "x", (1, None), Decimal("1.50"))],
        "d timestamp_ntz, l array<int>, b boolean, f double, s string, o struct<a:int,b:int>, m decimal(5,2)",
    )
    row = convert_values(df).head()
    assert tuple(row) == ("2024-01-01 00:00:07", "[1,null]", 1, 2.5, "x", '{"a":1,"b":null}', Decimal("1.50"))
    assert convert_values(df.select("b", F.lit(None).alias("n"))).head().n is None


def test_null_text(spark):
    df = spark.createDataFrame([(None, 1), ("x", None)], "s string, i int")
    assert [tuple(r) for r in convert_values(df, null_text="NULL").collect()] == [("NULL", "1"), ("x", "NULL")]


def test_wall_times_do_not_pass_through_a_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 0),)], "d timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert convert_values(df).head().d == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_as_text(spark):
    df = spark.createDataFrame([(1, 1e20, True, None)], "i int, d double, b boolean, n string")
    assert tuple(as_text(df).head()) == ("1", "1.0E20", "true", None)


def test_prune_metadata(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_id int, _class int, a int")
    assert prune_metadata(df).columns == ["_id", "_class", "a"]
    assert prune_metadata(df, skip_id=True).columns == ["_class", "a"]
    assert prune_metadata(df, skip_id=True, skip_class=True).columns == ["a"]


def test_align_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 2.5)], "id int, d double")
    rows = sorted(tuple(r) for r in align_schemas([a, b, spark.range(3, 4)]).select("id", "s", "d").collect())
    assert rows == [(1, "x", None), (2, None, 2.5), (3, None, None)]


def test_pack_keeps_nulls(spark):
    assert pack_documents(spark.createDataFrame([(None, 1)], "a int, b int")).head().document == '{"a":null,"b":1}'


def test_pack_with_types(spark):
    df = spark.createDataFrame(
        [(Decimal("1.50"), 2**40, datetime(2024, 1, 1, 0, 0, 7, 5), bytearray(b"\x00\x01"), None)],
        "m decimal(5,2), l long, t timestamp_ntz, b binary, n decimal(5,2)",
    )
    doc = json.loads(pack_documents(df, typed=True).head().document)
    assert doc == {
        "m": {"$numberDecimal": "1.50"},
        "l": {"$numberLong": str(2**40)},
        "t": {"$date": "2024-01-01T00:00:07.000005Z"},
        "b": {"$binary": {"base64": base64.b64encode(b"\x00\x01").decode(), "subType": "00"}},
        "n": None,
    }


CITIES = (
    "id long, district_id long, name_en string, name_si string, name_ta string, sub_name_en string, sub_name_si string, "
    "sub_name_ta string, postcode string, latitude double, longitude double"
)


def test_map_fields(spark):
    names = [c.split()[0] for c in CITIES.split(", ")]
    df = spark.createDataFrame([(1, 2, "Kandy", "මහනුවර", "கண்டி", None, None, None, "20000", 7.29, 80.63)], CITIES)
    assert map_fields(df, {n: i for i, n in enumerate(names)}).head() == df.head()
    assert map_fields(df, {"province": 1}).columns == ["province"]
    assert tuple(map_fields(df, {"b": 2, "a": 0, "again": 0}).head()) == ("Kandy", 1, 1)
    for wrong in (11, -1):
        with pytest.raises(IndexError):
            map_fields(df, {"x": wrong})


def test_map_fields_by_position_when_names_repeat(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("A"))
    assert tuple(map_fields(df, {"x": 1, "y": 0}).head()) == (2, 1)


def test_schema_report(spark):
    df = spark.createDataFrame([], "a int, b struct<c:string>")
    assert [tuple(r) for r in schema_report(df).collect()] == [
        (0, "a", "int"),
        (1, "b", "struct<c:string>"),
        (2, "b.c", "string"),
    ]
