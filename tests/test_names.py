import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docferry.functions import database_name, normalize_columns, normalize_text, prefix_columns, quote, snake_case

NAMES = {
    "userName": "user_name",
    "HTTPServer": "http_server",
    "My Name": "my__name",
    "ABC": "abc",
    "zip2Code": "zip2_code",
    "fooBarID": "foo_bar_id",
    "_id": "_id",
    "_class": "_class",
    "4-NOT SPECIFIED": "4-not_specified",
    "small ring": "small_ring",
    "aBCd": "a_b_cd",
    "XAbCd": "x_ab_cd",
    "": "",
}


def by_character(name):
    """The naming rule one character at a time."""
    chars = name.replace(" ", "_")
    out = []
    for before, c, after in zip("\n" + chars, chars, chars[1:] + "\n"):
        starts_word = "A" <= c <= "Z" and (
            "a" <= before <= "z" or "0" <= before <= "9" or (before != "\n" and "a" <= after <= "z")
        )
        out.append("_" + c if starts_word else c)
    return "".join(out).lower()


@pytest.mark.parametrize("name,expected", NAMES.items())
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@given(st.text(alphabet="abAB1 _-\n", max_size=12))
def test_snake_case_agrees_character_by_character(name):
    assert snake_case(name) == by_character(name)


def test_text_rule_is_the_name_rule(spark):
    words = list(NAMES) + ["aAbBcC", "Ab Cd", "x9Yz", "AAAa", "a_B", "A1b2C3"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for row in df.select("w", normalize_text("w").alias("n")).collect():
        assert row.n == snake_case(row.w)


def test_database_name_and_quote():
    assert database_name("my-db-1") == "my_db_1"
    assert quote("a`b") == "`a``b`"
    assert quote('a"b', '"') == '"a""b"'


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "userName int, `odd.name` int, `HTTPServer` int")
    assert normalize_columns(df).columns == ["user_name", "odd.name", "http_server"]


def test_collision_is_an_error_unless_last_wins(spark):
    df = spark.createDataFrame([(1, 2, 3)], "userName int, a int, user_name int")
    with pytest.raises(ValueError, match="user_name"):
        normalize_columns(df)
    out = normalize_columns(df, on_collision="last")
    assert out.columns == ["user_name", "a"] and tuple(out.head()) == (3, 2)


def test_columns_that_differ_by_case_collide(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("A"))
    assert normalize_columns(df, on_collision="last").head().a == 2


def test_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert prefix_columns(df, "p").columns == ["p_a", "p_b"]
    assert prefix_columns(df).columns == ["a", "b"]
