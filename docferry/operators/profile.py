"""Profile of a collection: one pass, one row per (path, kind).

The grouping is by path and kind, so partial aggregation leaves a few rows per task
and the shuffle does not grow with the data, however the documents are spread.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.values import convert_column, is_date_text, is_integer_text, is_number_text
from docferry.operators import leaves
from docferry.operators.leaves import at_path, is_nested, kind_of, shape_of, text_of
from docferry.session import remove_path, written

# This many levels in a loop of this many reach the 1,000 that the JSON parser reads at most.
LEVELS = 32
# More members than a relational table may have columns: an object of so many is a map, whose keys are data.
MAX_KEYS = 4096
# A profile of more rows than this is searched for maps where it is and not on the driver.
ROWS_AT_ONCE = 16_384
INT_LIMIT = 2_147_483_647
LONG_LIMIT = 9_223_372_036_854_775_807
# Integers up to here are exact in a double.
DOUBLE_LIMIT = 9_007_199_254_740_992


def with_order(docs: DataFrame, order_by: str, name: str = "ord") -> DataFrame:
    """Add the sort key of each document: numbers by value, then anything else by text, missing last."""
    doc, kind, text = F.col(docs.columns[0]), F.col("_kind"), F.col("_text")
    number = F.when(kind.isin(leaves.INT, leaves.LONG, leaves.DOUBLE, leaves.DECIMAL), text.try_cast("decimal(38,9)"))
    order = F.struct(
        text.isNull().alias("missing"), number.isNull().alias("not_number"), number.alias("number"), text.alias("text")
    )
    staged = docs.select(*docs.columns, at_path(doc, [order_by]).alias("_value"))
    staged = staged.withColumn("_shape", shape_of("_value")).withColumn("_kind", kind_of("_shape"))
    staged = staged.withColumn("_text", text_of("_value", "_kind"))
    return staged.select(*docs.columns, order.alias(name))


def kept_whole(as_json: Iterable[Iterable[str]]) -> Column:
    """Condition on ``path``: one of the objects that stay whole."""
    return reduce(lambda a, b: a | b, (F.col("path") == F.array(*map(F.lit, p)) for p in as_json), F.lit(False))


def _opened(values: Column, as_json: Iterable[Iterable[str]]) -> Column:
    """One level deeper: the members of the objects among ``open`` join ``done``, or ``open`` if they are objects themselves."""

    def is_open(leaf: Column) -> Column:
        path, shape = leaf["path"], leaf["shape"]
        nested = shape.startswith("OBJECT<") & ~shape.startswith("OBJECT<`$") & (shape != "OBJECT<>")
        return reduce(lambda a, b: a & b, (path != F.array(*map(F.lit, p)) for p in as_json), nested)

    def members(leaf: Column) -> Column:
        entries = F.map_entries(F.try_variant_get(leaf["v"], "$", "map<string,variant>"))
        return F.transform(entries, lambda e: F.struct(
            F.array_append(leaf["path"], e["key"]).alias("path"), e["value"].alias("v"), F.schema_of_variant(e["value"]).alias("shape"),
        ))

    # Going through an array evaluates the members once, not once for each of the two lists.
    level = F.array(F.flatten(F.transform(values["open"], members)))
    split = F.transform(level, lambda found: F.struct(
        F.concat(values["done"], F.filter(found, lambda leaf: ~is_open(leaf))).alias("done"), F.filter(found, is_open).alias("open"),
    ))
    return F.element_at(split, 1)


def _to_the_end(values: Column, as_json: Iterable[Iterable[str]], levels: int | None) -> Column:
    """Open level after level while there is something to open; without ``levels``, to the deepest the parser of documents reads."""

    def some(at_most: int, state: Column) -> Column:
        return F.when(F.size(state["open"]) > 0, F.sequence(F.lit(1), F.lit(at_most))).otherwise(F.expr("array()").cast("array<int>"))

    def step(state: Column, _: Column) -> Column:
        return F.when(F.size(state["open"]) > 0, _opened(state, as_json)).otherwise(state)

    if levels is not None:
        return F.aggregate(some(levels, values), values, step)
    return F.aggregate(some(LEVELS, values), values, lambda state, _: F.aggregate(some(LEVELS, state), state, step))


def unfold(
    docs: DataFrame, depth: int | None = None, order_by: str | None = None, as_json: Iterable[Iterable[str]] = ()
) -> DataFrame:
    """One row per leaf: ``path``, ``v`` (variant), ``shape`` and, on request, the document's ``ord``.

    ``docs`` holds one VARIANT column; objects at the paths ``as_json`` are not unfolded. Every top-level member goes as deep as it
    is itself, in one pass: members that are no objects cost nothing at deeper levels. With a ``depth`` objects below stay as they are.
    """
    spark = docs.sparkSession
    doc = F.col(docs.columns[0])
    if not isinstance(docs.schema[0].dataType, T.VariantType):
        raise TypeError("expected documents in one VARIANT column; read_collection(as_variant=True) gives one")
    as_json = [list(p) for p in as_json]
    extra = ", ord" if order_by else ""
    base = docs.select(doc.alias("doc"))
    if order_by:
        base = with_order(base, order_by)
    rows = spark.sql(
        f"SELECT array(e.key) AS path, e.value AS v{extra} FROM {{base}}, LATERAL variant_explode(doc) AS e",
        base=base,
    ).withColumn("shape", shape_of("v"))
    if depth == 1:
        return rows
    more = ["ord"] if order_by else []
    whole = F.array(F.struct("path", "v", "shape"))
    none = F.filter(whole, lambda leaf: F.lit(False))
    found = _to_the_end(F.struct(none.alias("done"), whole.alias("open")), as_json, depth and depth - 1)
    found = F.flatten(F.transform(F.array(found), lambda state: F.concat(state["done"], state["open"])))
    leaves_of = F.when(is_nested("shape") & ~kept_whole(as_json), found).otherwise(whole)
    return rows.select(*more, F.inline(leaves_of)).select("path", "v", *more, "shape")


def measures() -> list[Column]:
    """Aggregates behind sizing and demotion; all fit a hash aggregate with map-side partial sums."""
    kind, text = F.col("type_tag"), F.col("text")
    is_text = kind == leaves.STRING
    return [
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(kind == leaves.NULL).alias("n_null"),
        F.max(F.length(text)).alias("max_chars"),
        F.max(F.col("octets")).alias("max_bytes"),
        F.count_if(F.col("is_wide")).alias("n_wide_int"),
        F.count_if(F.col("is_beyond")).alias("n_beyond_long"),
        F.count_if(F.col("is_inexact")).alias("n_inexact"),
        F.count_if(kind.isin(leaves.DOUBLE, leaves.DECIMAL) & ~is_number_text(text)).alias("n_not_finite"),
        F.max("digits").alias("max_digits"),
        F.max("scale").alias("max_scale"),
        F.count_if(F.when(is_text, ~is_integer_text(text))).alias("n_bad_int"),
        F.count_if(F.when(is_text, ~is_number_text(text))).alias("n_bad_number"),
        F.count_if(F.when(is_text, ~is_date_text(text))).alias("n_bad_date"),
        F.count_if(F.col("is_hoist")).alias("n_hoist"),
    ]


def leaf_rows(
    docs: DataFrame,
    depth: int | None = None,
    order_by: str | None = None,
    wanted: Column | None = None,
    as_json: Iterable[Iterable[str]] = (),
) -> DataFrame:
    """One row per leaf with its kind and text: ``path, type_tag, text, is_hoist`` (and ``ord``).

    ``wanted`` is a condition on ``path``. Filters on the other columns are better avoided: they
    would be pushed below the steps here and repeat their work.
    """
    rows = unfold(docs, depth, order_by, as_json)
    rows = rows if wanted is None else rows.where(wanted)
    rows = rows.withColumn("type_tag", kind_of("shape"))
    if as_json:
        whole = kept_whole(as_json) & F.col("type_tag").isin(leaves.OBJECT, leaves.EMPTY)
        rows = rows.withColumn("type_tag", F.when(whole, leaves.OTHER).otherwise(F.col("type_tag")))
    rows = rows.withColumn("text", text_of("v", "type_tag"))
    hoist = F.when(
        (F.col("type_tag") == leaves.STRING) & (F.size("path") >= 3),
        F.try_element_at("path", F.lit(-2)) == F.col("text"),
    )
    return rows.select("path", "type_tag", "text", F.coalesce(hoist, F.lit(False)).alias("is_hoist"), *(["ord"] if order_by else []))


def profile_documents(
    docs: DataFrame, depth: int | None = None, as_json: Iterable[Iterable[str]] = (), max_keys: int | None = MAX_KEYS
) -> DataFrame:
    """Count and measure every (path, kind) of VARIANT documents, at whatever level they are.

    Columns: ``path`` (array of keys), ``type_tag``, ``n_docs``, ``n_null``, ``max_chars`` and
    ``max_bytes`` of the text form (bytes of the content for binaries), ``n_wide_int`` and
    ``n_beyond_long`` (integers beyond 32 and 64 bits), ``n_inexact`` (integers a double may not hold), ``n_not_finite`` (NaN and infinities), ``max_digits`` and
    ``max_scale`` (digits before and after the decimal point), ``n_bad_int`` / ``n_bad_number`` / ``n_bad_date`` (texts an integer, number or
    datetime column would refuse), ``n_hoist`` (values equal to the key of the object they are in).

    The result is one row per path and kind, already computed. Objects used as maps, whose keys are data, have no end of paths: those
    named in ``as_json``, and those with more than ``max_keys`` different keys, are one value of kind OTHER each, their JSON text. With
    a ``depth`` it is one lazy pass: objects below show as kind OBJECT, and none is looked for.
    """
    if depth is None:
        rows, schema, _ = complete_profile(docs, as_json, max_keys)
        return docs.sparkSession.createDataFrame(rows, schema)
    return _measured(leaf_rows(docs, depth, as_json=as_json))


def _measured(rows: DataFrame) -> DataFrame:
    """The profile of leaves."""
    kind, text = F.col("type_tag"), F.col("text")
    content = F.when(kind == leaves.BINARY, F.octet_length(F.unbase64(text))).otherwise(F.octet_length(text))
    whole = kind.isin(leaves.INT, leaves.LONG) | ((kind == leaves.STRING) & is_integer_text(text))
    exact, is_whole, mantissa = F.col("exact"), F.col("is_whole"), F.col("mantissa")
    number = kind.isin(leaves.INT, leaves.LONG) | (kind.isin(leaves.STRING, leaves.DOUBLE, leaves.DECIMAL) & is_number_text(text))
    # digits of plain and of exponential forms: 1.5E3 has four and none after the point
    exponent = F.when(F.contains(F.lower(text), F.lit("e")), F.coalesce(F.substring_index(F.lower(text), "e", -1).try_cast("int"), F.lit(0))).otherwise(F.lit(0))
    before = F.length(F.ltrim(F.substring_index(mantissa, ".", 1), F.lit("+-0")))
    after = F.when(F.contains(mantissa, F.lit(".")), F.length(F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0")))).otherwise(F.lit(0))
    not_finite = F.when(kind.isin(leaves.DOUBLE, leaves.DECIMAL), F.lit(0))
    rows = rows.withColumns({"is_whole": whole, "mantissa": F.when(number, F.substring_index(F.lower(text), "e", 1))})
    rows = rows.withColumns({"exact": F.when(is_whole, F.abs(text.try_cast("decimal(38,0)"))), "exponent": F.when(mantissa.isNotNull(), exponent)})
    rows = rows.withColumns({
        "octets": content,
        "is_wide": F.when(is_whole, F.coalesce(exact > INT_LIMIT, F.lit(True))),
        "is_beyond": F.when(is_whole, F.coalesce(exact > LONG_LIMIT, F.lit(True))),
        "is_inexact": F.when(is_whole, F.coalesce(exact > DOUBLE_LIMIT, F.lit(True))),
        "digits": F.when(mantissa.isNotNull(), F.greatest(F.lit(0), before + F.col("exponent"))).otherwise(not_finite),
        "scale": F.when(mantissa.isNotNull(), F.greatest(F.lit(0), after - F.col("exponent"))).otherwise(not_finite),
    })
    return rows.groupBy("path", "type_tag").agg(*measures())


def complete_profile(
    docs: DataFrame, as_json: Iterable[Iterable[str]] = (), max_keys: int | None = MAX_KEYS
) -> tuple[list[Row], T.StructType, list[list[str]]]:
    """Rows and schema of the profile to the full depth of the documents, and the objects that stay whole.

    The driver sees few rows: a profile of more than ``ROWS_AT_ONCE`` is written first, and the objects used as maps are found in that
    table. Where there are any, one more pass takes them whole. Documents with more than ``max_keys`` fields of their own fit no table
    and are an error.
    """
    as_json = [list(p) for p in as_json]
    found = _measured(leaf_rows(docs, as_json=as_json))
    rows = found.limit(ROWS_AT_ONCE + 1).collect() if max_keys is not None else found.collect()
    if max_keys is None:
        maps = []
    elif len(rows) <= ROWS_AT_ONCE:
        maps = _maps_among([tuple(r.path) for r in rows], max_keys)
    else:
        kept, path = written(found, "profile")
        maps = map_paths(kept, max_keys)
        rows = [] if maps else kept.collect()
        remove_path(docs.sparkSession, path)
    if [] in maps:
        raise ValueError(f"the documents have more than {max_keys} different fields")
    if maps:
        return complete_profile(docs, as_json + maps, max_keys)
    if any(r.type_tag == leaves.OBJECT for r in rows):
        raise ValueError(f"documents nest deeper than {LEVELS * LEVELS} levels")
    return rows, found.schema, as_json


def _maps_among(paths: list[tuple[str, ...]], max_keys: int) -> list[list[str]]:
    keys: dict[tuple[str, ...], set[str]] = {}
    for path in paths:
        for i, key in enumerate(path):
            keys.setdefault(path[:i], set()).add(key)
    wide = {path for path, found in keys.items() if len(found) > max_keys}
    return sorted(list(path) for path in wide if not any(path[:i] in wide for i in range(len(path))))


def map_paths(profile: DataFrame, max_keys: int = MAX_KEYS) -> list[list[str]]:
    """Objects with more than ``max_keys`` different keys, the outermost only, out of a profile of any size.

    Keys are counted by one aggregate over the rows of the profile. Maps within maps may be as many as the data has keys, so the
    outermost are taken level by level and only these reach the driver: no object around them has more than ``max_keys`` members.
    """
    steps = F.transform(
        F.sequence(F.lit(0), F.size("path") - 1),
        lambda i: F.struct(F.slice("path", F.lit(1), i).alias("parent"), F.element_at("path", i + 1).alias("key")),
    )
    members = profile.select(F.explode(steps).alias("step")).select("step.parent", "step.key").distinct()
    wide, path = written(members.groupBy("parent").agg(F.count("*").alias("n_keys")).where(F.col("n_keys") > max_keys), "maps")
    found: list[list[str]] = []
    left = wide
    while (level := left.agg(F.min(F.size("parent"))).head()[0]) is not None:
        found += [list(r.parent) for r in left.where(F.size("parent") == level).select("parent").collect()]
        if level == 0:
            break
        outside = (F.slice("parent", 1, len(p)) != F.array(*map(F.lit, p)) for p in found)
        left = wide.where(reduce(lambda a, b: a & b, outside, F.size("parent") > level))
    remove_path(profile.sparkSession, path)
    return sorted(found)


def first_values(docs: DataFrame, order_by: str, wanted: Column, as_json: Iterable[Iterable[str]] = ()) -> DataFrame:
    """First leaf of each path among the ``wanted`` ones, by document order: ``path, is_bad, first``.

    ``wanted`` is a condition on ``path``. ``is_bad`` splits values a datetime column would refuse from the others. A minimum over
    structs sorts its input, so ask for the few paths that need it, not for all.
    """
    kind, text = F.col("type_tag"), F.col("text")
    is_date = (kind == leaves.DATE) | ((kind == leaves.STRING) & is_date_text(text))
    bad = ~is_date & ~kind.isin(leaves.NULL, leaves.EMPTY)
    rows = leaf_rows(docs, None, order_by, wanted, as_json).withColumn("is_bad", bad)
    first = F.when(kind != leaves.EMPTY, F.struct("ord", "type_tag", F.length(text).alias("chars"), "is_hoist"))
    return rows.groupBy("path", "is_bad").agg(F.min(first).alias("first")).where("first IS NOT NULL")


def _typed_leaves(schema: T.StructType, col: Column | None = None, path: tuple[str, ...] = ()):
    for f in schema.fields:
        here = F.col("`" + f.name.replace("`", "``") + "`") if col is None else col.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            yield from _typed_leaves(f.dataType, here, (*path, f.name))
        else:
            yield (*path, f.name), here, f.dataType


def typed_kind(data_type: T.DataType) -> str:
    """Leaf kind of a column whose type is already known."""
    kinds = {
        leaves.INT: (T.ByteType, T.ShortType, T.IntegerType),
        leaves.LONG: (T.LongType,),
        leaves.DOUBLE: (T.FloatType, T.DoubleType),
        leaves.DECIMAL: (T.DecimalType,),
        leaves.BOOLEAN: (T.BooleanType,),
        leaves.DATE: (T.TimestampType, T.TimestampNTZType, T.DateType),
        leaves.LIST: (T.ArrayType,),
        leaves.BINARY: (T.BinaryType,),
        leaves.NULL: (T.NullType,),
        leaves.STRING: (T.StringType, T.VarcharType, T.CharType),
    }
    return next((k for k, types in kinds.items() if isinstance(data_type, types)), leaves.OTHER)


def profile_columns(df: DataFrame) -> DataFrame:
    """Profile of typed rows: one aggregate over all leaf columns, same main columns as above.

    Every column has one kind, so nothing is exploded and the pass stays in generated code.
    """
    found = list(_typed_leaves(df.schema))
    aggs, parts = [], []
    for i, (path, col, data_type) in enumerate(found):
        kind = typed_kind(data_type)
        text = col if kind == leaves.BINARY else convert_column(col, data_type).cast("string")
        chars = F.lit(None).cast("int") if kind == leaves.BINARY else F.max(F.length(text))
        aggs += [
            F.count(col).alias(f"n_{i}"),
            chars.alias(f"c_{i}"),
            F.max(F.octet_length(text)).alias(f"b_{i}"),
        ]
        part = F.struct(
            F.array(*map(F.lit, path)).alias("path"),
            F.lit(kind).alias("type_tag"),
            F.col("n_rows").alias("n_docs"),
            (F.col("n_rows") - F.col(f"n_{i}")).alias("n_null"),
            F.col(f"c_{i}").alias("max_chars"),
            F.col(f"b_{i}").alias("max_bytes"),
        )
        parts.append(part)
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    return totals.select(F.inline(F.array(*parts)))
