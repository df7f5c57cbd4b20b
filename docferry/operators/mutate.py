"""Finds, updates and deletes of a document store, as whole-table operations.

A DataFrame is not changed in place: each change gives the collection after it, and the
matching count function says how many documents it touched. :func:`docferry.sources.replace_collection`
puts the result in the store.

Frames of typed columns and documents as stored (one VARIANT column) are treated alike: names are fields of
the document, dotted names fields of objects in it. Values in documents keep their kind, so 5 is not "5" and true is not 1.
"""

from __future__ import annotations

import datetime
import decimal
import json
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.values import field
from docferry.operators.joins import join_unique
from docferry.operators.leaves import EXTENDED_KINDS, INT, LONG, DOUBLE, DECIMAL, at_path, member
from docferry.operators.profile import with_order

ID_FIELD = "_id"
_FLAG = "_matched"
#: Equal rows that a task unfolds at a time.
COPIES = 100_000
EXTENDED_NUMBERS = [key for key, kind in EXTENDED_KINDS.items() if kind in (INT, LONG, DOUBLE, DECIMAL)]


def _is_stored(df: DataFrame) -> bool:
    """Documents as stored: one VARIANT column."""
    return len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType)


def _lookup(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    """Column and type of a dotted field; a missing field is an untyped NULL."""
    if _is_stored(df):
        parts = path.split(".")
        parts = parts[1:] if parts[0] == df.columns[0] and len(parts) > 1 else parts
        return at_path(field(df.columns[0]), parts), T.VariantType()
    col, data_type = None, df.schema
    for part in path.split("."):
        if isinstance(data_type, T.StructType) and part in data_type.names:
            col = field(part) if col is None else col.getField(part)
            data_type = data_type[part].dataType
        elif isinstance(data_type, T.VariantType) and col is not None:
            col = at_path(col, [part])
        else:
            return F.lit(None), T.NullType()
    return col, data_type


def _scalar(col: Column, value: Any) -> Column:
    """A variant read as the type of ``value``; NULL if it is of another kind."""
    shape = F.schema_of_variant(col)
    if isinstance(value, bool):
        return F.when(shape == "BOOLEAN", F.try_variant_get(col, "$", "boolean"))
    if isinstance(value, (int, float)):
        as_type = "double" if isinstance(value, float) else "decimal(38,9)"
        plain = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
        wrapped = [member(col, k, "string").try_cast(as_type) for k in EXTENDED_NUMBERS]
        return F.coalesce(F.when(plain, F.try_variant_get(col, "$", as_type)), *wrapped)
    return F.when(shape == "STRING", F.try_variant_get(col, "$", "string"))


def _holds(col: Column, value: Any, test: Callable[[Column], Column]) -> Column:
    """Whether a variant, or a member of the list it is, passes a comparison with ``value``."""
    members = F.when(F.schema_of_variant(col).startswith("ARRAY"), F.try_variant_get(col, "$", "array<variant>"))
    either = F.coalesce(test(_scalar(col, value)), F.lit(False))
    return either | F.coalesce(F.exists(members, lambda m: F.coalesce(test(_scalar(m, value)), F.lit(False))), F.lit(False))


def _same_kind(data_type: T.DataType, value: Any) -> bool:
    """Whether a typed column can hold a value like ``value`` at all; times and dates may be given as text."""
    if isinstance(data_type, T.ArrayType):
        return _same_kind(data_type.elementType, value)
    if isinstance(value, bool):
        return isinstance(data_type, T.BooleanType)
    if isinstance(value, (int, float, decimal.Decimal)):
        return isinstance(data_type, T.NumericType)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(value, str):
        return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType, *times))
    if isinstance(value, datetime.date):
        return isinstance(data_type, times)
    return True


def _equals(col: Column, data_type: T.DataType, value: Any) -> Column:
    """Equality as a document store means it: null also matches a missing field, a list its members."""
    if value is None:
        return F.is_variant_null(col) | col.isNull() if isinstance(data_type, T.VariantType) else col.isNull()
    if isinstance(data_type, T.ArrayType) and not isinstance(value, (list, tuple)):
        if not _same_kind(data_type, value):
            return F.lit(False)
        return F.coalesce(F.array_contains(col, value), F.lit(False))
    if isinstance(data_type, T.VariantType):
        if isinstance(value, (list, tuple)):
            return F.coalesce(F.to_json(col) == F.to_json(F.parse_json(F.lit(json.dumps(value)))), F.lit(False))
        return _holds(col, value, lambda c: c == F.lit(value))
    if isinstance(value, (list, tuple)):
        return F.coalesce(col == F.array(*map(F.lit, value)), F.lit(False))
    return _compared(col, data_type, value, lambda c, v: c == v)


def _compared(col: Column, data_type: T.DataType, value: Any, test: Callable[[Column, Column], Column]) -> Column:
    """A comparison with a value of the column's kind; no value matches one of another kind, and text that is no time no time."""
    if not _same_kind(data_type, value):
        return F.lit(False)
    wanted = F.lit(value)
    if isinstance(value, str) and not isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        wanted = wanted.try_cast(data_type)
    return test(col, wanted)


def _condition(df: DataFrame, path: str, operator: str, value: Any) -> Column:
    col, data_type = _lookup(df, path)
    compare = {
        "$gt": lambda c: c > F.lit(value),
        "$gte": lambda c: c >= F.lit(value),
        "$lt": lambda c: c < F.lit(value),
        "$lte": lambda c: c <= F.lit(value),
    }
    if operator in compare:
        if isinstance(data_type, T.VariantType):
            return _holds(col, value, compare[operator])
        if isinstance(data_type, T.ArrayType):
            return F.exists(col, compare[operator]) if _same_kind(data_type, value) else F.lit(False)
        return compare[operator](col) if _same_kind(data_type, value) else F.lit(False)
    if operator == "$eq":
        return _equals(col, data_type, value)
    if operator == "$ne":
        return ~F.coalesce(_equals(col, data_type, value), F.lit(False))
    if operator == "$in":
        if value and not isinstance(data_type, (T.ArrayType, T.VariantType)) and None not in value:
            alike = [v for v in value if _same_kind(data_type, v)]
            return col.isin(*alike) if alike else F.lit(False)
        return reduce(lambda a, b: a | b, [_equals(col, data_type, v) for v in value], F.lit(False))
    if operator == "$exists":
        return col.isNotNull() if value else col.isNull()
    raise ValueError(f"unknown query operator {operator!r}")


def matches(df: DataFrame, query: dict[str, Any]) -> Column:
    """Condition of a query document: equality on dotted fields and
    ``$gt $gte $lt $lte $eq $ne $in $exists $and $or``."""
    parts = []
    for name, wanted in query.items():
        if name in ("$and", "$or"):
            join = (lambda a, b: a & b) if name == "$and" else (lambda a, b: a | b)
            parts.append(reduce(join, [matches(df, q) for q in wanted]))
        elif name.startswith("$"):
            raise ValueError(f"unknown query operator {name!r}")
        elif isinstance(wanted, dict) and wanted and all(k.startswith("$") for k in wanted):
            parts += [_condition(df, name, op, v) for op, v in wanted.items()]
        else:
            parts.append(_equals(*_lookup(df, name), wanted))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def find(df: DataFrame, query: dict[str, Any] | None = None) -> DataFrame:
    """Documents that match; an empty query matches all."""
    return df.where(matches(df, query)) if query else df


def _flagged(df: DataFrame, query: dict[str, Any], first_only: bool, order_by: str | list[str]) -> DataFrame:
    """``df`` with a flag on the rows a change applies to.

    The first match is the first by ``order_by``; matches that tie in it are told apart by a hash of the whole
    document, and of documents equal in all fields one is taken. It is found as a top-1 and joined back by broadcast.
    """
    match = F.coalesce(matches(df, query), F.lit(False))
    if not first_only:
        return df.withColumn(_FLAG, match)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    as_text = F.to_json(F.struct(*map(field, df.columns)), {"ignoreNullFields": "false"})
    if _is_stored(df):
        known = reduce(lambda d, i: with_order(d, order_by[i], f"_order_{i}"), range(len(order_by)), df)
    else:
        known = df.select("*", *(field(c).alias(f"_order_{i}") for i, c in enumerate(order_by)))
    # only rows that match are written as text, and only their hashes are compared before that
    marked = known.select(
        *map(field, df.columns), F.struct(*(f"_order_{i}" for i in range(len(order_by)))).alias("_order"), match.alias("_match"), F.when(match, F.xxhash64(as_text)).alias("_whole")
    )
    first = marked.where("_match").orderBy("_order", "_whole").limit(1)
    first = first.select(F.col("_order").alias("_first"), F.col("_whole").alias("_one"), as_text.alias("_text"))
    same = F.col("_match") & F.col("_order").eqNullSafe(F.col("_first")) & (F.col("_whole") == F.col("_one"))
    joined = marked.join(F.broadcast(first), same, "left").select(*map(field, df.columns), (F.col("_one").isNotNull() & (as_text == F.col("_text"))).alias("_same"))
    rest = joined.where("NOT _same").drop("_same").withColumn(_FLAG, F.lit(False))
    return rest.unionByName(_one_of_equal(joined.where("_same").drop("_same")))


def _one_of_equal(rows: DataFrame) -> DataFrame:
    """Rows that are all equal, the first of them flagged: counted where they are, then unfolded in chunks over many tasks."""
    n_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = rows.agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*map(field, rows.columns))).alias("_row")).where("_n > 0")
    chunks = one.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
    places = F.sequence("_start", F.least(F.col("_start") + COPIES, F.col("_n")) - 1)
    unfolded = chunks.repartition(n_tasks, "_start").select("_row", F.explode(places).alias("_place"))
    return unfolded.select(*(F.col("_row").getField(c).alias(c) for c in rows.columns), (F.col("_place") == 0).alias(_FLAG))


def _assign(df: DataFrame, name: str, value: Any) -> Column:
    """The new value in the type the field has, if it is there already."""
    known = _lookup(df, name)[1]
    return F.lit(value) if isinstance(known, (T.NullType, T.VariantType)) else F.lit(value).cast(known)


def _set_member(doc: Column, path: list[str], value: Any) -> Column:
    """A stored document with one member set, the objects on the way made where they are missing."""
    members = F.coalesce(F.try_variant_get(doc, "$", "map<string,variant>"), F.expr("CAST(map() AS map<string,variant>)"))
    inner = _set_member(F.try_element_at(members, F.lit(path[0])), path[1:], value) if path[1:] else F.parse_json(F.lit(json.dumps(value)))
    others = F.map_filter(members, lambda k, _: k != path[0])
    return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(path[0]), inner)))


def _changed(df: DataFrame, changes: dict[str, Any]) -> dict[str, Column]:
    """Top-level columns after setting the fields; a dotted name sets a member of an object."""
    new: dict[str, Column] = {}
    if _is_stored(df):
        top = df.columns[0]
        paths = {name: name.split(".") for name in changes}
        paths = {name: p[1:] if p[0] == top and len(p) > 1 else p for name, p in paths.items()}
        return {top: reduce(lambda doc, name: _set_member(doc, paths[name], changes[name]), changes, field(top))}
    for name, value in changes.items():
        top, _, inner = name.partition(".")
        if name in df.columns or not inner:
            new[name] = _assign(df, name, value)
            continue
        if top not in df.columns or not isinstance(df.schema[top].dataType, T.StructType):
            raise ValueError(f"{name!r} is no member of an object")
        whole = new.get(top, field(top))
        new[top] = F.coalesce(whole, F.from_json(F.lit("{}"), df.schema[top].dataType)).withField(inner, _assign(df, name, value))
    return new


def update(
    df: DataFrame,
    query: dict[str, Any],
    changes: dict[str, Any],
    first_only: bool = True,
    order_by: str | list[str] = ID_FIELD,
) -> DataFrame:
    """The collection after setting fields on the first match (or on all); a new field is added."""
    flagged = _flagged(df, query, first_only, order_by)
    new = {
        name: F.when(F.col(_FLAG), value).otherwise(field(name) if name in df.columns else F.lit(None))
        for name, value in _changed(df, changes).items()
    }
    kept = [new.get(c, field(c)).alias(c) for c in df.columns]
    return flagged.select(*kept, *(c.alias(n) for n, c in new.items() if n not in df.columns))


def modified_count(
    df: DataFrame,
    query: dict[str, Any],
    changes: dict[str, Any],
    first_only: bool = True,
    order_by: str | list[str] = ID_FIELD,
) -> int:
    """How many documents an update changes; a match that already holds the values does not count."""
    differs = F.lit(False)
    for name, value in changes.items():
        now, data_type = _lookup(df, name)
        if isinstance(data_type, T.VariantType):
            same = F.to_json(now).eqNullSafe(F.to_json(F.parse_json(F.lit(json.dumps(value)))))
        else:
            same = F.lit(False) if isinstance(data_type, T.NullType) else now.eqNullSafe(_assign(df, name, value))
        differs = differs | ~same
    flagged = _flagged(df, query, first_only, order_by)
    return flagged.where(F.col(_FLAG) & differs).count()


def delete(
    df: DataFrame, query: dict[str, Any], first_only: bool = True, order_by: str | list[str] = ID_FIELD
) -> DataFrame:
    """The collection without the first match (or without all)."""
    return _flagged(df, query, first_only, order_by).where(~F.col(_FLAG)).drop(_FLAG)


def deleted_count(
    df: DataFrame, query: dict[str, Any], first_only: bool = True, order_by: str | list[str] = ID_FIELD
) -> int:
    """How many documents a delete removes."""
    return _flagged(df, query, first_only, order_by).where(F.col(_FLAG)).count()


def apply_patches(
    df: DataFrame, patches: DataFrame, key: str | list[str], order_by: str | None = None
) -> DataFrame:
    """Set fields on many documents at once: one patch row per key, NULL leaves a field alone.

    Several patches of one key are folded field by field, the last non-NULL by ``order_by`` wins
    (without it the greatest value).
    """
    key = [key] if isinstance(key, str) else list(key)
    changed = [c for c in patches.columns if c not in (*key, order_by)]
    pick = (lambda c: F.max_by(field(c), F.when(field(c).isNotNull(), field(order_by)))) if order_by else (lambda c: F.max(field(c)))
    folded = patches.groupBy(*map(field, key)).agg(*(pick(c).alias(f"_new_{i}") for i, c in enumerate(changed)))
    joined = join_unique(df, folded, key, "left")
    new = {c: F.col(f"_new_{i}") for i, c in enumerate(changed)}
    kept = [(F.coalesce(new[c], field(c)) if c in new else field(c)).alias(c) for c in df.columns]
    return joined.select(*kept, *(new[c].alias(c) for c in changed if c not in df.columns))


def delete_keys(df: DataFrame, keys: DataFrame, key: str | list[str]) -> DataFrame:
    """The collection without the documents whose key is listed."""
    key = [key] if isinstance(key, str) else list(key)
    return join_unique(df, keys.select(*map(field, key)).distinct(), key, "left_anti").select(*map(field, df.columns))
