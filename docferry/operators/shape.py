"""Shape of rows: pruning, flattening, alignment, packing and field maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.naming import join_parts, settle_collisions
from docferry.functions.values import KEEP_NULLS, field

ID_FIELD, CLASS_FIELD = "_id", "_class"


def prune_metadata(df: DataFrame, skip_id: bool = False, skip_class: bool = False) -> DataFrame:
    """Drop the store's own fields; both stay by default."""
    return df.drop(*([ID_FIELD] if skip_id else []), *([CLASS_FIELD] if skip_class else []))


def _is_extended(data_type: T.DataType) -> bool:
    """A struct that stands for one Extended JSON scalar."""
    return isinstance(data_type, T.StructType) and bool(data_type) and all(n.startswith("$") for n in data_type.names)


def _scalar(col: Column, data_type: T.DataType) -> tuple[Column, T.DataType]:
    """The scalar out of an Extended JSON struct, where there is just one member of it."""
    if _is_extended(data_type) and len(data_type) == 1 and not isinstance(data_type[0].dataType, T.StructType):
        return col.getField(data_type[0].name), data_type[0].dataType
    return col, data_type


def _walk(struct: T.StructType, col: Column | None, path: tuple[str, ...]):
    """Every object and leaf below ``struct``: (path, column, type)."""
    for f in struct.fields:
        here = field(f.name) if col is None else col.getField(f.name)
        here_path = (*path, f.name)
        yield here_path, here, f.dataType
        if isinstance(f.dataType, T.StructType) and not _is_extended(f.dataType):
            yield from _walk(f.dataType, here, here_path)


def _hoists(col: Column, struct: T.StructType, key: str) -> Column:
    """True when one of the object's own values equals the key it sits under."""
    hits = [col.getField(f.name) == F.lit(key) for f in struct.fields if isinstance(f.dataType, T.StringType)]
    return reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits], F.lit(False))


def hoisted_objects(df: DataFrame, hoist: str = "any", order_by: str = ID_FIELD) -> set[tuple[str, ...]]:
    """Objects below the top level whose key drops out of the path, decided once per collection.

    ``"any"`` looks at all rows in one aggregate, ``"sample"`` at the first row by ``order_by``.
    """
    candidates = [(p, c, t) for p, c, t in _walk(df.schema, None, ()) if len(p) > 1 and isinstance(t, T.StructType)]
    candidates = [(p, c, t) for p, c, t in candidates if not _is_extended(t)]
    if hoist == "never" or not candidates:
        return set()
    if hoist not in ("any", "sample"):
        raise ValueError(f"unknown hoist {hoist!r}")
    hits = df.select(
        *([field(order_by).alias("ord")] if hoist == "sample" else []),
        *(_hoists(c, t, p[-1]).alias(f"h{i}") for i, (p, c, t) in enumerate(candidates)),
    )
    if hoist == "any":
        row = hits.agg(*(F.bool_or(f"h{i}").alias(f"h{i}") for i in range(len(candidates)))).head()
    else:
        row = hits.orderBy(F.col("ord").asc_nulls_last()).limit(1).head()
    return {p for i, (p, _, _) in enumerate(candidates) if row is not None and row[f"h{i}"]}


def flatten(
    df: DataFrame,
    sep: str = "_",
    hoist: str = "never",
    *,
    keep_parent: bool = False,
    on_collision: str = "error",
    order_by: str = ID_FIELD,
) -> DataFrame:
    """Nested objects to flat columns named ``parent_child``, parts in snake case; lists stay leaves.

    A hoisted object leaves its key out of the name, and objects inside it also keep a column
    of their own as JSON text. ``keep_parent`` keeps each top-level object as JSON text too.
    """
    hoisted = hoisted_objects(df, hoist, order_by)
    names, cols = [], []

    def walk(struct: T.StructType, parent: Column | None, named: tuple[str, ...], path: tuple[str, ...], inside: bool):
        for f in struct.fields:
            col = field(f.name) if parent is None else parent.getField(f.name)
            here, nested = (*path, f.name), isinstance(f.dataType, T.StructType) and not _is_extended(f.dataType)
            if not nested:
                names.append(join_parts((*named, f.name), sep))
                cols.append(_scalar(col, f.dataType)[0])
                continue
            if inside or (keep_parent and not path):
                names.append(join_parts((*named, f.name), sep))
                cols.append(F.to_json(col, KEEP_NULLS))
            drops = here in hoisted and not inside
            walk(f.dataType, col, named if drops else (*named, f.name), here, drops)

    walk(df.schema, None, (), (), False)
    return df.select(*(cols[i].alias(names[i]) for i in settle_collisions(names, on_collision)))


def align_schemas(dfs: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; a column a frame lacks is NULL."""
    plain = [df.select("*") for df in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), plain)


def extended(col: Column, data_type: T.DataType) -> Column:
    """Extended JSON form of a value plain JSON has no type for; others unchanged."""
    if isinstance(data_type, T.DecimalType):
        return F.when(col.isNotNull(), F.struct(col.cast("string").alias("$numberDecimal")))
    if isinstance(data_type, T.LongType):
        return F.when(col.isNotNull(), F.struct(col.cast("string").alias("$numberLong")))
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        iso = F.concat(F.translate(col.cast("timestamp_ntz").cast("string"), " ", "T"), F.lit("Z"))
        return F.when(col.isNotNull(), F.struct(iso.alias("$date")))
    if isinstance(data_type, T.TimestampType):
        utc = F.convert_timezone(None, F.lit("UTC"), col)
        return extended(utc, T.TimestampNTZType())
    if isinstance(data_type, T.BinaryType):
        content = F.struct(F.base64(col).alias("base64"), F.lit("00").alias("subType"))
        return F.when(col.isNotNull(), F.struct(content.alias("$binary")))
    return col


def pack_documents(df: DataFrame, name: str = "document", *, typed: bool = False) -> DataFrame:
    """One JSON document per row, every column under its own name, NULLs kept.

    ``typed`` writes decimals, 64-bit integers, dates and binaries in Extended JSON, so that
    a document store gives them back with their types.
    """
    members = [
        (extended(field(f.name), f.dataType) if typed else field(f.name)).alias(f.name) for f in df.schema
    ]
    return df.select(F.to_json(F.struct(*members), KEEP_NULLS).alias(name))


def map_fields(df: DataFrame, mapping: dict[str, int]) -> DataFrame:
    """Output field <- source column at a position; renames, reorders, drops, repeats."""
    width = len(df.columns)
    wrong = {f: i for f, i in mapping.items() if not 0 <= i < width}
    if wrong:
        raise IndexError(f"positions out of range for {width} columns: {wrong}")
    by_position = df.toDF(*(f"_{i}" for i in range(width)))
    return by_position.select(*(F.col(f"_{i}").alias(f) for f, i in mapping.items()))


def schema_report(df: DataFrame) -> DataFrame:
    """Schema as rows: position, dotted path, type; nested members included."""
    rows = [(i, ".".join(p), t.simpleString()) for i, (p, _, t) in enumerate(_walk(df.schema, None, ()))]
    return df.sparkSession.createDataFrame(rows, "position int, path string, type string")
