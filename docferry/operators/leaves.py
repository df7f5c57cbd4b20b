"""Leaf values of VARIANT documents: their kind and their text form.

A document keeps every value's own type. Objects whose only keys start with ``$``
are Extended JSON scalars, so they count as leaves here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leaf kinds, named after what the value is in the document store.
STRING, INT, LONG, DOUBLE, DECIMAL = "STRING", "INT", "LONG", "DOUBLE", "DECIMAL"
BOOLEAN, OBJECT_ID, DATE, LIST = "BOOLEAN", "OBJECT_ID", "DATE", "LIST"
BINARY, NULL, OTHER = "BINARY", "NULL", "OTHER"
EMPTY, OBJECT = "EMPTY", "OBJECT"

# Extended JSON keys and the kinds they stand for.
EXTENDED_KINDS = {
    "$oid": OBJECT_ID,
    "$date": DATE,
    "$numberInt": INT,
    "$numberLong": LONG,
    "$numberDouble": DOUBLE,
    "$numberDecimal": DECIMAL,
    "$binary": BINARY,
}

# The expressions below are SQL text over column names: they are large, and the plan they end
# up in names each of their inputs as a column, so that no input is worked out twice.

# Kind out of the schema text of a value. A whole decimal too wide for 64 bits is kept exact;
# narrower ones of scale 0 were written as 6.0.
KIND_SQL = (
    """CASE
    WHEN {shape} = 'STRING' THEN 'STRING'
    WHEN {shape} = 'BIGINT' THEN 'INT'
    WHEN startswith({shape}, 'DECIMAL') THEN
        if({shape} RLIKE '^DECIMAL[(](19|[23][0-9]),0[)]$', 'DECIMAL', 'DOUBLE')
    WHEN {shape} IN ('DOUBLE', 'FLOAT') THEN 'DOUBLE'
    WHEN {shape} = 'BOOLEAN' THEN 'BOOLEAN'
    WHEN {shape} = 'VOID' THEN 'NULL'
    WHEN startswith({shape}, 'ARRAY') THEN 'LIST'
    WHEN startswith({shape}, 'TIMESTAMP') OR {shape} = 'DATE' THEN 'DATE'
    WHEN {shape} = 'BINARY' THEN 'BINARY'
    WHEN {shape} = 'OBJECT<>' THEN 'EMPTY'
    """
    + "\n    ".join(f"WHEN startswith({{shape}}, 'OBJECT<`{key}`: ') THEN '{kind}'" for key, kind in EXTENDED_KINDS.items())
    + """
    WHEN startswith({shape}, 'OBJECT<`$') THEN 'OTHER'
    WHEN startswith({shape}, 'OBJECT') THEN 'OBJECT'
    ELSE 'OTHER' END"""
)

# UTC wall time of a date: milliseconds, ISO text or a native timestamp.
DATE_SQL = """coalesce(
    timestampadd(MICROSECOND, unix_micros(coalesce(
        timestamp_millis(try_cast(try_variant_get({value}, '$.$date.$numberLong', 'string') AS BIGINT)),
        CASE schema_of_variant(try_variant_get({value}, '$.$date', 'variant'))
            WHEN 'BIGINT' THEN timestamp_millis(try_variant_get({value}, '$.$date', 'bigint'))
            WHEN 'STRING' THEN try_cast(try_variant_get({value}, '$.$date', 'string') AS TIMESTAMP) END
    )), TIMESTAMP_NTZ '1970-01-01 00:00:00'),
    try_variant_get({value}, '$', 'timestamp_ntz'))"""

# Bytes of a binary, in the current or the older Extended JSON form.
BINARY_SQL = """coalesce(
    try_to_binary(coalesce(
        try_variant_get({value}, '$.$binary.base64', 'string'),
        CASE WHEN schema_of_variant(try_variant_get({value}, '$.$binary', 'variant')) = 'STRING'
            THEN try_variant_get({value}, '$.$binary', 'string') END), 'base64'),
    try_variant_get({value}, '$', 'binary'))"""

# Text of a leaf as a relational text column would hold it; NULL for null.
TEXT_SQL = (
    """CASE {kind}
    WHEN 'STRING' THEN try_variant_get({value}, '$', 'string')
    WHEN 'INT' THEN coalesce(try_variant_get({value}, '$.$numberInt', 'string'), try_variant_get({value}, '$', 'string'))
    WHEN 'DOUBLE' THEN coalesce(
        CAST(try_variant_get({value}, '$', 'double') AS STRING), try_variant_get({value}, '$.$numberDouble', 'string'))
    WHEN 'BOOLEAN' THEN if(try_variant_get({value}, '$', 'boolean'), '1', '0')
    WHEN 'NULL' THEN NULL
    WHEN 'EMPTY' THEN NULL
    WHEN 'OBJECT_ID' THEN try_variant_get({value}, '$.$oid', 'string')
    WHEN 'DATE' THEN substring(CAST("""
    + DATE_SQL
    + """ AS STRING), 1, 19)
    WHEN 'LONG' THEN coalesce(try_variant_get({value}, '$.$numberLong', 'string'), try_variant_get({value}, '$', 'string'))
    WHEN 'DECIMAL' THEN coalesce(try_variant_get({value}, '$.$numberDecimal', 'string'), try_variant_get({value}, '$', 'string'))
    WHEN 'BINARY' THEN base64("""
    + BINARY_SQL
    + """)
    ELSE to_json({value}, map('ignoreNullFields', 'false')) END"""
)


def member(doc: Column, key: str, as_type: str = "variant") -> Column:
    """One member of an object by its literal key; any key is allowed."""
    if key and not any(c in key for c in "'?\\"):
        return F.try_variant_get(doc, f"$['{key}']", as_type)
    members = F.try_variant_get(doc, "$", "map<string,variant>")
    value = F.try_element_at(members, F.lit(key))
    return value if as_type == "variant" else F.try_variant_get(value, "$", as_type)


def at_path(doc: Column, path: list[str], as_type: str = "variant") -> Column:
    """The value at a nested path of literal keys."""
    plain = all(key and not any(c in key for c in "'?\\") for key in path)
    if plain:
        return F.try_variant_get(doc, "$" + "".join(f"['{key}']" for key in path), as_type)
    for key in path[:-1]:
        doc = member(doc, key)
    return member(doc, path[-1], as_type)


def shape_of(value: str) -> Column:
    """Schema text of a variant column, the base of the two functions below."""
    return F.expr(f"schema_of_variant({value})")


def is_nested(shape: str) -> Column:
    """True for an object with members to walk into."""
    return F.expr(f"startswith({shape}, 'OBJECT<') AND NOT startswith({shape}, 'OBJECT<`$') AND {shape} <> 'OBJECT<>'")


def kind_of(shape: str) -> Column:
    """Leaf kind out of the schema text in a column."""
    return F.expr(KIND_SQL.format(shape=shape))


def date_value(value: str) -> Column:
    """UTC wall time of the date leaves in a column."""
    return F.expr(DATE_SQL.format(value=value))


def binary_value(value: str) -> Column:
    """Bytes of the binary leaves in a column."""
    return F.expr(BINARY_SQL.format(value=value))


def text_of(value: str, kind: str) -> Column:
    """Text form of the leaves in a column, given their kinds in another."""
    return F.expr(TEXT_SQL.format(value=value, kind=kind))
