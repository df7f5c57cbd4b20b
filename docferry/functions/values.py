"""Values: what a typed field looks like once it is written to a relational table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_NULLS = {"ignoreNullFields": "false"}

# What counts as a good value in an integer or datetime column.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T]|$)"


def field(name: str) -> Column:
    """A top-level column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_seconds_text(ts: Column) -> Column:
    """``2024-01-31 23:59:59``, the fraction cut. Plain cast: a wall time must not pass through a zone."""
    return F.substring(ts.cast("string"), 1, 19)


def _reads_as(text: Column, pattern: str) -> Column:
    """Match a number-like pattern; a plain comparison first spares most texts the pattern."""
    return F.when((text >= "+") & (text < ":"), text.rlike(pattern)).otherwise(F.lit(False))


def is_integer_text(text: Column) -> Column:
    return _reads_as(text, INTEGER_PATTERN)


def is_number_text(text: Column) -> Column:
    return _reads_as(text, NUMBER_PATTERN)


def is_date_text(text: Column) -> Column:
    """True when the text reads as a date or date-time; the cheap pattern goes first."""
    return F.when(_reads_as(text, DATE_PATTERN), text.try_cast("timestamp_ntz").isNotNull()).otherwise(F.lit(False))


def convert_column(col: Column, data_type: T.DataType, null_text: str | None = None) -> Column:
    """Relational form of one column: dates as text to the second, lists and
    objects as JSON text, booleans as 1/0, the rest unchanged."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        out = to_seconds_text(col)
    elif isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        out = F.to_json(col, KEEP_NULLS)
    elif isinstance(data_type, T.VariantType):
        out = F.to_json(col)
    elif isinstance(data_type, T.BooleanType):
        out = col.cast("int")
    elif isinstance(data_type, T.NullType):
        out = col.cast("string")
    else:
        out = col
    return out if null_text is None else F.coalesce(out.cast("string"), F.lit(null_text))


def convert_values(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Convert all columns in one projection; ``null_text="NULL"`` writes NULL as that text."""
    return df.select(*(convert_column(field(f.name), f.dataType, null_text).alias(f.name) for f in df.schema))


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*(field(c).cast("string").alias(c) for c in df.columns))
