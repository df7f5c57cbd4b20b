"""Sizes of relational text types, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the target tables are sized by.
WIDTH_STEP = 25
MAX_VARCHAR = 1000
TEXT_BYTES = 65_535
MEDIUMTEXT_BYTES = 16_777_215


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def varchar_width(n: Column | str) -> Column:
    """Next multiple of the step above ``n`` characters, within the limits."""
    n = _column(n).cast("long")
    steps = F.floor(n / WIDTH_STEP).cast("long") + 1
    return F.greatest(F.lit(WIDTH_STEP), F.least(steps * WIDTH_STEP, F.lit(MAX_VARCHAR))).cast("int")


def varchar(width: Column) -> Column:
    return F.concat(F.lit("VARCHAR("), width.cast("string"), F.lit(")"))


def varchar_type(n: Column | str) -> Column:
    """Text type for values of up to ``n`` characters: VARCHAR(n), or TEXT for 0, unknown and too long."""
    n = _column(n)
    return F.when(n.between(1, MAX_VARCHAR), varchar(varchar_width(n))).otherwise(F.lit("TEXT"))


def text_type(max_bytes: Column | str) -> Column:
    """Smallest unbounded text type that holds ``max_bytes`` bytes."""
    max_bytes = _column(max_bytes)
    return (
        F.when(max_bytes > MEDIUMTEXT_BYTES, F.lit("LONGTEXT"))
        .when(max_bytes > TEXT_BYTES, F.lit("MEDIUMTEXT"))
        .otherwise(F.lit("TEXT"))
    )


def declared_width(sql_type: Column) -> Column:
    """The n of VARCHAR(n), NULL for other types."""
    return F.regexp_extract(sql_type, r"^VARCHAR\((\d+)\)$", 1).try_cast("int")


def widen(sql_type: Column | str, max_chars: Column | str, max_bytes: Column | str) -> Column:
    """Type a column ends with once values of this size went in, starting from ``sql_type``.

    VARCHAR doubles until the value fits and becomes a TEXT type past 1000; TEXT types
    grow by bytes; NULL marks a BLOB that cannot grow; other types stay.
    """
    sql_type, max_chars, max_bytes = _column(sql_type), _column(max_chars), _column(max_bytes)
    width = declared_width(sql_type)
    doublings = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: width * F.pow(F.lit(2), k).cast("int"))
    fitting = F.try_element_at(F.filter(doublings, lambda w: w >= max_chars), F.lit(1))
    text_rank = F.array_position(F.array(*map(F.lit, ("TEXT", "MEDIUMTEXT", "LONGTEXT"))), sql_type)
    needed = text_type(max_bytes)
    return (
        F.when(width.isNotNull() & F.coalesce(max_chars <= width, F.lit(True)), sql_type)
        .when(width.isNotNull() & (fitting <= MAX_VARCHAR), varchar(fitting))
        .when(width.isNotNull(), needed)
        .when((text_rank == 3) | ((text_rank == 2) & (needed == "TEXT")), sql_type)
        .when(text_rank > 0, needed)
        .when((sql_type == "BLOB") & (max_bytes > TEXT_BYTES), F.lit(None).cast("string"))
        .otherwise(sql_type)
    )
