"""CSV in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.values import convert_values
from docferry.functions.values import field as column
from docferry.operators.shape import flatten

# Quotes doubled as in RFC 4180, so that a quoted value may hold quotes and line ends; blanks around values are kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# How line ends inside values are written. "escaped": as \\n and \\r, a backslash as two, and NUL, which parsers drop, as \\0, so that a
# row is one line and files can be split; "quoted": as they are, within quotes, so that a file is read by one task.
LINE_ENDS = ("escaped", "quoted")

# What NULL is read as in files with escapes, where no value can be a single backslash and a letter N: nothing between separators
# is NULL, an empty text ("") stays one. It is written only in a table of one column, where NULL would be a blank line.
NULL_OPTIONS = {"nullValue": "\\N"}


def _escaped(text: Column) -> Column:
    for raw, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def _unescaped(text: Column) -> Column:
    # between pairs of backslashes, taken from the left, a backslash always begins a mark
    def raw(part: Column) -> Column:
        for mark, character in (("\\r", "\r"), ("\\n", "\n"), ("\\0", "\x00")):
            part = F.replace(part, F.lit(mark), F.lit(character))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), raw), "\\")


def _check(line_ends: str) -> None:
    if line_ends not in LINE_ENDS:
        raise ValueError(f"unknown line_ends {line_ends!r}")


def read_csv(spark: SparkSession, path: str | list[str], line_ends: str = "quoted") -> DataFrame:
    """CSV with a header; every column is text.

    By default quoted values may hold line ends, as in any CSV. Files of :func:`archive_csv` have none
    (``line_ends="escaped"``) and split into blocks.
    """
    _check(line_ends)
    if line_ends == "quoted":
        return spark.read.options(**CSV_OPTIONS).option("multiLine", True).csv(path)
    rows = spark.read.options(**CSV_OPTIONS, **NULL_OPTIONS).csv(path)
    return rows.select(*(F.when(F.contains(column(c), F.lit("\\")), _unescaped(column(c))).otherwise(column(c)).alias(c) for c in rows.columns))


def archive_csv(df: DataFrame, path: str, mode: str = "overwrite", line_ends: str = "escaped") -> None:
    """Rows as CSV with a header; nested fields are flattened and converted first, as CSV has none."""
    _check(line_ends)
    flat = convert_values(flatten(df))
    binary = {f.name for f in flat.schema if isinstance(f.dataType, T.BinaryType)}
    texts = {f.name for f in flat.schema if isinstance(f.dataType, T.StringType)} if line_ends == "escaped" else set()
    plain = flat.select(
        *((F.base64(column(c)) if c in binary else _escaped(column(c)) if c in texts else column(c)).alias(c) for c in flat.columns)
    )
    plain.write.mode(mode).options(**CSV_OPTIONS, **(NULL_OPTIONS if line_ends == "escaped" and len(plain.columns) == 1 else {})).csv(path)
