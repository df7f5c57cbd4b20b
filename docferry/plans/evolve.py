"""A further load into a table that is there: the types both need, the columns to add, and the rows side by side.

A column's type only grows: the type of the table and the one that the new documents need meet in the narrowest type that keeps
the values of both. Columns that the new documents lack stay, NULL for their rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.naming import quote
from docferry.functions.values import field, to_seconds_text
from docferry.functions.widths import MAX_VARCHAR
from docferry.operators import leaves
from docferry.plans.infer import KEY, PLAN_SCHEMA, spark_type

ADD, MODIFY = "add", "modify"
TEXTS = ("TEXT", "MEDIUMTEXT", "LONGTEXT")
WHOLE = ("BOOLEAN", "INT", "BIGINT")
#: Characters that a value of a type may need as text.
TEXT_WIDTH = {"BOOLEAN": 5, "INT": 11, "BIGINT": 20, "FLOAT": 24, "DOUBLE": 24, "DATETIME": 26}
#: Digits before the point.
WHOLE_DIGITS = {"BOOLEAN": 1, "INT": 10, "BIGINT": 19}


def _sized(sql_type: str) -> tuple[str, tuple[int, ...]]:
    name, _, sizes = sql_type.upper().replace(" ", "").partition("(")
    return name, tuple(int(n) for n in re.findall(r"\d+", sizes))


def _width(sql_type: str) -> int:
    name, sizes = _sized(sql_type)
    return sizes[0] + 3 if name == "DECIMAL" else TEXT_WIDTH[name]


def _varchar(width: int) -> str:
    return f"VARCHAR({width})" if width <= MAX_VARCHAR else "TEXT"


def wider(a: str, b: str) -> str:
    """The narrowest planned type that keeps all values of two."""
    (x, n), (y, m) = _sized(a), _sized(b)
    if (x, n) == (y, m):
        return a
    if "BLOB" in (x, y):
        raise ValueError(f"no column holds both {a} and {b}")
    if x in TEXTS or y in TEXTS:
        return TEXTS[max(TEXTS.index(t) for t in (x, y) if t in TEXTS)]
    if "VARCHAR" in (x, y):
        return _varchar(max(s[0] if t == "VARCHAR" else _width(whole) for t, s, whole in ((x, n, a), (y, m, b))))
    if x in WHOLE and y in WHOLE:
        # as numbers: true is 1
        return WHOLE[max(WHOLE.index(x), WHOLE.index(y))]
    if "DECIMAL" in (x, y):
        parts = [(s[0] - s[1], s[1]) if t == "DECIMAL" else (WHOLE_DIGITS[t], 0) for t, s in ((x, n), (y, m)) if t == "DECIMAL" or t in WHOLE]
        before, after = (max(p) for p in zip(*parts, strict=True))
        if len(parts) == 2 and before + after <= 38:
            return f"DECIMAL({before + after}, {after})"
    elif {x, y} <= {"FLOAT", "DOUBLE", "BOOLEAN", "INT"}:
        return "DOUBLE"
    return _varchar(max(_width(a), _width(b)))


def planned_type(data_type: T.DataType) -> str:
    """Planned type of a column of a folder table; its texts have no bound."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision}, {data_type.scale})"
    names = {T.BooleanType: "BOOLEAN", T.IntegerType: "INT", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.TimestampNTZType: "DATETIME", T.BinaryType: "BLOB"}
    return names.get(type(data_type), "LONGTEXT")


def evolve_plan(plan: DataFrame, existing: Mapping[str, str], *, grow: bool = True) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """The plan with types that also keep what an existing table holds, and what must change in that table.

    ``existing`` has the planned type of each column. Changes are (``add`` or ``modify``, column, type), in plan order.
    Without ``grow`` the columns that are there keep their types, and only new ones are added.
    """
    rows, changes = [], []
    for row in plan.orderBy("position").collect():
        name, sql_type = row["column"], row.sql_type
        if row.role == KEY:
            if name not in existing:
                raise ValueError(f"the table has no key {name!r}")
            rows.append(row)
            continue
        if name not in existing:
            changes.append((ADD, name, sql_type))
        elif grow and row.kinds and set(row.kinds) != {leaves.NULL}:
            sql_type = wider(existing[name], sql_type)
            if _sized(sql_type) != _sized(existing[name]):
                changes.append((MODIFY, name, sql_type))
        else:
            sql_type = existing[name]
        rows.append({**row.asDict(), "sql_type": sql_type, "spark_type": spark_type(sql_type)})
    as_tuples = [tuple(r[c] for c in plan.columns) for r in rows]
    return plan.sparkSession.createDataFrame(as_tuples, PLAN_SCHEMA), changes


def render_changes(changes: list[tuple[str, str, str]], table: str, mark: str = "`") -> list[str]:
    """One ALTER TABLE statement per change."""
    verbs = {ADD: "ADD COLUMN", MODIFY: "MODIFY COLUMN"}
    return [f"ALTER TABLE {quote(table, mark)} {verbs[kind]} {quote(column, mark)} {sql_type};" for kind, column, sql_type in changes]


def grown(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of the existing table with the types of the evolved plan; columns that are not planned stay as they are."""
    types = {r["column"]: r.spark_type for r in plan.collect()}
    out = []
    for f in rows.schema:
        col, wanted = field(f.name), types.get(f.name)
        if wanted is None or wanted == f.dataType.simpleString():
            out.append(col)
        elif wanted == "string" and isinstance(f.dataType, T.TimestampNTZType):
            out.append(to_seconds_text(col).alias(f.name))
        else:
            # numbers that were true and false are 1 and 0
            out.append(col.cast(wanted).alias(f.name))
    return rows.select(*out)


def side_by_side(old: DataFrame, new: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of both, columns of the table first and then those that are added; what a side lacks is NULL."""
    return grown(old, plan).unionByName(new, allowMissingColumns=True)


def next_key(old: DataFrame, key: str) -> int:
    """The greatest key of the table, 0 if it is empty."""
    return old.agg(F.max(field(key))).first()[0] or 0
