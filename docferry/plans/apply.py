"""Turn documents into the rows of a planned table: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from docferry.functions.values import to_seconds_text
from docferry.operators import leaves
from docferry.operators.leaves import at_path, binary_value, date_value, kind_of, member, shape_of, text_of
from docferry.operators.shape import ID_FIELD
from docferry.plans.infer import KEY, LEAF, PARENT


def _source(doc: Column, paths: list) -> Column:
    """Value of a column; of several fields with one name the last present one."""
    values = [at_path(doc, list(p)) for p in reversed(paths)]
    return values[0] if len(values) == 1 else F.coalesce(*values)


def _kinds(row: Row) -> set[str]:
    return set(row.kinds) - {leaves.NULL}


def _is_mixed(row: Row) -> bool:
    """True when each value's own kind decides how it is read."""
    kinds = _kinds(row)
    if row.role == PARENT:
        return True
    if row.spark_type == "string":
        return bool(kinds) and kinds not in ({leaves.STRING}, {leaves.OBJECT_ID}, {leaves.LIST})
    return row.spark_type.startswith(("int", "bigint", "double", "decimal")) and not kinds <= {
        leaves.INT,
        leaves.LONG,
        leaves.DOUBLE,
        leaves.DECIMAL,
        leaves.BOOLEAN,
        leaves.OBJECT,
    }


def _text(row: Row, value: Column) -> Column:
    """Text column whose values are all of one kind."""
    kinds = _kinds(row)
    if not kinds:
        return F.lit(None).cast("string")
    if kinds == {leaves.STRING}:
        return F.try_variant_get(value, "$", "string")
    if kinds == {leaves.OBJECT_ID}:
        return member(value, "$oid", "string")
    return F.when(~F.is_variant_null(value), F.to_json(value))


def _mixed_text(row: Row) -> Column:
    """Text of values of several kinds; objects only where the column is for them."""
    value, kind = f"_v{row.position}", F.col(f"_k{row.position}")
    text = text_of(value, f"_k{row.position}")
    if row.role == PARENT or (leaves.OTHER in row.kinds and leaves.OBJECT not in row.kinds):
        return F.when(kind.isin(leaves.OBJECT, leaves.EMPTY), F.to_json(value)).otherwise(text)
    return F.when(kind != leaves.OBJECT, text) if leaves.OBJECT in row.kinds else text


def _typed(row: Row, value: Column) -> Column:
    """Column of a type other than text, values of fitting kinds."""
    kinds = _kinds(row)
    if row.spark_type == "binary":
        return binary_value(f"_v{row.position}")
    if row.spark_type == "boolean":
        return F.try_variant_get(value, "$", "boolean")
    if row.spark_type == "timestamp_ntz":
        dates = date_value(f"_v{row.position}")
        if leaves.STRING in kinds:
            dates = F.coalesce(dates, F.try_variant_get(value, "$", "string").try_cast("timestamp_ntz"))
        return to_seconds_text(dates).cast("timestamp_ntz")
    wrapped = [k for k, kind in leaves.EXTENDED_KINDS.items() if kind in kinds]
    return F.coalesce(
        F.try_variant_get(value, "$", row.spark_type),
        *(member(value, k, "string").try_cast(row.spark_type) for k in wrapped),
    )


def _stage(docs: DataFrame, rows: list[Row], kinds_of: list[Row]) -> DataFrame:
    """Put the values of ``rows``, and the kinds of some of them, next to the documents as columns
    ``_v<position>`` and ``_k<position>``, so that each is worked out once."""
    doc = F.col(docs.columns[0])
    staged = docs.select(*docs.columns, *(_source(doc, r.paths).alias(f"_v{r.position}") for r in rows))
    if not kinds_of:
        return staged
    staged = staged.withColumns({f"_s{r.position}": shape_of(f"_v{r.position}") for r in kinds_of})
    return staged.withColumns({f"_k{r.position}": kind_of(f"_s{r.position}") for r in kinds_of})


def _plan_rows(plan: DataFrame) -> list[Row]:
    return plan.where(F.col("role") != KEY).orderBy("position").collect()


def _column(docs: DataFrame, row: Row, mixed: bool, staged: bool) -> Column:
    value = F.col(f"_v{row.position}") if staged else _source(F.col(docs.columns[0]), row.paths)
    if mixed:
        return _mixed_text(row).try_cast(row.spark_type)
    return _text(row, value) if row.spark_type == "string" else _typed(row, value)


def _with_nulls(row: Row, col: Column, value: Column, null_text: str | None) -> Column:
    if null_text is not None and row.spark_type == "string" and leaves.NULL in row.kinds:
        return F.when(F.is_variant_null(value), F.lit(null_text)).otherwise(col)
    return col


def apply_plan(docs: DataFrame, plan: DataFrame, null_text: str | None = None) -> DataFrame:
    """Rows of the planned table, without its surrogate key.

    A missing field is NULL; an explicit null too, or ``null_text`` in text columns.
    """
    rows = _plan_rows(plan)
    mixed = [r for r in rows if _is_mixed(r)]
    named = mixed + [r for r in rows if r.spark_type in ("binary", "timestamp_ntz")]
    out = []
    for row in rows:
        value = F.col(f"_v{row.position}") if row in named else _source(F.col(docs.columns[0]), row.paths)
        col = _column(docs, row, row in mixed, row in named)
        out.append(_with_nulls(row, col, value, null_text).alias(row["column"]))
    return _stage(docs, named, mixed).select(*out)


def _holds(row: Row, col: Column, text: Column) -> Column:
    """True where a typed column has the value whose text is given, and not another one near it."""
    kinds = _kinds(row)
    if row.spark_type == "boolean" and not kinds <= {leaves.BOOLEAN}:
        return col.isNotNull() & (F.col(f"_k{row.position}") == leaves.BOOLEAN)
    if row.spark_type.startswith(("int", "bigint", "double", "decimal")) and not kinds <= {leaves.INT, leaves.BOOLEAN}:
        wide = "decimal(38,10)"
        same = F.coalesce(text.try_cast(wide) == col.try_cast(wide), text.try_cast("double") == col.cast("double"))
        return col.isNotNull() & F.coalesce(same, F.lit(True))
    return col.isNotNull()


def apply_plan_checked(docs: DataFrame, plan: DataFrame, null_text: str | None = None) -> tuple[DataFrame, str]:
    """As :func:`apply_plan`, and one more column, whose name is returned too, with the values the row could not take.

    That column is an array of ``document`` (its ``_id`` as JSON), ``column`` and ``value``, empty in most rows. A value either is in its column as it was or is
    in this array, and its column is NULL then: texts in number columns, fractions in integer columns, integers that
    a double does not hold, and so on. Objects whose members have columns of their own lose nothing.
    """
    rows = _plan_rows(plan)
    mixed = [r for r in rows if _is_mixed(r)]
    leaf = [r for r in rows if r.role == LEAF]
    rest = [r for r in rows if r not in leaf]
    taken, name = {r["column"].lower() for r in rows}, "_rejected"
    while name in taken:
        name = f"_{name}"
    nothing = "CAST(NULL AS struct<document:string,column:string,value:string>)"
    document = F.to_json(at_path(F.col(docs.columns[0]), [ID_FIELD])).alias("document")
    out, checks = [], [F.expr(nothing)]
    for row in rows:
        value, col = F.col(f"_v{row.position}"), _column(docs, row, row in mixed, True)
        if row in leaf:
            text, kind = text_of(f"_v{row.position}", f"_k{row.position}"), F.col(f"_k{row.position}")
            asked = text.isNotNull() & (kind != leaves.OBJECT) if leaves.OBJECT in row.kinds else text.isNotNull()
            holds = _holds(row, col, text)
            checks.append(F.when(asked & ~holds, F.struct(document, F.lit(row["column"]).alias("column"), text.alias("value"))))
            col = F.when(holds, col)
        out.append(_with_nulls(row, col, value, null_text).alias(row["column"]))
    staged = _stage(docs, leaf + rest, [*leaf, *(r for r in rest if r in mixed)])
    return staged.select(*out, F.array_compact(F.array(*checks)).alias(name)), name


def reject_rows(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Values the planned columns cannot take: the document, ``column`` and ``value``, one row each."""
    rows = [r for r in _plan_rows(plan) if r.role == LEAF and r.spark_type != "string"]
    staged = _stage(docs, rows, rows)
    checks = [F.expr("CAST(NULL AS struct<column:string,value:string>)")]
    for row in rows:
        text = text_of(f"_v{row.position}", f"_k{row.position}")
        bad = text.isNotNull() & _typed(row, F.col(f"_v{row.position}")).isNull()
        checks.append(F.when(bad, F.struct(F.lit(row["column"]).alias("column"), text.alias("value"))))
    # The generator drops documents without a rejected value; a filter would be pushed below the
    # stages above and evaluate their expressions over and over.
    return staged.select(*docs.columns, F.inline(F.array_compact(F.array(*checks))))
