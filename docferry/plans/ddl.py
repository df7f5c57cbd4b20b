"""Text of the target table's definition."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docferry.functions.naming import quote
from docferry.plans.infer import KEY


def render_ddl(plan: DataFrame, table: str, mark: str = "`") -> str:
    """CREATE TABLE statement of a plan, identifiers quoted."""
    columns = [
        f"{quote(r['column'], mark)} {r.sql_type}" + (" AUTO_INCREMENT PRIMARY KEY" if r.role == KEY else "")
        for r in plan.orderBy("position").collect()
    ]
    return f"CREATE TABLE IF NOT EXISTS {quote(table, mark)} ({', '.join(columns)});"


def render_additions(added: DataFrame, table: str, mark: str = "`") -> list[str]:
    """One ALTER TABLE statement per row of :func:`docferry.plans.infer.diff_schema`."""
    return [
        f"ALTER TABLE {quote(table, mark)} ADD COLUMN {quote(r['column'], mark)} {r.sql_type};" for r in added.collect()
    ]


def writer_types(plan: DataFrame) -> str:
    """Value of the JDBC writer's ``createTableColumnTypes``: the sized text columns.

    The writer parses these as Spark types, so unbounded text is left to the dialect.
    """
    sized = [r for r in plan.orderBy("position").collect() if r.sql_type.startswith("VARCHAR(")]
    return ", ".join(f"{quote(r['column'])} {r.sql_type}" for r in sized)
