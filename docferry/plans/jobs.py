"""End-to-end jobs: whole databases, single tables and file loads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.naming import database_name
from docferry.operators.keys import add_surrogate_key
from docferry.operators.shape import ID_FIELD, map_fields
from docferry.plans.apply import apply_plan, apply_plan_checked
from docferry.plans.ddl import writer_types
from docferry.plans.evolve import evolve_plan, next_key, planned_type, side_by_side
from docferry.plans.infer import KEY, PLAN_SCHEMA, plan_documents, table_name
from docferry.session import list_names, remove_path, written
from docferry.sources.documents import (
    DocumentStore,
    list_collections,
    read_collection,
    read_json_documents,
    sample_document,
    write_collection,
)
from docferry.sources.files import archive_csv, read_csv
from docferry.sources.tables import Connection, FileTables, list_tables, read_table, reset_target, write_table

REPORT_SCHEMA = (
    "source string, target string, status string, rows_in long, rows_out long, columns int, seconds double"
)
MIGRATED, SKIPPED_EMPTY, FAILED = "migrated", "skipped_empty", "failed"


def run_report(spark: SparkSession, rows: list[tuple], *, rejected: bool = False) -> DataFrame:
    """One row per collection or table a job went through; with how many values were rejected, where that is counted."""
    return spark.createDataFrame(rows, REPORT_SCHEMA + ", rejected long" * rejected)


def _each(names: list, one: Callable[..., tuple], concurrency: int) -> list[tuple]:
    """Run the work of every name, several Spark jobs at a time when asked."""
    if concurrency <= 1:
        return [one(n) for n in names]
    with ThreadPoolExecutor(concurrency) as pool:
        return list(pool.map(one, names))


def _typed_rows(docs: DataFrame, plan: DataFrame, null_text: str | None, checked: bool) -> tuple[DataFrame, str, DataFrame | None]:
    """The typed rows in the shared folder, their path, and if ``checked`` the values they could not take.

    Those lie next to the rows they come from, so they take no further pass over the documents.
    """
    if not checked:
        return *written(apply_plan(docs, plan, null_text), "typed"), None
    rows, name = apply_plan_checked(docs, plan, null_text)
    typed, path = written(rows, "typed")
    return typed.drop(name), path, typed.select(F.inline(name))


def _keep_rejects(rejected: DataFrame | None, rejects: str | None, target: str) -> tuple[int, str | None]:
    """Write rejected values into the quarantine; how many there are, and the folder of this load.

    Counted from what was written, so a task that is repeated does not count twice.
    """
    if rejected is None:
        return 0, None
    path = f"{rejects.rstrip('/')}/table={target}/load={uuid.uuid4().hex}"
    rejected.write.parquet(path)
    return rejected.sparkSession.read.schema(rejected.schema).parquet(path).count(), path


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """The quarantine of all loads: ``document`` (its ``_id`` as JSON), ``column``, ``value``, ``table``, ``load``."""
    schema = "document string, column string, value string, table string, load string"
    if not list_names(spark, rejects):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", rejects).parquet(f"{rejects.rstrip('/')}/table=*/load=*")


def documents_to_rows(
    docs: DataFrame,
    mode: str = "full",
    *,
    order_by: str = ID_FIELD,
    null_text: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame, str | None]:
    """Typed rows of the target table, surrogate key first, and the plan behind them.

    Two passes over the documents: one to profile, one to write the typed rows, which the key
    assignment then reads as columns. The third value is that scratch table, to be removed once
    the rows are written (``None`` without a surrogate key).
    """
    plan = plan_documents(docs, mode, order_by=order_by, null_text=null_text, **options)
    if plan.where(F.col("role") == KEY).isEmpty():
        return apply_plan(docs, plan, null_text), plan, None
    typed, path, _ = _typed_rows(docs, plan, null_text, False)
    return _keyed(typed, plan, order_by), plan, path


def _keyed(typed: DataFrame, plan: DataFrame, order_by: str) -> DataFrame:
    keyed = plan.where(F.col("role") == KEY).head()
    if keyed is None:
        return typed
    by = [r["column"] for r in plan.orderBy("position").collect() if [order_by] in [list(p) for p in r.paths]]
    # Documents may lack the field or share it, so ties are always broken by the rest of the row.
    return add_surrogate_key(typed, by, keyed["column"])


def migrate_collection(
    spark: SparkSession,
    store: DocumentStore,
    name: str | list[str],
    conn: Connection,
    *,
    archive: str | None = None,
    on_malformed: str = "error",
    rejects: str | None = None,
    **options,
) -> tuple:
    """One collection, or several that share a table, into one table; returns its report row.

    ``rejects`` names a folder for values that the typed columns cannot hold as they are (:func:`read_rejects`); their columns are NULL,
    and the report row ends with their number.
    """
    names = [name] if isinstance(name, str) else list(name)
    began, target, name = time.time(), table_name(names[0]), ", ".join(names)
    parts = [read_collection(spark, store, n, as_variant=True, on_malformed=on_malformed) for n in names]
    docs = reduce(DataFrame.union, parts)
    if docs.isEmpty():
        return name, target, SKIPPED_EMPTY, 0, 0, 0, time.time() - began, *(0,) * bool(rejects)
    kept, n_rejected = None, 0
    if rejects:
        order_by, null_text = options.pop("order_by", ID_FIELD), options.pop("null_text", None)
        plan = plan_documents(docs, options.pop("mode", "full"), order_by=order_by, null_text=null_text, **options)
        typed, scratch, rejected = _typed_rows(docs, plan, null_text, True)
        rows = _keyed(typed, plan, order_by)
    else:
        rows, plan, scratch = documents_to_rows(docs, **options)
    try:
        rows_in = (spark.read.parquet(scratch) if scratch else docs).count()
        if rejects:
            n_rejected, kept = _keep_rejects(rejected, rejects, target)
        write_table(rows, conn, target, staged=True, expected_rows=rows_in, column_types=writer_types(plan))
    except Exception:
        if kept:
            remove_path(spark, kept)
        raise
    finally:
        if scratch:
            remove_path(spark, scratch)
    landed = read_table(spark, conn, target)
    if archive:
        archive_csv(landed, f"{archive.rstrip('/')}/{target}")
    return name, target, MIGRATED, rows_in, landed.count(), len(landed.columns), time.time() - began, *(n_rejected,) * bool(rejects)


def append_collection(
    spark: SparkSession,
    store: DocumentStore,
    name: str,
    conn: FileTables,
    *,
    order_by: str = ID_FIELD,
    on_malformed: str = "error",
    on_misfit: str = "grow",
    rejects: str | None = None,
    **options,
) -> tuple[tuple, list[tuple[str, str, str]]]:
    """A further load of one collection into its table: the report row, and what changed in the table.

    Columns are added and types grow as the new documents need it (:mod:`docferry.plans.evolve`); keys go on after the greatest one. The
    table is a folder table, whose files are written anew and swapped in; for a database, ``evolve_plan`` with its column
    types and ``render_changes`` give the statements. Without a table this is its first load.

    With ``on_misfit="reject"`` the columns that are there keep their types, and values that these cannot hold go to the
    folder ``rejects`` as in :func:`migrate_collection`; the report row ends with their number.
    """
    if on_misfit not in ("grow", "reject"):
        raise ValueError(f"unknown on_misfit {on_misfit!r}")
    if on_misfit == "reject" and not rejects:
        raise ValueError("rejected values need a folder: rejects")
    target = table_name(name)
    if target not in list_tables(spark, conn):
        return migrate_collection(spark, store, name, conn, order_by=order_by, on_malformed=on_malformed, rejects=rejects, **options), []
    if not isinstance(conn, FileTables):
        raise TypeError("rows are appended to folder tables; render_changes gives a database's statements")
    began, docs = time.time(), read_collection(spark, store, name, as_variant=True, on_malformed=on_malformed)
    if docs.isEmpty():
        return (name, target, SKIPPED_EMPTY, 0, 0, 0, time.time() - began, *(0,) * bool(rejects)), []
    old, kept, n_rejected = read_table(spark, conn, target), None, 0
    planned, existing = plan_documents(docs, order_by=order_by, **options), {f.name: planned_type(f.dataType) for f in old.schema}
    plan, changes = evolve_plan(planned, existing, grow=on_misfit == "grow")
    typed, scratch, rejected = _typed_rows(docs, plan, options.get("null_text"), bool(rejects))
    try:
        rows, keyed = typed, plan.where(F.col("role") == KEY).head()
        if keyed is not None:
            by = [r["column"] for r in plan.orderBy("position").collect() if [order_by] in [list(p) for p in r.paths]]
            key = keyed["column"]
            last = F.lit(next_key(old, key))
            rows = add_surrogate_key(typed, by, key).withColumn(key, (F.col(key) + last).cast(old.schema[key].dataType))
        whole = side_by_side(old, rows, plan)
        rows_in = typed.count()
        n_rejected, kept = _keep_rejects(rejected, rejects, target)
        write_table(whole, conn, target, staged=True)
    except Exception:
        if kept:
            remove_path(spark, kept)
        raise
    finally:
        remove_path(spark, scratch)
    return (name, target, MIGRATED, rows_in, rows_in, len(whole.columns), time.time() - began, *(n_rejected,) * bool(rejects)), changes


def _failure(name: str, target: str, began: float, error: Exception) -> tuple:
    """Report row of a collection or table that could not be migrated; its kind of error, no values."""
    kind = getattr(error, "getCondition", lambda: None)() or type(error).__name__
    return name, target, f"{FAILED}: {kind}", 0, 0, 0, time.time() - began


def migrate_collections(
    spark: SparkSession,
    store: DocumentStore,
    conn: Connection,
    *,
    collections: list[str] | None = None,
    reset: bool = False,
    archive: str | None = None,
    concurrency: int = 1,
    on_same_name: str = "merge",
    on_failure: str = "report",
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Every collection, or the named ones, into a table of its own; empty ones are skipped.

    Collections whose table names are the same (``userEvents``, ``user_events``) fill one table together, and share
    a row of the report; ``on_same_name="error"`` refuses them. That is settled before anything is written.
    A collection that cannot be migrated does not end the others: its row of the report says ``failed: <kind of error>``
    (``on_failure="raise"`` raises the error once it occurs). ``reset`` empties the target first and is destructive, so it is off by default. ``archive``
    also writes each table as CSV below that path. ``rejects`` names a folder for values that the typed columns cannot hold,
    and adds their number to the report as ``rejected``. Other options go to
    :func:`docferry.plans.infer.plan_documents`.
    """
    if on_same_name not in ("merge", "error"):
        raise ValueError(f"unknown on_same_name {on_same_name!r}")
    if on_failure not in ("report", "raise"):
        raise ValueError(f"unknown on_failure {on_failure!r}")
    by_table: dict[str, list[str]] = {}
    for n in list_collections(spark, store, collections):
        by_table.setdefault(table_name(n), []).append(n)
    shared = {t: n for t, n in by_table.items() if len(n) > 1}
    if shared and on_same_name == "error":
        raise ValueError(f"collections share a table: {shared}")
    names = list(by_table.values())
    if reset:
        reset_target(spark, conn)

    def work(n: list[str]) -> tuple:
        began = time.time()
        try:
            return migrate_collection(spark, store, n, conn, archive=archive, rejects=rejects, **options)
        except Exception as error:
            if on_failure == "raise":
                raise
            return *_failure(", ".join(n), table_name(n[0]), began, error), *(0,) * bool(rejects)

    return run_report(spark, _each(names, work, concurrency), rejected=bool(rejects))


def migrate_table(
    spark: SparkSession,
    conn: Connection,
    table: str,
    store: DocumentStore,
    *,
    mapping: dict[str, int] | None = None,
    target: str | None = None,
    partition_on: str | None = None,
    mode: str = "append",
) -> tuple:
    """One table into one collection, all columns or by a field map; returns its report row."""
    began, target = time.time(), target or table
    rows = read_table(spark, conn, table, partition_on)
    packed = map_fields(rows, mapping) if mapping else rows
    held = lambda: read_collection(spark, store, target, as_variant=True).count()
    before = held() if mode == "append" else 0
    write_collection(packed, store, target, mode)
    n_rows, written_back = rows.count(), held() - before
    status = MIGRATED if n_rows else SKIPPED_EMPTY
    return table, target, status, n_rows, written_back, len(packed.columns), time.time() - began


def migrate_tables(
    spark: SparkSession,
    conn: Connection,
    store: DocumentStore,
    *,
    tables: list[str] | None = None,
    partition_on: dict[str, str] | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Every table into a collection of the same name."""
    partition_on = partition_on or {}
    work = lambda t: migrate_table(spark, conn, t, store, partition_on=partition_on.get(t))
    return run_report(spark, _each(tables or list_tables(spark, conn), work, concurrency))


def load_csv_to_table(
    spark: SparkSession, path: str, conn: Connection, table: str, mode: str = "overwrite", line_ends: str = "quoted"
) -> None:
    """CSV file(s) into a table, all columns as text."""
    write_table(read_csv(spark, path, line_ends), conn, table, mode)


def load_csv_to_collection(spark: SparkSession, path: str, store: DocumentStore, name: str, line_ends: str = "quoted") -> None:
    """CSV file(s) appended to a collection, all values as text."""
    write_collection(read_csv(spark, path, line_ends), store, name)


def load_json_to_collection(spark: SparkSession, path: str, store: DocumentStore, name: str, on_malformed: str = "error") -> None:
    """JSON Lines documents appended to a collection, values as they are."""
    write_collection(read_json_documents(spark, path, on_malformed=on_malformed), store, name)


def job_from_message(store_of: Callable[[dict], DocumentStore], conn_of: Callable[[dict], Connection]):
    """A job for control messages that name both sides: all tables into the named database."""

    def job(spark: SparkSession, message: dict) -> None:
        migrate_tables(spark, conn_of(message), store_of(message))

    return job


def documents_database(message: dict) -> str:
    """Database the documents go to: the one the message names, else the source's name."""
    return message.get("mongo_db_name") or message["sql_database"]


def relational_database(message: dict) -> str:
    """Database the tables go to, in a form that needs no quoting."""
    return database_name(message["database"])


__all__ = [
    "PLAN_SCHEMA",
    "append_collection",
    "documents_database",
    "documents_to_rows",
    "job_from_message",
    "load_csv_to_collection",
    "load_csv_to_table",
    "load_json_to_collection",
    "migrate_collection",
    "migrate_collections",
    "migrate_table",
    "migrate_tables",
    "read_rejects",
    "relational_database",
    "run_report",
    "sample_document",
]
