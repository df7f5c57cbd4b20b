"""Relational tables: over JDBC, or a folder with one parquet table per name."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docferry.functions.naming import quote
from docferry.plans.ddl import render_ddl, writer_types
from docferry.session import list_names, make_dir, path_exists, remove_path, rename_path

BATCH_SIZE = 1000
PARQUET = ".parquet"
STAGING = "__staging"
STAGED_ATTEMPTS = 3


@dataclass(frozen=True)
class JdbcConnection:
    """A database over JDBC. Secrets stay out of ``repr``."""

    url: str = field(repr=False)
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)
    max_connections: int = 16

    def properties(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        return {**self.options, **{k: v for k, v in given.items() if v is not None}, "preferTimestampNTZ": "true"}

    @property
    def is_derby(self) -> bool:
        """The embedded database. It refuses the writer's NULL for a sized text column."""
        return self.url.startswith("jdbc:derby:")

    def name(self, table: str, mark: str = '"') -> str:
        """Quoted table name for the SQL the connection's dialect builds."""
        mark = "`" if self.url.startswith(("jdbc:mysql", "jdbc:mariadb")) else mark
        return ".".join(quote(p, mark) for p in ([self.schema] if self.schema else []) + [table])


@dataclass(frozen=True)
class FileTables:
    """A folder that plays the database: one parquet table per name."""

    location: str

    def path(self, table: str) -> str:
        return f"{self.location.rstrip('/')}/{table}{PARQUET}"


Connection = JdbcConnection | FileTables


def catalog(spark: SparkSession, conn: JdbcConnection) -> str:
    """Name of a Spark catalog for the connection, registered in this session on first use."""
    name = f"jdbc_{uuid.uuid5(uuid.NAMESPACE_URL, conn.url + (conn.user or '')).hex[:12]}"
    base = f"spark.sql.catalog.{name}"
    if spark.conf.get(base, None) is None:
        spark.conf.set(f"{base}.url", conn.url)
        for key, value in conn.properties().items():
            spark.conf.set(f"{base}.{key}", value)
        spark.conf.set(base, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    return name


def _namespace(spark: SparkSession, conn: JdbcConnection) -> str:
    return ".".join(quote(p) for p in [catalog(spark, conn)] + ([conn.schema] if conn.schema else []))


def list_tables(spark: SparkSession, conn: Connection) -> list[str]:
    """Names of the tables, sorted."""
    if isinstance(conn, FileTables):
        return [n.removesuffix(PARQUET) for n in list_names(spark, conn.location) if n.endswith(PARQUET)]
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {_namespace(spark, conn)}").collect())


def _split(spark: SparkSession, conn: JdbcConnection, table: str, column: str, parts: int) -> dict[str, str]:
    """Bounds of a parallel read, from the database's own minimum and maximum."""
    name = conn.name(table)
    ends = read_query(spark, conn, f"SELECT min({column}) AS lo, max({column}) AS hi FROM {name}").head()
    if ends[0] is None:
        return {}
    return {"partitionColumn": column, "lowerBound": str(ends[0]), "upperBound": str(ends[1]), "numPartitions": str(parts)}


def read_query(spark: SparkSession, conn: JdbcConnection, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=conn.url, query=query, **conn.properties()).load()


def read_table(
    spark: SparkSession,
    conn: Connection,
    table: str,
    partition_on: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """All rows of a table. Over JDBC ``partition_on`` (a number or date column, best the primary
    key) splits the read into ranges; filters and column choices reach the database."""
    if isinstance(conn, FileTables):
        return spark.read.parquet(conn.path(table))
    split = {}
    if partition_on:
        mark = "`" if conn.url.startswith(("jdbc:mysql", "jdbc:mariadb")) else '"'
        split = _split(spark, conn, table, quote(partition_on, mark), partitions or conn.max_connections)
    reader = spark.read.format("jdbc").options(url=conn.url, dbtable=conn.name(table), **conn.properties())
    return reader.options(**split).load()


def describe_table(spark: SparkSession, conn: Connection, table: str) -> DataFrame:
    """Columns of a table in order: ``position, name, type``, sized text types included."""
    rows = []
    for i, f in enumerate(read_table(spark, conn, table).schema):
        sized = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING")
        rows.append((i, f.name, sized or f.dataType.simpleString()))
    return spark.createDataFrame(rows, "position int, name string, type string")


def reset_target(spark: SparkSession, conn: Connection) -> None:
    """Drop all tables of the target and start empty. Destructive."""
    if isinstance(conn, FileTables):
        for table in list_tables(spark, conn):
            remove_path(spark, conn.path(table))
        make_dir(spark, conn.location)
        return
    namespace = _namespace(spark, conn)
    if conn.schema and not spark.sql(f"SHOW NAMESPACES IN {quote(catalog(spark, conn))} LIKE '{conn.schema}'").isEmpty():
        for table in list_tables(spark, conn):
            spark.sql(f"DROP TABLE IF EXISTS {namespace}.{quote(table)}")
    elif conn.schema:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    else:
        raise ValueError("reset_target needs a connection with a schema")


def planned_schema(plan: DataFrame) -> T.StructType:
    """Spark schema of a planned table."""
    fields = ", ".join(f"{quote(r['column'])} {r.spark_type}" for r in plan.orderBy("position").collect())
    return T._parse_datatype_string(fields)


def create_table(plan: DataFrame, conn: Connection, table: str) -> str:
    """Make the planned table, empty, unless it is there; returns the statement as the database would see it."""
    spark = plan.sparkSession
    if table not in list_tables(spark, conn):
        empty = spark.createDataFrame([], planned_schema(plan))
        write_table(empty, conn, table, mode="overwrite", column_types=writer_types(plan))
    return render_ddl(plan, table)


def write_table(
    df: DataFrame,
    conn: Connection,
    table: str,
    mode: str = "append",
    *,
    batch_size: int = BATCH_SIZE,
    staged: bool = False,
    expected_rows: int | None = None,
    truncate: bool = False,
    column_types: str = "",
) -> None:
    """Write rows into a table, in parallel from the executors.

    ``staged`` writes a side table first and swaps it in when its row count is right
    (``expected_rows``, else counted), so that a failed or repeated task leaves no part of a
    load behind; it replaces the table.
    """
    if staged:
        _write_staged(df, conn, table, batch_size, column_types, expected_rows)
    elif isinstance(conn, FileTables):
        df.write.mode(mode).parquet(conn.path(table))
    else:
        writer = df.write.format("jdbc").mode(mode).options(url=conn.url, dbtable=conn.name(table), **conn.properties())
        writer = writer.option("batchsize", batch_size).option("numPartitions", conn.max_connections)
        if column_types:
            writer = writer.option("createTableColumnTypes", column_types)
        writer.option("truncate", truncate).save()


def _write_staged(
    df: DataFrame, conn: Connection, table: str, batch_size: int, column_types: str, expected_rows: int | None
) -> None:
    spark, side = df.sparkSession, table + STAGING
    if isinstance(conn, FileTables):
        # A parquet write is committed as a whole, repeated tasks included.
        write_table(df, conn, side, "overwrite")
        landed = None if expected_rows is None else spark.read.parquet(conn.path(side)).count()
        if landed != expected_rows:
            raise RuntimeError(f"{side} holds {landed} rows instead of {expected_rows}; {table} is unchanged")
        # the table that was there goes only once the new one is in its place
        before = f"{conn.path(table)}{STAGING}"
        if path_exists(spark, before):
            remove_path(spark, before)
        if path_exists(spark, conn.path(table)):
            rename_path(spark, conn.path(table), before)
        rename_path(spark, conn.path(side), conn.path(table))
        if path_exists(spark, before):
            remove_path(spark, before)
        return
    wanted = df.count() if expected_rows is None else expected_rows
    column_types = "" if conn.is_derby else column_types
    for _ in range(STAGED_ATTEMPTS):
        # A JDBC write commits per partition; one repeated after a lost executor leaves extra rows.
        write_table(df, conn, side, "overwrite", batch_size=batch_size, column_types=column_types)
        landed = read_table(spark, conn, side).count()
        if landed == wanted:
            break
    else:
        raise RuntimeError(f"{side} holds {landed} rows instead of {wanted}; {table} is unchanged")
    namespace = _namespace(spark, conn)
    if table in list_tables(spark, conn):
        spark.sql(f"DROP TABLE {namespace}.{quote(table)}")
    if conn.is_derby:
        # Spark leaves the new name unquoted for this database, which would fold it to upper case.
        _execute(spark, conn, f"RENAME TABLE {conn.name(side)} TO {quote(table, '"')}")
        return
    new_name = ".".join(quote(p) for p in ([conn.schema] if conn.schema else []) + [table])
    spark.sql(f"ALTER TABLE {namespace}.{quote(side)} RENAME TO {new_name}")


def _execute(spark: SparkSession, conn: JdbcConnection, statement: str) -> None:
    properties = spark._jvm.java.util.Properties()
    for key, value in conn.properties().items():
        properties.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(conn.url, properties)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()
