"""Registered queries: each runs operators of the library over whole tables, next to SQL that says
what must come out."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions import (
    as_text,
    convert_values,
    normalize_columns,
    normalize_text,
    prefix_columns,
    varchar_type,
    widen,
)
from docferry.functions.widths import text_type
from docferry.operators import (
    add_surrogate_key,
    align_schemas,
    apply_patches,
    delete,
    delete_keys,
    deleted_count,
    find,
    flatten,
    map_fields,
    modified_count,
    pack_documents,
    profile_columns,
    profile_documents,
    prune_metadata,
    schema_report,
    update,
)
from docferry.plans import (
    apply_plan,
    diff_schema,
    plan_columns,
    plan_documents,
    reject_rows,
    render_additions,
    render_ddl,
)
from docferry.plans.jobs import (
    append_collection,
    load_csv_to_collection,
    load_csv_to_table,
    load_json_to_collection,
    migrate_collections,
    migrate_table,
    migrate_tables,
    read_rejects,
)
from docferry.session import is_local, make_dir, scratch_dir
from docferry.sources import (
    DocumentStore,
    FileTables,
    JdbcConnection,
    archive_csv,
    create_table,
    describe_table,
    documents_of,
    list_collections,
    list_tables,
    malformed_lines,
    read_collection,
    read_csv,
    read_json_documents,
    read_table,
    replace_collection,
    sample_document,
    write_collection,
    write_table,
)
from docferry.streaming import (
    accepted,
    control_stream,
    job_ready,
    keep_table,
    latest_per_topic,
    parse_control,
    quarantine,
    run_on_messages,
    run_when_all_known,
)
from docferry.streaming.control import BOTH_TOPIC, DOCUMENTS_TOPIC, RELATIONAL_TOPIC, ControlSource

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

JDBC_SETTING = "spark.docferry.jdbc.url"

#: The given tables and how many columns each has.
COLUMNS_OF = {
    "benchmark": 2, "conversations": 4, "customer": 5, "documents": 5, "embeddings": 3, "events": 6, "labels": 3,
    "lineitem": 11, "nation": 3, "orders": 6, "pages": 3, "part": 6, "region": 2, "supplier": 4,
}


def query(sql: str | None = None):
    """Register a query under its function name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, FileTables(sf_dir), name)


def document_store(spark: SparkSession, label: str) -> DocumentStore:
    """A new, empty document store in the shared folder."""
    path = scratch_dir(spark, label)
    make_dir(spark, path)
    return DocumentStore(path)


def file_tables(spark: SparkSession, label: str) -> FileTables:
    """A new, empty folder of tables in the shared folder."""
    path = scratch_dir(spark, label)
    make_dir(spark, path)
    return FileTables(path)


def relational_target(spark: SparkSession, label: str):
    """A database to write to: the configured JDBC one, else an embedded one.

    An embedded database lives in one process, so only a local session uses it; a cluster
    without a configured database writes to a folder of tables instead.
    """
    url = spark.conf.get(JDBC_SETTING, None)
    if url:
        return JdbcConnection(url)
    if not is_local(spark):
        return file_tables(spark, label)
    path = scratch_dir(spark, label)
    make_dir(spark, path)
    return JdbcConnection(f"jdbc:derby:{path}/db;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")


# --- names -----------------------------------------------------------------------------------

SNAKE_SQL = (
    "lower(regexp_replace(regexp_replace(replace({0}, ' ', '_'), '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), "
    "'([a-z0-9])([A-Z])', '\\1_\\2', 'g'))"
)


@query(f"SELECT p_partkey, {SNAKE_SQL.format('p_name')} AS name, {SNAKE_SQL.format('p_brand')} AS brand FROM part")
def normalize_text_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", normalize_text("p_name").alias("name"), normalize_text("p_brand").alias("brand"))


@query(f"SELECT o_orderkey, {SNAKE_SQL.format('o_orderpriority')} AS priority FROM orders")
def normalize_text_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", normalize_text("o_orderpriority").alias("priority"))


@query(f"SELECT doc_id, {SNAKE_SQL.format('text')} AS text FROM documents")
def normalize_text_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("text"))


@query(
    "SELECT o_orderkey AS src_order_key, o_custkey AS src_cust_key, o_orderstatus AS src_order_status, "
    "o_totalprice AS src_total_price, o_orderdate AS src_order_date, o_orderpriority AS src_order__priority FROM orders"
)
def normalize_columns_orders(spark, sf_dir):
    camel = ["orderKey", "CustKey", "orderStatus", "totalPrice", "orderDate", "order Priority"]
    return prefix_columns(normalize_columns(table(spark, sf_dir, "orders").toDF(*camel)), "src")


@query("SELECT o_orderkey AS order_key, o_orderpriority AS order_status FROM orders")
def normalize_columns_last_wins(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    clash = orders.select(
        F.col("o_orderkey").alias("orderKey"),
        F.col("o_orderstatus").alias("orderStatus"),
        F.col("o_orderpriority").alias("order_status"),
    )
    return normalize_columns(clash, on_collision="last")


# --- widths ----------------------------------------------------------------------------------

VARCHAR_SQL = (
    "CASE WHEN {0} BETWEEN 1 AND 1000 THEN 'VARCHAR(' || least(greatest(25, ({0} // 25 + 1) * 25), 1000) || ')' "
    "ELSE 'TEXT' END"
)
TEXT_SQL = "CASE WHEN {0} <= 65535 THEN 'TEXT' WHEN {0} <= 16777215 THEN 'MEDIUMTEXT' ELSE 'LONGTEXT' END"
SIZED_SQL = (
    "CASE WHEN {0} BETWEEN 1 AND 1000 THEN 'VARCHAR(' || least(greatest(25, ({0} // 25 + 1) * 25), 1000) || ')' "
    "WHEN {1} <= 65535 THEN 'TEXT' WHEN {1} <= 16777215 THEN 'MEDIUMTEXT' ELSE 'LONGTEXT' END"
)


def widen_sql(width: str, chars: str, octets: str) -> str:
    """Doubling of a VARCHAR(width), spelled out, in SQL."""
    steps = " ".join(
        f"WHEN {chars} <= {width} * {1 << k} AND {width} * {1 << k} <= 1000 THEN 'VARCHAR(' || {width} * {1 << k} || ')'"
        for k in range(1, 10)
    )
    return f"CASE WHEN {chars} <= {width} THEN 'VARCHAR(' || {width} || ')' {steps} ELSE {TEXT_SQL.format(octets)} END"


@query(f"SELECT doc_id, {VARCHAR_SQL.format('length(text)')} AS sql_type FROM documents")
def varchar_type_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", varchar_type(F.length("text")).alias("sql_type"))


@query(f"SELECT conv_id, turn, {VARCHAR_SQL.format('length(text)')} AS sql_type FROM conversations")
def varchar_type_conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", varchar_type(F.length("text")).alias("sql_type")
    )


@query(
    "SELECT source, max(length(text)) AS max_chars, max(strlen(text)) AS max_bytes, "
    + SIZED_SQL.format("max(length(text))", "max(strlen(text))")
    + " AS sql_type FROM documents GROUP BY source"
)
def sized_by_source_documents(spark, sf_dir):
    sizes = (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(F.max(F.length("text")).alias("max_chars"), F.max(F.octet_length("text")).alias("max_bytes"))
    )
    sized = varchar_type("max_chars")
    return sizes.withColumn("sql_type", F.when(sized == "TEXT", text_type("max_bytes")).otherwise(sized))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {SIZED_SQL.format(f'max(length({c}))', f'max(strlen({c}))')} AS sql_type, max(length({c})) AS max_chars, max(strlen({c})) AS max_bytes FROM documents"
        for c in ("lang", "source", "text")
    )
    + "".join(f" UNION ALL SELECT '{c}', 'BIGINT', max(length(CAST({c} AS VARCHAR))), max(length(CAST({c} AS VARCHAR))) FROM documents" for c in ("doc_id", "n_chars"))
)
def infer_plan_documents(spark, sf_dir):
    """The plan of a table for all columns of documents, types and sizes from every row."""
    plan = plan_documents(documents_of(table(spark, sf_dir, "documents")), key=None)
    return plan.select("column", "sql_type", "max_chars", "max_bytes")


@query(
    "WITH g AS (SELECT role, min_by(length(text), (conv_id, turn)) AS n, max(length(text)) AS max_chars, "
    "max(strlen(text)) AS max_bytes FROM conversations GROUP BY role), "
    "s AS (SELECT *, least(greatest(25, (n // 25 + 1) * 25), 1000) AS width FROM g) "
    "SELECT role, " + VARCHAR_SQL.format("n") + " AS start_type, "
    "CASE WHEN n BETWEEN 1 AND 1000 THEN " + widen_sql("width", "max_chars", "max_bytes")
    + " ELSE " + TEXT_SQL.format("max_bytes") + " END AS sql_type FROM s"
)
def widen_from_sample(spark, sf_dir):
    # One fixed-width number orders the rows, so the first-row aggregate stays a hash aggregate.
    place = (F.col("conv_id").cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)") + F.col("turn")).cast("decimal(38,0)")
    sizes = (
        table(spark, sf_dir, "conversations")
        .groupBy("role")
        .agg(
            F.min_by(F.length("text"), place).alias("n"),
            F.max(F.length("text")).alias("max_chars"),
            F.max(F.octet_length("text")).alias("max_bytes"),
        )
        .withColumn("start_type", varchar_type("n"))
    )
    return sizes.select("role", "start_type", widen("start_type", "max_chars", "max_bytes").alias("sql_type"))


# --- profile and plan ------------------------------------------------------------------------


def profile_view(profile: DataFrame, *more: str) -> DataFrame:
    return profile.select(F.concat_ws(".", "path").alias("path"), "type_tag", "n_docs", "n_null", "max_chars", "max_bytes", *more)


def profile_sql(relation: str, columns: dict[str, tuple[str, str]], numbers: bool = True) -> str:
    """One aggregate per column, put together: path -> (kind, text expression)."""
    parts = []
    for path, (kind, text) in columns.items():
        wide = f"count(*) FILTER (abs(CAST({text} AS HUGEINT)) > 2147483647)" if kind in ("INT", "LONG") else "0"
        bad = f"count(*) FILTER (NOT regexp_matches({text}, '^[+-]?[0-9]+$'))" if kind == "STRING" else "0"
        counts = f", {wide} AS n_wide_int, {bad} AS n_bad_int" if numbers else ""
        parts.append(
            f"SELECT '{path}' AS path, '{kind}' AS type_tag, count(*) AS n_docs, 0 AS n_null, "
            f"max(length({text})) AS max_chars, max(strlen({text})) AS max_bytes{counts} FROM {relation}"
        )
    return " UNION ALL ".join(parts)


EVENT_TEXTS = {
    "event_id": ("LONG", "CAST(event_id AS VARCHAR)"),
    "ts": ("DATE", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
    "user_id": ("LONG", "CAST(user_id AS VARCHAR)"),
    "event_type": ("STRING", "event_type"),
    "value": ("DOUBLE", "CAST(value AS VARCHAR)"),
    "props": ("STRING", "props"),
}


@query(profile_sql("events", EVENT_TEXTS))
def profile_events(spark, sf_dir):
    docs = documents_of(table(spark, sf_dir, "events"))
    return profile_view(profile_documents(docs), "n_wide_int", "n_bad_int")


@query(profile_sql("events", EVENT_TEXTS, numbers=False))
def profile_columns_events(spark, sf_dir):
    return profile_view(profile_columns(table(spark, sf_dir, "events")))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents with ``props`` as a nested object, one VARIANT column."""
    events = table(spark, sf_dir, "events")
    nested = events.select(
        F.col("event_id").alias("_id"),
        F.struct(F.concat(F.col("ts").cast("string"), F.lit("Z")).alias("$date")).alias("createdAt"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        "value",
        F.parse_json("props").alias("props"),
    )
    return nested.select(F.parse_json(F.to_json(F.struct("*"))).alias("doc"))


NESTED_TEXTS = {
    "_id": ("INT", "CAST(event_id AS VARCHAR)"),
    "createdAt": ("DATE", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
    "userId": ("INT", "CAST(user_id AS VARCHAR)"),
    "eventType": ("STRING", "event_type"),
    "value": ("DOUBLE", "CAST(value AS VARCHAR)"),
    "props.k": ("INT", "json_extract_string(props, '$.k')"),
}


def digits_sql(relation: str, columns: dict[str, tuple[str, str]]) -> str:
    """Most digits before and after the decimal point of the columns that are numbers, NULL for the others."""
    parts = []
    for path, (kind, text) in columns.items():
        before, after = f"max(length(ltrim(split_part({text}, '.', 1), '-0')))", f"max(length(rtrim(split_part({text}, '.', 2), '0')))"
        measured = (before, after) if kind in ("INT", "LONG", "DOUBLE") else ("max(CAST(NULL AS INTEGER))",) * 2
        parts.append(f"SELECT '{path}' AS path, {measured[0]} AS max_digits, {measured[1]} AS max_scale FROM {relation}")
    return " UNION ALL ".join(parts)


@query(f"SELECT * FROM ({profile_sql('events', NESTED_TEXTS)}) JOIN ({digits_sql('events', NESTED_TEXTS)}) USING (path)")
def profile_props(spark, sf_dir):
    """All paths of documents with a nested object, with sizes and digits."""
    found = profile_documents(event_documents(spark, sf_dir))
    return profile_view(found, "n_wide_int", "n_bad_int", "max_digits", "max_scale")


@query(
    "SELECT 'embedding' AS path, 'LIST' AS type_tag, count(*) AS n_docs, 0 AS n_null FROM embeddings "
    "UNION ALL SELECT 'label', 'INT', count(*), 0 FROM embeddings UNION ALL SELECT 'vec_id', 'LONG', count(*), 0 FROM embeddings"
)
def profile_embeddings(spark, sf_dir):
    docs = documents_of(table(spark, sf_dir, "embeddings"))
    return profile_view(profile_documents(docs)).select("path", "type_tag", "n_docs", "n_null")


def plan_view(plan: DataFrame, *more: str) -> DataFrame:
    return plan.select("position", "column", "sql_type", *more)


@query(
    "SELECT * FROM (VALUES (0, 'id', 'INT'), (1, '_id', 'INT'), (2, 'created_at', 'DATETIME'), "
    "(4, 'props_k', 'INT'), (5, 'user_id', 'INT'), (6, 'value', 'DOUBLE')) t(position, \"column\", sql_type) "
    "UNION ALL SELECT 3, 'event_type', " + SIZED_SQL.format("max(length(event_type))", "max(strlen(event_type))") + " FROM events"
)
def plan_events(spark, sf_dir):
    return plan_view(plan_documents(event_documents(spark, sf_dir)))


@query(
    "SELECT * FROM (VALUES (0, 'id', 'INT'), (1, '_id', 'INT'), (2, 'created_at', 'DATETIME'), "
    "(4, 'props_k', 'INT'), (5, 'user_id', 'INT'), (6, 'value', 'FLOAT')) t(position, \"column\", sql_type) "
    "UNION ALL SELECT 3, 'event_type', CASE WHEN n BETWEEN 1 AND 1000 THEN " + widen_sql("width", "max_chars", "max_chars")
    + " ELSE 'TEXT' END FROM (SELECT *, least(greatest(25, (n // 25 + 1) * 25), 1000) AS width FROM "
    "(SELECT min_by(length(event_type), event_id) AS n, max(length(event_type)) AS max_chars FROM events))"
)
def plan_events_sample(spark, sf_dir):
    return plan_view(plan_documents(event_documents(spark, sf_dir), "sample"))


@query(
    "SELECT 0 AS position, 'doc_id' AS \"column\", 'BIGINT' AS sql_type, max(length(CAST(doc_id AS VARCHAR))) AS max_chars FROM documents "
    + "".join(
        f"UNION ALL SELECT {i}, '{c}', {SIZED_SQL.format(f'max(length({c}))', f'max(strlen({c}))')}, max(length({c})) FROM documents "
        for i, c in ((1, "lang"), (3, "source"), (4, "text"))
    )
    + "UNION ALL SELECT 2, 'n_chars', 'BIGINT', max(length(CAST(n_chars AS VARCHAR))) FROM documents"
)
def plan_columns_documents(spark, sf_dir):
    return plan_view(plan_columns(table(spark, sf_dir, "documents"), key=None), "max_chars")


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose ``mixed`` field is a number, and text for clicks; ``seenAt`` a date, and text for views."""
    events = table(spark, sf_dir, "events")
    number = F.get_json_object("props", "$.k")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    mixed = F.when(F.col("event_type") == "click", quoted(F.col("event_type"))).otherwise(number)
    at = F.when(F.col("event_type") == "view", quoted(F.col("event_type"))).otherwise(
        F.concat(F.lit('{"$date":"'), F.col("ts").cast("string"), F.lit('Z"}'))
    )
    text = F.concat(F.lit('{"_id":'), F.col("event_id").cast("string"), F.lit(',"mixed":'), mixed, F.lit(',"seenAt":'), at, F.lit("}"))
    return events.select(F.parse_json(text).alias("doc"))


MIXED_SQL = (
    "SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN event_type ELSE json_extract_string(props, '$.k') END AS mixed, "
    "CASE WHEN event_type = 'view' THEN event_type ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen_at FROM events"
)


@query(
    f"WITH m AS ({MIXED_SQL}), g AS (SELECT min_by(event_type, event_id) AS first_type, "
    "count(*) FILTER (NOT regexp_matches(mixed, '^[+-]?[0-9]+$')) AS bad_int, "
    "count(*) FILTER (NOT regexp_matches(seen_at, '^[0-9]{4}-')) AS bad_date, max(length(mixed)) AS mixed_chars, max(length(seen_at)) AS at_chars FROM m) "
    "SELECT 'mixed' AS \"column\", CASE WHEN bad_int > 0 THEN 'VARCHAR(25)' ELSE 'INT' END AS sql_type, mixed_chars AS max_chars FROM g "
    "UNION ALL SELECT 'seen_at', CASE WHEN bad_date > 0 THEN 'VARCHAR(25)' ELSE 'DATETIME' END, at_chars FROM g"
)
def demote_mixed(spark, sf_dir):
    plan = plan_documents(mixed_documents(spark, sf_dir), "sample", key=None)
    return plan.where("column IN ('mixed', 'seen_at')").select("column", "sql_type", "max_chars")


@query(
    f"WITH m AS ({MIXED_SQL}) SELECT event_id, 'mixed' AS \"column\", mixed AS value FROM m WHERE event_type = 'click' "
    "UNION ALL SELECT event_id, 'seen_at', seen_at FROM m WHERE event_type = 'view'"
)
def reject_mixed(spark, sf_dir):
    """Rows a plan made before the bad values came would refuse."""
    events = mixed_documents(spark, sf_dir)
    clean = events.where("try_variant_get(doc, '$.mixed', 'string') <> 'click' AND try_variant_get(doc, '$.seenAt', 'string') <> 'view'")
    rejected = reject_rows(events, plan_documents(clean))
    return rejected.select(F.try_variant_get("doc", "$._id", "bigint").alias("event_id"), "column", "value")


@query(
    "SELECT 'c_mktsegment' AS \"column\", " + SIZED_SQL.format("max(length(c_mktsegment))", "max(strlen(c_mktsegment))")
    + " AS sql_type FROM customer UNION ALL SELECT 'c_name', "
    + SIZED_SQL.format("max(length(c_name))", "max(strlen(c_name))") + " FROM customer"
)
def diff_schema_customer(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    before = plan_columns(customers.drop("c_name", "c_mktsegment"), key=None)
    return diff_schema(before, customers)


@query(
    "SELECT 'CREATE TABLE IF NOT EXISTS `customer` (`id` INT AUTO_INCREMENT PRIMARY KEY, `c_acctbal` DOUBLE, "
    "`c_custkey` BIGINT, `c_mktsegment` ' || " + SIZED_SQL.format("max(length(c_mktsegment))", "0") + " || ', `c_name` ' || "
    + SIZED_SQL.format("max(length(c_name))", "0") + " || ', `c_nationkey` INT);' AS ddl FROM customer"
)
def ddl_customer(spark, sf_dir):
    ddl = render_ddl(plan_columns(table(spark, sf_dir, "customer")), "customer")
    return spark.createDataFrame([(ddl,)], "ddl string")


@query(
    "SELECT 'ALTER TABLE `orders` ADD COLUMN `o_orderpriority` ' || "
    + SIZED_SQL.format("max(length(o_orderpriority))", "0") + " || ';' AS ddl FROM orders"
)
def ddl_added_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    before = plan_columns(orders.drop("o_orderpriority"), key=None)
    return spark.createDataFrame([(s,) for s in render_additions(diff_schema(before, orders), "orders")], "ddl string")


# --- shape and values ------------------------------------------------------------------------

EVENT_ROWS_SQL = (
    "SELECT event_id AS _id, date_trunc('second', ts) AS created_at, event_type, CAST(json_extract(props, '$.k') AS INT) AS props_k, "
    "user_id, value FROM events"
)


@query(
    "SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS props_k, "
    "CAST(json_extract(props, '$.k') AS INT) AS props_inner_twice_k FROM events"
)
def flatten_events(spark, sf_dir):
    doubled = F.concat(F.rtrim("props", F.lit("}")), F.lit(',"Inner":{"twiceK":'), F.get_json_object("props", "$.k"), F.lit("}}"))
    events = table(spark, sf_dir, "events").withColumn("props", F.from_json(doubled, "k int, Inner struct<twiceK:int>"))
    return flatten(events)


@query(EVENT_ROWS_SQL.replace("event_id AS _id", "CAST(event_id AS INT) AS _id").replace("user_id, value", "CAST(user_id AS INT) AS user_id, value"))
def rows_of_event_documents(spark, sf_dir):
    docs = event_documents(spark, sf_dir)
    return apply_plan(docs, plan_documents(docs))


def status_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a status object below the top level, under a key that some rows repeat as a value."""
    orders = table(spark, sf_dir, "orders")
    inner = F.struct("o_orderstatus", F.col("o_orderpriority").alias("orderPriority"), F.struct("o_totalprice").alias("money"))
    return orders.select(F.col("o_orderkey").alias("_id"), F.struct(inner.alias("P")).alias("order"))


@query(
    "SELECT o_orderkey AS _id, o_orderstatus AS order_o_orderstatus, o_orderpriority AS order_order_priority, "
    "o_totalprice AS order_money_o_totalprice, "
    "CAST(json_extract(CAST(order_money AS JSON), '$.o_totalprice') AS DOUBLE) AS money_of_parent FROM "
    "(SELECT *, json_object('o_totalprice', o_totalprice) AS order_money FROM orders) "
    "WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P')"
)
def flatten_hoist(spark, sf_dir):
    flat = flatten(status_documents(spark, sf_dir), hoist="any")
    money = F.get_json_object("order_money", "$.o_totalprice").cast("double")
    return flat.withColumn("money_of_parent", money).drop("order_money")


@query(
    "WITH s AS (SELECT min_by(o_orderstatus, o_orderkey) = 'P' AS hoists FROM orders) "
    "SELECT o_orderkey AS _id, o_orderstatus AS status, o_orderpriority AS priority, hoists FROM orders, s"
)
def flatten_hoist_by_sample(spark, sf_dir):
    flat = flatten(status_documents(spark, sf_dir), hoist="sample")
    hoists = "order_o_orderstatus" in flat.columns
    at = "order_" if hoists else "order_p_"
    return flat.select(
        "_id", F.col(at + "o_orderstatus").alias("status"), F.col(at + "order_priority").alias("priority"),
        F.lit(hoists).alias("hoists"),
    )


@query(
    "SELECT o_orderkey AS _id, o_orderstatus AS order_p_o_orderstatus, o_orderpriority AS order_p_order_priority, "
    "o_totalprice AS order_p_money_o_totalprice FROM orders"
)
def flatten_without_hoist(spark, sf_dir):
    return flatten(status_documents(spark, sf_dir), hoist="never")


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value, CASE WHEN value > 50 THEN 1 ELSE 0 END AS high, "
    "'[' || user_id || ',' || event_id || ']' AS pair FROM events"
)
def convert_values_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return convert_values(
        events.select("event_id", "ts", "value", (F.col("value") > 50).alias("high"), F.array("user_id", "event_id").alias("pair"))
    )


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type = 'click' THEN 'NULL' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts, "
    "CASE WHEN event_type = 'error' THEN 'NULL' ELSE CAST(value AS VARCHAR) END AS value FROM events"
)
def null_text(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    gaps = events.select(
        "event_id",
        F.when(F.col("event_type") != "click", F.col("ts")).alias("ts"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )
    return convert_values(gaps, null_text="NULL")


@query("SELECT CAST(COLUMNS(*) AS VARCHAR) FROM orders")
def as_text_orders(spark, sf_dir):
    return as_text(table(spark, sf_dir, "orders"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def prune_metadata_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumns({"_id": F.col("doc_id").cast("string"), "_class": F.lit("Document")})
    return prune_metadata(docs, skip_id=True, skip_class=True)


@query(
    "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal, c_mktsegment, NULL::BIGINT AS s_suppkey FROM customer "
    "UNION ALL BY NAME SELECT s_suppkey, s_name AS name, s_nationkey AS nation, s_acctbal AS c_acctbal FROM supplier"
)
def align_customer_supplier(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "key", "c_name": "name", "c_nationkey": "nation"})
    suppliers = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_name": "name", "s_nationkey": "nation", "s_acctbal": "c_acctbal"}
    )
    return align_schemas([customers, suppliers])


@query("SELECT CAST(to_json(nation) AS VARCHAR) AS document FROM nation")
def pack_documents_nation(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "nation"))


@query("SELECT CAST(to_json(customer) AS VARCHAR) AS document FROM customer")
def pack_documents_customer(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "customer"))


@query("SELECT c_name AS customer, c_custkey AS id, c_name AS name_en FROM customer")
def map_fields_customer(spark, sf_dir):
    return map_fields(table(spark, sf_dir, "customer"), {"customer": 1, "id": 0, "name_en": 1})


@query(
    "SELECT t.*, n_values FROM (SELECT count(*) AS n_values FROM orders), (VALUES (0, '_id', 'bigint'), (1, 'order', 'struct<P:struct<o_orderstatus:string,orderPriority:string,money:struct<o_totalprice:double>>>'), "
    "(2, 'order.P', 'struct<o_orderstatus:string,orderPriority:string,money:struct<o_totalprice:double>>'), "
    "(3, 'order.P.o_orderstatus', 'string'), (4, 'order.P.orderPriority', 'string'), "
    "(5, 'order.P.money', 'struct<o_totalprice:double>'), (6, 'order.P.money.o_totalprice', 'double')) t(position, path, type)"
)
def schema_report_orders(spark, sf_dir):
    """Every field of nested rows with its type, and how many rows have a value there."""
    rows = status_documents(spark, sf_dir)
    return with_values(schema_report(rows), rows, "path")


# --- surrogate keys --------------------------------------------------------------------------


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS id, * FROM orders")
def surrogate_key_orders(spark, sf_dir):
    return add_surrogate_key(table(spark, sf_dir, "orders"), "o_orderkey", unique=True)


@query("SELECT row_number() OVER (ORDER BY c_name) AS id, * FROM customer")
def surrogate_key_by_name(spark, sf_dir):
    return add_surrogate_key(table(spark, sf_dir, "customer"), "c_name")


@query("SELECT row_number() OVER (ORDER BY event_type, ts, event_id) AS id, * FROM events")
def surrogate_key_skewed(spark, sf_dir):
    """Few distinct values lead the order, so each holds a large share of the rows."""
    return add_surrogate_key(table(spark, sf_dir, "events"), ["event_type", "ts", "event_id"])


@query("SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus, l_linenumber) AS id, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def surrogate_key_copies(spark, sf_dir):
    """Rows with very many exact copies."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return add_surrogate_key(rows, ["l_returnflag", "l_linestatus", "l_linenumber"])


# --- finds and keyed changes -----------------------------------------------------------------

ORDER_QUERY = {"o_totalprice": {"$gt": 300000, "$lte": 400000}, "$or": [{"o_orderstatus": "P"}, {"o_orderpriority": {"$in": ["1-URGENT", "5-LOW"]}}]}


@query(
    "SELECT * FROM orders WHERE o_totalprice > 300000 AND o_totalprice <= 400000 "
    "AND (o_orderstatus = 'P' OR o_orderpriority IN ('1-URGENT', '5-LOW'))"
)
def find_orders(spark, sf_dir):
    return find(table(spark, sf_dir, "orders"), ORDER_QUERY)


@query("SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS INT) >= 50 AND event_type <> 'click'")
def find_in_documents(spark, sf_dir):
    docs = event_documents(spark, sf_dir)
    found = find(docs, {"doc.props.k": {"$gte": 50}, "doc.eventType": {"$ne": "click"}})
    return found.select(F.try_variant_get("doc", "$._id", "bigint").alias("event_id"))


FIRST_SQL = "(SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)"
FIRST_QUERY = {"o_orderstatus": "F", "o_totalprice": {"$gt": 200000}}


@query(
    f"SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = {FIRST_SQL} THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
    f"o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_orderkey = {FIRST_SQL} THEN 'seen' END AS note FROM orders"
)
def update_first_order(spark, sf_dir):
    return update(table(spark, sf_dir, "orders"), FIRST_QUERY, {"o_orderstatus": "X", "note": "seen"}, order_by="o_orderkey")


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 0 ELSE o_totalprice END "
    "AS o_totalprice, o_orderdate, o_orderpriority FROM orders"
)
def update_all_orders(spark, sf_dir):
    return update(table(spark, sf_dir, "orders"), FIRST_QUERY, {"o_totalprice": 0}, first_only=False)


@query(
    "SELECT s_suppkey, n_name AS s_name, s_nationkey, s_acctbal, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey "
    "WHERE n_regionkey < 3 UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier LEFT JOIN nation "
    "ON s_nationkey = n_nationkey WHERE n_regionkey >= 3 OR n_regionkey IS NULL"
)
def apply_patches_supplier(spark, sf_dir):
    patches = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_name"), "n_regionkey"
    )
    return apply_patches(table(spark, sf_dir, "supplier"), patches, "s_nationkey")


@query(f"SELECT * FROM orders WHERE o_orderkey <> {FIRST_SQL}")
def delete_first_order(spark, sf_dir):
    return delete(table(spark, sf_dir, "orders"), FIRST_QUERY, order_by="o_orderkey")


@query("SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def delete_keys_documents(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").where("toxic = 1")
    return delete_keys(table(spark, sf_dir, "documents"), toxic, "doc_id")


@query(
    "SELECT 'updated first' AS change, CAST(count(*) > 0 AS INT) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000 "
    "UNION ALL SELECT 'updated all', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000 "
    "UNION ALL SELECT 'updated to itself', 0 UNION ALL "
    "SELECT 'deleted all', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000"
)
def change_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = [
        ("updated first", modified_count(orders, FIRST_QUERY, {"o_orderstatus": "X"}, order_by="o_orderkey")),
        ("updated all", modified_count(orders, FIRST_QUERY, {"o_orderstatus": "X"}, first_only=False)),
        ("updated to itself", modified_count(orders, FIRST_QUERY, {"o_orderstatus": "F"}, first_only=False)),
        ("deleted all", deleted_count(orders, FIRST_QUERY, first_only=False)),
    ]
    return spark.createDataFrame(rows, "change string, n long")


# --- sources and sinks -----------------------------------------------------------------------


@query("SELECT page_id, url, html FROM pages")
def json_to_collection(spark, sf_dir):
    store = document_store(spark, "pages")
    lines = scratch_dir(spark, "lines")
    table(spark, sf_dir, "pages").write.json(lines)
    load_json_to_collection(spark, lines, store, "pages")
    return read_collection(spark, store, "pages").select("page_id", "url", "html")


@query("SELECT doc_id, lang, source, text, n_chars FROM documents")
def collection_round_trip(spark, sf_dir):
    """Table to documents to table again, through the plan of the documents."""
    store = document_store(spark, "documents")
    write_collection(table(spark, sf_dir, "documents"), store, "documents")
    docs = read_collection(spark, store, "documents", as_variant=True)
    return apply_plan(docs, plan_documents(docs, key=None))


@query("SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 1")
def sample_document_events(spark, sf_dir):
    first = sample_document(event_documents(spark, sf_dir))
    return first.select(
        F.try_variant_get("doc", "$._id", "bigint").alias("event_id"),
        F.try_variant_get("doc", "$.userId", "bigint").alias("user_id"),
    )


@query(
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, "
    "CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part"
)
def csv_round_trip(spark, sf_dir):
    path = scratch_dir(spark, "parts")
    archive_csv(table(spark, sf_dir, "part"), path)
    return read_csv(spark, path, line_ends="escaped")


@query(
    "SELECT CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '\\N' WHEN 3 THEN text || chr(92) || chr(0) || 'n' ELSE chr(92) || chr(92) || 'n' || chr(10) || text END AS text FROM documents, range(2)"
)
def csv_round_trip_empty_texts(spark, sf_dir):
    """A table of one column through an archive, and as one of two: NULLs, empty texts, backslashes, marks and NUL characters stay as they are."""
    path, kind = scratch_dir(spark, "texts"), F.pmod("doc_id", F.lit(5))
    back = F.lit("\\")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.lit("\\N")).when(kind == 3, F.concat("text", back, F.lit("\x00n")))
    text = text.when(kind == 4, F.concat(back, back, F.lit("n\n"), F.col("text")))
    texts = table(spark, sf_dir, "documents").select(text.alias("text"))
    archive_csv(texts, f"{path}/one")
    archive_csv(texts.withColumn("other", F.col("text")), f"{path}/two")
    return read_csv(spark, f"{path}/one", line_ends="escaped").unionByName(read_csv(spark, f"{path}/two", line_ends="escaped").select(F.col("other").alias("text")))


@query("SELECT CAST(COLUMNS(*) AS VARCHAR) FROM documents")
def csv_round_trip_documents(spark, sf_dir):
    """Texts with line ends, quotes and backslashes, through an archive into a table."""
    path, target = scratch_dir(spark, "documents"), file_tables(spark, "tables")
    archive_csv(table(spark, sf_dir, "documents"), path)
    load_csv_to_table(spark, path, target, "documents", line_ends="escaped")
    return read_table(spark, target, "documents")


@query("SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages")
def csv_quoted_pages(spark, sf_dir):
    """The same with line ends kept within quotes, into a collection."""
    path, store = scratch_dir(spark, "pages"), document_store(spark, "collections")
    archive_csv(table(spark, sf_dir, "pages"), path, line_ends="quoted")
    load_csv_to_collection(spark, path, store, "pages")
    return read_collection(spark, store, "pages").select("page_id", "url", "html")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, json_extract_string(props, '$.k') AS props_k FROM events")
def csv_archive_flattens(spark, sf_dir):
    path = scratch_dir(spark, "events")
    archive_csv(table(spark, sf_dir, "events").select("event_id", "ts", F.from_json("props", "k int").alias("props")), path)
    return read_csv(spark, path, line_ends="escaped")


@query("SELECT CAST(COLUMNS(*) AS VARCHAR) FROM supplier")
def csv_to_table(spark, sf_dir):
    path, target = scratch_dir(spark, "suppliers"), file_tables(spark, "tables")
    archive_csv(table(spark, sf_dir, "supplier"), path)
    load_csv_to_table(spark, path, target, "supplier", line_ends="escaped")
    return read_table(spark, target, "supplier")


@query("SELECT CAST(COLUMNS(*) AS VARCHAR) FROM nation")
def csv_to_collection(spark, sf_dir):
    path, store = scratch_dir(spark, "nations"), document_store(spark, "collections")
    archive_csv(table(spark, sf_dir, "nation"), path)
    load_csv_to_collection(spark, path, store, "nation", line_ends="escaped")
    return read_collection(spark, store, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT * FROM customer")
def jdbc_round_trip(spark, sf_dir):
    """Create from a plan, write in parallel, replace through a staged write, read split by key."""
    customers, target = table(spark, sf_dir, "customer"), relational_target(spark, "jdbc")
    create_table(plan_columns(customers, key=None), target, "customer")
    write_table(customers.select("c_acctbal", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"), target, "customer")
    write_table(customers, target, "customer_copy", staged=True)
    back = read_table(spark, target, "customer", partition_on="c_custkey", partitions=4)
    copied = read_table(spark, target, "customer_copy").select("c_custkey", F.col("c_name").alias("copied_name"))
    return back.join(copied, "c_custkey").where("c_name = copied_name").select(*customers.columns)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COLUMNS_OF))
def tables_listing(spark, sf_dir):
    """The tables that are found, each with its rows."""
    names = list_tables(spark, FileTables(sf_dir))
    counts = (table(spark, sf_dir, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in names)
    return reduce(DataFrame.union, counts)


def with_values(described: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """A description with the number of values of each column or field, named in ``name``."""
    fields = [r[0] for r in described.select(name).collect()]
    counts = rows.agg(*(F.count(f).alias(f"n{i}") for i, f in enumerate(fields)))
    pairs = F.array(*(F.struct(F.lit(f).alias("_field"), F.col(f"n{i}").alias("n_values")) for i, f in enumerate(fields)))
    return described.join(counts.select(F.inline(pairs)), F.col(name) == F.col("_field")).drop("_field")


ORDERS_COLUMNS = ("o_orderkey bigint", "o_custkey bigint", "o_orderstatus string", "o_totalprice double", "o_orderdate timestamp_ntz", "o_orderpriority string")


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS name, '{t}' AS type, count({c}) AS n_values FROM orders" for i, (c, t) in enumerate(x.split() for x in ORDERS_COLUMNS)
    )
)
def describe_table_orders(spark, sf_dir):
    """Columns and types of a table, and how many rows have a value there."""
    return with_values(describe_table(spark, FileTables(sf_dir), "orders"), table(spark, sf_dir, "orders"), "name")


# --- control messages ------------------------------------------------------------------------

EVENT_TOPICS = ("click", "view", "purchase", "error")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of messages: the type is the topic, the id the offset. Views are cut short,
    so they are no JSON; errors lack the key. The table may be one file or a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern may be a file or a folder
    value = (
        F.when(F.col("event_type") == "view", F.rtrim(F.col("props"), F.lit("}")))
        .when(F.col("event_type") == "error", F.replace("props", F.lit('"k"'), F.lit('"other"')))
        .otherwise(F.col("props"))
    )
    return events.select(
        F.col("event_type").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(F.col("event_id")).alias("timestamp"),
        value.alias("value"),
    )


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {t: ("k",) for t in EVENT_TOPICS}
    return parse_control(event_messages(spark, sf_dir), keys, keys)


def drained(stream: DataFrame, label: str, output_mode: str) -> DataFrame:
    """Everything a stream gives for the data there now, as a table."""
    spark = stream.sparkSession
    path, checkpoint = scratch_dir(spark, label), scratch_dir(spark, f"{label}-checkpoint")
    stream_query = keep_table(stream, path, checkpoint, output_mode)
    stream_query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


USABLE_SQL = "event_type IN ('click', 'view', 'purchase', 'error') AND event_type NOT IN ('view', 'error')"


@query(
    "SELECT event_type AS topic, max(event_id) AS \"offset\", CAST(json_extract_string(max_by(props, event_id), '$.k') AS INT) AS k, "
    f"count(*) AS n_messages FROM events WHERE {USABLE_SQL} GROUP BY event_type"
)
def control_latest(spark, sf_dir):
    latest = drained(latest_per_topic(parsed_events(spark, sf_dir)), "latest", "complete")
    return latest.select("topic", "offset", F.col("shown")["k"].cast("int").alias("k"), "n_messages")


@query(
    "SELECT event_type AS topic, event_id AS \"offset\", CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN 'unknown topic' "
    "WHEN event_type = 'view' THEN 'bad json' ELSE 'missing key' END AS status, "
    "CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'error') THEN 'unknown topic' "
    "WHEN event_type = 'view' THEN 'bad json' ELSE 'k' END AS reason "
    f"FROM events WHERE NOT ({USABLE_SQL})"
)
def control_quarantine(spark, sf_dir):
    return drained(quarantine(parsed_events(spark, sf_dir)), "quarantine", "append").drop("partition")


@query(
    f"SELECT topic, arg_max(event_id, (o_time, event_id % 2, event_id)) AS \"offset\" FROM (SELECT event_type AS topic, event_id, -(event_id % 1000) AS o_time FROM events WHERE {USABLE_SQL}) GROUP BY topic"
)
def control_latest_by_time(spark, sf_dir):
    """Messages of two partitions, sent in another order than their offsets: time decides."""
    keys = {t: ("k",) for t in EVENT_TOPICS}
    sent = event_messages(spark, sf_dir).withColumns({
        "partition": F.pmod("offset", F.lit(2)).cast("int"),
        "timestamp": F.timestamp_micros(F.lit(10**9) - F.pmod("offset", F.lit(1000))),
    })
    latest = drained(latest_per_topic(parse_control(sent, keys, keys)), "latest", "complete")
    return latest.select("topic", "offset")


@query(
    f"SELECT topic, arg_max(event_id, (o_time, event_id % 2, event_id)) AS \"offset\" FROM (SELECT event_type AS topic, event_id, -(event_id % 1000) AS o_time FROM events WHERE {USABLE_SQL}) GROUP BY topic"
)
def control_latest_folder(spark, sf_dir):
    """The same from a folder of messages that tells when each was sent, in another order than their offsets."""
    keys, folder = {t: ("k",) for t in EVENT_TOPICS}, scratch_dir(spark, "sent")
    messages = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.pmod("event_id", F.lit(2)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(F.lit(10**9) - F.pmod("event_id", F.lit(1000))).alias("timestamp"),
        F.when(F.col("event_type") == "view", F.lit("{{")).when(F.col("event_type") == "error", F.lit("{}")).otherwise(F.col("props")).alias("value"),
    )
    messages.write.json(folder)
    sent = control_stream(spark, ControlSource(path=folder))
    latest = drained(latest_per_topic(parse_control(sent, keys, keys)), "latest", "complete")
    return latest.select("topic", "offset")


@query(
    f"SELECT event_type AS topic, event_id AS \"offset\", CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE {USABLE_SQL}"
)
def control_accepted(spark, sf_dir):
    good = drained(accepted(parsed_events(spark, sf_dir)), "accepted", "append")
    return good.select("topic", "offset", F.col("shown")["k"].cast("int").alias("k"))


@query(
    "SELECT count(DISTINCT event_type) AS n_sides, count(DISTINCT event_type) = 2 AS ready FROM events "
    f"WHERE {USABLE_SQL} AND event_type IN ('click', 'purchase')"
)
def job_ready_events(spark, sf_dir):
    latest = drained(latest_per_topic(parsed_events(spark, sf_dir)), "ready", "complete")
    return job_ready(latest, ("click", "purchase"))


@query(
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000"
)
def find_wrong_kind(spark, sf_dir):
    """Alternatives of another kind than their columns match nothing, and are no error."""
    orders = table(spark, sf_dir, "orders")
    other = [{"o_orderstatus": 5}, {"o_orderkey": "five"}, {"o_orderstatus": {"$gt": 1}}, {"o_orderdate": "no date"}, {"o_totalprice": {"$in": ["x", True]}}]
    wanted = {"o_orderstatus": {"$in": ["F", 5]}, "o_totalprice": {"$gt": 100000, "$ne": "x"}}
    return find(orders, {"$or": [*other, wanted]}).select("o_orderkey", "o_orderstatus")


# --- jobs ------------------------------------------------------------------------------------

COLLECTIONS = ("customer", "supplier", "region")


def collections_of(spark: SparkSession, sf_dir: str) -> DocumentStore:
    """A document store with three tables as collections, and an empty one."""
    store = document_store(spark, "store")
    for name in COLLECTIONS:
        write_collection(table(spark, sf_dir, name), store, name)
    write_collection(table(spark, sf_dir, "nation").where("false"), store, "emptyOne")
    return store


@query(
    "SELECT 'customer' AS source, 'customer' AS target, 'migrated' AS status, count(*) AS rows_in, count(*) AS rows_out, 6 AS columns FROM customer "
    "UNION ALL SELECT 'supplier', 'supplier', 'migrated', count(*), count(*), 5 FROM supplier "
    "UNION ALL SELECT 'region', 'region', 'migrated', count(*), count(*), 3 FROM region "
    "UNION ALL SELECT 'emptyOne', 'empty_one', 'skipped_empty', 0, 0, 0"
)
def migrate_report(spark, sf_dir):
    store, target = collections_of(spark, sf_dir), file_tables(spark, "target")
    report = migrate_collections(spark, store, target, reset=True, concurrency=4)
    return report.drop("seconds")


@query(
    "SELECT row_number() OVER (ORDER BY event_id) AS id, CAST(event_id AS INT) AS _id, date_trunc('second', ts) AS created_at, event_type, "
    "CAST(json_extract(props, '$.k') AS INT) AS props_k, CAST(user_id AS INT) AS user_id, value FROM events"
)
def migrate_events(spark, sf_dir):
    """The whole way of one collection: documents in a store to rows of a typed, keyed table."""
    store, target = document_store(spark, "events"), file_tables(spark, "target")
    write_collection(event_documents(spark, sf_dir), store, "webEvents")
    migrate_collections(spark, store, target)
    return read_table(spark, target, "web_events")


@query(
    "SELECT CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS _id, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, event_type, json_extract_string(props, '$.k') AS props_k, "
    "CAST(user_id AS VARCHAR) AS user_id, CAST(value AS VARCHAR) AS value FROM events"
)
def migrate_events_archive(spark, sf_dir):
    """The CSV archive that goes with a migration."""
    store, target, archive = document_store(spark, "events"), file_tables(spark, "target"), scratch_dir(spark, "archive")
    write_collection(event_documents(spark, sf_dir), store, "webEvents")
    migrate_collections(spark, store, target, archive=archive)
    return read_csv(spark, f"{archive}/web_events", line_ends="escaped")


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS source, '{t}' AS target, 'migrated' AS status, count(*) AS rows_in, count(*) AS rows_out, {n} AS columns FROM {t}"
        for t, n in COLUMNS_OF.items()
    )
)
def migrate_tables_report(spark, sf_dir):
    """All tables of a database into collections."""
    return migrate_tables(spark, FileTables(sf_dir), document_store(spark, "store"), concurrency=4).drop("seconds")


def stored_lines(spark: SparkSession, lines: DataFrame, name: str) -> DocumentStore:
    """A new store with one collection of the given JSON lines."""
    store = document_store(spark, "lines")
    lines.toDF("value").write.text(store.path(name))
    return store


def migrated(spark: SparkSession, lines: DataFrame, **options) -> DataFrame:
    """The table that a collection of JSON lines becomes, its values as text."""
    store, target = stored_lines(spark, lines, "things"), file_tables(spark, "target")
    migrate_collections(spark, store, target, **options)
    rows = read_table(spark, target, "things").drop("id")
    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))


@query(
    "SELECT CAST(event_id AS VARCHAR) AS _id, event_id || if(event_id % 2 = 0, '', repeat('0', 18)) || '.000' AS wide, "
    "event_id || if(event_id % 2 = 0, '', repeat('7', 40)) AS wider FROM events"
)
def migrate_wide_numbers(spark, sf_dir):
    """Integers, and texts of integers, beyond 64 bits and beyond any decimal: every digit stays."""
    wide = "concat(event_id, if(event_id % 2 = 0, '', repeat('{0}', {1})))"
    quoted = lambda text: f"if(event_id % 2 = 0, {text}, concat('\"', {text}, '\"'))"
    parts = f"""concat('{{"_id":', event_id, ',"wide":', {wide.format(0, 18)}, ',"wider":', {quoted(wide.format(7, 40))}, '}}')"""
    return migrated(spark, table(spark, sf_dir, "events").select(F.expr(parts)))


@query(
    "SELECT CAST(event_id AS VARCHAR) AS _id, "
    "CASE event_id % 3 WHEN 0 THEN 'Infinity' WHEN 1 THEN '9007199254740993' ELSE CAST(event_id AS VARCHAR) END AS beside_long, "
    "CASE event_id % 3 WHEN 0 THEN 'NaN' WHEN 1 THEN event_id || '.25' ELSE CAST(event_id AS VARCHAR) END AS beside_decimal, "
    "CASE event_id % 2 WHEN 0 THEN '-Infinity' ELSE event_id || '.5' END AS beside_double FROM events"
)
def migrate_non_finite(spark, sf_dir):
    """NaN and infinities next to integers, decimals and doubles: no value becomes NULL."""
    third, wrapped = "event_id % 3", "concat('{{\"$number{0}\":\"', {1}, '\"}}')"
    beside_long = f"CASE {third} WHEN 0 THEN {wrapped.format('Double', repr('Infinity'))} WHEN 1 THEN '9007199254740993' ELSE string(event_id) END"
    beside_decimal = f"CASE {third} WHEN 0 THEN {wrapped.format('Decimal', repr('NaN'))} WHEN 1 THEN {wrapped.format('Decimal', 'concat(event_id, ' + repr('.25') + ')')} ELSE string(event_id) END"
    beside_double = f"if(event_id % 2 = 0, {wrapped.format('Double', repr('-Infinity'))}, concat(event_id, '.5'))"
    parts = f"""concat('{{"_id":', event_id, ',"beside_long":', {beside_long}, ',"beside_decimal":', {beside_decimal}, ',"beside_double":', {beside_double}, '}}')"""
    return migrated(spark, table(spark, sf_dir, "events").select(F.expr(parts)))


@query(
    "SELECT CAST(row_number() OVER (ORDER BY event_id % 2, event_id) AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS _id, "
    "CAST(event_id * if(event_id % 2 = 0, 1, 10000000000) AS VARCHAR) AS number, "
    "if(event_id % 2 = 0, CAST(event_id AS VARCHAR), 'n/a ' || event_id) AS mixed, "
    "if(event_id % 2 = 0, NULL, event_type) AS added, if(event_id % 2 = 0, event_type, NULL) AS gone FROM events"
)
def migrate_second_run(spark, sf_dir):
    """Two loads into one table: the second has longer numbers, texts in a number column, a new field, and lacks one."""
    target = file_tables(spark, "target")
    parts = (
        ("event_id % 2 = 0", """concat('{"_id":', event_id, ',"number":', event_id, ',"mixed":', event_id, ',"gone":"', event_type, '"}')"""),
        ("event_id % 2 = 1", """concat('{"_id":', event_id, ',"number":', event_id * 10000000000, ',"mixed":"n/a ', event_id, '","added":"', event_type, '"}')"""),
    )
    for half, line in parts:
        lines = table(spark, sf_dir, "events").where(half).select(F.expr(line))
        append_collection(spark, stored_lines(spark, lines, "things"), "things", target)
    rows = read_table(spark, target, "things")
    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))


def strict_loads(spark: SparkSession, sf_dir: str) -> tuple[FileTables, str, tuple]:
    """Even events, then odd ones whose values do not all fit the table that is there: the tables, the quarantine, the second report row."""
    target, rejects, report = file_tables(spark, "target"), scratch_dir(spark, "rejects"), ()
    number = "CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN string(event_id) WHEN event_id % 3 = 1 THEN concat(event_id % 1000, '.5') ELSE concat('\"n/a ', event_id, '\"') END"
    at = """if(event_id % 2 = 1 AND event_id % 5 = 0, '"soon"', '{"$date":"2024-01-31T00:00:00Z"}')"""
    flag = "if(event_id % 2 = 1 AND event_id % 7 = 0, '3', 'true')"
    line = f"""concat('{{"_id":', event_id, ',"number":', {number}, ',"seenAt":', {at}, ',"flag":', {flag}, '}}')"""
    for half in ("event_id % 2 = 0", "event_id % 2 = 1"):
        lines = table(spark, sf_dir, "events").where(half).select(F.expr(line))
        report, _ = append_collection(spark, stored_lines(spark, lines, "things"), "things", target, on_misfit="reject", rejects=rejects)
    return target, rejects, report


@query(
    "WITH odd AS (SELECT * FROM events WHERE event_id % 2 = 1), found AS ("
    "SELECT CAST(event_id AS VARCHAR) AS document, 'number' AS \"column\", if(event_id % 3 = 1, (event_id % 1000) || '.5', 'n/a ' || event_id) AS value FROM odd WHERE event_id % 3 <> 0 "
    "UNION ALL SELECT CAST(event_id AS VARCHAR), 'seen_at', 'soon' FROM odd WHERE event_id % 5 = 0 UNION ALL SELECT CAST(event_id AS VARCHAR), 'flag', '3' FROM odd WHERE event_id % 7 = 0) "
    "SELECT 'things' AS \"table\", document, \"column\", value, (SELECT count(*) FROM found) AS rejected FROM found"
)
def migrate_rejects(spark, sf_dir):
    """What a table with fixed types could not take of a second load, and the number the report gives."""
    _, rejects, report = strict_loads(spark, sf_dir)
    return read_rejects(spark, rejects).drop("load").withColumn("rejected", F.lit(report[-1]).cast("long"))


@query(
    "SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 2 = 0 OR event_id % 3 = 0 THEN event_id END AS number, "
    "CASE WHEN event_id % 2 = 0 OR event_id % 5 <> 0 THEN '2024-01-31 00:00:00' END AS seen_at, CASE WHEN event_id % 2 = 0 OR event_id % 7 <> 0 THEN true END AS flag FROM events"
)
def migrate_rejects_kept(spark, sf_dir):
    """The table after those loads: types as they were, every row there, NULL where a value was rejected."""
    target, _, _ = strict_loads(spark, sf_dir)
    as_text = lambda c: F.col(c).cast("string").alias(c)
    return read_table(spark, target, "things").select(as_text("_id"), "number", as_text("seen_at"), "flag")


@query(
    "SELECT source, target, status, CASE WHEN source = 'broken' THEN 0 ELSE n END AS rows_in FROM (SELECT count(*) AS n FROM events), "
    "(VALUES ('broken', 'broken', 'failed: ValueError'), ('first', 'first', 'migrated'), ('second', 'second', 'migrated')) AS t(source, target, status)"
)
def migrate_with_bad_collection(spark, sf_dir):
    """Three collections, one with two fields of one name: it is reported, the others are migrated."""
    store, events = document_store(spark, "lines"), table(spark, sf_dir, "events")
    for name, field in (("first", "some"), ("broken", "userName"), ("second", "other")):
        line = f"""concat('{{"_id":', event_id, ',"{field}":1,"user_name":2}}')"""
        events.select(F.expr(line).alias("value")).write.text(store.path(name))
    return migrate_collections(spark, store, file_tables(spark, "target")).select("source", "target", "status", "rows_in")


@query(
    "SELECT CAST(event_id AS VARCHAR) AS _id, event_id || if(event_id % 2 = 0, '.00001', '.50000') AS exact, "
    "CASE event_id % 2 WHEN 0 THEN '9007199254740993.0' ELSE event_id || '.5' END AS mixed FROM events"
)
def migrate_mixed_decimals(spark, sf_dir):
    """Decimals with more places than usual next to doubles, and integers that no double holds."""
    parts = """concat('{"_id":', event_id, ',"exact":', if(event_id % 2 = 0, concat('{"$numberDecimal":"', event_id, '.00001"}'), concat(event_id, '.5')),
        ',"mixed":', if(event_id % 2 = 0, '9007199254740993', concat(event_id, '.5')), '}')"""
    return migrated(spark, table(spark, sf_dir, "events").select(F.expr(parts)))


@query("SELECT CAST(event_id AS VARCHAR) AS _id, '{\"u' || user_id || '\":' || event_id || '}' AS by_user FROM events")
def migrate_map_like(spark, sf_dir):
    """An object whose keys are data is known by their number: one column, not one for each key."""
    parts = """concat('{"_id":', event_id, ',"byUser":{"u', user_id, '":', event_id, '}}')"""
    return migrated(spark, table(spark, sf_dir, "events").select(F.expr(parts)), max_keys=8)


@query("SELECT o_orderkey AS _id, o_totalprice AS total_price, o_orderstatus AS status FROM orders")
def migrate_same_name(spark, sf_dir):
    """Two collections whose names become one table name fill one table."""
    store, target = document_store(spark, "store"), file_tables(spark, "target")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("totalPrice"), F.col("o_orderstatus").alias("status"))
    write_collection(orders.where("status = 'F'"), store, "orderList")
    write_collection(orders.where("status <> 'F'"), store, "order_list")
    migrate_collections(spark, store, target)
    return read_table(spark, target, "order_list").select(F.col("_id").cast("long").alias("_id"), "total_price", "status")


@query(
    "SELECT 'customer' AS source, 'customer' AS target, 'migrated' AS status, count(*) AS rows_in, count(*) AS rows_out, 6 AS columns FROM customer "
    "UNION ALL SELECT 'supplier', 'supplier', 'migrated', count(*), count(*), 5 FROM supplier"
)
def migrate_chosen_collections(spark, sf_dir):
    """Only the named collections."""
    report = migrate_collections(spark, collections_of(spark, sf_dir), file_tables(spark, "target"), collections=["supplier", "customer"])
    return report.drop("seconds")


@query("SELECT rtrim(props, '}') AS value, 'malformed' AS found FROM events WHERE event_type = 'view' UNION ALL SELECT CAST(event_id AS VARCHAR), 'document' FROM events WHERE event_type <> 'view'")
def reject_malformed(spark, sf_dir):
    """Lines that hold no document are told apart from those that do."""
    value = "if(event_type = 'view', rtrim('}', props), concat('{\"_id\":', event_id, '}'))"
    store = stored_lines(spark, table(spark, sf_dir, "events").select(F.expr(value)), "things")
    bad = malformed_lines(spark, store.path("things")).select("value", F.lit("malformed").alias("found"))
    good = read_json_documents(spark, store.path("things"), on_malformed="skip")
    return bad.unionByName(good.select(F.try_variant_get("doc", "$._id", "string").alias("value"), F.lit("document").alias("found")))


@query("SELECT c_name AS name, c_custkey AS id FROM customer")
def migrate_table_by_map(spark, sf_dir):
    store = document_store(spark, "store")
    migrate_table(spark, FileTables(sf_dir), "customer", store, mapping={"name": 1, "id": 0}, target="people")
    docs = read_collection(spark, store, "people", as_variant=True)
    return apply_plan(docs, plan_documents(docs, key=None))


@query("SELECT 'n_nationkey' AS field, n_nationkey AS value FROM nation UNION ALL SELECT 'n_regionkey', n_regionkey FROM nation")
def migrate_on_message(spark, sf_dir):
    """A control message starts the migration of a database; a second copy of it is not run again."""
    store, inbox = document_store(spark, "store"), scratch_dir(spark, "inbox")
    keys = {k: "x" for k in ("sql_host", "sql_port", "sql_user", "sql_password", "mongo_uri", "mongo_db_name")}
    value = json.dumps({**keys, "sql_database": sf_dir})
    spark.createDataFrame([(BOTH_TOPIC, 0, 1, value)], "topic string, partition int, offset long, value string").write.json(inbox)
    job = lambda s, message: migrate_tables(s, FileTables(message["sql_database"]), store)
    for _ in range(2):
        run = run_on_messages(
            control_stream(spark, ControlSource(path=inbox)), job, f"{store.location}-done", scratch_dir(spark, "checkpoint")
        )
        run.awaitTermination()
    docs = read_collection(spark, store, "nation", as_variant=True)
    rows = apply_plan(docs, plan_documents(docs, key=None))
    return rows.select(F.expr("stack(2, 'n_nationkey', n_nationkey, 'n_regionkey', n_regionkey) AS (field, value)"))


@query(
    "SELECT event_type AS topic, CAST(json_extract_string(max_by(props, event_id), '$.k') AS INT) AS k, 'None,done,None' AS calls FROM events "
    "WHERE event_type IN ('click', 'purchase') GROUP BY event_type"
)
def control_ready_restarted(spark, sf_dir):
    """Messages of one side, a restart, those of the other side, another restart: one job, with the last message of each."""
    inbox, state, out = scratch_dir(spark, "sent"), scratch_dir(spark, "state"), scratch_dir(spark, "told")
    sides, calls = ("click", "purchase"), []

    def job(session: SparkSession, messages: dict) -> None:
        told = [(topic, int(message["k"])) for topic, message in messages.items()]
        session.createDataFrame(told, "topic string, k int").write.mode("append").parquet(out)

    for side in (*sides, None):
        if side:
            events = table(spark, sf_dir, "events").where(F.col("event_type") == side)
            events.select(
                F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                F.timestamp_micros("event_id").alias("timestamp"), F.col("props").alias("value"),
            ).write.mode("append").json(inbox)
        source = ControlSource(path=inbox)
        calls.append(run_when_all_known(spark, source, job, state, sides, required={t: ("k",) for t in sides}))
    return spark.read.schema("topic string, k int").parquet(out).withColumn("calls", F.lit(",".join(map(str, calls))))


@query(" UNION ALL ".join(f"SELECT '{t}' AS collection, count(*) AS n_docs FROM {t}" for t in COLUMNS_OF))
def migrate_when_ready(spark, sf_dir):
    """Where the tables are and where they go come in two messages; with the second one the whole database is migrated."""
    store, inbox, state = document_store(spark, "store"), scratch_dir(spark, "inbox"), scratch_dir(spark, "state")
    job = lambda s, sides: migrate_tables(s, FileTables(sides[RELATIONAL_TOPIC]["database"]), DocumentStore(sides[DOCUMENTS_TOPIC]["collection"]), concurrency=4)
    sent = (
        (RELATIONAL_TOPIC, {"url": "x", "username": "x", "password": "x", "database": sf_dir}),
        (DOCUMENTS_TOPIC, {"uri": "x", "collection": store.location}),
    )
    for topic, message in sent:
        spark.createDataFrame([(topic, 0, 1, json.dumps(message))], "topic string, partition int, offset long, value string").write.mode("append").json(inbox)
        run_when_all_known(spark, ControlSource(path=inbox), job, state)
    counts = [
        read_collection(spark, store, n, as_variant=True).agg(F.count("*").alias("n_docs")).select(F.lit(n).alias("collection"), "n_docs")
        for n in list_collections(spark, store)
    ]
    return reduce(DataFrame.unionByName, counts)


@query("SELECT unnest(['customer', 'emptyOne', 'region', 'supplier']) AS collection")
def collections_listing(spark, sf_dir):
    names = list_collections(spark, collections_of(spark, sf_dir))
    return spark.createDataFrame([(n,) for n in names], "collection string")


# --- keys of rows that lack them -----------------------------------------------------------------


@query(
    "SELECT has_key, count(*) AS n, count(*) AS n_ids, min(id) AS low, max(id) AS high, count(*) AS in_order FROM ("
    "SELECT event_id % 2 = 0 AS has_key, row_number() OVER (ORDER BY event_id % 2 DESC, event_id) AS id FROM events) GROUP BY has_key"
)
def surrogate_key_missing_ids(spark, sf_dir):
    """Half of the rows lack the key they are numbered by: they come first, told apart by what else they hold."""
    events = table(spark, sf_dir, "events").withColumn("key", F.when(F.col("event_id") % 2 == 0, F.col("event_id")))
    numbered = add_surrogate_key(events, "key", rows_per_bucket=1000)
    has_key = F.col("key").isNotNull()
    missing = events.where("key IS NULL").count()
    place = F.when(has_key, F.floor(F.col("key") / 2) + 1 + missing == F.col("id")).otherwise(F.col("id") <= missing)
    return numbered.groupBy(has_key.alias("has_key")).agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("n_ids"), F.min("id").alias("low"), F.max("id").alias("high"), F.count_if(place).alias("in_order")
    )


# --- documents as stored ------------------------------------------------------------------------


def kinds_by_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose k is a number, a text or a list by turns."""
    k = "get_json_object(props, '$.k')"
    value = f"""concat('{{"_id":', event_id, ',"k":', CASE event_id % 3 WHEN 0 THEN {k} WHEN 1 THEN concat('"', {k}, '"') ELSE concat('[', {k}, ',-1]') END, '}}')"""
    return table(spark, sf_dir, "events").select(F.parse_json(F.expr(value)).alias("doc"))


def stored_ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.try_variant_get("doc", "$._id", "long").alias("event_id"))


@query("SELECT event_id FROM events WHERE event_id % 3 <> 1 AND CAST(json_extract_string(props, '$.k') AS INT) = 5")
def find_mixed_kinds(spark, sf_dir):
    """A number is found as a number and in lists, not as text."""
    return stored_ids(find(kinds_by_turns(spark, sf_dir), {"k": 5}))


@query("SELECT event_id AS _id, CASE WHEN event_type = 'click' THEN 'seen' ELSE event_type END AS event_type, CASE WHEN event_type = 'click' THEN 1 END AS mark FROM events")
def update_event_documents(spark, sf_dir):
    """Documents as stored, changed and put back into their collection."""
    store = document_store(spark, "events")
    write_collection(event_documents(spark, sf_dir), store, "webEvents")
    docs = read_collection(spark, store, "webEvents", as_variant=True)
    replace_collection(update(docs, {"eventType": "click"}, {"eventType": "seen", "more.mark": 1}, first_only=False), store, "webEvents")
    back = read_collection(spark, store, "webEvents", as_variant=True)
    return back.select(
        F.try_variant_get("doc", "$._id", "long").alias("_id"), F.try_variant_get("doc", "$.eventType", "string").alias("event_type"), F.try_variant_get("doc", "$.more.mark", "int").alias("mark")
    )


def ordered_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nothing but their status and priority: nearly all of them tie."""
    return table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")


FIRST_TIED = "(SELECT min(o_orderpriority) FROM orders WHERE o_orderstatus = 'O')"


@query(
    f"SELECT o_orderpriority, o_orderstatus, count(*) - CASE WHEN o_orderstatus = 'O' AND o_orderpriority = {FIRST_TIED} THEN 1 ELSE 0 END AS n "
    f"FROM orders GROUP BY o_orderpriority, o_orderstatus UNION ALL SELECT {FIRST_TIED}, 'changed', 1"
)
def update_first_tied(spark, sf_dir):
    """One of many equal first matches is changed, and no other row."""
    changed = update(ordered_by_priority(spark, sf_dir), {"o_orderstatus": "O"}, {"o_orderstatus": "changed"}, order_by="o_orderpriority")
    return changed.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query(
    f"SELECT o_orderpriority, o_orderstatus, count(*) - CASE WHEN o_orderstatus = 'O' AND o_orderpriority = {FIRST_TIED} THEN 1 ELSE 0 END AS n FROM orders GROUP BY o_orderpriority, o_orderstatus"
)
def delete_first_tied(spark, sf_dir):
    """One of many equal first matches goes, and no other row."""
    kept = delete(ordered_by_priority(spark, sf_dir), {"o_orderstatus": "O"}, order_by="o_orderpriority")
    return kept.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
