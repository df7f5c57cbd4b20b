"""The target table of a collection, worked out before anything is written.

A plan is a DataFrame with one row per target column, in column order:
``position, column, paths, kinds, role, sql_type, spark_type, max_chars, max_bytes``.
It has as many rows as the table has columns. Objects whose keys are data would make a column of each key; such
objects, named in ``as_json`` or known by the number of their keys, become one text column each.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.naming import join_parts, snake_case
from docferry.functions.widths import TEXT_BYTES, text_type, varchar, varchar_type, varchar_width, widen
from docferry.operators import leaves
from docferry.operators.leaves import at_path
from docferry.operators.profile import INT_LIMIT, MAX_KEYS, complete_profile, first_values, leaf_rows, profile_columns, with_order

SKIP_METADATA = ("_id", "_class")
KEY_COLUMN = "id"
LEAF, PARENT, KEY = "leaf", "parent", "key"

# Spark types of the relational types in a plan; text types are STRING.
SPARK_TYPES = {
    "BOOLEAN": "boolean",
    "INT": "int",
    "BIGINT": "bigint",
    "FLOAT": "double",
    "DOUBLE": "double",
    "DATETIME": "timestamp_ntz",
    "BLOB": "binary",
}
NUMERIC = [leaves.BOOLEAN, leaves.INT, leaves.LONG, leaves.DOUBLE, leaves.DECIMAL]

PLAN_SCHEMA = (
    "position int, column string, paths array<array<string>>, kinds array<string>, role string, "
    "sql_type string, spark_type string, max_chars long, max_bytes long"
)


def spark_type(sql_type: str) -> str:
    """Spark type of a relational type in a plan."""
    if sql_type.startswith("DECIMAL("):
        return sql_type.lower().replace(" ", "")
    return SPARK_TYPES.get(sql_type, "string")


def collect_profile(
    docs: DataFrame, order_by: str | None = None, as_json: Iterable[Iterable[str]] = (), max_keys: int | None = MAX_KEYS
) -> DataFrame:
    """Profile a collection to its full depth, as a small local DataFrame.

    Objects with more than ``max_keys`` different keys stay whole like those in ``as_json``. ``order_by`` names the key that says which document is the sample
    and which one brings a field first; it adds ``in_sample, first_rank, first_chars,
    first_hoist`` (set on the kind that came first) and ``bad_chars``.
    """
    spark = docs.sparkSession
    rows, found, as_json = complete_profile(docs, as_json, max_keys)
    if order_by is None:
        return spark.createDataFrame(rows, found)
    firsts, bad_chars, sample_ord = _first_facts(docs, rows, order_by, as_json)
    ranks = {o: i for i, o in enumerate(sorted({f.ord for f in firsts.values()}))}

    def facts(row: Row) -> tuple:
        first = firsts.get(tuple(row.path))
        if first is None or first.type_tag != row.type_tag:
            return (*row, False, None, None, False, None)
        bad = bad_chars.get(tuple(row.path))
        return (*row, first.ord == sample_ord, ranks[first.ord], first.chars, first.is_hoist, bad)

    more = "in_sample boolean, first_rank long, first_chars int, first_hoist boolean, bad_chars int"
    schema = T.StructType(found.fields + T._parse_datatype_string(more).fields)
    return spark.createDataFrame([facts(r) for r in rows], schema)


def _first_facts(docs: DataFrame, rows: list[Row], order_by: str, as_json: Iterable[Iterable[str]]) -> tuple[dict, dict, Row | None]:
    """First value of every path, length of the first bad value of date paths, order of the sample.

    The sample document answers most paths; one further pass looks only at the paths it lacks
    and at date paths that also hold something else.
    """
    doc = docs.columns[0]
    first = with_order(docs, order_by).orderBy("ord").limit(1)
    sample = first.select(F.to_json(doc).alias("text"), "ord").collect()
    if not sample:
        return {}, {}, None
    one = docs.sparkSession.createDataFrame([(sample[0]["text"],)], "text string").select(F.parse_json("text").alias(doc))
    own = leaf_rows(one, None, order_by, as_json=as_json).select("path", "ord", "type_tag", F.length("text").alias("chars"), "is_hoist")
    firsts = {tuple(r.path): r for r in own.collect() if r.type_tag != leaves.EMPTY}
    kinds: dict[tuple, set] = {}
    for r in rows:
        kinds.setdefault(tuple(r.path), set()).add(r.type_tag)
    late = [p for p in kinds if p not in firsts]
    dates = [p for p, f in firsts.items() if f.type_tag == leaves.DATE and kinds[p] - {leaves.DATE, leaves.NULL}]
    bad_chars = {}
    if late or dates:
        wanted = F.col("path").isin(*(F.array(*map(F.lit, p)) for p in late + dates))
        for r in first_values(docs, order_by, wanted, as_json).collect():
            path = tuple(r.path)
            if path not in dates and (path not in firsts or r.first.ord < firsts[path].ord):
                firsts[path] = r.first
            if path in dates and r.is_bad:
                bad_chars[path] = r.first.chars
    return firsts, bad_chars, sample[0]["ord"]


def _column_names(paths: set[tuple[str, ...]], hoisted: set[tuple[str, ...]], sep: str) -> dict[tuple[str, ...], str]:
    """Column name of every path; hoisted objects leave no part in the name.

    A hoisted object sits below the top level, and the members it holds are
    looked at as such only when they are not themselves inside a hoisted step.
    """
    names = {}
    for path in paths:
        kept, skipped = [path[0]], False
        for i in range(1, len(path)):
            skipped = not skipped and path[: i + 1] in hoisted and i + 1 < len(path)
            if not skipped:
                kept.append(path[i])
        names[path] = join_parts(kept, sep)
    return names


def _hoisted_paths(rows: list[Row], hoist: str) -> set[tuple[str, ...]]:
    if hoist == "never":
        return set()
    if hoist == "any":
        return {tuple(r.path[:-1]) for r in rows if r.n_hoist}
    if hoist == "sample":
        return {tuple(r.path[:-1]) for r in rows if r.in_sample and r.first_hoist}
    raise ValueError(f"unknown hoist {hoist!r}")


def _array(kinds: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{k}'" for k in kinds) + ")"


def _has(*kinds: str) -> Column:
    return F.expr(f"arrays_overlap(kinds, {_array(kinds)})")


def _only(*kinds: str) -> Column:
    return F.expr(f"size(values) > 0 AND size(array_except(values, {_array(kinds)})) = 0")


def _exact_type() -> Column:
    """Type for all numeric values seen, without loss: the narrowest that holds them, NULL if only text does."""
    decimal, double = f"array_contains(kinds, '{leaves.DECIMAL}')", f"array_contains(kinds, '{leaves.DOUBLE}')"
    least = f"greatest(coalesce(max_scale, 0), if({decimal}, 3, 0))"
    scale = f"if(coalesce(max_digits, 0) + {least} <= 38, {least}, coalesce(max_scale, 0))"
    return F.expr(
        f"""CASE
        WHEN {decimal} OR n_beyond_long > 0 OR ({double} AND n_inexact > 0) THEN
            -- no decimal is infinite or no number
            if(n_not_finite = 0 AND coalesce(max_digits, 0) + {scale} <= 38, concat('DECIMAL(38, ', {scale}, ')'), NULL)
        WHEN {double} THEN 'DOUBLE'
        WHEN array_contains(kinds, '{leaves.LONG}') OR n_wide_int > 0 THEN 'BIGINT'
        WHEN arrays_overlap(kinds, {_array((leaves.INT, leaves.STRING))}) THEN 'INT'
        ELSE 'BOOLEAN' END"""
    )


def _number_type(floating: str) -> Column:
    """Numeric type by the kinds seen, as a column that starts with a sample evolves."""
    return F.expr(
        f"""CASE
        WHEN array_contains(kinds, '{leaves.DECIMAL}') THEN 'DECIMAL(38, 3)'
        WHEN array_contains(kinds, '{leaves.DOUBLE}') THEN '{floating}'
        WHEN array_contains(kinds, '{leaves.LONG}') OR n_wide_int > 0 THEN 'BIGINT'
        WHEN arrays_overlap(kinds, {_array((leaves.INT, leaves.STRING))}) THEN 'INT'
        ELSE 'BOOLEAN' END"""
    )


def _sized_text() -> Column:
    """VARCHAR by the longest value, else the text type that holds it."""
    sized = varchar_type("max_chars")
    return F.when(sized == "TEXT", text_type("max_bytes")).otherwise(sized)


def _full_type() -> Column:
    """Type from all documents: the narrowest that keeps every value."""
    texts_are = lambda bad: ~_has(leaves.STRING) | (F.col(bad) == 0)
    number = F.coalesce(_exact_type(), _sized_text())
    blob = F.when(F.col("max_bytes") > TEXT_BYTES, F.lit(None).cast("string")).otherwise(F.lit("BLOB"))
    return (
        F.when(F.size("values") == 0, F.lit("TEXT"))
        .when(_only(*NUMERIC), number)
        .when(
            _only(*NUMERIC, leaves.STRING) & _has(leaves.INT, leaves.LONG) & ~_has(leaves.DOUBLE, leaves.DECIMAL)
            & texts_are("n_bad_int"),
            number,
        )
        .when(
            _only(*NUMERIC, leaves.STRING) & _has(leaves.DOUBLE, leaves.DECIMAL) & texts_are("n_bad_number"),
            number,
        )
        .when(_only(leaves.DATE, leaves.STRING) & _has(leaves.DATE) & texts_are("n_bad_date"), F.lit("DATETIME"))
        .when(_only(leaves.OBJECT_ID), widen(F.lit("VARCHAR(24)"), "max_chars", "max_bytes"))
        .when(_only(leaves.BINARY), blob)
        .when(_only(leaves.OTHER), widen(F.lit("VARCHAR(255)"), "max_chars", "max_bytes"))
        .when(_has(leaves.BINARY), text_type(F.col("max_bytes") * 2 + 4))
        .when(_has(leaves.LIST), text_type("max_bytes"))
        .otherwise(_sized_text())
    )


def _start_type() -> Column:
    """Type a column starts with: by the sample document, or by the first document that
    brings the field later, whose value is converted to text or 1/0 before it is typed."""
    kind, chars, in_sample = F.col("first_kind"), F.col("first_chars"), F.col("in_sample")
    unmeasured = in_sample & F.col("is_metadata")
    converted = ~in_sample & kind.isin(leaves.OBJECT_ID, leaves.DATE, leaves.LIST)
    return (
        F.when((kind == leaves.STRING) & unmeasured, F.lit("TEXT"))
        .when((kind == leaves.STRING) | converted, varchar_type(chars))
        .when((kind == leaves.NULL) & ~in_sample, varchar_type(F.lit(len("NULL"))))
        .when(kind == leaves.INT, F.lit("INT"))
        .when(kind == leaves.LONG, F.lit("BIGINT"))
        .when(kind == leaves.DOUBLE, F.lit("FLOAT"))
        .when(kind == leaves.DECIMAL, F.lit("DECIMAL(38, 3)"))
        .when(kind == leaves.BOOLEAN, F.when(in_sample, "BOOLEAN").otherwise("INT"))
        .when(kind == leaves.OBJECT_ID, F.lit("VARCHAR(24)"))
        .when(kind == leaves.DATE, F.lit("DATETIME"))
        .when(kind.isin(leaves.LIST, leaves.NULL), F.lit("TEXT"))
        .when(kind == leaves.BINARY, F.lit("BLOB"))
        .otherwise(F.lit("VARCHAR(255)"))
    )


def _evolved_type() -> Column:
    """Type the start type ends with after all documents went in."""
    start = F.col("start")
    ladder = F.array(*map(F.lit, ("BOOLEAN", "INT", "BIGINT", "FLOAT", "DECIMAL(38, 3)")))
    step = F.greatest(F.array_position(ladder, start), F.array_position(ladder, _number_type("FLOAT")))
    refused = ~_only(*NUMERIC, leaves.STRING) & (F.size("values") > 0)
    bad_text = F.when(start.isin("FLOAT", "DECIMAL(38, 3)"), F.col("n_bad_number") > 0).otherwise(F.col("n_bad_int") > 0)
    bad_number = refused | (_has(leaves.STRING) & bad_text) | F.col("null_as_text")
    bad_date = ~_only(leaves.DATE, leaves.STRING) & (F.size("values") > 0) | (F.col("n_bad_date") > 0) | F.col("null_as_text")
    date_width = varchar(varchar_width(F.coalesce(F.col("first_bad_chars"), F.lit(len("NULL")))))
    grown = lambda t: widen(t, "max_chars", "max_bytes")
    return (
        F.when((F.array_position(ladder, start) > 0) & bad_number, grown(varchar(varchar_width(F.lit(0)))))
        .when(F.array_position(ladder, start) > 0, F.try_element_at(ladder, step.cast("int")))
        .when((start == "DATETIME") & bad_date, grown(date_width))
        .otherwise(grown(start))
    )


def infer_plan(
    profile: DataFrame,
    mode: str = "full",
    *,
    hoist: str = "never",
    sep: str = "_",
    on_collision: str = "error",
    null_text: str | None = None,
    skip: tuple[str, ...] = (),
    key: str | None = KEY_COLUMN,
    object_sizes: DataFrame | None = None,
) -> DataFrame:
    """Plan of the target table out of a collected profile.

    ``mode="full"`` types each column from all documents. ``mode="sample"`` starts from the
    first document and applies the widening and demotion rules to the rest; it needs a
    profile taken with ``order_by``. ``object_sizes`` adds columns that hold whole objects
    (:func:`measure_objects`).
    """
    if mode not in ("full", "sample"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = profile.sparkSession
    rows = [r for r in profile.collect() if r.path[0] not in skip]
    with_first = "first_rank" in profile.columns
    if not with_first and (mode == "sample" or hoist == "sample"):
        raise ValueError("this needs a profile taken with order_by")
    hoisted = _hoisted_paths(rows, hoist)
    kept = [r for r in rows if r.type_tag not in (leaves.EMPTY, leaves.OBJECT)]
    # Paths that hold an object in some documents; a column for other values there skips these.
    holds_object = {tuple(r.path[:i]) for r in rows for i in range(1, len(r.path))}
    holds_object |= {tuple(r.path) for r in rows if r.type_tag == leaves.EMPTY}
    objects = [] if object_sizes is None else object_sizes.collect()
    names = _column_names({tuple(r.path) for r in kept} | {tuple(o.path) for o in objects}, hoisted, sep)

    sources: dict[str, set[tuple[str, ...]]] = {}
    for path, name in names.items():
        sources.setdefault(name, set()).add(path)
    clashes = sorted(n for n, paths in sources.items() if len(paths) > 1)
    if clashes and on_collision != "last":
        raise ValueError(f"several fields share the name(s) {clashes}; pass on_collision='last' to keep the last")

    facts = [
        (
            names[tuple(r.path)],
            list(r.path),
            r.type_tag,
            r.n_docs,
            r.max_chars,
            r.max_bytes,
            getattr(r, "n_wide_int", 0),
            getattr(r, "n_beyond_long", 0),
            getattr(r, "n_inexact", 0),
            getattr(r, "n_not_finite", 0),
            getattr(r, "max_digits", None),
            getattr(r, "max_scale", None),
            getattr(r, "n_bad_int", 0),
            getattr(r, "n_bad_number", 0),
            getattr(r, "n_bad_date", 0),
            tuple(r.path) in ((m,) for m in SKIP_METADATA),
            *((r.in_sample, r.first_rank, r.first_chars, r.bad_chars) if with_first else (None,) * 4),
        )
        for r in kept
    ]
    fact_schema = (
        "column string, path array<string>, kind string, n_docs long, max_chars long, max_bytes long, n_wide_int long, "
        "n_beyond_long long, n_inexact long, n_not_finite long, max_digits long, max_scale long, n_bad_int long, n_bad_number long, n_bad_date long, is_metadata boolean, in_sample boolean, rank long, "
        "chars long, bad_chars long"
    )
    null_chars = F.when(F.lit(null_text is not None) & (F.col("kind") == leaves.NULL), F.lit(len(null_text or "")))
    folded = (
        spark.createDataFrame(facts, fact_schema)
        .groupBy("column")
        .agg(
            F.array_sort(F.collect_set("path")).alias("paths"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
            F.greatest(F.max("max_chars"), F.max(null_chars)).alias("max_chars"),
            F.greatest(F.max("max_bytes"), F.max(null_chars)).alias("max_bytes"),
            *(F.sum(c).alias(c) for c in ("n_wide_int", "n_beyond_long", "n_inexact", "n_not_finite", "n_bad_int", "n_bad_number", "n_bad_date")),
            *(F.max(c).alias(c) for c in ("max_digits", "max_scale")),
            F.bool_or("is_metadata").alias("is_metadata"),
            F.bool_or("in_sample").alias("in_sample"),
            F.min_by("kind", "rank").alias("first_kind"),
            F.min_by("chars", "rank").alias("first_chars"),
            F.min_by("bad_chars", F.when(F.col("bad_chars").isNotNull(), F.col("rank"))).alias("first_bad_chars"),
        )
        .withColumn("values", F.array_remove("kinds", leaves.NULL))
        .withColumn("null_as_text", F.lit(null_text is not None) & F.array_contains("kinds", leaves.NULL))
    )
    if mode == "full":
        typed = folded.withColumn("values", F.when(
            F.col("null_as_text"), F.array_union("values", F.array(F.lit(leaves.OTHER), F.lit(leaves.STRING)))
        ).otherwise(F.col("values"))).withColumn("sql_type", _full_type())
    else:
        typed = folded.withColumn("start", _start_type()).withColumn("sql_type", _evolved_type())
    found = typed.select("column", "paths", "kinds", "sql_type", "max_chars", "max_bytes").collect()

    stuck = sorted(r.column for r in found if r.sql_type is None)
    if stuck:
        raise ValueError(f"values too long for a BLOB, which cannot grow: {stuck}")
    whole = {names[tuple(o.path)]: o for o in objects}
    both = {r.column for r in found if r.column in whole}
    plan = [
        (
            r.column,
            [list(p) for p in r.paths],
            list(r.kinds) + [leaves.OBJECT] * any(tuple(p) in holds_object for p in r.paths),
            LEAF,
            r.sql_type,
            r.max_chars,
            r.max_bytes,
        )
        for r in found
        if r.column not in both
    ]
    plan += [
        (c, [list(o.path)], [leaves.OBJECT], PARENT, "LONGTEXT" if c in both else o.sql_type, o.max_chars, o.max_bytes)
        for c, o in whole.items()
    ]
    plan.sort(key=lambda r: min(r[1]))
    if key and not any(r[0] == key for r in plan):
        n_docs = max((r.n_docs for r in rows), default=0)
        plan.insert(0, (key, [], [], KEY, "BIGINT" if n_docs > INT_LIMIT else "INT", None, None))
    return spark.createDataFrame(
        [(i, c, p, k, role, t, "bigint" if role == KEY else spark_type(t), n, b)
         for i, (c, p, k, role, t, n, b) in enumerate(plan)],
        PLAN_SCHEMA,
    )


def measure_objects(docs: DataFrame, paths: list[list[str]]) -> DataFrame:
    """Sizes of whole objects as JSON text, one aggregate for all paths; the type starts as VARCHAR(255)."""
    doc = F.col(docs.columns[0])
    texts = [F.to_json(at_path(doc, p)) for p in paths]
    sizes = docs.agg(
        *(F.max(F.length(t)).cast("long").alias(f"c_{i}") for i, t in enumerate(texts)),
        *(F.max(F.octet_length(t)).cast("long").alias(f"b_{i}") for i, t in enumerate(texts)),
    ).head()
    rows = [(list(p), sizes[f"c_{i}"], sizes[f"b_{i}"]) for i, p in enumerate(paths)]
    frame = docs.sparkSession.createDataFrame(rows, "path array<string>, max_chars long, max_bytes long")
    return frame.withColumn("sql_type", widen(F.lit("VARCHAR(255)"), "max_chars", "max_bytes"))


def plan_documents(
    docs: DataFrame,
    mode: str = "full",
    *,
    hoist: str = "never",
    keep_parent: bool = False,
    order_by: str = "_id",
    as_json: Iterable[str] = (),
    max_keys: int | None = MAX_KEYS,
    **options,
) -> DataFrame:
    """Profile a collection and infer its plan, object columns included.

    ``as_json`` names objects (dotted) that are kept whole, as the JSON text of one column. Objects with more than ``max_keys``
    different keys in all documents are maps, whose keys are data, and kept whole too (None: no limit).
    """
    needs_order = mode == "sample" or hoist == "sample"
    profile = collect_profile(docs, order_by if needs_order else None, [p.split(".") for p in as_json], max_keys)
    rows = profile.collect()
    hoisted = _hoisted_paths(rows, hoist)
    inner = {tuple(r.path[: i + 1]) for r in rows for i in range(len(r.path) - 1)}
    whole = {p for p in inner if p[:-1] in hoisted}
    if keep_parent:
        whole |= {p for p in inner if len(p) == 1}
    sizes = measure_objects(docs, sorted(map(list, whole))) if whole else None
    return infer_plan(profile, mode, hoist=hoist, object_sizes=sizes, **options)


def diff_schema(plan: DataFrame, df: DataFrame) -> DataFrame:
    """Columns ``df`` would add to the planned table: ``column, sql_type`` in column order."""
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType):
        new = plan_documents(df, key=None)
    else:
        new = infer_plan(_typed_profile(df), key=None)
    return new.join(plan.select("column"), "column", "left_anti").orderBy("position").select("column", "sql_type")


def _typed_profile(df: DataFrame) -> DataFrame:
    """Profile of typed rows; columns never seen NULL-free still carry their declared kind."""
    spark: SparkSession = df.sparkSession
    rows = profile_columns(df).withColumn("n_hoist", F.lit(0).cast("long"))
    return spark.createDataFrame(rows.collect(), rows.schema)


def plan_columns(df: DataFrame, **options) -> DataFrame:
    """Plan of a table for rows whose types are already known."""
    return infer_plan(_typed_profile(df), **options)


def table_name(collection: str) -> str:
    """Target table of a collection."""
    return snake_case(collection)
