"""Document collections: a folder of JSON Lines per collection, or a connector format."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.values import field as column
from docferry.operators.profile import with_order
from docferry.operators.shape import pack_documents
from docferry.session import list_names, make_dir, path_exists, remove_path, rename_path, written

DOC = "doc"
#: How collections of JSON Lines are packed; Spark and other readers on Hadoop open them by their ending.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
LINES_PER_FILE = 250_000


@dataclass(frozen=True)
class DocumentStore:
    """Where collections live.

    ``format="json"``: ``location`` is a folder with one folder of JSON Lines per collection,
    written with gzip, read with or without it.
    Any other format is a Spark connector (``mongodb``); ``location`` is the database name and
    ``options`` go to the connector, kept out of ``repr`` as they may hold a connection string.
    """

    location: str
    format: str = "json"
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}"

    def target(self, name: str) -> dict[str, str]:
        return {**self.options, "database": self.location, "collection": name}


def list_collections(spark: SparkSession, store: DocumentStore, names: list[str] | None = None) -> list[str]:
    """Names of the collections, or the asked ones among them; one that is not there is an error.

    A connector has no listing in Spark, so it takes the names as given.
    """
    if store.format == "json":
        found = list_names(spark, store.location)
        missing = sorted(set(names or ()) - set(found))
        if missing:
            raise ValueError(f"no such collections: {missing}")
        return found if names is None else [n for n in found if n in set(names)]
    if names is None:
        raise ValueError(f"format {store.format!r} cannot list collections; pass their names")
    return sorted(names)


def read_json_documents(
    spark: SparkSession, path: str | list[str], as_variant: bool = True, on_malformed: str = "error"
) -> DataFrame:
    """JSON documents, one per line: as one VARIANT column, or with the merged schema of all of them.

    A line that is no JSON object is an error, or left out with ``on_malformed="skip"``;
    :func:`malformed_lines` gives those lines.
    """
    if on_malformed not in ("error", "skip"):
        raise ValueError(f"unknown on_malformed {on_malformed!r}")
    if not as_variant:
        return spark.read.option("mode", "FAILFAST" if on_malformed == "error" else "DROPMALFORMED").json(path)
    lines = _lines(spark, path)
    if on_malformed == "skip":
        return lines.where(_is_document()).select(F.parse_json("value").alias(DOC))
    checked = F.when(_is_document(), F.parse_json("value")).otherwise(
        F.raise_error(F.lit("a line holds no JSON object; malformed_lines() gives such lines"))
    )
    return lines.select(checked.alias(DOC))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).where("trim(value) <> ''")


def _is_document() -> Column:
    return F.expr("coalesce(startswith(schema_of_variant(try_parse_json(value)), 'OBJECT<'), false)")


def malformed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that hold no document: ``value``."""
    return _lines(spark, path).where(~_is_document())


def documents_of(df: DataFrame) -> DataFrame:
    """Typed rows as documents in one VARIANT column, each value with its document type."""
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType):
        return df
    packed = pack_documents(df, DOC, typed=True)
    return packed.select(F.parse_json(DOC).alias(DOC))


def read_collection(
    spark: SparkSession, store: DocumentStore, name: str, as_variant: bool = False, on_malformed: str = "error"
) -> DataFrame:
    """All documents of a collection, as inferred columns or as one VARIANT column."""
    if store.format == "json":
        if not has_documents(spark, store, name):
            return spark.createDataFrame([], f"{DOC} variant" if as_variant else "_id string")
        return read_json_documents(spark, store.path(name), as_variant, on_malformed)
    df = spark.read.format(store.format).options(**store.target(name)).load()
    return documents_of(df) if as_variant else df


def replace_collection(df: DataFrame, store: DocumentStore, name: str) -> None:
    """Put changed documents in the place of a collection, also when ``df`` reads that collection.

    They are written next to it first; the old documents go when the new ones are complete.
    """
    if store.format != "json":
        kept, _ = written(df, "replacement")
        write_collection(kept, store, name, "overwrite")
        return
    staged = f"_{name}-{uuid.uuid4().hex}"
    write_collection(df, store, staged)
    remove_path(df.sparkSession, store.path(name))
    rename_path(df.sparkSession, store.path(staged), store.path(name))


def has_documents(spark: SparkSession, store: DocumentStore, name: str) -> bool:
    """False for an empty collection, without reading data."""
    return path_exists(spark, store.path(name)) and bool(list_names(spark, store.path(name)))


def sample_document(df: DataFrame, order_by: str = "_id") -> DataFrame:
    """The first document by key; no row when the collection is empty."""
    if isinstance(df.schema[0].dataType, T.VariantType) and len(df.columns) == 1:
        return with_order(df, order_by).orderBy("ord").limit(1).drop("ord")
    return df.orderBy(column(order_by).asc_nulls_last()).limit(1)


def write_collection(df: DataFrame, store: DocumentStore, name: str, mode: str = "append") -> None:
    """Write rows as documents, NULLs kept; an empty frame still makes the collection."""
    if store.format != "json":
        df.write.format(store.format).mode(mode).options(**store.target(name)).save()
        return
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.VariantType):
        lines = df.select(F.to_json(df.columns[0]).alias("value"))
    else:
        lines = pack_documents(df, "value", typed=True)
    # lines repeat every field name; a packed file cannot be split by its readers, so none gets long
    writer = lines.write.mode(mode).option("maxRecordsPerFile", LINES_PER_FILE).options(**PACKED)
    writer.text(store.path(name))
    make_dir(df.sparkSession, store.path(name))
