from docferry.sources.documents import (
    DocumentStore,
    documents_of,
    list_collections,
    malformed_lines,
    read_collection,
    read_json_documents,
    replace_collection,
    sample_document,
    write_collection,
)
from docferry.sources.files import archive_csv, read_csv
from docferry.sources.tables import (
    FileTables,
    JdbcConnection,
    create_table,
    describe_table,
    list_tables,
    read_table,
    reset_target,
    write_table,
)

__all__ = [
    "DocumentStore",
    "FileTables",
    "JdbcConnection",
    "archive_csv",
    "create_table",
    "describe_table",
    "documents_of",
    "list_collections",
    "list_tables",
    "malformed_lines",
    "read_collection",
    "read_csv",
    "read_json_documents",
    "read_table",
    "replace_collection",
    "reset_target",
    "sample_document",
    "write_collection",
    "write_table",
]
