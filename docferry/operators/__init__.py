from docferry.operators.keys import add_surrogate_key
from docferry.operators.mutate import (
    apply_patches,
    delete,
    delete_keys,
    deleted_count,
    find,
    matches,
    modified_count,
    update,
)
from docferry.operators.profile import map_paths, profile_columns, profile_documents
from docferry.operators.shape import (
    align_schemas,
    flatten,
    map_fields,
    pack_documents,
    prune_metadata,
    schema_report,
)

__all__ = [
    "add_surrogate_key",
    "align_schemas",
    "apply_patches",
    "delete",
    "delete_keys",
    "deleted_count",
    "find",
    "flatten",
    "map_fields",
    "map_paths",
    "matches",
    "modified_count",
    "pack_documents",
    "profile_columns",
    "profile_documents",
    "prune_metadata",
    "schema_report",
    "update",
]
