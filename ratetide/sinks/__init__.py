from .writers import (  # noqa: F401
    append, materialize, merge_upsert, overwrite, schema_sync, upsert_rows, write_ndjson,
    write_partitioned,
)
