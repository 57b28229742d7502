"""Readers, writers and catalog operations."""

from quarry.sources.readers import (  # noqa: F401
    normalise_columns,
    read_csv,
    read_json,
    read_parquet,
    read_path_sql,
    read_table,
    from_local,
    typed_with_rejects,
)
from quarry.sources.sinks import (  # noqa: F401
    ctas,
    save_table,
    write_csv,
    write_json,
    write_parquet,
    write_path,
)
