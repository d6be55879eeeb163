from qualia.sources.catalog import (
    DEFAULT_CATALOG,
    default_catalog,
    empty_catalog,
    read_catalog_csv,
    standardize_catalog,
    write_catalog_csv,
)
from qualia.sources.sinks import (
    export_format,
    fresh_path,
    read_result_csv,
    save_table,
    shared_dir,
    write_result_csv,
)
from qualia.sources.tables import TableResolver, full_table_name

__all__ = [
    "DEFAULT_CATALOG",
    "TableResolver",
    "default_catalog",
    "empty_catalog",
    "export_format",
    "fresh_path",
    "full_table_name",
    "read_catalog_csv",
    "read_result_csv",
    "save_table",
    "shared_dir",
    "standardize_catalog",
    "write_catalog_csv",
    "write_result_csv",
]
