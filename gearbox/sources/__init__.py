from gearbox.sources.fixtures import listings, listings_raw, listings_table, table
from gearbox.sources.fs import data_files, path_exists, require_path
from gearbox.sources.readers import (
    read_csv,
    read_existing_parquet,
    read_first_available,
    read_parquet,
    read_part,
    require_schema,
    schema_profile,
    schema_table,
    sql_view_scan,
)

__all__ = [
    "data_files", "listings", "listings_raw", "listings_table", "path_exists", "read_csv",
    "read_existing_parquet", "read_first_available", "read_parquet", "read_part", "require_path",
    "require_schema", "schema_profile", "schema_table", "sql_view_scan", "table",
]
