from gearbox.functions.columns import (
    hash_bucket,
    hash_unit,
    is_missing,
    not_null_all,
    resolve_column,
    to_double,
)

__all__ = ["hash_bucket", "hash_unit", "is_missing", "not_null_all", "resolve_column", "to_double"]
