from gearbox.sinks.writers import write_csv, write_if_nonempty, write_parquet

__all__ = ["write_csv", "write_if_nonempty", "write_parquet"]
