"""Sources: the raw repairs table (CSV, Parquet, catalog) and the mapping seeds."""

from glazework.sources.raw import (
    RAW_COLUMNS,
    RAW_SCHEMA,
    land_raw_csv,
    read_raw_csv,
    read_raw_parquet,
    read_raw_table,
    write_raw_csv,
)
from glazework.sources.seeds import load_seeds, repeated_keys, seed_rows

__all__ = [
    "RAW_COLUMNS",
    "RAW_SCHEMA",
    "land_raw_csv",
    "load_seeds",
    "read_raw_csv",
    "read_raw_parquet",
    "read_raw_table",
    "repeated_keys",
    "seed_rows",
    "write_raw_csv",
]
