"""Sources (scans) and sinks (partitioned CSV writes, export, registration, audit)."""

from freshcat.sources.sinks import (
    PARTITION_COLUMNS,
    create_partitioned_table,
    export_named_file,
    partition_dir,
    partition_row_counts,
    read_partitioned_csv,
    register_partitions,
    write_partitioned_csv,
)
from freshcat.sources.tables import (
    DRIVER_TABLES,
    catalog_table,
    first_non_empty,
    load,
    load_all,
    read_csv_lookup,
    sql_scan,
)

__all__ = [
    "DRIVER_TABLES",
    "PARTITION_COLUMNS",
    "catalog_table",
    "create_partitioned_table",
    "export_named_file",
    "first_non_empty",
    "load",
    "load_all",
    "partition_dir",
    "partition_row_counts",
    "read_csv_lookup",
    "read_partitioned_csv",
    "register_partitions",
    "sql_scan",
    "write_partitioned_csv",
]
