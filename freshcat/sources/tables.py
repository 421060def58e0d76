"""Scans (S1-S5): catalogue tables, empty fallback, SQL text scan, typed CSV lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Tables the driver provides as one parquet file each.
DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one table stored as ``{base}/{name}.parquet``.

    Parquet keeps column pruning, predicate pushdown and vectorised reads; nothing is
    selected here so that Catalyst prunes to what the plan uses.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def load_all(spark: SparkSession, base: str, names: Iterable[str] = DRIVER_TABLES) -> dict[str, DataFrame]:
    return {name: load(spark, base, name) for name in names}


def catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Scan a table registered in the session catalog (S1 against a metastore)."""
    return spark.table(f"{database}.{table}" if database else table)


def sql_scan(spark: SparkSession, table: str) -> DataFrame:
    """``SELECT * FROM table`` as SQL text."""
    return spark.sql(f"SELECT * FROM {table}")


def first_non_empty(*loaders: Callable[[], DataFrame]) -> DataFrame:
    """Return the first loader's frame that has at least one row (S3, A4).

    ``isEmpty()`` reads at most one row (a LIMIT 1 job), where ``count() <= 0`` would scan
    everything. The last loader is returned even when empty.
    """
    if not loaders:
        raise ValueError("first_non_empty needs at least one loader")
    for loader in loaders[:-1]:
        frame = loader()
        if not frame.isEmpty():
            return frame
    return loaders[-1]()


def read_csv_lookup(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    null_value: str | None = None,
    empty_value: str | None = None,
) -> DataFrame:
    """Typed CSV lookup table (S5); never ``inferSchema`` (a full extra pass, unstable types).

    ``null_value``/``empty_value`` keep NULL and ``""`` apart on a round trip (H17).
    """
    reader = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if empty_value is not None:
        reader = reader.option("emptyValue", empty_value)
    return reader.csv(path)
