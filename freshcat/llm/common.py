"""Helpers shared by the operators: table access, staging, word columns."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshcat.session import checkpoint_dir

#: Words are runs of anything but the six ASCII white-space characters.
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for an application, so that they need
    not have it installed: an archive in the shared checkpoint folder, which Spark copies to
    every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    archive = f"{checkpoint_dir(spark).rstrip('/')}/py-{uuid.uuid4().hex}/freshcat.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(archive)
    stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text): other columns are cut at the scan, a null text becomes empty."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def with_text_hash(df: DataFrame) -> DataFrame:
    """(doc_id, text) plus ``th``: rows are told apart by id and text, so ids may repeat or be null."""
    return df.select("doc_id", F.xxhash64("text").alias("th"), "text")


def same_key(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for name in names:
        cond = cond & a[name].eqNullSafe(b[name])
    return cond


def split_words(text: Column) -> Column:
    """Array of the words of a text; empty for an empty or blank text."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACES)).otherwise(F.array().cast("array<string>"))


def as_row(**cols: Column) -> Column:
    """``inline(as_row(...))``: a one-row generator. Catalyst does not push a projection
    through it, so an array built below is computed once instead of once for every use
    inside a lambda above."""
    return F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder that nothing has used."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


#: Narrow rows (a few numbers) that are worth a task.
ROWS_A_TASK = 200_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more tasks than ``rows`` narrow rows are worth: what is small is not written as
    hundreds of near-empty files. Nothing moves, and many rows keep all partitions."""
    return df.coalesce(max(1, -(-rows // ROWS_A_TASK)))


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing will read any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
