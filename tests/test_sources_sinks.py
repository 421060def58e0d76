"""Scans with fallback, CSV lookups, partitioned writes, export, registration, audit."""

import glob
import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from freshcat.session import checkpoint_dir
from freshcat.sources import (
    create_partitioned_table,
    export_named_file,
    first_non_empty,
    partition_dir,
    partition_row_counts,
    read_csv_lookup,
    read_partitioned_csv,
    register_partitions,
    write_partitioned_csv,
)
from tests.conftest import rows

DATA = StructType([StructField("k", IntegerType()), StructField("txt", StringType())])


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), f"{name}-{uuid.uuid4().hex}")


def test_first_non_empty_falls_back(spark):
    empty = spark.createDataFrame([], DATA)
    full = spark.createDataFrame([(1, "a")], DATA)
    assert rows(first_non_empty(lambda: empty, lambda: full)) == [(1, "a")]
    assert rows(first_non_empty(lambda: full, lambda: empty)) == [(1, "a")]


def test_csv_keeps_null_empty_and_null_text_apart(spark):
    path = _scratch(spark, "csv")
    df = spark.createDataFrame([(1, ""), (2, None), (3, "null"), (4, "x")], DATA)
    df.coalesce(1).write.option("header", "true").option("nullValue", "\\N").option("emptyValue", '""').csv(path)
    back = read_csv_lookup(spark, path, DATA, null_value="\\N", empty_value="")
    assert sorted(rows(back)) == [(1, ""), (2, None), (3, "null"), (4, "x")]


def test_partitioned_write_overwrites_one_partition_only(spark):
    root = _scratch(spark, "parts")
    march = spark.createDataFrame([(1, "a"), (2, "b")], DATA)
    april = spark.createDataFrame([(3, "c")], DATA)
    write_partitioned_csv(march, root, {"site": "s", "corner": "c", "target_date": "20230301"}, order=[F.col("k")])
    write_partitioned_csv(april, root, {"site": "s", "corner": "c", "target_date": "20230401"})
    # rerun March with new content: April must survive
    write_partitioned_csv(march.where("k = 2"), root, {"site": "s", "corner": "c", "target_date": "20230301"})
    back = read_partitioned_csv(spark, root, DATA)
    assert back.schema["target_date"].dataType == StringType()
    assert sorted(rows(back)) == [(2, "b", "s", "c", "20230301"), (3, "c", "s", "c", "20230401")]


def test_single_file_per_partition_and_named_export(spark):
    root = _scratch(spark, "export")
    df = spark.createDataFrame([(i, str(i)) for i in range(50)], DATA).repartition(5)
    values = {"site": "s", "corner": "c", "target_date": "20230301"}
    write_partitioned_csv(df, root, values, order=[F.col("k").desc()], single_file=True)
    target_dir = partition_dir(root, values)
    assert len(glob.glob(os.path.join(target_dir, "part-*"))) == 1
    path = export_named_file(spark, target_dir, "20230301_s_c.csv")
    assert path.endswith("20230301_s_c.csv")
    with open(os.path.join(target_dir, "20230301_s_c.csv")) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == "k,txt" and lines[1] == "49,49" and len(lines) == 51


def test_register_partitions_makes_them_visible(spark):
    root = _scratch(spark, "table")
    df = spark.createDataFrame([(1, "a")], DATA)
    write_partitioned_csv(df, root, {"site": "s", "corner": "c", "target_date": "20230301"})
    table = f"fc_test_{uuid.uuid4().hex[:8]}"
    create_partitioned_table(spark, table, root, DATA)
    assert spark.table(table).count() == 0
    assert register_partitions(spark, table) == "SUCCEEDED"
    write_partitioned_csv(df, root, {"site": "s", "corner": "c", "target_date": "20230401"})
    register_partitions(spark, table)
    assert sorted(rows(spark.table(table).select("k", "target_date"))) == [(1, "20230301"), (1, "20230401")]


def test_partition_audit_reports_missing_days(spark):
    written = spark.createDataFrame([("s", "2023-03-01"), ("s", "2023-03-01"), ("s", "2023-03-03")], ["site", "d"])
    written = written.withColumn("d", F.to_date("d"))
    expected = spark.createDataFrame([("s",)], ["site"]).select(
        "site", F.explode(F.sequence(F.to_date(F.lit("2023-03-01")), F.to_date(F.lit("2023-03-04")))).alias("d")
    )
    got = sorted((r.site, r.d.isoformat(), r.row_count) for r in partition_row_counts(written, expected, ("site", "d")).collect())
    assert got == [("s", "2023-03-01", 2), ("s", "2023-03-02", 0), ("s", "2023-03-03", 1), ("s", "2023-03-04", 0)]


def test_catalog_table_and_sql_scan(spark):
    from freshcat.sources import catalog_table, load, sql_scan

    nation = load(spark, "/root/testdata/sf0.001", "nation")
    nation.createOrReplaceTempView("fc_nation_view")
    assert catalog_table(spark, None, "fc_nation_view").count() == 25
    assert sql_scan(spark, "fc_nation_view").columns == ["n_nationkey", "n_name", "n_regionkey"]


def test_stage_cuts_the_lineage(spark):
    from freshcat.session import stage

    src = spark.range(0, 100).withColumn("sq", F.col("id") * F.col("id")).where("id % 7 = 0")
    staged = stage(src, "unit")
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "parquet" in plan and "Range" not in plan
    assert staged.count() == 15 and checkpoint_dir(spark).replace("file:", "") in staged.inputFiles()[0]
