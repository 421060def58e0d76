"""Distributed global row number, top-k, HAVING count, calendars and backfill months."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from freshcat.functions.calendar import day_sequence, month_sequence
from freshcat.operators import first_per_key, global_row_number, having_count, months_until_target, top_k
from tests.conftest import SF_SMALL, rows


def test_global_row_number_equals_window_form(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    ours = global_row_number(orders, [("o_totalprice", False)], ties=[("o_orderkey", True)], partitions=7)
    w = Window.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
    ref = orders.withColumn("rank", F.row_number().over(w))
    assert sorted(rows(ours)) == sorted(rows(ref))
    # after the range-partitioned write the rows are not shuffled or ranked again: the plan holds
    # the written file, the few counts and their window
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "row_number" not in plan and plan.count("Window [") == 1
    physical = ours._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "o_orderkey" not in "".join(x for x in physical.splitlines() if "Exchange" in x)


def test_row_number_within_groups_over_few_and_many_partitions(spark):
    df = spark.createDataFrame([("abc"[k % 3] if k % 7 else None, k % 11, k) for k in range(500)], "g string, v int, k int").repartition(6)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("k"))
    ref = sorted(rows(df.withColumn("rank", F.row_number().over(w))), key=str)
    for n in (1, 3, 40):
        got = global_row_number(df, [("v", False)], ties=[("k", True)], partitions=n, within=["g"])
        assert sorted(rows(got), key=str) == ref
    assert global_row_number(df.limit(0), [("v", False)]).count() == 0


def test_run_month_follows_the_given_clock():
    from freshcat.plans.monthly_job import current_month

    assert current_month(now=dt.datetime(2023, 2, 28, 14, 59)) == "2023-02"
    assert current_month(now=dt.datetime(2023, 2, 28, 15, 0)) == "2023-03"
    assert current_month(now=dt.datetime(2023, 3, 1, 1, 0, tzinfo=dt.timezone(dt.timedelta(hours=9)))) == "2023-03"
    assert current_month(tz="UTC", now=dt.datetime(2023, 2, 28, 15, 0)) == "2023-02"


def test_galloping_backfill_equals_one_month_at_a_time():
    import random

    from freshcat.operators.backfill import gallop_until_target

    rng = random.Random(2)
    months = [f"m{k}" for k in range(12)]  # newest first
    for _ in range(200):
        keys = ["a", "b", "c"]
        rows_of = {(k, m): rng.choice([0, 0, 1, 3, 9]) for k in keys for m in months}
        known = {p: rng.choice([0, n, 5]) for p, n in rows_of.items() if rng.random() < 0.3}
        target, seen = rng.choice([0, 1, 5, 12, 500]), []

        def evaluate(some, oldest, newest):
            span = months[months.index(newest):months.index(oldest) + 1]
            pairs = [(k, m) for k in some for m in span]
            assert not set(pairs) & set(known) and not set(pairs) & set(seen)
            seen.extend(pairs)
            return {p: rows_of[p] for p in pairs if rows_of[p]}

        got = gallop_until_target(keys, months, target, evaluate, known)
        want = []
        for k in keys:
            total = 0
            for m in months:
                if total >= target:
                    break
                if (k, m) not in known:
                    want.append((k, m))
                total += known.get((k, m), rows_of[k, m])
        assert got == want
        # ranges of 1, 2, 4, ...: fewer than twice the needed months and one are made
        for k in keys:
            assert sum(p[0] == k for p in seen) <= 2 * sum(p[0] == k for p in want) + 1


def test_top_k_and_having(spark):
    df = spark.createDataFrame([(k, v) for k, v in [(1, 5), (2, 9), (3, 9), (4, 1), (None, 7)]], "k int, v int")
    assert rows(top_k(df, [("v", False)], 3, ties=[("k", True)])) == [(2, 9), (3, 9), (None, 7)]
    groups = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "g string")
    assert sorted(rows(having_count(groups, "g", 2))) == [("a", 2)]
    # NULL group counts 0: it never reaches a threshold of 1
    assert sorted(rows(having_count(groups, "g", 1)), key=str) == [("a", 2), ("b", 1)]


def test_dedup_plans_a_partial_group_limit(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_orderkey")
    out = first_per_key(df, "l_partkey", [("l_suppkey", True)], ties=[("l_orderkey", True)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_month_and_day_sequences(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 8, 17, 5, 0),)], "ts timestamp")
    months = [r.m.isoformat() for r in df.select(F.explode(month_sequence(F.col("ts"), 3)).alias("m")).collect()]
    assert months == ["2001-08-01", "2001-07-01", "2001-06-01"]
    days = [r.d.isoformat() for r in df.select(F.explode(day_sequence(F.lit("2024-02-28"), 3)).alias("d")).collect()]
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_months_until_target(spark):
    monthly = spark.createDataFrame(
        [("2023-05", 40), ("2023-04", 30), ("2023-03", 50), ("2023-02", 10), ("2023-01", 99)],
        "month string, row_count long",
    )
    got = rows(months_until_target(monthly, "month", "row_count", 100, newest="2023-05", oldest="2023-02")
               .orderBy(F.col("month").desc()))
    # 2023-05 (0 before), 2023-04 (40), 2023-03 (70) are needed; 2023-02 has 120 before it
    assert got == [("2023-05", 40, 0), ("2023-04", 30, 40), ("2023-03", 50, 70)]


def test_keep_until_target_per_corner(spark):
    from freshcat.operators import keep_until_target

    data = ([("s", "c", "20230401", i) for i in range(2)] + [("s", "c", "20230301", i) for i in range(3)]
            + [("s", "c", "20230201", 0)] + [("t", "c", "20230201", i) for i in range(9)])
    df = spark.createDataFrame(data, "site string, corner string, target_date string, i int")
    got = sorted({(r.site, r.target_date) for r in keep_until_target(df, 4).collect()})
    # s/c: April (0 before), March (2 before) kept; February has 5 rows before it
    assert got == [("s", "20230301"), ("s", "20230401"), ("t", "20230201")]
    assert keep_until_target(df, 4).count() == 2 + 3 + 9
