"""Incremental runner: new item files republish only their months; reruns are no-ops."""

import os
import uuid

from freshcat.session import checkpoint_dir
from freshcat.streaming import run_incremental


def test_incremental_publishes_touched_months(spark):
    base = os.path.join(checkpoint_dir(spark).replace("file:", ""), f"stream-{uuid.uuid4().hex}")
    source = os.path.join(base, "items")
    ckpt = os.path.join(base, "ckpt")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderdate")
    schema = orders.schema
    # first delivery: orders of March 1996 (UTC wall clock; the month is taken in JST)
    orders.where("o_orderdate >= '1996-03-01' AND o_orderdate < '1996-03-20'").write.parquet(
        os.path.join(source, "part1")
    )
    calls = []
    done = run_incremental(spark, source + "/*", schema, "o_orderdate", lambda a, b: calls.append((a, b)), ckpt)
    assert calls == [("1996-03", "1996-03")] and len(done) == 1
    # nothing new: nothing republished
    assert run_incremental(spark, source + "/*", schema, "o_orderdate", lambda a, b: calls.append((a, b)), ckpt) == []
    # second delivery spanning two months
    orders.where("o_orderdate >= '1996-04-25' AND o_orderdate < '1996-05-10'").write.parquet(
        os.path.join(source, "part2")
    )
    run_incremental(spark, source + "/*", schema, "o_orderdate", lambda a, b: calls.append((a, b)), ckpt)
    assert calls[-1] == ("1996-04", "1996-05")
    # a third with a gap: the months between are not published again
    orders.where("(o_orderdate >= '1996-07-05' AND o_orderdate < '1996-07-20') OR (o_orderdate >= '1996-10-05' AND o_orderdate < '1996-10-20')").write.parquet(
        os.path.join(source, "part3")
    )
    run_incremental(spark, source + "/*", schema, "o_orderdate", lambda a, b: calls.append((a, b)), ckpt)
    assert calls[-2:] == [("1996-07", "1996-07"), ("1996-10", "1996-10")]
