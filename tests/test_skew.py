"""A group holding a third of all rows: what crosses the shuffle, read from SQL metrics."""

from pyspark.sql import functions as F

from freshcat.operators import aggregate_musics_to_album, first_per_key


def _final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    return plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def _nodes(plan):
    """All nodes of a physical plan, descending into adaptive query stages."""
    stack, out = [plan], []
    while stack:
        node = stack.pop()
        out.append(node)
        if node.nodeName() in ("ShuffleQueryStage", "BroadcastQueryStage"):
            stack.append(node.plan())
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return out


def _metric(node, name):
    metrics = node.metrics()
    return metrics.get(name).get().value() if metrics.contains(name) else None


def _rows_into_window_shuffles(df):
    """Records written by each exchange fed directly by a partial WindowGroupLimit."""
    found = []
    for node in _nodes(_final_plan(df)):
        if node.nodeName() == "Exchange" and node.children().apply(0).nodeName() == "WindowGroupLimit":
            found.append(_metric(node, "shuffleRecordsWritten"))
    return found


def _skewed(spark, parts=8):
    base = spark.range(0, 3000).select(
        F.col("id").cast("string").alias("material_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
        .when(F.col("id") % 3 == 1, (F.col("id") / 2).cast("long").cast("string"))
        .otherwise(F.lit(None).cast("string"))
        .alias("album_music_id"),
        (F.col("id") % 97).cast("int").alias("release_date"),
    )
    cols = {c: F.col("material_id") for c in ("material_name", "music_id", "music_name", "artist_id", "artist_name",
                                              "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id",
                                              "johnnys", "album_music_name", "album_artist_id", "album_artist_name")}
    out = base.select(
        F.lit(1).alias("pickup"),
        "material_id",
        "album_music_id",
        "release_date",
        F.lit(0).alias("score"),
        F.col("release_date").alias("album_release_date"),
        *[v.alias(k) for k, v in cols.items()],
    )
    return out.repartition(parts)


def test_hot_group_ships_one_row_per_task(spark):
    df = _skewed(spark)
    out = aggregate_musics_to_album(df, threshold_num=2, order_column="release_date")
    rows = out.collect()
    assert sum(1 for r in rows if r.music_id == "HOT") == 1
    written = _rows_into_window_shuffles(out)
    assert written, "expected a shuffle fed by a partial WindowGroupLimit"
    # of the hot album's 1000 rows at most threshold rows a map task cross the shuffle; the other
    # 2000 rows, those on no album among them, once each
    assert max(w for w in written if w is not None) <= 2000 + 2 * 8


def test_hot_key_dedup_is_pre_limited(spark):
    df = _skewed(spark).withColumn("k", F.when(F.col("album_music_id") == "HOT", F.lit("HOT")).otherwise(
        F.col("material_id")))
    out = first_per_key(df.select("k", "release_date", "material_id"), "k", [("release_date", True)])
    got = out.where("k = 'HOT'").collect()
    assert len(got) == 1 and got[0].release_date == 0
    out.collect()
    written = [w for w in _rows_into_window_shuffles(out) if w is not None]
    assert written and max(written) <= 3000 - 1000 + 8


def test_hot_join_key_is_split_by_the_skew_join_rule(spark):
    from freshcat.operators import Hop, join_hop

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # a third of the left rows carry one artist id
        left = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("artist_id"), F.col("id").alias("v")
        )
        right = spark.range(0, 30000).select(F.col("id").alias("a_id"), (F.col("id") * 2).alias("w"))
        out = join_hop(left, Hop(right, "artist_id", "a_id", ["w"]))
        assert out.count() == 30000
        out.collect()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
