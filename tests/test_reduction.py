"""The fixed-size key filter, and the album side reduced by it."""

from pyspark.sql import functions as F

from freshcat.operators import reduce as red
from freshcat.operators.joins import Hop, join_hop
from freshcat.operators.reduce import maybe_in
from freshcat.plans.monthly_job import album_parts, corner_job, with_albums
from freshcat.plans.corners import Corner
from freshcat.session import stage
from tests.conftest import rows
from tests.test_monthly_job import NINE, catalogue  # noqa: F401


def _frames(spark, left, right):
    big = spark.range(0, 4000).select(F.when(F.col("id") % 10 != 9, F.col("id")).cast(left).alias("k"), "id")
    small = spark.range(0, 4000, 37).select(F.when(F.col("id") % 5 != 4, F.col("id")).cast(right).alias("key")).unionByName(spark.createDataFrame([(None,)], f"key {right}"))
    return big, small


def test_no_match_is_lost_for_any_pair_of_key_types(spark):
    for left, right in (("bigint", "bigint"), ("int", "bigint"), ("bigint", "smallint"), ("string", "string"), ("string", "int"), ("bigint", "string"),
                        ("double", "double"), ("decimal(10,2)", "decimal(10,2)"), ("int", "double")):
        big, small = _frames(spark, left, right)
        if left == "string":
            big = big.withColumn("k", F.when(F.col("id") % 100 == 1, "no number").otherwise(F.col("k")))
        hop = lambda df: sorted(r.id for r in join_hop(df, Hop(small, "k", "key", [], how="inner")).select("id").collect())  # noqa: B023, E731
        kept = maybe_in(big, "k", small, "key")
        assert hop(kept) == hop(big) and len(hop(big)) > 50
        if "double" not in (left, right):
            assert kept.count() < 300  # of 4000: the keys and some false hits


def test_a_full_filter_lets_everything_through(spark, monkeypatch):
    big, small = _frames(spark, "bigint", "bigint")
    monkeypatch.setattr(red, "SLOTS", 1)
    kept = maybe_in(big, "k", small.unionByName(spark.range(0, 4000).select(F.col("id").alias("key"))), "key")
    assert kept.count() == big.where("k is not null").count()
    assert maybe_in(big, "k", small.limit(0), "key").count() == 0


def test_the_large_side_is_not_shuffled(spark):
    big, small = _frames(spark, "bigint", "bigint")
    plan = maybe_in(big, "k", small, "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning") == plan.count("hashpartitioning(__fc_slot") == 1  # the keys' bits


def test_reduced_albums_join_like_all_albums(spark):
    doc = lambda *ids: '{"Groups": [{"Items": [%s]}]}' % ", ".join('{"AssetId": %d}' % i for i in ids)
    heads = spark.createDataFrame(
        [(f"c{k}", f"album {k}", f"artist {k}", doc(k, k + 1, k + 500)) for k in range(0, 200)] + [("c7", "seven again", "x", doc(7, 8)), ("c8", "none", "x", None), (None, "no id", "x", doc(3))],
        "id string, title_title string, artist_names_text string, asset_structure string")
    bridge = spark.createDataFrame([(f"c{k}", f"col{k % 90}") for k in range(0, 200, 2)] + [(None, "col1"), ("c7", "col7")], "collection_detail_id string, collection_id string")
    ids = spark.createDataFrame([(f"col{k % 90}", k, f"i{k % 60}") for k in range(300)] + [(None, 1, "i1")], "collection_id string, asset_id int, material_id string")
    items = spark.createDataFrame([(f"i{k}", f"r{k}", None, "20230301") for k in range(0, 60, 3)], "id string, artist_id string, delivery_start_date timestamp, target_date string")
    target = stage(spark.createDataFrame([(k, (k * 7) % 30 if k % 4 else None) for k in range(60)], "n int, asset_id int"), "test-target")
    joined = [sorted(rows(with_albums(target, *album_parts(heads, bridge, ids, items, assets=assets)).distinct()), key=str) for assets in (None, target)]
    assert joined[0] == joined[1] and len(joined[0]) > 60
    tracks, _ = album_parts(heads, bridge, ids, items, assets=target)
    assert tracks.count() < 0.3 * album_parts(heads, bridge, ids, items)[0].count()


def test_rows_without_assets_or_albums_stay(spark, catalogue):  # noqa: F811
    # i9 has no row in the id map at all
    out = corner_job(catalogue, "2023-03", Corner("s", "c", "SiteA", ("030300",)), threshold=2)
    assert NINE in rows(out)


def test_the_id_map_is_not_shuffled_whole(spark, catalogue, monkeypatch):  # noqa: F811
    """A catalogue of many assets, few of them in the month: what the album side keeps."""
    from freshcat.plans import monthly_job

    many = spark.range(1000, 30_000).select(
        F.concat(F.lit("far"), (F.col("id") % 500).cast("string")).alias("collection_id"), F.col("id").cast("int").alias("asset_id"),
        F.concat(F.lit("far-item"), F.col("id").cast("string")).alias("material_id"), F.lit(None).cast("timestamp").alias("catalog_end_date"))
    kept, real = [], monthly_job.maybe_in

    def noted(df, key, keys, column):
        out = real(df, key, keys, column)
        kept.append((key, df.count(), out.count()))
        return out

    monkeypatch.setattr(monthly_job, "maybe_in", noted)
    tables = {**catalogue, "id_map": catalogue["id_map"].unionByName(many)}
    plain = rows(corner_job(catalogue, "2023-03", Corner("s", "c", "SiteA", ("030300",)), threshold=2))
    kept.clear()
    assert rows(corner_job(tables, "2023-03", Corner("s", "c", "SiteA", ("030300",)), threshold=2)) == plain
    reads = [(before, after) for key, before, after in kept if key in ("material_id", "collection_id")]
    assert len(reads) == 2 and all(before > 29_000 and after < 300 for before, after in reads)
