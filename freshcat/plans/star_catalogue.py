"""The catalogue's own tables, derived by Spark from the driver's star schema.

Where :mod:`freshcat.plans.star` maps the catalogue roles straight onto the star tables
(the efficient form), this module builds the fourteen catalogue tables with their own
names and columns, so that the catalogue-schema job (:func:`corner_job`: the four-bridge
material snowflake, the provider id map, album header -> collection bridge -> id map ->
material, the JSON track explode) runs unchanged on data that grows with the driver
tables. Item bridges are projections of ``lineitem`` here, so the snowflake re-joins
them on the item id -- the shape of the catalogue, not a plan one would pick for a star.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshcat.operators.joins import Hop, snowflake_left_join
from freshcat.plans.corners import Corner
from freshcat.plans.star import (
    ASSET_STRIDE,
    BACKFILL_OLDEST,
    FLAGSHIP_MONTH,
    FLAGSHIP_SEGMENT,
    FLAGSHIP_THRESHOLD,
    FLAGSHIP_TYPES,
    album_document,
    star_corners,
    star_flags,
    star_tieup_bridge,
    star_tieups,
)


def _no_end() -> F.Column:
    return F.lit(None).cast("timestamp_ntz").alias("catalog_end_date")


def _item_key() -> F.Column:
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *key)


def catalogue_from_star(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The catalogue tables (lazy) derived from the driver tables."""
    li = t["lineitem"]
    lines = li.select(
        _item_key().alias("item_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_returnflag",
        "l_linestatus",
    )
    item = lines.select(
        F.col("item_id").alias("id"),
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("name"),
        F.col("l_shipdate").alias("delivery_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("delivery_end_date"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.col("l_shipdate")).alias(
            "catalog_end_date"
        ),
    )
    ftdt = snowflake_left_join(lines, [Hop(t["part"], "l_partkey", "p_partkey", {"p_type": "filetype_id"})])
    site = snowflake_left_join(
        lines,
        [
            Hop(t["orders"], "l_orderkey", "o_orderkey", {"o_custkey": "__fc_cust"}),
            Hop(t["customer"], "__fc_cust", "c_custkey", {"c_mktsegment": "site_name"}),
        ],
    )
    orders = t["orders"].where(F.col("o_orderstatus") != "P")
    headers = snowflake_left_join(
        orders, [Hop(t["customer"], "o_custkey", "c_custkey", {"c_name": "__fc_cname"})]
    ).select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title_title"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Album")).otherwise(F.lit("Single")).alias("release_type"),
        F.lit("AlbumName").alias("title_titletype"),
        F.lit("ja-Hani").alias("title_titlelanguage"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("en")).otherwise(F.lit("ja-Hani")).alias(
            "artist_names_language"
        ),
        F.col("__fc_cname").alias("artist_names_text"),
        album_document(F.col("o_orderkey"), F.col("o_orderpriority")).alias("asset_structure"),
        _no_end(),
    )
    return {
        "item": item,
        "item_artist": lines.select("item_id", F.col("l_suppkey").alias("artist_id"), _no_end()),
        "item_filetype": ftdt.select("item_id", "filetype_id", _no_end()),
        "item_music": lines.select("item_id", F.col("l_partkey").alias("music_id"), _no_end()),
        "item_site": site.select("site_name", "item_id", _no_end()),
        "music": t["part"].select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("tieup"), _no_end()
        ),
        "artist": t["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), _no_end()),
        "id_map": lines.select(
            F.col("l_orderkey").alias("collection_id"),
            (F.col("l_orderkey") * ASSET_STRIDE + F.col("l_linenumber")).alias("asset_id"),
            F.col("item_id").alias("material_id"),
            _no_end(),
        ),
        "flags": star_flags(t),
        "music_tieup": star_tieup_bridge(t).select("music_id", "tieup_id", "pattern_id", _no_end()),
        "tieup": star_tieups(t).select("id", "name", "detailgenre_id", "searchable", _no_end()),
        "album_detail": headers,
        "album_collection": orders.select(
            F.col("o_orderkey").alias("collection_detail_id"), F.col("o_orderkey").alias("collection_id")
        ),
    }


CATALOGUE_CORNER = Corner(FLAGSHIP_SEGMENT.lower(), "economy_large_medium", FLAGSHIP_SEGMENT, FLAGSHIP_TYPES)


def catalogue_corner_job(t: Mapping[str, DataFrame], month: str = FLAGSHIP_MONTH) -> DataFrame:
    """The catalogue-schema corner job on the derived catalogue (C1, C6-C8 as written)."""
    from freshcat.plans.monthly_job import corner_job

    return corner_job(catalogue_from_star(t), month, CATALOGUE_CORNER, threshold=FLAGSHIP_THRESHOLD)


def catalogue_all_corners(t: Mapping[str, DataFrame], month: str = FLAGSHIP_MONTH) -> DataFrame:
    """Every corner of the month: the function the command line runs."""
    from freshcat.plans.monthly_job import all_corners_job

    return all_corners_job(catalogue_from_star(t), month, star_corners(), threshold=FLAGSHIP_THRESHOLD)


def catalogue_backfill(t: Mapping[str, DataFrame], oldest: str = BACKFILL_OLDEST, newest: str = FLAGSHIP_MONTH) -> DataFrame:
    """Every corner of several months: the function the command line runs."""
    from freshcat.plans.monthly_job import backfill_job

    return backfill_job(catalogue_from_star(t), oldest, newest, star_corners(), threshold=FLAGSHIP_THRESHOLD)


def catalogue_backfill_until_target(
    t: Mapping[str, DataFrame], oldest: str = BACKFILL_OLDEST, newest: str = FLAGSHIP_MONTH, target_rows: int = 50
) -> DataFrame:
    """The months a newest-first backfill makes per corner until ``target_rows``: ranges of
    months through the catalogue-schema job."""
    from freshcat.plans.monthly_job import arrivals_job, backfill_until, months_between

    tables = catalogue_from_star(t)
    rows, _ = backfill_until(
        lambda some, a, b: arrivals_job(tables, some, a, b, threshold=FLAGSHIP_THRESHOLD), star_corners(), months_between(oldest, newest)[::-1], target_rows)
    return rows


def catalogue_text_ids(t: Mapping[str, DataFrame], month: str = FLAGSHIP_MONTH) -> DataFrame:
    """The corner job where the id map's asset ids are text, some of them no numbers."""
    from freshcat.plans.monthly_job import corner_job

    tables = catalogue_from_star(t)
    asset = F.col("asset_id").cast("string")
    text = F.when(F.col("asset_id") % 3 == 0, F.concat(F.lit("x-"), asset)).otherwise(asset)
    tables["id_map"] = tables["id_map"].withColumn("asset_id", text)
    return corner_job(tables, month, CATALOGUE_CORNER, threshold=FLAGSHIP_THRESHOLD)


def catalogue_repeated_headers(t: Mapping[str, DataFrame], month: str = FLAGSHIP_MONTH) -> DataFrame:
    """The corner job where album ids repeat: of every third album a second current header row
    has another name and lists the next order's tracks."""
    from freshcat.plans.monthly_job import corner_job

    tables = catalogue_from_star(t)
    heads = tables["album_detail"]
    again = heads.where(F.col("id") % 3 == 0).withColumn("title_title", F.concat("title_title", F.lit(" (again)"))).withColumn(
        "asset_structure", album_document(F.col("id") + 1, F.lit("3-MEDIUM")))
    tables["album_detail"] = heads.unionByName(again)
    return corner_job(tables, month, CATALOGUE_CORNER, threshold=FLAGSHIP_THRESHOLD)


def catalogue_empty_bridge(t: Mapping[str, DataFrame], month: str = FLAGSHIP_MONTH) -> DataFrame:
    """The corner job where the first scan of the collection bridge comes back empty (S3)."""
    from freshcat.plans.monthly_job import corner_job

    tables = catalogue_from_star(t)
    full = tables["album_collection"]
    tables["album_collection"] = full.where(F.col("collection_id") < 0)
    corner = replace(CATALOGUE_CORNER, fallback_collection_bridge=True)
    return corner_job(tables, month, corner, threshold=FLAGSHIP_THRESHOLD, bridge_fallback=lambda: full)


def catalogue_export(t: Mapping[str, DataFrame], root: str, month: str = FLAGSHIP_MONTH) -> DataFrame:
    """Publish every corner and one without rows, and read the named files back."""
    from freshcat.plans.monthly_job import corner_job, run_all_corners
    from freshcat.sources.sinks import read_partitioned_csv

    tables = catalogue_from_star(t)
    corners = [*star_corners(), Corner("nowhere", "empty", "NO SUCH SITE", ("NONE",))]
    run_all_corners(tables, root, corners, month, threshold=FLAGSHIP_THRESHOLD)
    schema = corner_job(tables, month, CATALOGUE_CORNER).schema
    return read_partitioned_csv(t["lineitem"].sparkSession, root, schema).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def catalogue_audit(t: Mapping[str, DataFrame], root: str, month: str = FLAGSHIP_MONTH, days: int = 7) -> DataFrame:
    """Publish every corner and one without rows, then audit these and a corner that never ran,
    for the month's first days (only the first is a partition)."""
    from freshcat.plans.monthly_job import audit_published, run_all_corners, target_date_of

    corners = [*star_corners(), Corner("nowhere", "empty", "NO SUCH SITE", ("NONE",))]
    run_all_corners(catalogue_from_star(t), root, corners, month, threshold=FLAGSHIP_THRESHOLD)
    never = Corner("nowhere", "never_run", "NO SUCH SITE", ("NONE",))
    return audit_published(t["lineitem"].sparkSession, root, [*corners, never], target_date_of(month), days)
