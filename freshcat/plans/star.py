"""The catalogue roles mapped onto the driver's star schema.

The driver tables (TPC-H-like) have no catalogue, so the monthly job runs on this
mapping, which keeps every join a many-to-one hop or a bounded fan-out and every filter
pushable:

==================  =====================================================================
catalogue role      star schema
==================  =====================================================================
item (material)     one ``lineitem`` row; id = ``orderkey-linenumber-partkey-suppkey``
start of delivery   ``o_orderdate`` of the item's order (stored UTC, month taken in JST)
SCD end date        ``l_shipdate`` of returned, finished lines (flag R, status F), else NULL
music / file type   ``part`` (``p_name``, ``p_type``) through ``l_partkey``
artist              ``supplier`` (``s_name``) through ``l_suppkey``
site contract       ``customer.c_mktsegment`` through ``orders``
tie-up bridge       ``part`` with ``p_size <= 45``: brand number, pattern = ``p_size``
tie-up              distinct brands; brands 21-25 are not searchable, genre =
                    (brand - 1) div 5, NULL for brands 1-5
flag list           suppliers of nations in region ``ASIA``
album               an order with status F or O; artist = its customer; release date =
                    ``o_orderdate``; tracks = its seven line slots, asset id =
                    ``orderkey * 8 + linenumber``, given as a JSON document whose shape
                    depends on ``o_orderpriority``: tracks in the first of two groups
                    (1), after top-level items (2), alone (3); no group (4); not JSON (5)
==================  =====================================================================

Nothing is collected per order: each album document is built from its own order row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.functions.timezone import JST, local_epoch_seconds, local_month_partition
from freshcat.operators.dedup import filter_duplicate_tieup_item
from freshcat.operators.explode import explode_tracks
from freshcat.operators.filters import corner_filter, current_rows, in_local_month, in_local_months
from freshcat.operators.joins import Hop, join_hop, snowflake_left_join
from freshcat.plans.corners import Corner
from freshcat.plans.monthly_job import backfill_until, corner_targets, months_between, new_arrivals_fact, rollup_fact

# Fixed values of the star mapping (parameters of the driver queries).
FLAGSHIP_MONTH = "1996-03"
FLAGSHIP_SEGMENT = "BUILDING"
FLAGSHIP_TYPES = ("ECONOMY", "LARGE", "MEDIUM")
FLAGSHIP_THRESHOLD = 2
FLAGSHIP_TOP_K = 20
BACKFILL_OLDEST = "1996-01"
BACKFILL_NEWEST = "1996-06"
TRACK_SLOTS = 7
ASSET_STRIDE = 8
TIEUP_MAX_SIZE = 45
UNSEARCHABLE_FROM_BRAND = 21
FLAG_REGION = "ASIA"
FLAG_VALUE = "listed"
ALBUM_STATUSES = ("F", "O")
STAR_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STAR_TYPE_GROUPS = {
    "economy_large_medium": ("ECONOMY", "LARGE", "MEDIUM"),
    "promo_small_standard": ("PROMO", "SMALL", "STANDARD"),
}


def star_corners() -> tuple[Corner, ...]:
    """Ten corners: every segment x two file type groups; one keeps items without tie-up."""
    corners = []
    for segment in STAR_SEGMENTS:
        for name, types in STAR_TYPE_GROUPS.items():
            keep_missing = segment == "HOUSEHOLD" and name == "promo_small_standard"
            corners.append(Corner(segment.lower(), name, segment, types, require_tieup=not keep_missing))
    return tuple(corners)


def brand_number(column: str = "p_brand") -> Column:
    return F.substring_index(F.col(column), "#", -1).try_cast("int")


def star_items(
    t: Mapping[str, DataFrame],
    month: str | None = None,
    tz: str = JST,
    newest: str | None = None,
    with_album: bool = False,
) -> DataFrame:
    """Current line items as catalogue items, dated by their order (month-filtered when
    ``month`` is given: the range lands on the ``orders`` scan, and the join to the line
    items becomes an inner join that a runtime bloom filter can prune)."""
    source = t["lineitem"]
    named = [] if with_album else [c.alias(n) for n, c in line_names("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").items()]
    lines = source.select(
        *named,
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.col("l_shipdate")).alias(
            "catalog_end_date"
        ),
        "l_orderkey",
        *["l_linenumber"] * with_album,
        F.col("l_partkey").alias("music_id"),
        F.col("l_suppkey").alias("artist_id"),
        (F.col("l_orderkey") * ASSET_STRIDE + F.col("l_linenumber")).alias("asset_id"),
    )
    wanted = {"o_orderdate": "delivery_start_date", "o_custkey": "__fc_custkey"}
    orders = t["orders"]
    if with_album:
        # an order's customer is joined to the order, not to each of its lines
        named = Hop(t["customer"], "o_custkey", "c_custkey", {"c_mktsegment": "site_name", "c_name": "__fc_cname"})
        orders = join_hop(orders, named, tag="c").withColumn("__fc_listed", listed_assets())
        wanted |= {c: c for c in ("site_name", "__fc_cname", "__fc_listed")}
    items = join_hop(
        current_rows(lines).drop("catalog_end_date"),
        Hop(orders, "l_orderkey", "o_orderkey", wanted),
        tag="o",
    )
    if with_album:  # the list stays at this join: the joins after it move a flag a line
        listed = F.coalesce(F.array_contains("__fc_listed", F.col("asset_id")), F.lit(False))
        items = items.withColumn("__fc_is_track", listed).drop("__fc_listed")
    if month and newest:
        items = in_local_months(items, "delivery_start_date", month, newest, tz).withColumn(
            "target_date", local_month_partition("delivery_start_date", tz)
        )
    elif month:
        items = in_local_month(items, "delivery_start_date", month, tz)
    return items


def line_names(*keys: str) -> dict[str, Column]:
    """Id and name of a line from its keys (order, line number, part, supplier)."""
    key = [F.col(c).cast("string") for c in keys]
    return {"id": F.concat_ws("-", *key), "name": F.concat_ws("/", key[0], key[1])}


def star_material(
    t: Mapping[str, DataFrame],
    month: str | None = None,
    tz: str = JST,
    newest: str | None = None,
) -> DataFrame:
    """Material snowflake on the star (C1): item -> part, supplier, customer.

    ``month`` alone: that month; ``month`` .. ``newest``: a range, with ``target_date``."""
    material = snowflake_left_join(
        star_items(t, month, tz, newest),
        [
            Hop(t["part"], "music_id", "p_partkey", {"p_name": "music_name", "p_type": "filetype_id"}),
            Hop(t["supplier"], "artist_id", "s_suppkey", {"s_name": "artist_name"}),
            Hop(t["customer"], "__fc_custkey", "c_custkey", {"c_mktsegment": "site_name"}),
        ],
    )
    return material.drop("__fc_custkey")


def star_target(
    t: Mapping[str, DataFrame],
    month: str | None = None,
    tz: str = JST,
    newest: str | None = None,
) -> DataFrame:
    """The material of the fact as far as its filters and the tie-ups need it: site, music, file
    type. The tie-up bridge joins next, on the key of the part join, and :func:`named_lines`
    brings the rest behind the tie-up filter, in the place of wide rows in every join."""
    music = Hop(t["part"], "music_id", "p_partkey", {"p_name": "music_name", "p_type": "filetype_id"})
    return join_hop(star_items(t, month, tz, newest, with_album=True), music)


def named_lines(t: Mapping[str, DataFrame], tz: str = JST) -> Callable[[DataFrame], DataFrame]:
    """What the fact's projection needs besides :func:`star_target`: artist (by the key of the flag
    list, which joins before it), id, name and album columns of each line."""

    def named(rows: DataFrame) -> DataFrame:
        out = join_hop(rows, Hop(t["supplier"], "artist_id", "s_suppkey", {"s_name": "artist_name"}), tag="s")
        out = out.withColumns(line_names("l_orderkey", "l_linenumber", "music_id", "artist_id"))
        return album_of_line(out, tz).drop("__fc_custkey", "l_linenumber")

    return named


def album_of_line(material: DataFrame, tz: str = JST) -> DataFrame:
    """Album columns of each line, from its own order's album document.

    Same result as exploding every album's first-group tracks and left-joining them on
    the asset id: a document lists only its own order's slots, so the one album that can
    list a line's asset is the line's order. The document is parsed once an order, below the
    join (:func:`listed_assets`), and the line is a track of the album iff its asset is in
    that list (:func:`star_items`) -- no album-track table, no shuffle of it.
    """
    values = {
        "album_music_id": F.col("l_orderkey"),
        "album_music_name": F.concat(F.lit("order "), F.col("l_orderkey").cast("string")),
        "album_artist_id": F.col("__fc_custkey"),
        "album_artist_name": F.col("__fc_cname"),
        "album_release_date": local_epoch_seconds("delivery_start_date", tz),
    }
    out = material
    for name, value in values.items():
        out = out.withColumn(name, F.when(F.col("__fc_is_track"), value))
    return out.drop("__fc_is_track", "__fc_cname")


def listed_assets() -> Column:
    """Assets of the first group of an order's album document (malformed, empty or no album: null)."""
    from freshcat.functions.nested import asset_structure_schema

    doc = album_document(F.col("o_orderkey"), F.col("o_orderpriority"))
    first = F.get(F.from_json(doc, asset_structure_schema("bigint")).getField("Groups"), F.lit(0))
    return F.when(F.col("o_orderstatus").isin(list(ALBUM_STATUSES)), first.getField("Items").getField("AssetId"))


def star_tieup_bridge(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["part"].where(F.col("p_size") <= TIEUP_MAX_SIZE).select(
        F.col("p_partkey").alias("music_id"), brand_number().alias("tieup_id"), F.col("p_size").alias("pattern_id")
    )


def star_tieups(t: Mapping[str, DataFrame]) -> DataFrame:
    brands = t["part"].select("p_brand").distinct()
    number = brand_number()
    return brands.select(
        number.alias("id"),
        F.col("p_brand").alias("name"),
        F.nullif(F.floor((number - 1) / 5).cast("int"), F.lit(0)).alias("detailgenre_id"),
        F.when(number >= UNSEARCHABLE_FROM_BRAND, F.lit(0)).otherwise(F.lit(1)).alias("searchable"),
    )


def star_flags(t: Mapping[str, DataFrame]) -> DataFrame:
    """The flag list: suppliers of the nations of one region, with a present flag value.

    Built with semi joins: a supplier is listed at most once whatever the nation table
    holds, and Catalyst sizes the result by the supplier side (an inner join would be
    estimated as a product of its inputs)."""
    regions = t["region"].where(F.col("r_name") == FLAG_REGION).select("r_regionkey")
    nations = t["nation"].join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return t["supplier"].join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select(
        F.col("s_suppkey").alias("artist_id"), F.lit(FLAG_VALUE).alias("is_johnnys")
    )


def album_document(orderkey: Column, priority: Column) -> Column:
    """The album's asset structure as JSON text, built from its own order row."""
    items = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.lit(TRACK_SLOTS)),
            lambda i: F.concat(
                F.lit('{"AssetId": '), (orderkey * ASSET_STRIDE + i).cast("string"), F.lit("}")
            ),
        ),
        ", ",
    )
    return (
        F.when(priority == "1-URGENT",
               F.concat(F.lit('{"Groups": [{"Items": ['), items, F.lit(']}, {"Items": [{"AssetId": 0}]}]}')))
        .when(priority == "2-HIGH",
              F.concat(F.lit('{"Items": [{"AssetId": 0}], "Groups": [{"Items": ['), items, F.lit("]}]}")))
        .when(priority == "3-MEDIUM", F.concat(F.lit('{"Groups": [{"Items": ['), items, F.lit("]}]}")))
        .when(priority == "4-NOT SPECIFIED", F.lit('{"Groups": []}'))
        .otherwise(F.lit("not json"))
    )


def star_album_headers(t: Mapping[str, DataFrame], tz: str = JST) -> DataFrame:
    """Albums with their JSON structure (input of the track explode)."""
    orders = t["orders"].where(F.col("o_orderstatus").isin(list(ALBUM_STATUSES)))
    albums = snowflake_left_join(orders, [Hop(t["customer"], "o_custkey", "c_custkey", {"c_name": "__fc_cname"})])
    return albums.select(
        F.col("o_orderkey").alias("album_music_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("album_music_name"),
        F.col("o_custkey").alias("album_artist_id"),
        F.col("__fc_cname").alias("album_artist_name"),
        local_epoch_seconds("o_orderdate", tz).alias("album_release_date"),
        album_document(F.col("o_orderkey"), F.col("o_orderpriority")).alias("asset_structure"),
    )


def star_album_tracks(t: Mapping[str, DataFrame], tz: str = JST) -> DataFrame:
    """Album dimension (C6): one row per first-group track."""
    return explode_tracks(star_album_headers(t, tz))


def star_fact(
    t: Mapping[str, DataFrame],
    month: str | None = None,
    segment: str | None = None,
    types: Sequence[str] | None = None,
    require_tieup: bool = True,
    tz: str = JST,
) -> DataFrame:
    """New-arrivals fact (C7) on the star; no month/corner = every current line item."""
    target = star_target(t, month, tz)
    if segment is not None:
        target = corner_filter(target, "site_name", segment, "filetype_id", types or ())
    return new_arrivals_fact(
        target, star_tieup_bridge(t), star_tieups(t), star_flags(t), require_tieup=require_tieup, tz=tz, named=named_lines(t, tz)
    )


def star_new_arrivals(
    t: Mapping[str, DataFrame],
    month: str = FLAGSHIP_MONTH,
    segment: str = FLAGSHIP_SEGMENT,
    types: Sequence[str] = FLAGSHIP_TYPES,
    threshold: int = FLAGSHIP_THRESHOLD,
    top_k: int | None = None,
    tz: str = JST,
) -> DataFrame:
    """The monthly corner job end to end on the star (C8): 15 columns, newest first.

    One plan from the scans to the sorted rows.
    """
    fact = star_fact(t, month, segment, types, tz=tz)
    rolled = rollup_fact(fact, threshold, top_k, sort=False)
    return filter_duplicate_tieup_item(rolled, order_column="release_date", ascending=False)


def star_all_corners(
    t: Mapping[str, DataFrame],
    month: str = FLAGSHIP_MONTH,
    corners: Sequence[Corner] | None = None,
    threshold: int = FLAGSHIP_THRESHOLD,
    tz: str = JST,
    newest: str | None = None,
) -> DataFrame:
    """Every corner of the month in one job (S12): site, corner + the 15 columns.

    With ``newest``: every month ``month`` .. ``newest`` too (backfill in one job), keyed
    by ``target_date`` as well."""
    corners = corners or star_corners()
    within = ("site", "corner", "target_date") if newest else ("site", "corner")
    target = corner_targets(star_target(t, month, tz, newest), corners)
    fact = new_arrivals_fact(
        target,
        star_tieup_bridge(t),
        star_tieups(t),
        star_flags(t),
        require_tieup=F.col("require_tieup"),
        tz=tz,
        within=within,
        named=named_lines(t, tz),
    )
    rolled = rollup_fact(fact, threshold, within=within, sort=False)
    return filter_duplicate_tieup_item(rolled, order_column="release_date", ascending=False, within=within)


def star_backfill(
    t: Mapping[str, DataFrame],
    oldest: str = BACKFILL_OLDEST,
    newest: str = BACKFILL_NEWEST,
    corners: Sequence[Corner] | None = None,
    threshold: int = FLAGSHIP_THRESHOLD,
    tz: str = JST,
) -> DataFrame:
    """Every corner of every month in the range, one job: site, corner, target_date + 15."""
    return star_all_corners(t, oldest, corners, threshold, tz, newest=newest)


BACKFILL_TARGET_ROWS = 100


def star_backfill_until_target(
    t: Mapping[str, DataFrame],
    oldest: str = BACKFILL_OLDEST,
    newest: str = BACKFILL_NEWEST,
    target_rows: int = BACKFILL_TARGET_ROWS,
    corners: Sequence[Corner] | None = None,
    threshold: int = FLAGSHIP_THRESHOLD,
    tz: str = JST,
) -> DataFrame:
    """The months a newest-first backfill publishes per corner until ``target_rows``."""
    rows, _ = backfill_until(
        lambda some, a, b: star_backfill(t, a, b, some, threshold, tz), corners or star_corners(), months_between(oldest, newest)[::-1], target_rows)
    return rows
