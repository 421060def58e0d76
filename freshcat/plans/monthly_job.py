"""The monthly new-arrivals job (C6-C8, S11, S12) over a catalogue of dimension tables.

``tables`` maps the roles of :data:`freshcat.plans.catalogue.ROLES` to frames. One pipeline,
:func:`arrivals_job`, takes corners and a range of months; one corner, all corners and a
backfill are calls of it, so they cannot differ. What several steps read (the months' items,
the target with all it joins, the tracks it reaches) is written once.

Stages (the order of the catalogue job):

1. material: current item rows of the months (pushed-down UTC range) -> snowflake (C1)
2. corner filter: the configuration's sites and codes as pushed IN lists, then the corner
   table (tens of rows, broadcast)
3. target rows (C7): id map, tie-up bridge, tie-up, flag list (all left joins), tie-up filter
4. album dimension (C6): first-group track explode (C2), album headers -> collection bridge ->
   id map -> item and artist, kept as two linear tables (:func:`album_parts`) and reduced,
   step by step, to what the target's assets can reach; then the fact's projection with
   defaults, ``distinct``
5. album rollup (C3, threshold 5, newest first)
6. tie-up de-duplication (C4)

The genre bridge that the catalogue job also left-joins on the *item* id selects nothing
(J13); under the ``distinct`` it cannot change the result, so it is not written. The global
sort before the rollup (O1) is dropped as the rollup ranks again. Every join compares text
and number keys by the same rule (:func:`freshcat.operators.joins.key_pair`), and nothing
depends on the size of the data: physical strategies are Catalyst's and AQE's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.functions.defaults import default_if_null, null_to_text
from freshcat.functions.timezone import JST, local_epoch_seconds, local_month_bounds, local_month_partition
from freshcat.operators.backfill import runs_of
from freshcat.operators.dedup import filter_duplicate_tieup_item
from freshcat.operators.explode import explode_tracks
from freshcat.operators.filters import all_of, codes_in, current_rows, in_local_months, searchable
from freshcat.operators.joins import Hop, flag_lookup, join_dim_material, join_hop, key_pair, snowflake_left_join
from freshcat.operators.ordering import total_order
from freshcat.operators.ranking import first_rows
from freshcat.operators.reduce import maybe_in
from freshcat.operators.rollup import aggregate_musics_to_album
from freshcat.plans.corners import Corner, corner_frame
from freshcat.session import drop_staged_since, stage, staged_mark

ALBUM_COLUMNS = ("album_music_id", "album_music_name", "album_artist_id", "album_artist_name", "album_release_date")
WITHIN = ("site", "corner", "target_date")

# The album header selection of the catalogue job.
ALBUM_HEADER_FILTER = {
    "release_type": "Album",
    "title_titletype": "AlbumName",
    "title_titlelanguage": "ja-Hani",
    "artist_names_language": "ja-Hani",
}


def current_month(tz: str = JST, now: datetime | None = None) -> str:
    """Default run month ``YYYY-MM`` in the catalogue's local zone (S11). ``now``: the clock, UTC
    where it has no zone; the present where not given."""
    now = now or datetime.now(timezone.utc)
    return (now if now.tzinfo else now.replace(tzinfo=timezone.utc)).astimezone(ZoneInfo(tz)).strftime("%Y-%m")


def month_items(tables: Mapping[str, DataFrame], oldest: str, newest: str, tz: str = JST) -> DataFrame:
    """Current items that start in local months ``oldest`` .. ``newest``, with their month as
    ``target_date`` (``YYYYMM01``)."""
    item = current_rows(tables["item"]).select("id", "name", "delivery_start_date", "delivery_end_date")
    return in_local_months(item, "delivery_start_date", oldest, newest, tz).withColumn(
        "target_date", local_month_partition("delivery_start_date", tz)
    )


def bridge_of(tables: Mapping[str, DataFrame], items: DataFrame, role: str, *columns: str) -> DataFrame:
    """Current rows of an item bridge that can belong to ``items``: the others are not shuffled."""
    return maybe_in(current_rows(tables[role]).select("item_id", *columns), "item_id", items, "id")


def material_dimension(tables: Mapping[str, DataFrame], oldest: str, newest: str | None = None, tz: str = JST,
                       items: DataFrame | None = None) -> DataFrame:
    """The months' items joined to their bridges and dimensions (C1). ``items``: the result of
    :func:`month_items`, where it is at hand."""
    items = month_items(tables, oldest, newest or oldest, tz) if items is None else items
    return join_dim_material(
        items,
        bridge_of(tables, items, "item_artist", "artist_id"),
        bridge_of(tables, items, "item_filetype", "filetype_id"),
        bridge_of(tables, items, "item_music", "music_id"),
        bridge_of(tables, items, "item_site", "site_name"),
        current_rows(tables["music"]).select("id", F.col("name").alias("music_name")),
        current_rows(tables["artist"]).select("id", F.col("name").alias("artist_name")),
    )


def corner_targets(material: DataFrame, corners: Sequence[Corner]) -> DataFrame:
    """Material of the corners, with ``site``, ``corner`` and ``require_tieup``.

    The sites and codes of all corners are IN lists on the material's own columns, so they
    reach the scans of the bridges; which corner a row belongs to is the join with the corner
    table, whose size is the configuration's."""
    spark = material.sparkSession
    codes = [code for c in corners for code in c.filetype_ids]
    wanted = material.where(F.col("site_name").isin([c.site_name for c in corners])).where(codes_in(material, "filetype_id", codes))
    config = corner_frame(spark, corners).select(
        "site", "corner", "require_tieup", F.col("site_name").alias("__fc_site"), F.col("filetype_id").alias("__fc_code"))
    types = {f.name: f.dataType for f in material.schema.fields}
    left, right = key_pair(F.col("filetype_id"), types["filetype_id"], F.col("__fc_code"), config.schema["__fc_code"].dataType)
    return wanted.join(F.broadcast(config), (F.col("site_name") == F.col("__fc_site")) & (left == right)).drop("__fc_site", "__fc_code")


def id_map(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Provider id map (collection, asset, material), current rows. What reads it reduces it to
    the keys it needs, and takes the distinct rows (A3) of that."""
    return current_rows(tables["id_map"]).select("collection_id", "asset_id", "material_id")


def album_parts(
    album_headers: DataFrame,
    collection_bridge: DataFrame,
    ids: DataFrame,
    items: DataFrame,
    tz: str = JST,
    id_type: str = "bigint",
    assets: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The album dimension (C6 + C2) in two linear parts: ``(tracks, variants)``.

    ``tracks``: (album_music_id, __fc_header, album_track_asset_id), one row per first-group
    track. ``variants``: the same two keys and the distinct album attributes, one per distinct
    (name, artist, release date, month) that the header's id-map rows lead to. ``__fc_header``
    tells header rows of one album id apart by what they hold (name, artist name, document),
    so an id may repeat. Joining an asset to ``tracks`` and then to ``variants`` gives, after
    the fact's DISTINCT, what joining the header to its id-map rows and its tracks gives,
    without building id-map rows x tracks inside every album.

    ``items``: (id, artist_id, delivery_start_date, target_date). An item's artist and date
    count only for facts of its own month (H12): ``__fc_album_month`` carries it.

    ``assets``: a written table whose ``asset_id`` holds every asset that will be looked up.
    The chain is then reduced from it, each step by the keys the one before it left: tracks
    that can be one of the assets (in the stage that parses the documents), albums of those
    tracks, their bridge rows, their collections' id-map rows, and items of these. Nothing else
    of the headers, the bridge or the id map is shuffled. The tracks, made by parsing documents,
    are written once, as they are read for their keys and for their rows; the bridge's two
    columns are scanned for both.
    """
    headers = album_headers.select(
        F.col("id").alias("album_music_id"),
        F.col("title_title").alias("album_music_name"),
        F.col("artist_names_text").alias("album_artist_name"),
        "asset_structure",
        F.sha2(F.to_json(F.struct("title_title", "artist_names_text", "asset_structure")), 256).alias("__fc_header"),
    )
    tracks = explode_tracks(headers, id_type=id_type)
    albums = headers.drop("asset_structure")
    bridge = collection_bridge.select("collection_detail_id", "collection_id")
    if assets is not None:
        tracks = stage(maybe_in(tracks, "album_track_asset_id", assets, "asset_id"), "tracks")
        albums = tracks.drop("album_track_asset_id").distinct()
        bridge = maybe_in(bridge, "collection_detail_id", tracks, "album_music_id")
        ids = maybe_in(ids, "collection_id", bridge, "collection_id")
    variants = snowflake_left_join(
        albums,
        [
            Hop(bridge, "album_music_id", "collection_detail_id", ["collection_id"]),
            Hop(ids.select("collection_id", "material_id").distinct(), "collection_id", "collection_id", {"material_id": "__fc_album_material"}),
            Hop(items, "__fc_album_material", "id",
                {"artist_id": "album_artist_id", "delivery_start_date": "__fc_album_start", "target_date": "__fc_album_month"}),
        ],
    ).select(
        "album_music_id", "__fc_header", "album_music_name", "album_artist_id", "album_artist_name",
        local_epoch_seconds("__fc_album_start", tz).alias("album_release_date"), "__fc_album_month",
    ).distinct()
    return tracks.select("album_music_id", "__fc_header", "album_track_asset_id"), variants


def fact_projection(
    joined: DataFrame,
    tz: str = JST,
    material_id: str = "id",
    material_name: str = "name",
) -> list[Column]:
    """The 19 fact columns with their defaults."""
    types = {f.name: f.dataType for f in joined.schema.fields}
    album = {c: F.col(c) for c in ALBUM_COLUMNS}
    if "__fc_album_month" in types:
        # album attributes count only from the fact's month
        same = F.col("__fc_album_month") == F.col("target_date")
        for c in ("album_artist_id", "album_release_date"):
            album[c] = F.when(same, F.col(c)).alias(c)
    return [
        F.lit(1).alias("pickup"),
        F.col(material_id).alias("material_id"),
        F.col(material_name).alias("material_name"),
        F.col("music_id"),
        F.col("music_name"),
        F.col("artist_id"),
        F.col("artist_name"),
        local_epoch_seconds("delivery_start_date", tz).alias("release_date"),
        default_if_null("__fc_pattern_id", 0, types["__fc_pattern_id"]).alias("pattern_id"),
        default_if_null("__fc_tieup_genre", 0, types["__fc_tieup_genre"]).alias("tieup_detail_genre_id"),
        null_to_text("__fc_tieup_name").alias("tieup_name"),
        default_if_null("__fc_tieup_key", 0, types["__fc_tieup_key"]).cast("int").alias("tieup_id"),
        F.col("johnnys"),
        F.lit(0).alias("score"),
        *[album[c] for c in ALBUM_COLUMNS],
    ]


def target_rows(
    material_target: DataFrame,
    tieup_bridge: DataFrame,
    tieups: DataFrame,
    flags: DataFrame,
    ids: DataFrame | None = None,
    require_tieup: bool | Column = True,
    material_id: str = "id",
) -> DataFrame:
    """The target materials with their assets, tie-ups and flag, tie-up filter applied: all that
    the fact needs but the albums.

    ``ids`` (material_id -> asset_id) is joined when the material has no ``asset_id`` yet; give it
    reduced to the materials in question. ``require_tieup``: True = ``searchable != 0`` (F6), False = also
    keep items without a tie-up (F7); a boolean column selects per row.
    """
    hops = []
    if ids is not None:
        hops.append(Hop(ids.select("material_id", "asset_id").distinct(), material_id, "material_id", ["asset_id"]))
    hops += [
        Hop(tieup_bridge, "music_id", "music_id", {"tieup_id": "__fc_tieup_ref", "pattern_id": "__fc_pattern_id"}),
        Hop(
            tieups,
            "__fc_tieup_ref",
            "id",
            {
                "id": "__fc_tieup_key",
                "name": "__fc_tieup_name",
                "detailgenre_id": "__fc_tieup_genre",
                "searchable": "__fc_searchable",
            },
        ),
    ]
    joined = flag_lookup(snowflake_left_join(material_target, hops), flags, "artist_id", "artist_id", "is_johnnys", "johnnys")
    if isinstance(require_tieup, Column):
        flag = F.col("__fc_searchable")
        return joined.filter((flag != 0) | (~require_tieup & flag.isNull()))
    return searchable(joined, "__fc_searchable", keep_missing=not require_tieup)


def with_albums(rows: DataFrame, tracks: DataFrame, variants: DataFrame) -> DataFrame:
    """:func:`target_rows` joined to the two parts of :func:`album_parts`. ``rows`` is read twice
    (those on an album and those on none), so it should be a written table."""
    joined = join_hop(rows, Hop(
        tracks.where(F.col("album_track_asset_id").isNotNull()), "asset_id", "album_track_asset_id",
        {"album_music_id": "__fc_album", "__fc_header": "__fc_header_of"}, how="inner"), tag="t")
    attributes = [c for c in variants.columns if c not in ("album_music_id", "__fc_header")]
    found = join_hop(joined, Hop(variants, ["__fc_album", "__fc_header_of"], ["album_music_id", "__fc_header"], attributes), tag="v")
    # rows on no album (null assets with them) neither carry its columns nor enter its second join
    types = {f.name: f.dataType for f in variants.schema.fields}
    listed = Hop(tracks.select("album_track_asset_id"), "asset_id", "album_track_asset_id", [], how="left_anti")
    alone = join_hop(rows.where(F.col("asset_id").isNotNull()), listed, tag="a").unionByName(rows.where(F.col("asset_id").isNull()))
    plain = alone.select("*", F.lit(None).cast(types["album_music_id"]).alias("__fc_album"), *[F.lit(None).cast(types[c]).alias(c) for c in attributes])
    return found.drop("__fc_header_of").unionByName(plain).withColumnRenamed("__fc_album", "album_music_id")


def new_arrivals_fact(
    material_target: DataFrame,
    tieup_bridge: DataFrame,
    tieups: DataFrame,
    flags: DataFrame,
    ids: DataFrame | None = None,
    require_tieup: bool | Column = True,
    tz: str = JST,
    within: Sequence[str] = (),
    material_id: str = "id",
    material_name: str = "name",
    albums: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    named: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Fact rows of the target materials (C7): left joins, tie-up filter, defaults, distinct.

    :func:`target_rows` describes ``ids`` and ``require_tieup``. ``albums`` makes the two parts of
    :func:`album_parts` from the joined target, which is written once for it and for the joins
    after it; None: the target already carries the album columns. ``named`` brings columns that
    only the projection needs, behind the tie-up filter.
    """
    joined = target_rows(material_target, tieup_bridge, tieups, flags, ids, require_tieup, material_id)
    if albums is not None:
        joined = stage(joined, "joined")
        joined = with_albums(joined, *albums(joined))
    if named is not None:
        joined = named(joined)
    cols = fact_projection(joined, tz, material_id, material_name)
    return joined.select(*[F.col(w) for w in within], *cols).distinct()


def rollup_fact(fact: DataFrame, threshold: int, top_k: int | None = None, within: Sequence[str] = (), sort: bool = True) -> DataFrame:
    """The rollup step of the jobs (newest first), of the first ``top_k`` rows where given (k
    rows per ``within`` group). The fact is read once. ``sort=False`` for callers that rank again."""
    return aggregate_musics_to_album(
        fact, top_k=top_k, threshold_num=threshold, order_column="release_date", ascending=False, within=within, sort=sort
    )


def arrivals_job(
    tables: Mapping[str, DataFrame],
    corners: Sequence[Corner],
    oldest: str,
    newest: str | None = None,
    threshold: int = 5,
    top_k: int | None = None,
    tz: str = JST,
    bridge_fallback: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Every corner of every month ``oldest`` .. ``newest`` (default: the one month):
    site, corner, target_date + the 15 columns, in no order (C8, C9, S12).

    ``bridge_fallback`` re-reads the collection bridge where the first scan is empty and a
    corner asks for it (S3).
    """
    from freshcat.sources.tables import first_non_empty

    newest = newest or oldest
    items = stage(month_items(tables, oldest, newest, tz), "items")
    target = corner_targets(material_dimension(tables, oldest, newest, tz, items), corners)
    bridge = tables["album_collection"]
    if bridge_fallback is not None and any(c.fallback_collection_bridge for c in corners):
        bridge = first_non_empty(lambda: tables["album_collection"], bridge_fallback)
    headers = all_of(tables["album_detail"], equals=ALBUM_HEADER_FILTER, null=["catalog_end_date"])
    ids = id_map(tables)
    # of the snowflake the albums use artist and start date; its other joins only repeat rows
    own = snowflake_left_join(items.select("id", "delivery_start_date", "target_date"), [Hop(bridge_of(tables, items, "item_artist", "artist_id"), "id", "item_id")])
    fact = new_arrivals_fact(
        target,
        current_rows(tables["music_tieup"]).select("music_id", "tieup_id", "pattern_id"),
        current_rows(tables["tieup"]).select("id", "name", "detailgenre_id", "searchable"),
        tables["flags"].select("artist_id", "is_johnnys"),
        ids=maybe_in(ids, "material_id", items, "id"),
        require_tieup=F.col("require_tieup"),
        tz=tz,
        within=WITHIN,
        albums=lambda rows: album_parts(headers, bridge, ids, own, tz, assets=rows),
    )
    rolled = rollup_fact(fact, threshold, top_k, within=WITHIN, sort=False)
    return filter_duplicate_tieup_item(rolled, order_column="release_date", ascending=False, within=WITHIN, sort=False)


def newest_first(result: DataFrame) -> DataFrame:
    """A job's rows by site, corner and month, newest first inside each."""
    return result.orderBy(*[F.col(w) for w in WITHIN], *total_order(result, [("release_date", False)], exclude=list(WITHIN)))


def corner_job(tables: Mapping[str, DataFrame], month: str, corner: Corner, **options) -> DataFrame:
    """One (site, corner, month): the 15-column result, newest first."""
    result = arrivals_job(tables, [corner], month, **options).drop(*WITHIN)
    return result.orderBy(*total_order(result, [("release_date", False)]))


def all_corners_job(tables: Mapping[str, DataFrame], month: str, corners: Sequence[Corner], **options) -> DataFrame:
    """Every corner of one month in one job (S12): site, corner + the 15 columns."""
    return newest_first(arrivals_job(tables, corners, month, **options)).drop("target_date")


def backfill_job(tables: Mapping[str, DataFrame], oldest: str, newest: str, corners: Sequence[Corner], **options) -> DataFrame:
    """Every corner of every month ``oldest`` .. ``newest`` in one job (C9 re-aimed)."""
    return newest_first(arrivals_job(tables, corners, oldest, newest, **options))


def target_date_of(month: str) -> str:
    """``YYYY-MM`` -> partition value ``YYYYMM01``."""
    return month.replace("-", "")[:6] + "01"


def export_name(month: str, site: str, corner: str) -> str:
    """Deterministic export file name ``{YYYYMM}01_{site}_{corner}.csv``."""
    return f"{target_date_of(month)}_{site}_{corner}.csv"


def months_between(oldest: str, newest: str) -> list[str]:
    """Months ``YYYY-MM`` from oldest to newest, both included."""
    first, last = (int(m[:4]) * 12 + int(m[5:7]) - 1 for m in (oldest, newest))
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(first, last + 1)]


def partitions_of(pairs: Iterable[tuple[Corner, str]]) -> list[dict[str, str]]:
    """Partition values of (corner, month) pairs."""
    return [{"site": c.site, "corner": c.corner, "target_date": target_date_of(m)} for c, m in pairs]


def only(result: DataFrame, partitions: Sequence[Mapping[str, str]]) -> DataFrame:
    """The rows of these partitions (corners x months of them, broadcast)."""
    if not partitions:
        return result.where(F.lit(False))
    wanted = result.sparkSession.createDataFrame([tuple(p[w] for w in WITHIN) for p in partitions], "site string, corner string, target_date string")
    return result.join(F.broadcast(wanted), list(WITHIN), "left_semi")


def publish_partitions(result: DataFrame, root: str, partitions: Sequence[Mapping[str, str]], table: str | None = None) -> list[str]:
    """Publish these partitions as one run: one write, one named CSV file each.

    Every partition given ends as exactly one file with a header: rows newest first, or no rows
    (also where an earlier run had some). Partitions not given are not touched. Runs that died
    between commit and publication are finished first (:mod:`freshcat.sources.publishing`).
    """
    from freshcat.sources.publishing import Files, add_partitions, publish_run, recover, write_run
    from freshcat.sources.sinks import escaped, partition_dir

    spark = result.sparkSession
    recover(spark, root)
    columns = [c for c in result.columns if c not in WITHIN]
    order = [F.col("release_date").desc(), *[F.col(c).asc() for c in columns if c != "release_date"]]
    named = lambda p: escaped(f"{p['target_date']}_{p['site']}_{p['corner']}.csv")
    publish_run(spark, root, write_run(only(result, partitions).select(*columns, *WITHIN), root, partitions, named, order))
    if table:
        add_partitions(spark, table, partitions)
    files = Files(spark, root)
    return [files.full_name(f"{partition_dir(root, p)}/{named(p)}") for p in partitions]


def publish(
    result: DataFrame,
    root: str,
    corners: Sequence[Corner],
    months: Sequence[str],
    table: str | None = None,
) -> list[str]:
    """:func:`publish_partitions` of every corner and month given."""
    return publish_partitions(result, root, partitions_of((c, m) for c in corners for m in months), table)


def published_rows(spark, root: str, corners: Sequence[Corner], months: Sequence[str]) -> dict[tuple[Corner, str], int]:
    """Rows of the corner-months that are published, from the manifests (nothing is read or run)."""
    from freshcat.sources.publishing import published

    names = {(c.site, c.corner, target_date_of(m)): (c, m) for c in corners for m in months}
    rows = only(published(spark, root), partitions_of(names.values())).collect()  # corners x months at most
    return {names[r.site, r.corner, r.target_date]: r["rows"] for r in rows}


def backfill_until(
    job: Callable[[Sequence[Corner], str, str], DataFrame],
    corners: Sequence[Corner],
    months: Sequence[str],
    target: int,
    known: Mapping[tuple[Corner, str], int] | None = None,
) -> tuple[DataFrame | None, list[tuple[Corner, str]]]:
    """The rows a newest-first backfill publishes until every corner has ``target``, and their
    (corner, month) pairs (C9).

    ``job(corners, oldest, newest)`` makes the rows of a range of months; it is called for ranges
    of 1, 2, 4, ... of ``months`` (newest first) and for the corners still short
    (:func:`freshcat.operators.backfill.gallop_until_target`). None: nothing had to be made.
    """
    from freshcat.operators.backfill import gallop_until_target

    made: list[DataFrame] = []
    names = {(c.site, c.corner, target_date_of(m)): (c, m) for c in corners for m in months}

    def evaluate(some: list[Corner], oldest: str, newest: str) -> dict:
        rows = stage(job(some, oldest, newest), "range")
        made.append(rows)
        return {names[r.site, r.corner, r.target_date]: r["count"] for r in rows.groupBy(*WITHIN).count().collect()}

    needed = gallop_until_target(list(corners), list(months), target, evaluate, known)
    kept = [only(rows, partitions_of(needed)) for rows in made]
    return (reduce(DataFrame.unionByName, kept) if kept else None), needed


def run_job(
    tables: Mapping[str, DataFrame],
    root: str,
    corners: Sequence[Corner],
    month: str | None = None,
    oldest: str | None = None,
    table: str | None = None,
    threshold: int = 5,
    tz: str = JST,
    until_rows: int | None = None,
    skip_months: Iterable[str] = (),
    keep_published: bool = False,
    bridge_fallback: Callable[[], DataFrame] | None = None,
) -> list[str]:
    """Compute and publish corners for a month, or for months ``oldest`` .. ``month``.

    ``until_rows``: make and publish, per corner, months newest first until so many rows; the
    other months are not computed and their partitions left alone. ``skip_months`` are not made
    or written; ``keep_published`` says the same of every corner-month published before. In the
    count of ``until_rows`` both have the rows their manifests tell (never published: none).
    Staged tables are removed whether the run succeeds or not. Returns the files.
    """
    month = month or current_month(tz)
    oldest = oldest or month
    skip = set(skip_months)
    for m in (month, oldest, *skip):
        local_month_bounds(m, tz)  # a bad month fails before anything is written
    spark = tables["item"].sparkSession
    job = lambda some, a, b: arrivals_job(tables, some, a, b, threshold=threshold, tz=tz, bridge_fallback=bridge_fallback)
    mark = staged_mark()
    try:
        months = months_between(oldest, month)
        before = published_rows(spark, root, corners, months) if keep_published or (skip and until_rows is not None) else {}
        known = {(c, m): before.get((c, m), 0) for c in corners for m in months if m in skip or (keep_published and (c, m) in before)}
        if until_rows is not None:
            rows, pairs = backfill_until(job, corners, months[::-1], until_rows, known)
        else:
            pairs = [(c, m) for c in corners for m in months if (c, m) not in known]
            wanted = {c: [m for d, m in pairs if d is c] for c in corners}
            parts = [stage(job(some, a, b), "result") for (a, b), some in runs_of(months[::-1], wanted).items()]
            rows = reduce(DataFrame.unionByName, parts) if parts else None
        if rows is None or not pairs:
            return []
        order = {p: k for k, p in enumerate((c, m) for c in corners for m in months)}
        return publish_partitions(rows, root, partitions_of(sorted(pairs, key=order.__getitem__)), table)
    finally:
        drop_staged_since(spark, mark)


def audit_published(spark, root: str, corners: Sequence[Corner], first_day: str, days: int) -> DataFrame:
    """What is published for every corner and each of ``days`` days from ``first_day``
    (``YYYYMMDD``): :func:`freshcat.sources.publishing.audit` (S10, C10)."""
    from freshcat.sources.publishing import audit

    first = datetime.strptime(first_day, "%Y%m%d")
    dates = [(first + timedelta(days=k)).strftime("%Y%m%d") for k in range(days)]
    return audit(spark, root, [{"site": c.site, "corner": c.corner, "target_date": d} for c in corners for d in dates])


def run_corner_job(tables: Mapping[str, DataFrame], root: str, corner: Corner, month: str | None = None, **options) -> str:
    """Compute one corner-month and publish it (C8 end to end). Returns the file."""
    return run_job(tables, root, [corner], month, **options)[0]


def run_all_corners(tables: Mapping[str, DataFrame], root: str, corners: Sequence[Corner], month: str | None = None, **options) -> list[str]:
    """Every corner of a month in one job, one export file per corner (S12 + sinks)."""
    return run_job(tables, root, corners, month, **options)
