"""The monthly job on a miniature catalogue in the catalogue's own schema."""

import datetime as dt

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from freshcat.plans.corners import Corner, corner_by_name, read_corners
from freshcat.plans.monthly_job import all_corners_job, corner_job
from tests.conftest import rows

UTC = dt.timezone.utc
S, I, T = StringType(), IntegerType(), TimestampType()


def _schema(*cols):
    return StructType([StructField(n, t) for n, t in cols])


def _epoch_local(ts):
    return int(ts.timestamp()) + 9 * 3600


MARCH_5 = dt.datetime(2023, 3, 5, 10, 0, tzinfo=UTC)
MARCH_20 = dt.datetime(2023, 3, 20, 1, 0, tzinfo=UTC)
FIRST_JST = dt.datetime(2023, 2, 28, 15, 0, tzinfo=UTC)  # 1 March 00:00 in Tokyo
APRIL_JST = dt.datetime(2023, 3, 31, 15, 0, tzinfo=UTC)  # 1 April 00:00 in Tokyo
ENDED = dt.datetime(2023, 3, 10, tzinfo=UTC)


@pytest.fixture(scope="module")
def catalogue(spark):
    def df(data, *cols):
        return spark.createDataFrame(data, _schema(*cols))

    item_rows = [
        ("i1", "item one", MARCH_5, None, None),
        ("i2", "item two", MARCH_5, None, None),
        ("i3", "item three", MARCH_5, None, None),
        ("i4", "item four", FIRST_JST, None, None),
        ("i5", "item five", APRIL_JST, None, None),
        ("i6", "item six", MARCH_5, None, None),
        ("i7", "item seven", MARCH_5, None, None),
        ("i8", "item eight", MARCH_5, None, ENDED),
        ("i9", "item nine", MARCH_20, None, None),
    ]
    bridge = [("i1", "r1"), ("i2", "r1"), ("i3", "r1"), ("i4", "r2"), ("i5", "r2"), ("i6", "r2"), ("i7", "r2"),
              ("i8", "r2"), ("i9", "r2")]
    ftdt = [(i, "030300") for i in ("i1", "i2", "i3", "i4", "i5", "i7", "i8", "i9")] + [("i6", "110600")]
    music_item = [("i1", "m1"), ("i2", "m2"), ("i3", "m3"), ("i4", "m4"), ("i5", "m1"), ("i6", "m1"),
                  ("i7", "m1"), ("i8", "m1"), ("i9", "m9")]
    site = [("SiteA", i) for i in ("i1", "i2", "i3", "i4", "i5", "i6", "i8", "i9")] + [("SiteB", "i7")]
    doc = '{"Groups": [{"Items": [{"AssetId": 101}, {"AssetId": 102}, {"AssetId": 103}]}]}'
    return {
        "item": df(item_rows, ("id", S), ("name", S), ("delivery_start_date", T), ("delivery_end_date", T),
                           ("catalog_end_date", T)),
        "item_artist": df([(a, b, None) for a, b in bridge], ("item_id", S), ("artist_id", S),
                                      ("catalog_end_date", T)),
        "item_filetype": df([(a, b, None) for a, b in ftdt], ("item_id", S), ("filetype_id", S),
                                    ("catalog_end_date", T)),
        "item_music": df([(a, b, None) for a, b in music_item], ("item_id", S), ("music_id", S),
                                     ("catalog_end_date", T)),
        "item_site": df([(a, b, None) for a, b in site], ("site_name", S), ("item_id", S),
                                             ("catalog_end_date", T)),
        "music": df([(m, f"song {m}", None, None) for m in ("m1", "m2", "m3", "m4", "m9")], ("id", S),
                            ("name", S), ("tieup", S), ("catalog_end_date", T)),
        "artist": df([("r1", "artist one", None), ("r2", "artist two", None)], ("id", S), ("name", S),
                             ("catalog_end_date", T)),
        "id_map": df(
            [("col1", 101, "i1", None), ("col1", 102, "i2", None), ("col1", 103, "i3", None),
             ("col1", 103, "i3", None)],
            ("collection_id", S), ("asset_id", I), ("material_id", S), ("catalog_end_date", T)),
        "flags": df([("r1", "x"), ("r1", "x")], ("artist_id", S), ("is_johnnys", S)),
        "music_tieup": df(
            [("m1", 10, 1, None), ("m2", 10, 2, None), ("m2", 20, None, None), ("m3", 30, 3, None),
             ("m9", 10, 9, None)],
            ("music_id", S), ("tieup_id", I), ("pattern_id", I), ("catalog_end_date", T)),
        "tieup": df(
            [(10, "tie ten", 7, 1, None), (20, "tie twenty", None, 1, None), (30, "tie thirty", 8, 0, None)],
            ("id", I), ("name", S), ("detailgenre_id", I), ("searchable", I), ("catalog_end_date", T)),
        "album_detail": df(
            [("c1", "album one", "Album", "AlbumName", "ja-Hani", "ja-Hani", "album artist", doc, None),
             ("c2", "single", "Single", "AlbumName", "ja-Hani", "ja-Hani", "x", doc, None)],
            ("id", S), ("title_title", S), ("release_type", S), ("title_titletype", S), ("title_titlelanguage", S),
            ("artist_names_language", S), ("artist_names_text", S), ("asset_structure", S), ("catalog_end_date", T)),
        "album_collection": df([("c1", "col1"), ("c2", "col1")], ("collection_detail_id", S),
                                               ("collection_id", S)),
    }


NINE = (1, "m9", "song m9", "i9", "item nine", "r2", "artist two", _epoch_local(MARCH_20), 9, 7, "tie ten", 10, 0,
        "music", 0)
ALBUM = (1, "c1", "album one", None, None, "r1", "album artist", _epoch_local(MARCH_5), None, None, None, None,
         None, "album", 0)
FOUR = (1, "m4", "song m4", "i4", "item four", "r2", "artist two", _epoch_local(FIRST_JST), 0, 0, "null", 0, 0,
        "music", 0)


def test_corner_job_requires_tieup(spark, catalogue):
    corner = Corner("s", "c", "SiteA", ("030300",))
    out = corner_job(catalogue, "2023-03", corner, threshold=2)
    assert rows(out) == [NINE, ALBUM]


def test_corner_job_keeps_items_without_tieup(spark, catalogue):
    corner = Corner("s", "c", "SiteA", ("030300",), require_tieup=False)
    out = corner_job(catalogue, "2023-03", corner, threshold=2)
    assert rows(out) == [NINE, ALBUM, FOUR]


def test_corner_job_below_threshold_keeps_tracks(spark, catalogue):
    corner = Corner("s", "c", "SiteA", ("030300",))
    out = rows(corner_job(catalogue, "2023-03", corner, threshold=5))
    assert [r[13] for r in out] == ["music", "music", "music"]
    # i2 has two tie-ups: the lower id survives
    assert [(r[3], r[11]) for r in out] == [("i9", 10), ("i1", 10), ("i2", 10)]


def test_all_corners_equals_each_corner(spark, catalogue):
    corners = [Corner("s", "strict", "SiteA", ("030300",)),
               Corner("s", "loose", "SiteA", ("030300",), require_tieup=False),
               Corner("t", "other", "SiteB", ("030300",))]
    together = sorted(rows(all_corners_job(catalogue, "2023-03", corners, threshold=2)), key=str)
    apart = []
    for c in corners:
        apart += [(c.site, c.corner) + r for r in rows(corner_job(catalogue, "2023-03", c, threshold=2))]
    assert together == sorted(apart, key=str)


def test_corners_are_read_from_a_file(tmp_path):
    path = tmp_path / "corners.json"
    path.write_text('[{"site": "a", "corner": "x", "site_name": "A", "filetype_ids": ["070040", 70040]},'
                    ' {"site": "a", "corner": "y", "site_name": "A", "filetype_ids": [], "require_tieup": false}]')
    first, second = read_corners(str(path))
    assert first == Corner("a", "x", "A", ("070040", "70040")) and not second.require_tieup
    assert corner_by_name("a", "y", (first, second)) is second
    with pytest.raises(KeyError):
        corner_by_name("b", "y", (first, second))
    path.write_text("[]")
    with pytest.raises(ValueError):
        read_corners(str(path))


def test_backfill_equals_each_month_and_corner(spark, catalogue):
    from freshcat.plans.monthly_job import backfill_job, target_date_of

    corners = [Corner("s", "strict", "SiteA", ("030300",)),
               Corner("s", "loose", "SiteA", ("030300",), require_tieup=False)]
    together = sorted(rows(backfill_job(catalogue, "2023-02", "2023-04", corners, threshold=2)), key=str)
    apart = []
    for month in ("2023-02", "2023-03", "2023-04"):
        for c in corners:
            apart += [(c.site, c.corner, target_date_of(month)) + r
                      for r in rows(corner_job(catalogue, month, c, threshold=2))]
    assert together == sorted(apart, key=str)
    assert {r[2] for r in together} == {"20230301", "20230401"}


def test_run_corner_job_exports_and_registers(spark, catalogue):
    import os
    import uuid

    from freshcat.plans.monthly_job import run_corner_job
    from freshcat.session import checkpoint_dir
    from freshcat.sources import create_partitioned_table

    root = os.path.join(checkpoint_dir(spark).replace("file:", ""), f"fact-{uuid.uuid4().hex}")
    corner = Corner("site_a", "wallpaper", "SiteA", ("030300",))
    out = corner_job(catalogue, "2023-03", corner, threshold=2)
    table = f"fc_fact_{uuid.uuid4().hex[:8]}"
    create_partitioned_table(spark, table, root, out.schema)
    path = run_corner_job(catalogue, root, corner, month="2023-03", table=table, threshold=2)
    assert path.endswith("site=site_a/corner=wallpaper/target_date=20230301/20230301_site_a_wallpaper.csv")
    with open(path.replace("file:", "")) as fh:
        lines = fh.read().splitlines()
    assert lines[0].startswith("pickup,music_id,music_name,material_id")
    assert len(lines) == 3 and lines[1].split(",")[3] == "i9"
    back = spark.table(table)
    assert back.count() == 2
    assert {r.target_date for r in back.select("target_date").collect()} == {"20230301"}


def test_empty_collection_bridge_falls_back(spark, catalogue):
    # a corner that asks for it re-reads the collection bridge when the first scan comes back empty
    asking = Corner("site_m", "tolerant", "SiteA", ("030300",), require_tieup=False,
                   fallback_collection_bridge=True)
    empty = dict(catalogue)
    empty["album_collection"] = catalogue["album_collection"].limit(0)
    fallback = lambda: catalogue["album_collection"]
    got = rows(corner_job(empty, "2023-03", asking, threshold=2, bridge_fallback=fallback))
    assert got == [NINE, ALBUM, FOUR]
    # without the fallback the album is still found through its own track list, but the
    # bridge to its items is missing: no album artist, no album release date
    plain = Corner("s", "c", "SiteA", ("030300",), require_tieup=False)
    album = [r for r in rows(corner_job(empty, "2023-03", plain, threshold=2)) if r[13] == "album"]
    assert len(album) == 1 and album[0][1] == "c1" and album[0][5] is None and album[0][7] is None


def test_default_month_is_the_local_month():
    import datetime as _dt
    from zoneinfo import ZoneInfo

    from freshcat.plans.monthly_job import current_month, export_name, target_date_of

    assert current_month() == _dt.datetime.now(ZoneInfo("Asia/Tokyo")).strftime("%Y-%m")
    assert target_date_of("2023-03") == "20230301"
    assert export_name("2023-03", "site_a", "voice") == "20230301_site_a_voice.csv"


def _files(root):
    import os

    # published files: runs and manifests are kept in folders that readers skip
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names
                  if not f.startswith((".", "_")) and not os.path.relpath(d, root).startswith("_"))


def test_run_all_corners_exports_each_corner(spark, catalogue):
    import os
    import uuid

    from freshcat.plans.monthly_job import run_all_corners
    from freshcat.session import checkpoint_dir

    root = os.path.join(checkpoint_dir(spark).replace("file:", ""), f"all-{uuid.uuid4().hex}")
    corners = [Corner("s", "strict", "SiteA", ("030300",)), Corner("t", "other", "SiteB", ("030300",)),
               Corner("u", "empty", "SiteC", ("030300",))]
    run = lambda tables: sorted(p.replace("file:", "") for p in run_all_corners(tables, root, corners, month="2023-03", threshold=2))
    paths = run(catalogue)
    assert [os.path.basename(p) for p in paths] == ["20230301_s_strict.csv", "20230301_t_other.csv", "20230301_u_empty.csv"]
    lines = lambda p: open(p).read().splitlines()
    assert len(lines(paths[0])) == 3  # header + i9 + album
    assert len(lines(paths[2])) == 1 and lines(paths[2]) == lines(paths[0])[:1]  # no arrivals: the header
    assert _files(root) == sorted(paths)
    # a rerun in which everything has gone leaves no old rows, nor any file more
    gone = {**catalogue, "item": catalogue["item"].limit(0)}
    assert run(gone) == paths and all(len(lines(p)) == 1 for p in paths) and _files(root) == sorted(paths)


def _config(spark, catalogue, tmp_path, empty=()):
    """The catalogue saved as tables with columns of other names, and the two files."""
    import json
    import uuid

    db = f"fc_cat_{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables = {}
    for name, frame in catalogue.items():
        if name == "id_map":
            frame = frame.withColumnRenamed("asset_id", "provider_asset")
        (frame.limit(0) if name in empty else frame).write.mode("overwrite").saveAsTable(f"{db}.t_{name}")
        tables[name] = f"{db}.t_{name}"
    tables["id_map"] = {"table": tables["id_map"], "columns": {"asset_id": "provider_asset"}}
    (tmp_path / "tables.json").write_text(json.dumps(tables))
    corners = [{"site": "s", "corner": "strict", "site_name": "SiteA", "filetype_ids": ["030300"]},
               {"site": "s", "corner": "loose", "site_name": "SiteA", "filetype_ids": ["030300"], "require_tieup": False}]
    (tmp_path / "corners.json").write_text(json.dumps(corners))
    root = str(tmp_path / "out")
    return root, ["--output", root, "--corners", str(tmp_path / "corners.json"), "--tables", str(tmp_path / "tables.json"), "--threshold", "2"]


def test_cli_one_corner_all_corners_and_backfill(spark, catalogue, tmp_path):
    import os

    from freshcat.plans import cli

    root, args = _config(spark, catalogue, tmp_path)
    names = lambda: [os.path.basename(f) for f in _files(root)]
    assert cli.main([*args, "--site", "s", "--corner", "strict", "--month", "2023-03"]) == 0
    assert names() == ["20230301_s_strict.csv"]
    # a backfill of one corner leaves the others alone; a skipped month is not written
    assert cli.main([*args, "--site", "s", "--corner", "strict", "--month", "2023-05", "--backfill-from", "2023-02", "--skip-months", "2023-03,2023-05"]) == 0
    assert names() == [f"{m}_s_strict.csv" for m in ("20230201", "20230301", "20230401")]
    before = {f: os.path.getmtime(f) for f in _files(root)}
    assert cli.main([*args, "--all-corners", "--month", "2023-03"]) == 0
    assert len(names()) == 4 and sum(os.path.getmtime(f) == t for f, t in before.items()) == 2
    # sorted by release date, newest first, in every way of running
    assert cli.main([*args, "--month", "2023-04", "--backfill-from", "2023-03"]) == 0
    for f in _files(root):
        table = [line.split(",") for line in open(f).read().splitlines()]
        dates = [int(r[table[0].index("release_date")]) for r in table[1:]]
        assert dates == sorted(dates, reverse=True)
    for bad in (["--site", "s"], [], ["--all-corners", "--site", "s", "--corner", "strict"]):
        with pytest.raises(SystemExit):
            cli.parse([*args, *bad])


def test_cli_backfill_until_rows_stops_at_the_newest_months(spark, catalogue, tmp_path):
    import os

    from freshcat.plans import cli

    root, args = _config(spark, catalogue, tmp_path)
    assert cli.main([*args, "--site", "s", "--corner", "loose", "--month", "2023-04", "--backfill-from", "2023-02", "--until-rows", "1"]) == 0
    assert [os.path.basename(f) for f in _files(root)] == ["20230401_s_loose.csv"]


def test_text_asset_ids_with_and_without_broadcasts(spark, catalogue):
    # an asset id that is no number matches nothing, whatever the join strategy
    from pyspark.sql import functions as F

    corner = Corner("s", "c", "SiteA", ("030300",))
    ids = catalogue["id_map"].withColumn("asset_id", F.when(F.col("asset_id") == 102, "x-9").otherwise(F.col("asset_id").cast("string")))
    tables = {**catalogue, "id_map": ids}
    plain = rows(corner_job(tables, "2023-03", corner, threshold=2))
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert rows(corner_job(tables, "2023-03", corner, threshold=2)) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    # i2 lost its asset, so one track of the album is left: below the threshold
    assert [(r[3], r[13]) for r in plain] == [("i9", "music"), ("i1", "music"), ("i2", "music")]


def test_codes_are_compared_alike_in_every_job(spark, catalogue):
    # on a numeric code column, text codes compare as numbers and others match nothing
    from pyspark.sql import functions as F

    tables = {**catalogue, "item_filetype": catalogue["item_filetype"].withColumn("filetype_id", F.col("filetype_id").cast("int"))}
    corner = Corner("s", "c", "SiteA", ("030300", "none"))
    assert rows(corner_job(tables, "2023-03", corner, threshold=2)) == [NINE, ALBUM]
    assert [r[2:] for r in sorted(rows(all_corners_job(tables, "2023-03", [corner], threshold=2)), key=str)] == sorted([NINE, ALBUM], key=str)


def test_corner_filters_reach_the_bridges(spark, catalogue):
    from freshcat.plans.monthly_job import corner_targets, material_dimension

    corners = [Corner("s", "a", "SiteA", ("030300",)), Corner("t", "b", "SiteB", ("110600",))]
    plan = corner_targets(material_dimension(catalogue, "2023-03"), corners)._jdf.queryExecution().optimizedPlan().toString()
    assert "site_name#" in plan and " IN (SiteA,SiteB)" in plan and " IN (030300,110600)" in plan


def test_top_k_per_corner_equals_each_corner(spark, catalogue):
    corner = Corner("s", "c", "SiteA", ("030300",), require_tieup=False)
    corners = [corner, Corner("t", "other", "SiteB", ("030300",))]
    together = sorted(rows(all_corners_job(catalogue, "2023-03", corners, threshold=2, top_k=2)), key=str)
    apart = []
    for c in corners:
        apart += [(c.site, c.corner) + r for r in rows(corner_job(catalogue, "2023-03", c, threshold=2, top_k=2))]
    assert together == sorted(apart, key=str) and len(apart) <= 4


def test_runner_removes_its_staged_intermediates(spark, catalogue):
    import os
    import uuid

    from freshcat.plans.monthly_job import run_corner_job
    from freshcat.session import checkpoint_dir

    base = checkpoint_dir(spark).replace("file:", "")
    before = {n for n in os.listdir(base) if n.startswith(("result-", "fact-", "cut-"))}
    root = os.path.join(base, f"run-{uuid.uuid4().hex}")
    run_corner_job(catalogue, root, Corner("s", "c", "SiteA", ("030300",)), month="2023-03", threshold=2)
    after = {n for n in os.listdir(base) if n.startswith(("result-", "fact-", "cut-"))}
    assert after == before
    # a failing run cleans up too
    with pytest.raises(Exception):
        run_corner_job(catalogue, "nosuchscheme://x", Corner("s", "c", "SiteA", ("030300",)), month="2023-03", threshold=2)
    assert {n for n in os.listdir(base) if n.startswith(("result-", "fact-", "cut-"))} == before
