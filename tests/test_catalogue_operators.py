"""The four catalogue operators on hand-written frames (shapes as in FIXTURES.md, part A)."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from freshcat.operators import (
    aggregate_musics_to_album,
    explode_tracks,
    filter_duplicate_tieup_item,
    join_dim_material,
)
from tests.conftest import rows

FACT_COLUMNS = [
    "pickup", "music_id", "music_name", "material_id", "material_name", "artist_id", "artist_name",
    "release_date", "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys",
    "transition_type", "score",
]


def test_material_join_multiplies_bridges_and_keeps_item_columns(spark):
    # two sites and two musics of one item give four rows; dimension rows without a bridge
    # and a null key on either side give none
    item = spark.createDataFrame([("x", 3), (None, 4)], "id string, length int")
    artists = spark.createDataFrame([(None, "nobody"), ("x", "band")], "item_id string, artist_id string")
    types = spark.createDataFrame([("x", "wav")], "item_id string, filetype_id string")
    musics = spark.createDataFrame([("x", 1), ("x", 2)], "item_id string, music_id int")
    sites = spark.createDataFrame([("x", "north"), ("x", "south")], "item_id string, site_name string")
    music = spark.createDataFrame([(2, "tune"), (3, "unused"), (None, "odd")], "id int, music_name string")
    artist = spark.createDataFrame([("band", "The Band")], "id string, artist_name string")
    out = join_dim_material(item, artists, types, musics, sites, music, artist)
    assert out.columns == ["id", "length", "artist_id", "filetype_id", "music_id", "site_name", "music_name", "artist_name"]
    assert sorted(rows(out), key=str) == sorted(
        [("x", 3, "band", "wav", m, s, {2: "tune"}.get(m), "The Band") for m in (1, 2) for s in ("north", "south")]
        + [(None, 4, None, None, None, None, None, None)], key=str)


def test_material_join_misses_and_fan_out(spark):
    item = spark.createDataFrame([("i1", "a1"), ("i2", "a2")], ["id", "col_a"])
    item_artist = spark.createDataFrame([("i1", "r1"), ("i1", "r9")], ["item_id", "artist_id"])
    empty_bridge = spark.createDataFrame([("zz", "x")], ["item_id", "col_c"])
    music_item = spark.createDataFrame([("i2", "m2")], ["item_id", "music_id"])
    item_site = spark.createDataFrame([("i1", "s1")], ["item_id", "site_name"])
    music = spark.createDataFrame([("m7", "f7")], ["id", "music_name"])
    artist = spark.createDataFrame([("r9", "g9")], ["id", "artist_name"])
    out = join_dim_material(item, item_artist, empty_bridge, music_item, item_site, music, artist)
    assert sorted(rows(out), key=str) == sorted(
        [
            ("i1", "a1", "r1", None, None, "s1", None, None),
            ("i1", "a1", "r9", None, None, "s1", None, "g9"),
            ("i2", "a2", None, None, "m2", None, None, None),
        ],
        key=str,
    )


def test_explode_first_group_only(spark):
    doc = (
        '{"Items": [{"AssetId": 900, "ResourceType": "Secondary"}],'
        ' "Groups": [{"Items": [{"AssetId": 11, "Description": null}, {"AssetId": 12}, {"AssetId": 13}],'
        ' "Groups": [], "Titles": [{"Title": "Disc one"}], "SequenceNumber": 1},'
        ' {"Items": [{"AssetId": 21}]}]}'
    )
    df = spark.createDataFrame([("alb1", "name1", "art1", "aname1", "d1", doc)],
                               ["album_music_id", "album_music_name", "album_artist_id", "album_artist_name",
                                "album_release_date", "asset_structure"])
    out = explode_tracks(df)
    assert out.schema[-1] == StructField("album_track_asset_id", LongType(), True)
    assert out.columns[:-1] == ["album_music_id", "album_music_name", "album_artist_id", "album_artist_name",
                                "album_release_date"]
    assert [r[-1] for r in out.collect()] == [11, 12, 13]


def test_explode_edge_documents(spark):
    docs = [
        ("empty_groups", '{"Groups": []}'),
        ("no_groups", '{"Items": [{"AssetId": 5}]}'),
        ("null_doc", None),
        ("malformed", "{not json"),
        ("empty_items", '{"Groups": [{"Items": []}]}'),
        ("too_big", '{"Groups": [{"Items": [{"AssetId": 99999999999}, {"AssetId": 7}]}]}'),
        ("as_text", '{"Groups": [{"Items": [{"AssetId": "8"}]}]}'),
    ]
    df = spark.createDataFrame(docs, ["album_music_id", "asset_structure"])
    got = sorted(rows(explode_tracks(df)), key=str)
    # every document yields at least one row; an id given as text is NULL
    assert ("empty_groups", None) in got
    assert ("no_groups", None) in got
    assert ("null_doc", None) in got
    assert ("malformed", None) in got
    assert ("empty_items", None) in got
    assert ("too_big", 7) in got and ("too_big", 99999999999) in got
    assert len([g for g in got if g[0] == "too_big"]) == 2
    assert len([g for g in got if g[0] == "as_text"]) == 1
    # property: rows = sum(max(1, len(first group items)))
    assert len(got) == 8


ROLLUP_SCHEMA = StructType(
    [StructField("pickup", IntegerType()), StructField("material_id", StringType()),
     StructField("material_name", StringType()), StructField("music_id", StringType()),
     StructField("music_name", StringType()), StructField("score", IntegerType())]
    + [StructField(c, StringType()) for c in (
        "artist_id", "artist_name", "release_date", "pattern_id", "tieup_detail_genre_id", "tieup_name",
        "tieup_id", "johnnys", "album_music_id", "album_music_name", "album_artist_id", "album_artist_name",
        "album_release_date")]
)


def _track(n, score, album):
    s = str(n)
    return (1, "mat" + s, "matname" + s, "mus" + s, "musname" + s, score, "art" + s, "artname" + s, "rel" + s,
            "pat" + s, "gen" + s, "tie" + s, "tieid" + s, "j" + s,
            "alb" + album, "albname" + album, "albart" + album, "albartname" + album, "albrel" + album)


def _rollup_input(spark):
    # two albums of different size interleaved with lone tracks; album P's best row is not
    # the first of the table, and two rows of Q tie in score
    data = [_track(7, 15, "P"), _track(1, 90, "L"), _track(2, 80, "Q"), _track(3, 80, "Q"), _track(4, 70, "P"),
            _track(5, 5, "Q"), _track(6, 3, "M")]
    return spark.createDataFrame(data, ROLLUP_SCHEMA)


def _music(n, score):
    s = str(n)
    return (1, "mus" + s, "musname" + s, "mat" + s, "matname" + s, "art" + s, "artname" + s, "rel" + s,
            "pat" + s, "gen" + s, "tie" + s, "tieid" + s, "j" + s, "music", score)


def _album(name):
    return (1, "alb" + name, "albname" + name, None, None, "albart" + name, "albartname" + name, "albrel" + name,
            None, None, None, None, None, "album", 0)


def _roll(df, **options):
    return aggregate_musics_to_album(df, order_column="score", **options)


def test_rollup_puts_each_album_at_its_best_row(spark):
    out = _roll(_rollup_input(spark), threshold_num=2)
    assert out.columns == FACT_COLUMNS and not out.schema["transition_type"].nullable
    assert rows(out) == [_music(1, 90), _album("Q"), _album("P"), _music(6, 3)]


def test_rollup_counts_only_what_the_cut_leaves(spark):
    # among the best four rows Q has two and P one: P stays a track
    assert rows(_roll(_rollup_input(spark), threshold_num=2, top_k=4)) == [_music(1, 90), _album("Q"), _music(4, 70)]
    assert rows(_roll(_rollup_input(spark), threshold_num=4)) == [
        _music(1, 90), _music(2, 80), _music(3, 80), _music(4, 70), _music(7, 15), _music(5, 5), _music(6, 3)]


def test_rollup_without_the_final_order_gives_the_same_rows(spark):
    ordered = rows(_roll(_rollup_input(spark), threshold_num=2))
    assert sorted(rows(_roll(_rollup_input(spark), threshold_num=2, sort=False)), key=str) == sorted(ordered, key=str)


def test_rollup_null_group_and_other_group_column(spark):
    from pyspark.sql import functions as F

    # the group column may be another one; rows without a group never roll up
    disc = F.when(F.col("album_music_id") != "albQ", F.col("album_music_id"))
    got = rows(_roll(_rollup_input(spark).withColumn("disc", disc), threshold_num=1, group_column="disc"))
    assert [(r[1], r[13]) for r in got] == [
        ("albL", "album"), ("mus2", "music"), ("mus3", "music"), ("albP", "album"), ("mus5", "music"), ("albM", "album")]


def test_rollup_threshold_counts_rows_not_tracks(spark):
    # one track fanned out over three tie-ups reaches threshold 3 on its own
    data = [_track(1, 9, "Z"), _track(1, 8, "Z"), _track(1, 7, "Z")]
    out = aggregate_musics_to_album(spark.createDataFrame(data, ROLLUP_SCHEMA), threshold_num=3)
    assert [r[13] for r in out.collect()] == ["album"]


DEDUP_SCHEMA = StructType(
    [StructField("pickup", IntegerType())]
    + [StructField(c, StringType()) for c in FACT_COLUMNS[1:13]]
    + [StructField("transition_type", StringType(), False), StructField("score", IntegerType())]
)


def test_dedup_first_tieup(spark):
    # material 8 has three tie-ups: the lowest id stays although it scores least and one is null
    tied = lambda tie, score: _music(8, score)[:11] + (tie,) + _music(8, score)[12:]
    lone = _music(1, 7)
    out = filter_duplicate_tieup_item(spark.createDataFrame([tied("t5", 30), lone, tied("t2", 1), tied("t9", 99)], DEDUP_SCHEMA))
    assert rows(out) == [lone, tied("t2", 1)]
    out = filter_duplicate_tieup_item(spark.createDataFrame([tied("t5", 30), tied(None, 4)], DEDUP_SCHEMA))
    assert rows(out) == [tied(None, 4)]  # a null id comes before any


def test_dedup_album_rows_collapse_or_keep(spark):
    albums = [
        (1, "albA", "n", None, None, "a", "an", "r", None, None, None, None, None, "album", 0),
        (1, "albB", "n", None, None, "a", "an", "r", None, None, None, None, None, "album", 0),
        _music(1, 5),
    ]
    df = spark.createDataFrame(albums, DEDUP_SCHEMA)
    collapsed = rows(filter_duplicate_tieup_item(df))
    assert len(collapsed) == 2 and collapsed[0] == _music(1, 5)
    # deterministic survivor: smallest remaining columns
    assert collapsed[1][1] == "albA"
    kept = rows(filter_duplicate_tieup_item(df, null_key="keep"))
    assert len(kept) == 3


def test_dedup_sorts_ascending_when_asked(spark):
    data = [_music(1, 500), _music(2, 300), _music(4, 100)]
    out = filter_duplicate_tieup_item(spark.createDataFrame(data, DEDUP_SCHEMA), order_column="score", ascending=True)
    assert [r[-1] for r in out.collect()] == [100, 300, 500]
    rolled = aggregate_musics_to_album(_rollup_input(spark), threshold_num=2, order_column="score", ascending=True)
    # ascending: an album stands at its lowest score
    assert [(r[1], r[13]) for r in rolled.collect()] == [
        ("mus6", "music"), ("albQ", "album"), ("albP", "album"), ("mus1", "music")]
