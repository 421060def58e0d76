"""Properties of the operators on generated inputs (few examples: each one is a Spark job)."""

import datetime as dt
import json
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from freshcat.operators import aggregate_musics_to_album, explode_tracks, first_per_key, global_row_number
from freshcat.operators import in_local_month

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

TEXT = ("material_id", "material_name", "music_id", "music_name", "artist_id", "artist_name", "pattern_id",
        "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys", "album_music_id", "album_music_name",
        "album_artist_id", "album_artist_name", "album_release_date")
FACT = StructType([StructField("pickup", IntegerType()), StructField("release_date", IntegerType()),
                   StructField("score", IntegerType())] + [StructField(c, StringType()) for c in TEXT])

facts = st.lists(
    st.tuples(st.integers(0, 5), st.sampled_from([None, "A", "B", "C"]), st.integers(0, 3)),
    min_size=0, max_size=25,
)


def _fact_rows(spec):
    out = []
    for i, (date, album, tie) in enumerate(spec):
        values = {c: f"{c}{i}" for c in TEXT}
        values["tieup_id"] = f"t{tie}"
        values["album_music_id"] = album
        values["album_music_name"] = None if album is None else f"name{album}"
        out.append((1, date, 0) + tuple(values[c] for c in TEXT))
    return out


@SETTINGS
@given(spec=facts, threshold=st.integers(1, 4))
def test_rollup_properties(spark, spec, threshold):
    df = spark.createDataFrame(_fact_rows(spec), FACT)
    out = aggregate_musics_to_album(df, threshold_num=threshold, order_column="release_date").collect()
    sizes = Counter(a for _, a, _ in spec if a is not None)
    large = {a for a, n in sizes.items() if n >= threshold}
    albums = [r for r in out if r.transition_type == "album"]
    # one group row per large group, every other row passes through unchanged
    assert sorted(r.music_id for r in albums) == sorted(large)
    assert len(out) == len(spec) - sum(sizes[a] for a in large) + len(large)
    assert len(out) <= len(spec)
    # output is in rank order: release_date descending
    dates = [r.release_date for r in out if r.transition_type == "music"]
    assert dates == sorted(dates, reverse=True)


@SETTINGS
@given(keys=st.lists(st.tuples(st.sampled_from([None, "k1", "k2", "k3"]), st.integers(0, 9)), max_size=30))
def test_dedup_properties(spark, keys):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(keys)], "k string, v int, i int")
    collapsed = first_per_key(df, "k", [("v", True)]).collect()
    kept = first_per_key(df, "k", [("v", True)], null_key="keep").collect()
    present = {k for k, _ in keys if k is not None}
    nulls = sum(1 for k, _ in keys if k is None)
    assert sorted(r.k for r in collapsed if r.k is not None) == sorted(present)
    assert sum(1 for r in collapsed if r.k is None) == min(1, nulls)
    assert sum(1 for r in kept if r.k is None) == nulls
    for r in collapsed:
        if r.k is not None:
            assert r.v == min(v for k, v in keys if k == r.k)


documents = st.one_of(
    st.none(),
    st.just("{not json"),
    st.lists(st.lists(st.integers(-5, 10**10), max_size=4), max_size=3).map(
        lambda groups: json.dumps({"Groups": [{"Items": [{"AssetId": a} for a in g]} for g in groups]})
    ),
)


@SETTINGS
@given(docs=st.lists(documents, max_size=8))
def test_explode_row_count(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "album int, asset_structure string")
    got = explode_tracks(df).collect()
    expected = 0
    for d in docs:
        try:
            groups = json.loads(d)["Groups"] if d else []
        except ValueError:
            groups = []
        expected += max(1, len(groups[0]["Items"]) if groups else 0)
    assert len(got) == expected
    ids = {r.album_track_asset_id for r in got if r.album_track_asset_id is not None}
    listed = {i["AssetId"] for d in docs if d and d[0] == "{" and d != "{not json" for g in json.loads(d)["Groups"][:1] for i in g["Items"]}
    assert ids == listed  # also those beyond 32 bits


instants = st.datetimes(min_value=dt.datetime(2022, 12, 1), max_value=dt.datetime(2023, 5, 1))


@SETTINGS
@given(values=st.lists(instants, max_size=20), month=st.sampled_from(["2023-01", "2023-02", "2023-03", "2023-04"]))
def test_month_range_equals_like(spark, values, month):
    schema = StructType([StructField("i", IntegerType()), StructField("ts", TimestampType())])
    df = spark.createDataFrame([(i, v.replace(tzinfo=dt.timezone.utc)) for i, v in enumerate(values)], schema)
    ours = sorted(r.i for r in in_local_month(df, "ts", month).collect())
    like = df.where(F.date_format(F.from_utc_timestamp("ts", "Asia/Tokyo"), "yyyy-MM-dd").like(f"{month}%"))
    assert ours == sorted(r.i for r in like.collect())


@SETTINGS
@given(values=st.lists(st.integers(0, 5), max_size=40), parts=st.integers(1, 6))
def test_global_row_number_matches_window(spark, values, parts):
    schema = StructType([StructField("id", LongType()), StructField("v", IntegerType())])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    ours = global_row_number(df, [("v", False)], ties=[("id", True)], partitions=parts)
    ref = df.withColumn("rank", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    assert sorted(tuple(r) for r in ours.collect()) == sorted(tuple(r) for r in ref.collect())


def _rank(row, first, columns, ascending=False):
    """Sort key of the stated order: ``first`` (descending unless told), then every other
    column ascending; nulls are least."""
    key = lambda v: (v is not None, v if v is not None else 0)
    lead = key(row[first])
    if not ascending:
        lead = (-lead[0], -lead[1])
    return lead, [key(row[c]) for c in columns if c != first]


def _rolled(spec, threshold, top_k):
    """The stated semantics in plain Python: cut, count, and one row for each large album."""
    names = FACT.fieldNames()
    table = sorted((dict(zip(names, r)) for r in _fact_rows(spec)), key=lambda r: _rank(r, "release_date", names))
    table = table[:top_k] if top_k else table
    sizes, seen, out = Counter(r["album_music_id"] for r in table), set(), []
    for r in table:
        album = r["album_music_id"]
        large = album is not None and sizes[album] >= threshold
        if large and album in seen:
            continue
        if large:
            seen.add(album)
            blank = ("material_id", "material_name", "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys")
            r = {**r, **dict.fromkeys(blank), "score": 0, **{c: r[f"album_{c}"] for c in ("music_id", "music_name", "artist_id", "artist_name", "release_date")}}
        out.append({**r, "release_date": str(r["release_date"]), "transition_type": "album" if large else "music"})
    return out


@SETTINGS
@given(spec=facts, threshold=st.integers(1, 4), k=st.sampled_from([None, 3, 7]))
def test_rollup_equals_a_plain_model(spark, spec, threshold, k):
    df = spark.createDataFrame(_fact_rows(spec), FACT).repartition(3)
    out = aggregate_musics_to_album(df, top_k=k, threshold_num=threshold, order_column="release_date")
    assert [r.asDict() for r in out.collect()] == [{c: m[c] for c in out.columns} for m in _rolled(spec, threshold, k)]


@SETTINGS
@given(spec=facts, k=st.integers(1, 9))
def test_a_cut_by_rank_equals_a_sorted_cut(spark, spec, k):
    from freshcat.operators import ranking

    df = spark.createDataFrame(_fact_rows(spec), FACT).repartition(3)
    for within in ((), ("album_music_id",)):
        plain = ranking.first_rows(df, [("release_date", False)], k, within=within)
        kept, ranking.MERGED_ROWS = ranking.MERGED_ROWS, 0  # as if k were large
        try:
            ranked = ranking.first_rows(df, [("release_date", False)], k, within=within)
            assert sorted(map(str, plain.collect())) == sorted(map(str, ranked.select(*plain.columns).collect()))
        finally:
            ranking.MERGED_ROWS = kept


@SETTINGS
@given(keys=st.lists(st.tuples(st.sampled_from([None, "m1", "m2", "m3"]), st.sampled_from([None, "t1", "t2"]),
                               st.integers(0, 3)), max_size=25))
def test_dedup_equals_a_plain_model(spark, keys):
    from freshcat.operators import filter_duplicate_tieup_item
    from freshcat.operators.rollup import OUTPUT_COLUMNS

    table = []
    for i, (mat, tie, score) in enumerate(keys):
        table.append({**{c: f"{c}{i}" for c in OUTPUT_COLUMNS}, "material_id": mat, "tieup_id": tie, "pickup": 1, "score": score, "transition_type": "music"})
    schema = ", ".join(f"{c} {'int' if c in ('pickup', 'score') else 'string'}" for c in OUTPUT_COLUMNS)
    df = spark.createDataFrame([tuple(r[c] for c in OUTPUT_COLUMNS) for r in table], schema).repartition(3)
    best = {}
    others = [c for c in OUTPUT_COLUMNS if c != "material_id"]
    for r in sorted(table, key=lambda r: _rank(r, "tieup_id", others, ascending=True)):
        best.setdefault(r["material_id"], r)
    want = sorted(best.values(), key=lambda r: _rank(r, "score", OUTPUT_COLUMNS))
    assert [r.asDict() for r in filter_duplicate_tieup_item(df).collect()] == want
