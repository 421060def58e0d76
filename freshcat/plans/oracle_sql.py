"""Independent DuckDB formulations of the driver queries (the correctness oracle).

They are written the way the catalogue job is written -- global ``row_number``,
``count() over (partition)``, survivor filter, raw left joins followed by ``DISTINCT`` --
not the way the Spark plans are built, so agreement checks the rewrites. Both sides spell
out NULL order (Spark: ascending = NULLS FIRST, descending = NULLS LAST) and the same
tie-break columns.
"""

from __future__ import annotations

from freshcat.plans.star import (
    ALBUM_STATUSES,
    ASSET_STRIDE,
    BACKFILL_NEWEST,
    BACKFILL_OLDEST,
    FLAG_REGION,
    FLAGSHIP_MONTH,
    FLAGSHIP_SEGMENT,
    FLAGSHIP_THRESHOLD,
    FLAGSHIP_TOP_K,
    FLAGSHIP_TYPES,
    TIEUP_MAX_SIZE,
    TRACK_SLOTS,
    UNSEARCHABLE_FROM_BRAND,
    star_corners,
)

FACT_COLUMNS = (
    "pickup", "material_id", "material_name", "music_id", "music_name", "artist_id", "artist_name",
    "release_date", "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys", "score",
    "album_music_id", "album_music_name", "album_artist_id", "album_artist_name", "album_release_date",
)
OUTPUT_COLUMNS = (
    "pickup", "music_id", "music_name", "material_id", "material_name", "artist_id", "artist_name",
    "release_date", "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys",
    "transition_type", "score",
)
ALBUM_SWAP = {
    "music_id": "album_music_id",
    "music_name": "album_music_name",
    "artist_id": "album_artist_id",
    "artist_name": "album_artist_name",
    "release_date": "album_release_date",
}
ALBUM_BLANK = ("material_id", "material_name", "pattern_id", "tieup_detail_genre_id", "tieup_name", "tieup_id", "johnnys")


def _q(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def local_epoch(expr: str) -> str:
    return f"CAST(floor(epoch({expr} + INTERVAL 9 HOUR)) AS BIGINT)"


def brand_no(expr: str = "p_brand") -> str:
    return f"TRY_CAST(split_part({expr}, '#', 2) AS INTEGER)"


def star_ctes(month: str | None = None, corner_where: str = "", corners: bool = False, newest: str | None = None) -> str:
    """CTEs item, material, target, tieup_bridge, tieup, flags, albums, tracks."""
    local_month = "strftime(o.o_orderdate + INTERVAL 9 HOUR, '%Y-%m')"
    if month and newest:
        month_pred = f"AND {local_month} BETWEEN '{month}' AND '{newest}'"
        month_col = ",\n         strftime(o.o_orderdate + INTERVAL 9 HOUR, '%Y%m') || '01' AS target_date"
    else:
        month_pred = f"AND {local_month} = '{month}'" if month else ""
        month_col = ""
    if corners:
        rows = []
        for c in star_corners():
            for code in c.filetype_ids:
                rows.append(f"('{c.site}', '{c.corner}', '{c.site_name}', '{code}', {str(c.require_tieup).upper()})")
        target = (
            "cfg(site, corner, cfg_site_name, cfg_code, require_tieup) AS (VALUES " + ", ".join(rows) + "),\n"
            "target AS (SELECT cfg.site, cfg.corner, cfg.require_tieup, m.* FROM material m "
            "JOIN cfg ON m.site_name = cfg.cfg_site_name AND m.filetype_id = cfg.cfg_code)"
        )
    else:
        target = f"target AS (SELECT * FROM material {corner_where})"
    return f"""
item AS (
  SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                   CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)) AS id,
         concat_ws('/', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS name,
         o.o_orderdate AS delivery_start_date,
         l.l_partkey AS music_id, l.l_suppkey AS artist_id,
         l.l_orderkey * {ASSET_STRIDE} + l.l_linenumber AS asset_id, o.o_custkey AS custkey{month_col}
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE (CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN l.l_shipdate END) IS NULL {month_pred}
),
material AS (
  SELECT i.*, p.p_name AS music_name, p.p_type AS filetype_id, s.s_name AS artist_name, c.c_mktsegment AS site_name
  FROM item i
  LEFT JOIN part p ON i.music_id = p.p_partkey
  LEFT JOIN supplier s ON i.artist_id = s.s_suppkey
  LEFT JOIN customer c ON i.custkey = c.c_custkey
),
{target},
tieup_bridge AS (
  SELECT p_partkey AS music_id, {brand_no()} AS tieup_id, p_size AS pattern_id FROM part WHERE p_size <= {TIEUP_MAX_SIZE}
),
tieup AS (
  SELECT b AS id, p_brand AS name, NULLIF(CAST(floor((b - 1) / 5) AS INTEGER), 0) AS detailgenre_id,
         CASE WHEN b >= {UNSEARCHABLE_FROM_BRAND} THEN 0 ELSE 1 END AS searchable
  FROM (SELECT DISTINCT p_brand, {brand_no()} AS b FROM part)
),
flags AS (
  SELECT s.s_suppkey AS artist_id, n.n_name AS is_johnnys
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name = '{FLAG_REGION}'
),
albums AS (
  SELECT o.o_orderkey AS album_music_id, 'order ' || CAST(o.o_orderkey AS VARCHAR) AS album_music_name,
         o.o_custkey AS album_artist_id, c.c_name AS album_artist_name,
         {local_epoch('o.o_orderdate')} AS album_release_date, o.o_orderpriority AS prio
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus IN ({_q(ALBUM_STATUSES)})
),
tracks AS (
  SELECT a.album_music_id, a.album_music_name, a.album_artist_id, a.album_artist_name, a.album_release_date,
         a.album_music_id * {ASSET_STRIDE} + g.i AS album_track_asset_id
  FROM albums a CROSS JOIN range(1, {TRACK_SLOTS + 1}) g(i)
  WHERE a.prio IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  UNION ALL
  SELECT a.album_music_id, a.album_music_name, a.album_artist_id, a.album_artist_name, a.album_release_date,
         CAST(NULL AS BIGINT) AS album_track_asset_id
  FROM albums a
  WHERE a.prio IS NULL OR a.prio NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
)"""


def fact_cte(require_tieup: bool | None = True, within: tuple[str, ...] = ()) -> str:
    """Raw left joins, tie-up filter, projection with defaults, DISTINCT."""
    if require_tieup is None:  # per corner
        where = "u.searchable <> 0 OR (NOT t.require_tieup AND u.searchable IS NULL)"
    elif require_tieup:
        where = "u.searchable <> 0"
    else:
        where = "u.searchable <> 0 OR u.searchable IS NULL"
    keep = "".join(f"t.{w}, " for w in within)
    return f"""
fact AS (
  SELECT DISTINCT {keep}1 AS pickup, t.id AS material_id, t.name AS material_name, t.music_id, t.music_name,
         t.artist_id, t.artist_name, {local_epoch('t.delivery_start_date')} AS release_date,
         COALESCE(b.pattern_id, 0) AS pattern_id, COALESCE(u.detailgenre_id, 0) AS tieup_detail_genre_id,
         COALESCE(CAST(u.name AS VARCHAR), 'null') AS tieup_name, CAST(COALESCE(u.id, 0) AS INTEGER) AS tieup_id,
         CASE WHEN f.is_johnnys IS NULL THEN 0 ELSE 1 END AS johnnys, 0 AS score,
         k.album_music_id, k.album_music_name, k.album_artist_id, k.album_artist_name, k.album_release_date
  FROM target t
  LEFT JOIN tieup_bridge b ON t.music_id = b.music_id
  LEFT JOIN tieup u ON b.tieup_id = u.id
  LEFT JOIN flags f ON t.artist_id = f.artist_id
  LEFT JOIN tracks k ON t.asset_id = k.album_track_asset_id
  WHERE {where}
)"""


def _asc(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def rollup_dedup_ctes(threshold: int, top_k: int | None = None, within: tuple[str, ...] = (), dedup: bool = True) -> str:
    """Window form of the rollup (C3) and the de-duplication (C4) over CTE ``fact``."""
    part = ", ".join(within)
    over_w = f"PARTITION BY {part} " if within else ""
    by_w = f"{part}, " if within else ""
    ties = [c for c in FACT_COLUMNS if c != "release_date"]
    rank_order = f"release_date DESC NULLS LAST, {_asc(ties)}"
    cut = f"WHERE rnk <= {top_k}" if top_k else ""
    cols = []
    for c in OUTPUT_COLUMNS:
        if c == "transition_type":
            cols.append("CASE WHEN is_album = 1 THEN 'album' ELSE 'music' END AS transition_type")
        elif c == "score":
            cols.append("CASE WHEN is_album = 1 THEN 0 ELSE score END AS score")
        elif c in ALBUM_SWAP:
            cols.append(f"CASE WHEN is_album = 1 THEN {ALBUM_SWAP[c]} ELSE {c} END AS {c}")
        elif c in ALBUM_BLANK:
            cols.append(f"CASE WHEN is_album = 1 THEN NULL ELSE {c} END AS {c}")
        else:
            cols.append(c)
    keep = "".join(f"{w}, " for w in within)
    text = f""",
ranked AS (SELECT *, row_number() OVER ({over_w}ORDER BY {rank_order}) AS rnk FROM fact),
kept AS (SELECT * FROM ranked {cut}),
counted AS (SELECT *, count(album_music_id) OVER (PARTITION BY {by_w}album_music_id) AS n_grp FROM kept),
marked AS (SELECT *, CASE WHEN album_music_id IS NOT NULL AND n_grp >= {threshold} THEN 1 ELSE 0 END AS is_album
           FROM counted),
firsts AS (SELECT *, row_number() OVER (PARTITION BY {by_w}album_music_id, is_album ORDER BY rnk) AS rn_grp FROM marked),
rolled AS (SELECT {keep}{', '.join(cols)} FROM firsts WHERE is_album = 0 OR rn_grp = 1)"""
    if dedup:
        dd_ties = [c for c in OUTPUT_COLUMNS if c not in ("material_id", "tieup_id")]
        text += f""",
dd AS (SELECT *, row_number() OVER (PARTITION BY {by_w}material_id ORDER BY tieup_id ASC NULLS FIRST, {_asc(dd_ties)})
       AS rn_dd FROM rolled)"""
    return text


def flagship_sql(month=FLAGSHIP_MONTH, segment=FLAGSHIP_SEGMENT, types=FLAGSHIP_TYPES, threshold=FLAGSHIP_THRESHOLD,
                 top_k=None) -> str:
    where = f"WHERE site_name = '{segment}' AND filetype_id IN ({_q(types)})"
    return (
        "WITH " + star_ctes(month, where) + "," + fact_cte(True) + rollup_dedup_ctes(threshold, top_k)
        + f"\nSELECT {', '.join(OUTPUT_COLUMNS)} FROM dd WHERE rn_dd = 1"
    )


def all_corners_sql(month=FLAGSHIP_MONTH, threshold=FLAGSHIP_THRESHOLD) -> str:
    within = ("site", "corner")
    return (
        "WITH " + star_ctes(month, corners=True) + "," + fact_cte(None, within)
        + rollup_dedup_ctes(threshold, within=within)
        + f"\nSELECT site, corner, {', '.join(OUTPUT_COLUMNS)} FROM dd WHERE rn_dd = 1"
    )


def backfill_sql(oldest=BACKFILL_OLDEST, newest=BACKFILL_NEWEST, threshold=FLAGSHIP_THRESHOLD) -> str:
    within = ("site", "corner", "target_date")
    return (
        "WITH " + star_ctes(oldest, corners=True, newest=newest) + "," + fact_cte(None, within)
        + rollup_dedup_ctes(threshold, within=within)
        + f"\nSELECT site, corner, target_date, {', '.join(OUTPUT_COLUMNS)} FROM dd WHERE rn_dd = 1"
    )


def catalogue_sql(month=FLAGSHIP_MONTH, segment=FLAGSHIP_SEGMENT, types=FLAGSHIP_TYPES, threshold=FLAGSHIP_THRESHOLD,
                  newest=None, corners=False, text_ids=False, repeated=False, select=None) -> str:
    """The catalogue-schema job on catalogue tables derived from the star, written with
    raw joins and a JSON parse in DuckDB (no shape rule).

    ``corners``: every corner, months ``month`` .. ``newest``; ``text_ids``: every third asset
    id of the id map is no number; ``repeated``: every third album has a second header row."""
    def slot_list(key):
        return (
            f"array_to_string(list_transform(range(1, {TRACK_SLOTS + 1}), "
            f"lambda i: '{{\"AssetId\": ' || CAST({key} * {ASSET_STRIDE} + i AS VARCHAR) || '}}'), ', ')"
        )

    slots = slot_list("o.o_orderkey")
    within = ("site", "corner", "target_date") if corners else ()
    keep = "".join(f"t.{w}, " for w in within)
    if corners:
        rows = [
            f"('{c.site}', '{c.corner}', '{c.site_name}', '{code}', {str(c.require_tieup).upper()})"
            for c in star_corners() for code in c.filetype_ids
        ]
        target = (
            "cfg(site, corner, cfg_site_name, cfg_code, require_tieup) AS (VALUES " + ", ".join(rows) + "),\n"
            "target AS (SELECT cfg.site, cfg.corner, cfg.require_tieup, m.* FROM material m "
            "JOIN cfg ON m.site_name = cfg.cfg_site_name AND m.filetype_id = cfg.cfg_code),"
        )
        tieup_test = "u.searchable <> 0 OR (NOT t.require_tieup AND u.searchable IS NULL)"
    else:
        target = f"target AS (SELECT * FROM material WHERE site_name = '{segment}' AND filetype_id IN ({_q(types)})),"
        tieup_test = "u.searchable <> 0"
    asset = f"l_orderkey * {ASSET_STRIDE} + l_linenumber"
    if text_ids:
        asset = f"CASE WHEN ({asset}) % 3 = 0 THEN 'x-' || CAST({asset} AS VARCHAR) ELSE CAST({asset} AS VARCHAR) END"
    again = ""
    if repeated:
        again = f"""
  UNION ALL SELECT id, title_title || ' (again)', release_type, title_titletype, title_titlelanguage,
         artist_names_language, artist_names_text, '{{"Groups": [{{"Items": [' || {slot_list("(id + 1)")} || ']}}]}}'
  FROM heads WHERE id % 3 = 0"""
    doc = f"""CASE o.o_orderpriority
      WHEN '1-URGENT' THEN '{{"Groups": [{{"Items": [' || {slots} || ']}}, {{"Items": [{{"AssetId": 0}}]}}]}}'
      WHEN '2-HIGH' THEN '{{"Items": [{{"AssetId": 0}}], "Groups": [{{"Items": [' || {slots} || ']}}]}}'
      WHEN '3-MEDIUM' THEN '{{"Groups": [{{"Items": [' || {slots} || ']}}]}}'
      WHEN '4-NOT SPECIFIED' THEN '{{"Groups": []}}'
      ELSE 'not json' END"""
    album_cols = "album_music_id, album_music_name, album_artist_id, album_artist_name, album_release_date, album_month"
    return f"""WITH
lines AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR)) AS item_id, * FROM lineitem
),
dim_item AS (
  SELECT item_id AS id, concat_ws('/', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS name,
         l_shipdate AS delivery_start_date,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_shipdate END AS catalog_end_date
  FROM lines
),
item_artist AS (SELECT item_id, l_suppkey AS artist_id FROM lines),
item_ftdt AS (SELECT l.item_id, p.p_type AS filetype_id FROM lines l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
music_item AS (SELECT item_id, l_partkey AS music_id FROM lines),
item_site AS (
  SELECT c.c_mktsegment AS site_name, l.item_id
  FROM lines l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
material AS (
  SELECT i.id, i.name, i.delivery_start_date, a.artist_id, f.filetype_id, mi.music_id, s.site_name,
         m.p_name AS music_name, ar.s_name AS artist_name,
         strftime(i.delivery_start_date + INTERVAL 9 HOUR, '%Y%m') || '01' AS target_date
  FROM dim_item i
  LEFT JOIN item_artist a ON i.id = a.item_id
  LEFT JOIN item_ftdt f ON i.id = f.item_id
  LEFT JOIN music_item mi ON i.id = mi.item_id
  LEFT JOIN item_site s ON i.id = s.item_id
  LEFT JOIN part m ON mi.music_id = m.p_partkey
  LEFT JOIN supplier ar ON a.artist_id = ar.s_suppkey
  WHERE i.catalog_end_date IS NULL
    AND strftime(i.delivery_start_date + INTERVAL 9 HOUR, '%Y-%m') BETWEEN '{month}' AND '{newest or month}'
),
{target}
idmap AS (SELECT DISTINCT l_orderkey AS collection_id, {asset} AS asset_id, item_id AS material_id FROM lines),
heads AS (
  SELECT o.o_orderkey AS id, 'order ' || CAST(o.o_orderkey AS VARCHAR) AS title_title,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Album' ELSE 'Single' END AS release_type,
         'AlbumName' AS title_titletype, 'ja-Hani' AS title_titlelanguage,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'en' ELSE 'ja-Hani' END AS artist_names_language,
         c.c_name AS artist_names_text, {doc} AS asset_structure
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus <> 'P'
),
detail AS (SELECT * FROM heads{again}),
bridge AS (SELECT o_orderkey AS collection_detail_id, o_orderkey AS collection_id FROM orders WHERE o_orderstatus <> 'P'),
albums AS (
  SELECT d.id AS album_music_id, d.title_title AS album_music_name, m.artist_id AS album_artist_id,
         d.artist_names_text AS album_artist_name, {local_epoch('m.delivery_start_date')} AS album_release_date,
         m.target_date AS album_month, d.asset_structure
  FROM detail d
  LEFT JOIN bridge b ON d.id = b.collection_detail_id
  LEFT JOIN idmap x ON b.collection_id = x.collection_id
  LEFT JOIN material m ON x.material_id = m.id
  WHERE d.release_type = 'Album' AND d.title_titletype = 'AlbumName' AND d.title_titlelanguage = 'ja-Hani'
    AND d.artist_names_language = 'ja-Hani'
),
parsed AS (
  SELECT *, CASE WHEN json_valid(asset_structure)
                 THEN CAST(json_extract(asset_structure, '$.Groups[0].Items[*].AssetId') AS BIGINT[]) END AS ids
  FROM albums
),
tracks AS (
  SELECT {album_cols}, unnest(ids) AS album_track_asset_id FROM parsed WHERE len(ids) > 0
  UNION ALL
  SELECT {album_cols}, CAST(NULL AS BIGINT) FROM parsed WHERE ids IS NULL OR len(ids) = 0
),
tieup_bridge AS (
  SELECT p_partkey AS music_id, {brand_no()} AS tieup_id, p_size AS pattern_id FROM part WHERE p_size <= {TIEUP_MAX_SIZE}
),
tieup AS (
  SELECT b AS id, p_brand AS name, NULLIF(CAST(floor((b - 1) / 5) AS INTEGER), 0) AS detailgenre_id,
         CASE WHEN b >= {UNSEARCHABLE_FROM_BRAND} THEN 0 ELSE 1 END AS searchable
  FROM (SELECT DISTINCT p_brand, {brand_no()} AS b FROM part)
),
flags AS (
  SELECT s.s_suppkey AS artist_id, n.n_name AS is_johnnys
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name = '{FLAG_REGION}'
),
fact AS (
  SELECT DISTINCT {keep}1 AS pickup, t.id AS material_id, t.name AS material_name, t.music_id, t.music_name,
         t.artist_id, t.artist_name, {local_epoch('t.delivery_start_date')} AS release_date,
         COALESCE(b.pattern_id, 0) AS pattern_id, COALESCE(u.detailgenre_id, 0) AS tieup_detail_genre_id,
         COALESCE(CAST(u.name AS VARCHAR), 'null') AS tieup_name, CAST(COALESCE(u.id, 0) AS INTEGER) AS tieup_id,
         CASE WHEN j.is_johnnys IS NULL THEN 0 ELSE 1 END AS johnnys, 0 AS score,
         k.album_music_id, k.album_music_name, CASE WHEN k.album_month = t.target_date THEN k.album_artist_id END AS album_artist_id,
         k.album_artist_name, CASE WHEN k.album_month = t.target_date THEN k.album_release_date END AS album_release_date
  FROM target t
  LEFT JOIN idmap x ON t.id = x.material_id
  LEFT JOIN tieup_bridge b ON t.music_id = b.music_id
  LEFT JOIN tieup u ON b.tieup_id = u.id
  LEFT JOIN flags j ON t.artist_id = j.artist_id
  LEFT JOIN tracks k ON TRY_CAST(x.asset_id AS BIGINT) = k.album_track_asset_id
  WHERE {tieup_test}
)""" + rollup_dedup_ctes(threshold, within=within) + f"\nSELECT {select or ', '.join((*within, *OUTPUT_COLUMNS))} FROM dd WHERE rn_dd = 1"


def backfill_until_target_sql(target_rows: int = 100) -> str:
    within = ("site", "corner", "target_date")
    cols = ", ".join(OUTPUT_COLUMNS)
    return (
        "WITH " + star_ctes(BACKFILL_OLDEST, corners=True, newest=BACKFILL_NEWEST) + "," + fact_cte(None, within)
        + rollup_dedup_ctes(FLAGSHIP_THRESHOLD, within=within)
        + f""",
result AS (SELECT site, corner, target_date, {cols} FROM dd WHERE rn_dd = 1),
monthly AS (SELECT site, corner, target_date, count(*) AS n FROM result GROUP BY site, corner, target_date),
needed AS (
  SELECT site, corner, target_date FROM (
    SELECT *, COALESCE(SUM(n) OVER (PARTITION BY site, corner ORDER BY target_date DESC
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM monthly) WHERE before < {target_rows}
)
SELECT r.* FROM result r JOIN needed USING (site, corner, target_date)"""
    )


def catalogue_until_target_sql(target_rows: int = 50) -> str:
    return f"""
WITH result AS ({catalogue_sql(BACKFILL_OLDEST, newest=FLAGSHIP_MONTH, corners=True)}),
monthly AS (SELECT site, corner, target_date, count(*) AS n FROM result GROUP BY site, corner, target_date),
needed AS (
  SELECT site, corner, target_date FROM (
    SELECT *, COALESCE(SUM(n) OVER (PARTITION BY site, corner ORDER BY target_date DESC
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM monthly) WHERE before < {target_rows}
)
SELECT r.* FROM result r JOIN needed USING (site, corner, target_date)"""


def audit_sql(days: int = 7) -> str:
    """Every corner, one without rows and one that never ran, for the month's first days."""
    first = f"{FLAGSHIP_MONTH}-01"
    corners = [(c.site, c.corner, True) for c in star_corners()] + [("nowhere", "empty", True), ("nowhere", "never_run", False)]
    rows = ", ".join(f"('{s}', '{c}', {str(ran).upper()})" for s, c, ran in corners)
    return f"""
WITH result AS ({catalogue_sql(corners=True)}),
counts AS (SELECT site, corner, target_date, count(*) AS n FROM result GROUP BY site, corner, target_date),
asked(site, corner, ran) AS (VALUES {rows}),
days AS (SELECT CAST(DATE '{first}' + CAST(k AS INTEGER) AS DATE) AS day FROM range({days}) r(k)),
expected AS (
  SELECT site, corner, strftime(day, '%Y%m%d') AS target_date, ran AND day = DATE '{first}' AS published FROM asked CROSS JOIN days
)
SELECT e.site, e.corner, e.target_date, COALESCE(c.n, 0) AS rows, CASE WHEN e.published THEN COALESCE(c.n, 0) END AS listed,
       CASE WHEN e.published THEN 1 ELSE 0 END::BIGINT AS files,
       CASE WHEN NOT e.published THEN 'missing' WHEN COALESCE(c.n, 0) = 0 THEN 'empty' ELSE 'ok' END AS status
FROM expected e LEFT JOIN counts c USING (site, corner, target_date)"""


def whole_rollup_sql(threshold: int, top_k: int | None = None) -> str:
    return (
        "WITH " + star_ctes(None) + "," + fact_cte(True) + rollup_dedup_ctes(threshold, top_k, dedup=False)
        + f"\nSELECT {', '.join(OUTPUT_COLUMNS)} FROM rolled"
    )


ITEM_ONLY = "WITH " + star_ctes(None)

ORACLE_SQL: dict[str, str] = {
    "scd_current": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem
WHERE (CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_shipdate END) IS NULL""",
    "dim_project": "SELECT p_partkey AS music_id, p_name AS music_name, p_type AS filetype_id FROM part",
    "jst_shift": "SELECT event_id, event_type, ts + INTERVAL 9 HOUR AS ts FROM events",
    "jst_epoch": f"SELECT event_id, {local_epoch('ts')} AS epoch_local FROM events",
    "month_filter": f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m') = '{FLAGSHIP_MONTH}'""",
    "corner_filter": ITEM_ONLY + f"""
SELECT id, music_id, artist_id, site_name, filetype_id FROM material
WHERE site_name = '{FLAGSHIP_SEGMENT}' AND filetype_id IN ({_q(FLAGSHIP_TYPES)})""",
    "album_select": """
SELECT o.o_orderkey, o.o_custkey, c.c_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT' AND c.c_mktsegment = 'BUILDING' AND n.n_regionkey = 2
  AND (CASE WHEN c.c_acctbal < 0 THEN o.o_orderdate END) IS NULL""",
    "material_join": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderstatus, o.o_custkey, p.p_name, s.s_name,
       c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM lineitem l
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) p ON l.l_partkey = p.p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'AMERICA') r ON n.n_regionkey = r.r_regionkey""",
    "distinct_rows": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "distinct_idmap": f"""
SELECT DISTINCT l_orderkey AS collection_id, l_orderkey * {ASSET_STRIDE} + l_linenumber AS asset_id,
       l_partkey AS material_id
FROM lineitem""",
    "tieup_searchable": ITEM_ONLY + """
SELECT i.id, i.music_id, u.id AS tieup_id, u.name AS tieup_name
FROM item i LEFT JOIN tieup_bridge b ON i.music_id = b.music_id LEFT JOIN tieup u ON b.tieup_id = u.id
WHERE u.searchable <> 0""",
    "tieup_searchable_or_null": ITEM_ONLY + """
SELECT i.id, i.music_id, u.id AS tieup_id, u.name AS tieup_name
FROM item i LEFT JOIN tieup_bridge b ON i.music_id = b.music_id LEFT JOIN tieup u ON b.tieup_id = u.id
WHERE u.searchable <> 0 OR u.searchable IS NULL""",
    "redundant_join": """
SELECT DISTINCT l.l_partkey, l.l_suppkey FROM lineitem l LEFT JOIN part g ON l.l_orderkey = g.p_partkey""",
    "flag_lookup": ITEM_ONLY + """
SELECT s.s_suppkey AS artist_id, s.s_name, CASE WHEN f.is_johnnys IS NULL THEN 0 ELSE 1 END AS johnnys
FROM supplier s LEFT JOIN flags f ON s.s_suppkey = f.artist_id""",
    "null_defaults": ITEM_ONLY + """
SELECT i.id, COALESCE(b.pattern_id, 0) AS pattern_id, COALESCE(u.detailgenre_id, 0) AS tieup_detail_genre_id,
       COALESCE(CAST(u.name AS VARCHAR), 'null') AS tieup_name, CAST(COALESCE(u.id, 0) AS INTEGER) AS tieup_id
FROM item i LEFT JOIN tieup_bridge b ON i.music_id = b.music_id LEFT JOIN tieup u ON b.tieup_id = u.id""",
    "json_parse": "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "explode_tracks": ITEM_ONLY + "\nSELECT album_music_id, album_track_asset_id FROM tracks",
    "track_album_join": ITEM_ONLY + """
SELECT i.id, k.album_music_id FROM item i LEFT JOIN tracks k ON i.asset_id = k.album_track_asset_id""",
    "album_dim": ITEM_ONLY + """
SELECT album_music_id, album_music_name, album_artist_id, album_artist_name, album_release_date, album_track_asset_id
FROM tracks""",
    "having_count": "SELECT l_orderkey, count(l_orderkey) AS row_count FROM lineitem GROUP BY l_orderkey HAVING count(l_orderkey) >= 5",
    "global_rank": """
SELECT o_orderkey, o_totalprice,
       CAST(row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS FIRST) AS BIGINT) AS rank
FROM orders""",
    "topk": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS FIRST LIMIT 100""",
    "album_rollup": whole_rollup_sql(5),
    "album_rollup_topk": whole_rollup_sql(5, 5000),
    "dedup_first": """
WITH k AS (SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_partkey END AS part_key, l_suppkey, l_orderkey, l_linenumber
           FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY part_key ORDER BY l_suppkey ASC NULLS FIRST, l_orderkey ASC NULLS FIRST,
                                   l_linenumber ASC NULLS FIRST) AS rn FROM k)
SELECT part_key, l_suppkey, l_orderkey, l_linenumber FROM r WHERE rn = 1""",
    "dedup_keep_null": """
WITH k AS (SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_partkey END AS part_key, l_suppkey, l_orderkey, l_linenumber
           FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY part_key ORDER BY l_suppkey ASC NULLS FIRST, l_orderkey ASC NULLS FIRST,
                                   l_linenumber ASC NULLS FIRST) AS rn FROM k)
SELECT part_key, l_suppkey, l_orderkey, l_linenumber FROM r WHERE rn = 1 OR part_key IS NULL""",
    "scan_fallback": "SELECT p_partkey, p_name FROM part",
    "csv_roundtrip": """
SELECT c_custkey, c_name, c_nationkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN 'null'
            ELSE c_name END AS note
FROM customer""",
    "partition_roundtrip": """
SELECT o.o_orderkey, o.o_totalprice, lower(c.c_mktsegment) AS site, 'orders' AS corner,
       strftime(date_trunc('month', o.o_orderdate + INTERVAL 9 HOUR), '%Y%m%d') AS target_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE strftime(o.o_orderdate + INTERVAL 9 HOUR, '%Y-%m') IN ('1996-03', '1996-04')""",
    "partition_audit": """
WITH types AS (SELECT DISTINCT event_type FROM events),
span AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events),
days AS (SELECT CAST(d AS DATE) AS day FROM span, generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
expected AS (SELECT event_type, day FROM types CROSS JOIN days),
counts AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY event_type, CAST(ts AS DATE))
SELECT e.event_type, e.day, COALESCE(c.row_count, 0) AS row_count
FROM expected e LEFT JOIN counts c ON e.event_type = c.event_type AND e.day = c.day""",
    "month_sequence": """
WITH m AS (SELECT date_trunc('month', max(o_orderdate)) AS newest FROM orders)
SELECT CAST(d AS DATE) AS month_start, strftime(d, '%Y-%m') AS month
FROM m, generate_series(m.newest - INTERVAL 23 MONTH, m.newest, INTERVAL 1 MONTH) g(d)""",
    "months_until_target": """
WITH monthly AS (SELECT strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m') AS month, count(*) AS row_count
                 FROM orders GROUP BY 1),
w AS (SELECT month, row_count,
             CAST(COALESCE(SUM(row_count) OVER (ORDER BY month DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS BIGINT) AS rows_before FROM monthly)
SELECT month, row_count, rows_before FROM w WHERE rows_before < 5000""",
    "new_arrivals": flagship_sql(),
    "new_arrivals_all_corners": all_corners_sql(),
    "new_arrivals_backfill": backfill_sql(),
    "catalogue_corner_job": catalogue_sql(),
    "jst_epoch_far": f"SELECT event_id, {local_epoch('ts + INTERVAL 100 YEAR')} AS epoch_local FROM events",
    "catalogue_all_corners": catalogue_sql(corners=True, select=", ".join(("site", "corner", *OUTPUT_COLUMNS))),
    "catalogue_backfill": catalogue_sql(BACKFILL_OLDEST, newest=FLAGSHIP_MONTH, corners=True),
    "catalogue_corner_job_text_ids": catalogue_sql(text_ids=True),
    "catalogue_repeated_headers": catalogue_sql(repeated=True),
    "catalogue_empty_bridge": catalogue_sql(),
    "export_roundtrip": catalogue_sql(corners=True, select=", ".join(
        (*OUTPUT_COLUMNS, "site", "corner", "target_date", "target_date || '_' || site || '_' || corner || '.csv' AS file"))),
    "export_audit": audit_sql(),
    "catalogue_backfill_until_target": catalogue_until_target_sql(),
    "run_month": """
WITH clock AS (SELECT strftime(max(ts) + INTERVAL 9 HOUR, '%Y-%m') AS month FROM events)
SELECT month, replace(month, '-', '') || '01' AS target_date, event_type, count(*) AS row_count
FROM events, clock WHERE strftime(ts + INTERVAL 9 HOUR, '%Y-%m') = month GROUP BY ALL""",
    "new_arrivals_backfill_until_target": backfill_until_target_sql(),
    "new_arrivals_topk": flagship_sql(top_k=FLAGSHIP_TOP_K),
}
