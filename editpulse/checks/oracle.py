"""DuckDB SQL for the registered queries, written independently from the same definitions."""

from __future__ import annotations

from editpulse.schemas import METRICS

FLAT = [f"{g}_{f}" for g, fields in METRICS.items() for f in fields]

CHANGESETS = """
cs AS (
  SELECT *, (xmin + xmax) / 2 AS lon, (ymin + ymax) / 2 AS lat,
    CASE WHEN xmin BETWEEN -180 AND 180 AND xmax BETWEEN -180 AND 180
          AND ymin BETWEEN -90 AND 90 AND ymax BETWEEN -90 AND 90
         THEN round(6371.01 * 2 * asin(sqrt(least(1.0,
           pow(sin(radians(ymax - ymin) / 2), 2)
           + cos(radians(ymin)) * cos(radians(ymax)) * pow(sin(radians(xmax - xmin) / 2), 2)))), 3)
    END AS diameter
  FROM (
    SELECT o_orderkey AS id, o_custkey AS uid, 'mapper-' || o_custkey AS username,
      o_orderdate AS created_at, o_orderdate + to_hours(o_orderkey % 24) AS closed_at,
      o_orderkey % 97 AS num_changes, o_orderkey % 11 > 1 AS tagged,
      CASE WHEN tagged THEN o_orderpriority END AS comment,
      CASE WHEN tagged AND o_orderkey % 3 > 0 THEN 'editor/' || (o_orderkey % 3) END AS created_by,
      CASE WHEN tagged AND o_orderkey % 7 = 0 THEN 'host-a' END AS host,
      CASE WHEN tagged AND o_orderkey % 4 = 0 THEN 'aerial' END AS imagery_used,
      CASE WHEN tagged AND o_orderkey % 6 = 0 THEN 'survey' END AS source,
      CASE WHEN tagged THEN CASE o_orderkey % 5 WHEN 1 THEN '#one' WHEN 2 THEN '#one;#two'
        WHEN 3 THEN '#one;' WHEN 4 THEN '#p' || (o_custkey % 10) || ';;#q' END END AS hashtag_text,
      CASE WHEN tagged AND o_orderkey % 2 = 0 THEN 'l' || (o_custkey % 3) END AS locale,
      CASE WHEN tagged AND o_orderkey % 8 = 0 THEN 'yes' END AS review,
      nullif((locale IS NOT NULL)::INT + (review IS NOT NULL)::INT, 0) AS n_tags,
      (o_custkey * 7919) % 46000 - 23000 + o_orderkey % 3 AS ux,
      CASE WHEN o_orderkey % 101 = 7 THEN 11600 ELSE (o_custkey * 104729) % 20000 - 10000 END AS uy,
      CASE WHEN o_orderkey % 13 > 0 THEN ux / 128.0::DOUBLE END AS xmin,
      CASE WHEN o_orderkey % 13 > 0 THEN (ux + 2 * (o_orderkey % 5)) / 128.0::DOUBLE END AS xmax,
      CASE WHEN o_orderkey % 13 > 0 THEN uy / 128.0::DOUBLE END AS ymin,
      CASE WHEN o_orderkey % 13 > 0 THEN (uy + 2 * (o_orderkey % 4)) / 128.0::DOUBLE END AS ymax
    FROM orders))"""

MEMBERS = """
ms AS (
  SELECT c_custkey AS uid, team::BIGINT AS chapter_id, n_name AS chapter,
    'University of ' || n_name AS university,
    CASE WHEN team % 7 <> 3 THEN 'City ' || team END AS city,
    'Country ' || (team % 5) AS country,
    CASE WHEN team % 6 <> 5 THEN 'POINT (' || (team * 5 - 60.5)::DOUBLE || ' ' || (20.25 - 2 * team)::DOUBLE || ')' END
      AS location, ds
  FROM (
    SELECT c_custkey, c_nationkey AS team, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25, c_mktsegment FROM customer WHERE c_custkey % 50 = 0
  ) JOIN nation ON team = n_nationkey
  JOIN (VALUES ('2001-08-05'), ('2001-07-29')) AS v(ds)
    ON ds = '2001-07-29' OR c_mktsegment <> 'BUILDING')"""

NEWEST = """
m AS (SELECT * FROM ms WHERE ds = (SELECT max(ds) FROM ms))"""

COUNTRIES = """
shp AS (
  SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS a3, n_name AS country, r_name AS continent,
    (n_nationkey + n_nationkey // 5) % 5 AS kind,
    -180 + 72 * (n_nationkey % 5) AS ox, -80 + 32 * (n_nationkey // 5) AS oy
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def contains(x: str, y: str) -> str:
    """Strict containment in the five outline kinds."""
    dx, dy = f"({x} - ox)", f"({y} - oy)"
    box = f"({dx} > 2 AND {dx} < 70 AND {dy} > 1 AND {dy} < 31)"
    return f"""CASE kind
      WHEN 0 THEN {box}
      WHEN 1 THEN {box} AND NOT ({dx} BETWEEN 20 AND 50 AND {dy} BETWEEN 8 AND 24)
      WHEN 2 THEN {box} AND NOT ({dx} >= 36 AND {dy} >= 16)
      WHEN 3 THEN {box} AND NOT ({dx} BETWEEN 30 AND 40)
      ELSE abs({dx} - 36) * 15 + abs({dy} - 16) * 50 < 750 END"""


KEPT = """
kept AS (
  SELECT cs.*, (SELECT max(ds) FROM ms) AS members_ds FROM cs
  WHERE created_at >= TIMESTAMP '1996-01-01' AND uid IN (SELECT uid FROM m))"""

HISTORY = """
hist AS (
  SELECT l_orderkey AS changeset, l_linenumber AS v, l_linestatus = 'O' AS vis,
    CASE l_returnflag WHEN 'N' THEN 'nodes' WHEN 'A' THEN 'ways' ELSE 'relations' END AS kind,
    l_partkey % 6 = 0 AS b, l_partkey % 12 = 0 OR l_partkey % 6 = 1 AS h, l_partkey % 6 = 2 AS a,
    l_partkey % 6 < 4 AS full_tags, l_partkey % 6 = 4 AS empty_tags
  FROM lineitem)"""


def _rollup() -> str:
    rules = {}
    for theme, flag in (("buildings", "b"), ("highways", "h"), ("amenities", "a")):
        rules[f"new_{theme}"] = f"{flag} AND v = 1"
        rules[f"edited_{theme}"] = f"{flag} AND v > 1"
    for kind in ("nodes", "ways", "relations"):
        rules[f"new_{kind}"] = f"kind = '{kind}' AND v = 1"
        rules[f"edited_{kind}"] = f"kind = '{kind}' AND v > 1"
        rules[f"deleted_{kind}"] = f"kind = '{kind}' AND NOT vis"
    rules["new_elements"] = "vis AND v = 1"
    rules["edited_elements"] = "vis AND v > 1"
    rules["deleted_elements"] = "NOT vis"
    rules["new_vertices"] = "vis AND v = 1 AND kind = 'nodes' AND empty_tags"
    rules["edited_vertices"] = "vis AND v > 1 AND kind = 'nodes' AND empty_tags"
    rules["new_features"] = "v = 1 AND full_tags"
    rules["edited_features"] = "vis AND v > 1 AND full_tags"
    counts = ",\n    ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in rules.items())
    return f"""
ru AS (
  SELECT changeset, {counts}
  FROM hist WHERE changeset IN (SELECT id FROM kept) GROUP BY changeset)"""


ROLLUP = _rollup()


def _struct_values() -> str:
    out = []
    for group, fields in METRICS.items():
        if group == "elements":
            values = {f: "num_changes" if f == "num_changes" else f"{f}_elements" for f in fields}
            present = "TRUE"
        elif group == "features":
            values = {f: f if f.endswith("vertices") else f"{f}_features" for f in fields}
            present = "TRUE"
        else:
            values = {f: f"{f}_{group}" for f in fields}
            present = " + ".join(values.values()) + " > 0"
        out += [f"CASE WHEN {present} THEN {v}::INT END AS {group}_{f}" for f, v in values.items()]
    return ",\n    ".join(out)


ENRICHED = f"""
lp AS (SELECT kept.*, ru.*, (SELECT strftime(max(created_at), '%Y-%m-%d') FROM kept) AS ds
       FROM kept JOIN ru ON id = changeset),
en AS (
  SELECT lp.*, {_struct_values()}, a3
  FROM lp LEFT JOIN shp ON {contains("lon", "lat")})"""


def cell(level: int, x: str = "lon", y: str = "lat") -> str:
    n = 1 << level

    def part(share: str) -> str:
        return f"least(greatest(floor({share} * {n}), 0), {n - 1})::BIGINT"

    return (
        f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN '{level}:' || "
        f"{part(f'({x} + 180) / 360')} || ':' || {part(f'({y} + 90) / 360')} END"
    )


EVENTS = f"""
ev AS (
  SELECT event_id AS id, user_id AS uid, ts AS created_at, event_type AS t,
    (props::JSON ->> '$.k')::INT AS k,
    ((user_id * 7919) % 46000 - 23000 + k % 3) / 128.0::DOUBLE AS xmin,
    ((user_id * 7919) % 46000 - 23000 + k % 3 + k % 2) / 128.0::DOUBLE AS xmax,
    ((user_id * 104729) % 20000 - 10000) / 128.0::DOUBLE AS ymin, ymin AS ymax,
    CASE WHEN k % 10 <> 9 THEN (xmin + xmax) / 2 END AS lon, CASE WHEN k % 10 <> 9 THEN ymin END AS lat,
    'N' || lpad((event_id % 28)::VARCHAR, 2, '0') AS a3,
    CASE WHEN t = 'click' THEN k % 5 END AS buildings_new, CASE WHEN t = 'click' THEN k % 3 END AS buildings_edited,
    CASE WHEN t = 'view' THEN k % 4 END AS highways_new, CASE WHEN t = 'view' THEN k % 6 END AS highways_edited,
    CASE WHEN t = 'purchase' THEN k % 3 END AS amenities_new,
    CASE WHEN t = 'purchase' THEN k % 2 END AS amenities_edited,
    k % 7 AS elements_new, k % 5 AS elements_edited, k % 2 AS elements_deleted, k AS elements_num_changes,
    k % 6 AS features_new, k % 5 AS features_edited, k % 9 AS features_new_vertices,
    k % 8 AS features_edited_vertices,
    {", ".join(
        f"CASE WHEN t = '{t}' THEN k % {n} END AS {g}_{f}"
        for g, t in (("nodes", "click"), ("ways", "view"), ("relations", "error"))
        for f, n in (("new", 3), ("edited", 4), ("deleted", 2))
    )}
  FROM events)"""


def _activity(source: str) -> str:
    return f"""
act AS (
  SELECT c.id, c.uid, c.created_at, {cell(16, "c.lon", "c.lat")} AS h3, c.xmin, c.ymin, c.xmax, c.ymax,
    c.lon, c.lat, c.a3, {", ".join("c." + f for f in FLAT)},
    m.chapter_id, m.chapter, m.university, m.country AS chapter_country, m.city AS chapter_city,
    m.location AS chapter_location, shp.country, shp.continent
  FROM {source} c JOIN m ON c.uid = m.uid LEFT JOIN shp ON c.a3 = shp.a3)"""


BASE = [MEMBERS, NEWEST, COUNTRIES]
ORDERS_ACTIVITY = [CHANGESETS, *BASE, KEPT, HISTORY, ROLLUP, ENRICHED, _activity("en")]
EVENTS_ACTIVITY = [*BASE, EVENTS, _activity("ev")]

DAILY = f"""
rows_d AS (SELECT * REPLACE (created_at::DATE AS created_at) FROM act WHERE lon IS NOT NULL AND lat IS NOT NULL),
day AS (
  SELECT h3, uid, created_at, min(chapter_id) AS chapter_id,
    {", ".join(f"coalesce(sum({f}), 0)::INT AS {f}" for f in FLAT)},
    min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, count(*) AS n_boxes
  FROM rows_d GROUP BY 1, 2, 3),
cen AS (
  SELECT h3, uid, created_at, sum(lon) / count(*) AS lon, sum(lat) / count(*) AS lat, count(*) AS n_points
  FROM (SELECT DISTINCT h3, uid, created_at, lon, lat FROM rows_d) GROUP BY 1, 2, 3),
daily AS (SELECT * FROM day JOIN cen USING (h3, uid, created_at))"""

DAILY_COLUMNS = (
    f"h3, uid, created_at, chapter_id, {', '.join(FLAT)}, xmin, ymin, xmax, ymax, lon, lat, n_points, n_boxes"
)

WEEKLY = """SELECT chapter_id, date_trunc('week', created_at)::TIMESTAMP AS week,
  sum(features_new + features_edited)::INT AS all_feats,
  sum(buildings_new + buildings_edited)::INT AS buildings,
  sum(highways_new + highways_edited)::INT AS highways,
  sum(amenities_new + amenities_edited)::INT AS amenities,
  sum(features_new + features_edited - buildings_new - buildings_edited - highways_new - highways_edited
      - amenities_new - amenities_edited)::INT AS other,
  count(DISTINCT uid) AS mappers
FROM daily GROUP BY 1, 2"""

MONTH = "(date_trunc('month', created_at) + INTERVAL 14 DAY)::TIMESTAMP"

MONTHLY = f"""SELECT {MONTH} AS month,
  {", ".join(
      f"sum({t}_{k})::BIGINT AS {k}_{t}"
      for k in ("new", "edited") for t in ("buildings", "highways", "amenities")
  )},
  count(DISTINCT chapter_id) AS chapters, count(DISTINCT uid) AS users
FROM daily WHERE created_at < DATE '2001-07-01' GROUP BY 1"""

MONTHLY_NAMES = [
    *(f"{k}_{t}" for k in ("new", "edited") for t in ("buildings", "highways", "amenities")), "chapters", "users",
]


def _country_months(start: str) -> str:
    return f"""SELECT country, {MONTH} AS month, sum(features_new + features_edited)::BIGINT AS all_feats
FROM act WHERE created_at > TIMESTAMP '{start}' AND country IS NOT NULL GROUP BY 1, 2"""


TOP = f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY all_feats DESC, country)::INT AS rank
  FROM ({_country_months("2001-04-01")})) WHERE rank <= 15"""

CHAPTERS = """SELECT DISTINCT chapter, chapter_id, chapter_city AS city, chapter_country AS country, university
FROM act"""

POINT_COLUMNS = """h3, (epoch(created_at))::INT AS timestamp, chapter_id,
  (features_new + features_edited)::INT AS all_feats, (buildings_new + buildings_edited)::INT AS buildings,
  (highways_new + highways_edited)::INT AS highways, (amenities_new + amenities_edited)::INT AS amenities"""


COARSE = """SELECT a.timestamp, a.h3, a.chapter_id, a.all_feats, c.lon, c.lat FROM (
  SELECT timestamp, h3, uid, min(chapter_id) AS chapter_id, sum(f)::INT AS all_feats FROM cw GROUP BY 1, 2, 3) a
JOIN (SELECT timestamp, h3, uid, sum(lon) / count(lon) AS lon, sum(lat) / count(lat) AS lat
      FROM (SELECT DISTINCT timestamp, h3, uid, lon, lat FROM cw) GROUP BY 1, 2, 3) c
ON a.timestamp = c.timestamp AND a.uid = c.uid AND a.h3 IS NOT DISTINCT FROM c.h3"""


def _coarse_rows(level: int) -> str:
    return f"""
cw AS (
  SELECT epoch(date_trunc('week', created_at))::INT AS timestamp, {cell(level)} AS h3, uid, chapter_id,
    features_new + features_edited AS f, lon, lat
  FROM act WHERE country IS NOT NULL)"""


def tile(lon: str, lat: str, zoom: int) -> tuple[str, str]:
    n = 1 << zoom
    clipped = f"radians(least(greatest({lat}, -85.06), 85.06))"
    y = f"(1 - ln(tan({clipped}) + 1 / cos({clipped})) / pi()) / 2"
    return tuple(
        f"least(greatest(floor({share} * {n}), 0), {n - 1})::INT" for share in (f"({lon} + 180) / 360", y)
    )


def _tile_boxes() -> str:
    x1, y1 = tile("xmin", "ymax", 6)
    x2, y2 = tile("xmax", "ymin", 6)
    return f"""SELECT 6 AS z, x, unnest(generate_series(y1, y2))::INT AS y, 'daily' AS layer,
  timestamp, chapter_id, all_feats, buildings, highways, amenities, xmin, ymin, xmax, ymax
FROM (SELECT *, unnest(generate_series(x1, x2))::INT AS x FROM (
  SELECT {POINT_COLUMNS}, xmin, ymin, xmax, ymax, {x1} AS x1, {x2} AS x2, {y1} AS y1, {y2} AS y2 FROM daily))"""


def _tile_points(source: str, columns: str, zoom: int, layer: str) -> str:
    x, y = tile("lon", "lat", zoom)
    return f"""SELECT {zoom} AS z, {x} AS x, {y} AS y, '{layer}' AS layer, {columns}, lon, lat FROM ({source})
WHERE lon IS NOT NULL"""


def _json_text(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


def _lines(elements: str, order: str, head: str, tail: str) -> str:
    return f"""SELECT '{head}' AS value
UNION ALL SELECT CASE WHEN row_number() OVER (ORDER BY {order}) = 1 THEN '' ELSE ',' END || json AS value
  FROM ({elements})
UNION ALL SELECT '{tail}' AS value"""


MONTHLY_JSON = _lines(
    "SELECT month, '{\"month\":' || epoch_ms(month) || "
    + " || ".join(f"',\"{n}\":' || {n}" for n in MONTHLY_NAMES)
    + f" || '}}' AS json FROM ({MONTHLY})",
    "month", "[", "]",
)

CHAPTERS_JSON = _lines(
    "SELECT chapter, chapter_id, '{\"chapter\":' || " + _json_text("chapter")
    + " || ',\"chapter_id\":' || chapter_id || ',\"city\":' || " + _json_text("city")
    + " || ',\"country\":' || " + _json_text("country") + " || ',\"university\":' || "
    + _json_text("university") + f" || '}}' AS json FROM ({CHAPTERS})",
    "chapter, chapter_id", '{"chapters":[', '],"ds":"2024-01-30"}',
)

TOP_JSON = _lines(
    "SELECT month, '{\"month\":\"' || strftime(month, '%Y-%m-%dT%H:%M:%S') || '\",\"top_countries\":[' || "
    "string_agg('[\"' || country || '\",' || all_feats || ']', ',' ORDER BY rank) || ']}' AS json "
    f"FROM ({TOP}) GROUP BY month",
    "month", "[", "]",
)

FEATURE_HEAD = (
    "'{\"type\":\"Feature\",\"properties\":{\"h3\":\"' || h3 || '\",\"timestamp\":' || timestamp "
    "|| ',\"chapter_id\":' || chapter_id || ',\"all_feats\":' || all_feats || ',\"buildings\":' || buildings "
    "|| ',\"highways\":' || highways || ',\"amenities\":' || amenities || '},\"geometry\":{\"type\":'"
)

PUBLIC = f"""SELECT d.h3, d.created_at, {", ".join("d." + f for f in FLAT)}, d.n_boxes::INT AS n_bboxes,
  m.chapter_id, m.chapter, m.country AS chapter_country, m.city AS chapter_city, m.location AS chapter_location,
  s.a3, s.country, s.country AS country_name, s.continent, d.lon, d.lat
FROM daily d JOIN m ON d.uid = m.uid LEFT JOIN shp s ON {contains("d.lon", "d.lat")}"""


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _pair(x: str, y: str) -> str:
    return f"'[' || {x} || ',' || {y} || ']'"


_H3 = (
    "((1::BIGINT << 59) + (8::BIGINT << 52) + (1::BIGINT << 51) + (1 << 21) - 1 "
    "+ ((l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 1073741824) * 2097152)"
)


def _h3_parent(r: int) -> str:
    unused = 1 << (3 * (15 - r))
    # drop the resolution field, blank the finer digits arithmetically, put the new resolution in
    return (
        f"printf('%x', (((1::BIGINT << 59) + ({r}::BIGINT << 52)) "
        f"+ ((({_H3} % (1::BIGINT << 52)) // {unused}) * {unused}) + {unused - 1})::BIGINT)"
    )


ORACLE: dict[str, str] = {
    "tag_extract": _with([CHANGESETS], "SELECT id, comment, created_by, host, imagery_used, source FROM cs"),
    "hashtag_split": _with(
        [CHANGESETS],
        "SELECT id, (length(hashtag_text) - length(replace(hashtag_text, ';', '')) + 1)::INT AS n_hashtags, "
        "replace(hashtag_text, ';', '|') AS hashtags FROM cs",
    ),
    "tags_residual": _with([CHANGESETS], "SELECT id, n_tags, locale, review FROM cs"),
    "bbox_diameter": _with([CHANGESETS], "SELECT id, diameter FROM cs"),
    "bbox_midpoint": _with([CHANGESETS], "SELECT id, xmin, ymin, xmax, ymax, lon, lat FROM cs"),
    "cell_assign": _with(
        [CHANGESETS],
        f"SELECT id, {cell(16)} AS cell_8, {cell(13)} AS cell_6, {cell(10)} AS cell_4 FROM cs",
    ),
    "cell_parent": _with([CHANGESETS], f"SELECT id, {cell(13)} AS cell_6, {cell(10)} AS cell_4 FROM cs"),
    "h3_cell_parent": f"SELECT l_orderkey, l_partkey, l_linenumber, printf('%x', ({_H3})::BIGINT) AS h3, "
    f"{_h3_parent(6)} AS parent_6, {_h3_parent(4)} AS parent_4 FROM lineitem",
    "latest_partition": _with(
        [MEMBERS, NEWEST], "SELECT uid, chapter_id, chapter, city, country, ds FROM m"
    ),
    "as_of_members": _with([MEMBERS], "SELECT uid, chapter_id, ds FROM ms WHERE ds = '2001-07-29'"),
    "one_chapter_per_member": _with(
        [MEMBERS, NEWEST],
        "SELECT uid, min(chapter_id) AS chapter_id, arg_min(chapter, chapter_id) AS chapter FROM m GROUP BY uid",
    ),
    "member_semi_join": _with(
        [CHANGESETS, MEMBERS, NEWEST, KEPT], "SELECT id, uid, created_at, members_ds FROM kept"
    ),
    "changeset_rollup": _with([CHANGESETS, MEMBERS, NEWEST, KEPT, HISTORY, ROLLUP], "SELECT * FROM ru"),
    "changeset_rollup_shuffled": _with(
        [CHANGESETS, MEMBERS, NEWEST, KEPT, HISTORY, ROLLUP], "SELECT * FROM ru"
    ),
    "changeset_rollup_bitmap": _with(
        [CHANGESETS, MEMBERS, NEWEST, KEPT, HISTORY, ROLLUP], "SELECT * FROM ru"
    ),
    "conditional_struct_flat": _with(
        ORDERS_ACTIVITY[:-1],
        "SELECT DISTINCT id, "
        + ", ".join(f"{g}_new IS NULL AS no_{g}" for g in METRICS)
        + f", {', '.join(FLAT)} FROM en",
    ),
    "point_in_polygon_join": _with(
        [CHANGESETS, COUNTRIES], f"SELECT id, lon, lat, a3 FROM cs LEFT JOIN shp ON {contains('lon', 'lat')}"
    ),
    "enriched_changesets": _with(
        ORDERS_ACTIVITY[:-1],
        "SELECT id, uid, username, created_at, closed_at, comment, created_by, imagery_used, host, source, "
        f"replace(hashtag_text, ';', '|') AS hashtags, n_tags, {', '.join(FLAT)}, diameter, lon, lat, a3, "
        "members_ds, ds FROM en",
    ),
    "activity_table": _with(
        ORDERS_ACTIVITY,
        "SELECT id, uid, h3, created_at, a3, chapter_id, chapter, university, chapter_country, chapter_city, "
        "chapter_location, country, continent, features_new FROM act",
    ),
    "daily_cells": _with([*ORDERS_ACTIVITY, DAILY], f"SELECT {DAILY_COLUMNS} FROM daily"),
    "daily_cells_events": _with([*EVENTS_ACTIVITY, DAILY], f"SELECT {DAILY_COLUMNS} FROM daily"),
    "daily_point_union": _with(
        [*EVENTS_ACTIVITY, DAILY], "SELECT DISTINCT h3, uid, created_at, lon, lat FROM rows_d"
    ),
    "daily_bboxes": _with(
        [*EVENTS_ACTIVITY, DAILY],
        "SELECT h3, uid, created_at, d.n_boxes, r.xmin, r.ymin, r.xmax, r.ymax "
        "FROM rows_d r JOIN daily d USING (h3, uid, created_at)",
    ),
    "daily_box_rows": _with(
        [*EVENTS_ACTIVITY, DAILY],
        """SELECT sha256('check{"h3":"' || h3 || '","uid":' || uid || ',"created_at":"' || created_at || '"}') AS row_key, """
        "xmin, ymin, xmax, ymax FROM rows_d",
    ),
    "weekly_chapters": _with([*ORDERS_ACTIVITY, DAILY], WEEKLY),
    "weekly_chapters_events": _with([*EVENTS_ACTIVITY, DAILY], WEEKLY),
    "monthly_activity": _with([*ORDERS_ACTIVITY, DAILY], MONTHLY),
    "monthly_document": _with([*ORDERS_ACTIVITY, DAILY], MONTHLY_JSON),
    "country_months": _with(ORDERS_ACTIVITY, _country_months("2001-04-01")),
    "country_months_events": _with(EVENTS_ACTIVITY, _country_months("2023-11-01")),
    "top15_countries": _with(ORDERS_ACTIVITY, TOP),
    "top_countries_document": _with(ORDERS_ACTIVITY, TOP_JSON),
    "chapter_index": _with(EVENTS_ACTIVITY, CHAPTERS),
    "chapters_document": _with(EVENTS_ACTIVITY, CHAPTERS_JSON),
    "coarse_cells_6": _with([*ORDERS_ACTIVITY, _coarse_rows(13)], COARSE),
    "coarse_cells_4": _with([*ORDERS_ACTIVITY, _coarse_rows(10)], COARSE),
    "coarse_cells_6_events": _with([*EVENTS_ACTIVITY, _coarse_rows(13)], COARSE),
    "daily_points": _with([*ORDERS_ACTIVITY, DAILY], f"SELECT {POINT_COLUMNS}, lon, lat FROM daily"),
    "daily_boxes": _with(
        [*ORDERS_ACTIVITY, DAILY], f"SELECT {POINT_COLUMNS}, xmin, ymin, xmax, ymax FROM daily"
    ),
    "geojson_points": _with(
        [*EVENTS_ACTIVITY, DAILY],
        f"SELECT {FEATURE_HEAD} || '\"Point\",\"coordinates\":' || {_pair('lon', 'lat')} || '}}}}' AS value "
        f"FROM (SELECT {POINT_COLUMNS}, lon, lat FROM daily)",
    ),
    "geojson_boxes": _with(
        [*ORDERS_ACTIVITY, DAILY],
        f"SELECT {FEATURE_HEAD} || '\"Polygon\",\"coordinates\":[[' || "
        + " || ',' || ".join(
            _pair(x, y)
            for x, y in (("xmin", "ymin"), ("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"), ("xmin", "ymin"))
        )
        + " || ']]}}' AS value "
        f"FROM (SELECT {POINT_COLUMNS}, xmin, ymin, xmax, ymax FROM daily)",
    ),
    "tile_points": _with(
        [*ORDERS_ACTIVITY, DAILY],
        _tile_points(
            f"SELECT {POINT_COLUMNS}, lon, lat FROM daily",
            "timestamp, chapter_id, all_feats, buildings, highways, amenities", 6, "daily",
        ),
    ),
    "tile_boxes": _with([*ORDERS_ACTIVITY, DAILY], _tile_boxes()),
    "tile_coarse": _with(
        [*EVENTS_ACTIVITY, _coarse_rows(13)],
        _tile_points(COARSE,
                     "timestamp, chapter_id, all_feats", 4, "r6agg"),
    ),
    "public_rollup": _with([*EVENTS_ACTIVITY, DAILY], PUBLIC),
    "public_rollup_boxes": _with(
        [*EVENTS_ACTIVITY, DAILY],
        f"SELECT p.h3, p.created_at, p.chapter_id, p.a3, r.xmin, r.ymin, r.xmax, r.ymax "
        f"FROM ({PUBLIC.replace('SELECT d.h3', 'SELECT d.uid, d.h3', 1)}) p JOIN rows_d r USING (h3, uid, created_at)",
    ),
}
