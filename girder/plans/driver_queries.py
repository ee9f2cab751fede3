"""The registered queries over the star-schema tables, flattened, and the same results in SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.functions import params as P
from girder.functions.geometry import probes
from girder.operators.spatial import elements_in_boxes, rooms_at
from girder.plans.args import QueryError
from girder.plans.registry import run
from girder.queries.sheets import visible_elements_of_all
from girder.sources.driver_tables import BOXES, SESSION, building, linked, named, odd


def _totals(spark: SparkSession, envelope: dict) -> DataFrame:
    return spark.createDataFrame([(envelope["total"], envelope["count"], envelope["truncated"])], "total long, count long, truncated boolean")


def get_levels(spark, sf_dir):
    return run(building(spark, sf_dir), SESSION, "get_levels").df


def get_rooms_page(spark, sf_dir):
    return run(building(spark, sf_dir), SESSION, "get_rooms").df.select("id", "unique_id", "number", "name", "area_sf", F.col("level.name").alias("level_name"),
        "level.elevation_ft")


def get_rooms_total(spark, sf_dir):
    return _totals(spark, run(building(spark, sf_dir), SESSION, "get_rooms", {"limit": "1000"}).envelope)


def get_rooms_unplaced(spark, sf_dir):
    return _totals(spark, run(building(spark, sf_dir), SESSION, "get_rooms", {"include_unplaced": True, "limit": 50}).envelope)


def get_rooms_fields(spark, sf_dir):
    """The rows of the JSON answer with id and the fields asked for; unknown ones are left out."""
    rows = run(building(spark, sf_dir), SESSION, "get_rooms", {"limit": 300, "fields": ["name", "number", "none"]}).to_dict()["rooms"]
    return spark.createDataFrame([(json.dumps(r, separators=(",", ":")),) for r in rows], "room string")


def get_rooms_without_area(spark, sf_dir):
    """Rooms of area 0, or NaN, aren't placed."""
    return run(odd(spark, sf_dir), SESSION, "get_rooms", {"limit": 1000}).df.select("id", "number", "area_sf")


def get_views_page(spark, sf_dir):
    return run(building(spark, sf_dir), SESSION, "get_views", {"view_type": "economy"}).df.select("id", "unique_id", "name", "view_type",
        F.col("level.name").alias("level_name"))


def get_views_total(spark, sf_dir):
    return _totals(spark, run(building(spark, sf_dir), SESSION, "get_views", {"limit": 1000}).envelope)


def get_links(spark, sf_dir):
    return run(building(spark, sf_dir), SESSION, "get_links").df


def model_revision(spark, sf_dir):
    return run(building(spark, sf_dir), SESSION, "get_model_revision").df


def project_info(spark, sf_dir):
    """Of a linked document with project information but without a name of its own, as if it were open."""
    from dataclasses import replace

    return run(building(spark, sf_dir), replace(SESSION, doc_id=1), "get_project_info").df


def _box(spark, sf_dir, **args):
    return run(building(spark, sf_dir), SESSION, "filter_elements_by_scope_box", args)


def scope_box_centroid(spark, sf_dir):
    found = _box(spark, sf_dir, scope_box_name="zone a", category="1-URGENT")
    return found.df.select("id", "name", "category", "in_box", F.col("design_option.is_primary").alias("is_primary"), F.col("level.name").alias("level_name"),
        "from_link", "project")


def scope_box_counts(spark, sf_dir):
    e = _box(spark, sf_dir, scope_box_id=1, category="1-URGENT", limit=500).envelope
    return spark.createDataFrame([(e["scope_box"]["id"], e["mode"], e["count_in"], e["count_out"])], "box long, mode string, count_in long, count_out long")


def scope_box_intersects(spark, sf_dir):
    return _box(spark, sf_dir, scope_box_id="1", category="2-HIGH", mode="Intersects", limit=2000).df.select("id", "in_box")


def scope_box_rotated_inside(spark, sf_dir):
    return _box(spark, sf_dir, scope_box_id=2, category="1-URGENT", inside_only=True, limit=10_000).df.select("id", "name")


def scope_box_ids(spark, sf_dir):
    return _box(spark, sf_dir, scope_box_id=1, element_ids=[5, 2, 5, 99_999_999, 40], mode="other").df.select("id", "in_box")


def scope_box_selection(spark, sf_dir):
    return _box(spark, sf_dir, scope_box_id=1).df.select("id", "in_box")


def scope_box_view(spark, sf_dir):
    return _box(spark, sf_dir, scope_box_id=1, category="3-MEDIUM", view_id=5).df.select("id", "in_box")


#: Arguments of a scope box query that fails.
FAILING = [{"scope_box_id": 7, "category": "none"}, {"scope_box_id": 987_654_321, "scope_box_name": "zone a"}, {"scope_box_name": "zone z"},
    {"scope_box_id": 1, "category": "none"}]


def scope_box_errors(spark, sf_dir):
    """Which of several faults is told."""
    model = building(spark, sf_dir)
    told = []
    for k, args in enumerate(FAILING):
        try:
            run(model, SESSION, "filter_elements_by_scope_box", args)
        except QueryError as e:
            told.append((k, str(e)))
    return spark.createDataFrame(told, "k int, message string")


def scope_box_members(spark, sf_dir):
    """All elements against all boxes."""
    boxes = [{"doc_id": b[0], "id": b[1], "min": b[3], "max": b[4], "inverse": b[5]} for b in BOXES]
    return elements_in_boxes(building(spark, sf_dir).elements, boxes).select("id", "box_id")


def element_by_uniqueid(spark, sf_dir):
    found = run(linked(spark, sf_dir), SESSION, "get_element_by_uniqueid", {"unique_id": "17", "unique_ids": ["nope", "3", "", 5, "17"]})
    return found.df.select("unique_id", "found", "id", "name", "category", "source", "sourceLocalId", "projectKey", "from_link", "link_instance_id", "link_title")


def element_by_ifcguid(spark, sf_dir):
    found = run(named(spark, sf_dir), SESSION, "get_element_by_ifcguid", {"ifc_guids": ["SMALL RING", "zzz", "red Widget"]})
    return found.df.select("ifc_guid", "found", "id", "unique_id", "name", "category", "type_id", "type_name", "projectKey")


def element_classification(spark, sf_dir):
    model = building(spark, sf_dir)
    types = model.element_types.select(F.col("type_id").alias("__type"), F.col("params").alias("type_params"))
    full = model.elements.select("id", "type_id", "params").join(types, F.col("type_id") == F.col("__type"), "left")
    return full.select("id", P.classification(F.col("type_params"), F.col("params"))["assembly_code"].alias("assembly_code"))


def element_params(spark, sf_dir):
    model = building(spark, sf_dir)
    types = model.element_types.select(F.col("type_id").alias("__type"), F.col("params").alias("type_params"))
    full = model.elements.select("id", "type_id", "params").join(types, F.col("type_id") == F.col("__type"), "left")
    return full.select("id", *[P.instance_or_type(n, F.col("params"), F.col("type_params")).alias(n) for n in ("width", "note")])


def sheet_views(spark, sf_dir):
    found = run(building(spark, sf_dir), SESSION, "get_sheets")
    return found.df.select("sheet_number", "current_revision", F.explode_outer("views").alias("v")).select("sheet_number", "current_revision",
        F.col("v.view.unique_id").alias("view_uid"), F.col("v.view.name").alias("view_name"), F.col("v.view.view_type").alias("view_type"))


def sheet_views_unresolved(spark, sf_dir):
    """Viewports that resolve to no view are left out."""
    found = run(odd(spark, sf_dir), SESSION, "get_sheets", {"limit": 500})
    return found.df.select("sheet_number", F.coalesce(F.size("views"), F.lit(0)).alias("n_views"))


def sheet_view_elements(spark, sf_dir):
    found = run(building(spark, sf_dir), SESSION, "get_sheets", {"sheet_number": "SUPPLIER#000000003", "include_elements": True, "element_limit": 5})
    each = found.df.select(F.explode("views").alias("v")).select("v.view.*")
    return each.select(F.col("unique_id").alias("view_uid"), "elements_truncated", F.explode_outer("elements").alias("e")).select("view_uid", "elements_truncated",
        F.col("e.unique_id").alias("unique_id"), F.col("e.ifc_guid").alias("ifc_guid"), F.col("e.classification.assembly_code").alias("assembly_code"))


def view_elements_capped(spark, sf_dir):
    """The first three elements of every view."""
    return visible_elements_of_all(building(spark, sf_dir), 0, 3).select("view_id", "rn", "unique_id")


def door_rooms(spark, sf_dir):
    found = run(building(spark, sf_dir), SESSION, "get_door_rooms", {"category": "2-HIGH", "door_params": ["width", "note", "none"], "room_params": ["use"]})
    side = lambda s: (F.col(f"{s}_room.id").alias(f"{s}_id"), F.col(f"{s}_room.number").alias(f"{s}_number"), F.col(f"{s}_room.level_name").alias(f"{s}_level"),
        F.try_element_at(f"{s}_room.params", F.lit("use")).alias(f"{s}_use"))
    return found.df.select("id", "type_name", "mark", "host_id", F.try_element_at("values", F.lit("width")).alias("width"),
        F.try_element_at("values", F.lit("note")).alias("note"), *side("from"), *side("to"), "resolution")


def door_rooms_no_stored(spark, sf_dir):
    """In a phase without stored rooms, so that all are found by where they are."""
    found = run(building(spark, sf_dir), SESSION, "get_door_rooms", {"category": "3-MEDIUM", "phase": "existing", "limit": 2000})
    return found.df.select("id", F.col("from_room.id").alias("from_id"), F.col("to_room.id").alias("to_id"), "resolution")


def rooms_at_points(spark, sf_dir):
    """The geometric lookup of all elements."""
    model = building(spark, sf_dir)
    facing = model.openings.select("element_id", "facing", "host_wall_width")
    both = model.elements.select("doc_id", "id", "location").where("location IS NOT NULL").join(facing, F.col("id") == F.col("element_id"))
    at = probes(F.col("location"), F.col("facing"), F.col("host_wall_width"))[0]
    return rooms_at(both.select("doc_id", F.col("id").alias("key"), at.alias("p")).select("doc_id", "key", "p.*"), model.rooms)


def rooms_at_slanted(spark, sf_dir):
    """The geometric lookup in footprints that aren't along the axes; half of the openings face nowhere."""
    model = odd(spark, sf_dir)
    facing = model.openings.select("element_id", "facing", "host_wall_width")
    both = model.elements.select("doc_id", "id", "location").where("location IS NOT NULL").join(facing, F.col("id") == F.col("element_id"))
    at = probes(F.col("location"), F.col("facing"), F.col("host_wall_width"))[1]
    return rooms_at(both.select("doc_id", F.col("id").alias("key"), at.alias("p")).select("doc_id", "key", "p.*"), model.rooms)


NAMES = """get_levels get_rooms_page get_rooms_total get_rooms_unplaced get_rooms_fields get_rooms_without_area get_views_page get_views_total get_links model_revision project_info scope_box_centroid scope_box_counts scope_box_intersects
scope_box_rotated_inside scope_box_ids scope_box_selection scope_box_view scope_box_members scope_box_errors element_by_uniqueid element_by_ifcguid element_classification element_params sheet_views sheet_views_unresolved sheet_view_elements
view_elements_capped door_rooms door_rooms_no_stored rooms_at_points rooms_at_slanted""".split()
QUERIES = {name: globals()[name] for name in NAMES}

_EL = """el AS (SELECT o_orderkey AS id, o_custkey, o_orderpriority AS category, o_totalprice / 1000 AS x, (o_custkey % 1000) / 10 AS y,
  (o_orderkey % 100) / 10 AS z, o_orderkey % 4 <> 1 AS has_loc, o_orderkey % 5 <> 0 AS has_box,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 40 WHEN o_orderkey % 30 < 25 THEN o_orderkey % 30 END AS level_id FROM orders)"""
_IN_A = "x BETWEEN 100 AND 300 AND y BETWEEN 10 AND 60 AND z BETWEEN 1 AND 8"
#: The middle of the box around (x, y, z), rounded as the query rounds it.
_MID = """mid AS (SELECT el.* REPLACE (CASE WHEN has_loc THEN x ELSE ((x - 3) + (x + 3)) * 0.5e0 END AS x,
  CASE WHEN has_loc THEN y ELSE ((y - 3) + (y + 3)) * 0.5e0 END AS y,
  CASE WHEN has_loc THEN z ELSE ((z - 1) + (z + 1)) * 0.5e0 END AS z) FROM el)"""
_TYPES = """ty AS (SELECT l_orderkey, min(l_partkey) AS type_id FROM lineitem GROUP BY 1), t AS (SELECT l_orderkey, p.* FROM ty
  JOIN part p ON p_partkey = type_id)"""
_HIT = f"((has_loc OR has_box) AND {_IN_A})"
_CORNERS = " OR ".join(f"(x {i} 3 BETWEEN 100 AND 300 AND y {j} 3 BETWEEN 10 AND 60 AND z {k} 1 BETWEEN 1 AND 8)" for i in "-+" for j in "-+" for k in "-+")
_ROTATED = "0.6e0 * x + 0.8e0 * y + 0e0 * z + (-160e0) BETWEEN -60 AND 60 AND -0.8e0 * x + 0.6e0 * y + 0e0 * z + 130e0 BETWEEN -60 AND 60 AND z BETWEEN 1 AND 8"
_DOORS = """q AS (SELECT o_orderkey AS id, o_custkey, o_orderstatus AS st, CASE WHEN o_orderkey % 4 <> 1 THEN o_totalprice / 1000 END AS x,
  CASE WHEN o_orderkey % 4 <> 1 THEN (o_custkey % 1000) / 10 END AS y,
  CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS nx, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS ny,
  CASE WHEN o_orderkey % 4 = 0 THEN 5.0e0 ELSE 1.0e0 END AS off
  FROM orders WHERE o_orderkey % 7 <> 3 AND o_orderpriority = '{category}' ORDER BY o_orderkey LIMIT {limit}),
g AS (SELECT q.*, (SELECT c_custkey FROM customer
  WHERE c_custkey < 50 AND c_custkey = floor((x + nx * off) / 10) AND y + ny * off >= 0 AND y + ny * off < 100) AS gf,
  (SELECT c_custkey FROM customer WHERE c_custkey < 50 AND c_custkey = floor((x - nx * off) / 10) AND y - ny * off >= 0 AND y - ny * off < 100) AS gt FROM q)"""
_KEY = "CASE r_regionkey WHEN 1 THEN 'revit:info-1' WHEN 2 THEN 'revit:info-2' WHEN 3 THEN r_name ELSE substr(sha256('/models/' || lower(r_name)), 1, 16) END"

ORACLE_SQL = {
    "get_levels": """SELECT 'n-' || n_nationkey AS unique_id, n_nationkey::BIGINT AS id, n_name AS name, n_regionkey * 3.0e0 AS elevation_ft,
  (n_regionkey * 3) || ' ft' AS elevation_user_units
  FROM nation""",
    "get_rooms_page": """SELECT c_custkey AS id, 'r-' || c_custkey AS unique_id, c_name AS number, c_mktsegment AS name, c_acctbal AS area_sf, n_name AS level_name,
  n_regionkey * 3.0e0 AS elevation_ft
  FROM (SELECT * FROM customer WHERE c_acctbal > 0 ORDER BY c_name, c_custkey LIMIT 200) LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "get_rooms_total": """SELECT count(*)::BIGINT AS total, least(count(*), 1000)::BIGINT AS count, count(*) > 1000 AS truncated FROM customer WHERE c_acctbal > 0""",
    "get_rooms_unplaced": "SELECT count(*)::BIGINT AS total, least(count(*), 50)::BIGINT AS count, count(*) > 50 AS truncated FROM customer",
    "get_rooms_fields": """SELECT json_object('id', c_custkey, 'number', c_name, 'name', c_mktsegment)::VARCHAR AS room FROM (SELECT * FROM customer WHERE c_acctbal > 0
  ORDER BY c_name, c_custkey LIMIT 300)""",
    "get_rooms_without_area": """SELECT c_custkey AS id, c_name AS number, c_acctbal AS area_sf FROM customer WHERE c_acctbal > 0 AND c_custkey % 5 > 1
  ORDER BY c_name, c_custkey LIMIT 1000""",
    "get_views_page": """SELECT p_partkey AS id, 'v-' || p_partkey AS unique_id, p_name AS name, p_type AS view_type, n_name AS level_name FROM (SELECT * FROM part
  WHERE lower(p_type) = 'economy' AND p_size NOT IN (49, 50) ORDER BY p_type, p_name, p_partkey LIMIT 200) LEFT
  JOIN nation ON n_nationkey = p_size % 30""",
    "get_views_total": """SELECT count(*)::BIGINT AS total, least(count(*), 1000)::BIGINT AS count, count(*) > 1000 AS truncated FROM part WHERE p_size NOT IN (49, 50)""",
    "get_links": f"""SELECT 'l-' || r_regionkey AS unique_id, r_regionkey::BIGINT AS id, r_name AS name, r_regionkey <> 4 AS loaded,
  CASE WHEN r_regionkey <> 4 THEN r_name END AS title, CASE WHEN r_regionkey <> 4 THEN {_KEY} END AS project_key
  FROM region WHERE r_regionkey <> 0""",
    "model_revision": """SELECT r_name AS title, '/models/' || lower(r_name) AS path, md5(strftime(last, '%Y-%m-%d %H:%M:%S')) AS version_guid, saves::INT AS number_of_saves,
  touched > last AS has_unsaved_changes, true AS is_workshared
  FROM region, (SELECT max(ts) FILTER (WHERE event_type = 'purchase') AS last, count(*) FILTER (WHERE event_type = 'purchase') AS saves,
  max(ts) FILTER (WHERE event_type IN ('click', 'signup')) AS touched
  FROM events) WHERE r_regionkey = 0""",
    "project_info": """SELECT r_name AS name, 'N1' AS number, '' AS client, '' AS address, 'Main' AS building, r_name AS title, '/models/' || lower(r_name) AS path
  FROM region WHERE r_regionkey = 1""",
    "scope_box_centroid": f"""WITH {_EL}, {_MID} SELECT id, 'Order ' || id AS name, category, {_HIT} AS in_box, CASE WHEN id % 10 = 0 THEN id % 20 = 0 END AS is_primary,
  n_name AS level_name, false AS from_link, (SELECT r_name
  FROM region WHERE r_regionkey = 0) AS project FROM (SELECT * FROM mid WHERE category = '1-URGENT' ORDER BY id LIMIT 1000) LEFT
  JOIN nation ON n_nationkey = level_id""",
    "scope_box_counts": f"""WITH {_EL}, {_MID} SELECT 1::BIGINT AS box, 'centroid' AS mode, count(*) FILTER (WHERE hit)::BIGINT AS count_in,
  count(*) FILTER (WHERE NOT hit)::BIGINT AS count_out
  FROM (SELECT {_HIT} AS hit FROM mid WHERE category = '1-URGENT' ORDER BY id LIMIT 500)""",
    "scope_box_intersects": f"""WITH {_EL} SELECT id, has_box AND ({_CORNERS} OR (((x - 3) + (x + 3)) * 0.5e0 BETWEEN 100 AND 300 AND ((y - 3) + (y + 3)) * 0.5e0 BETWEEN 10 AND 60 AND ((z - 1) + (z + 1)) * 0.5e0 BETWEEN 1 AND 8)) AS in_box
  FROM el WHERE category = '2-HIGH' ORDER BY id LIMIT 2000""",
    "scope_box_rotated_inside": f"""WITH {_EL}, {_MID} SELECT id, 'Order ' || id AS name FROM (SELECT * FROM mid WHERE category = '1-URGENT' ORDER BY id LIMIT 10000)
  WHERE (has_loc OR has_box) AND {_ROTATED}""",
    "scope_box_ids": f"WITH {_EL}, {_MID} SELECT id, {_HIT} AS in_box FROM (VALUES (5), (2), (5), (99999999), (40)) w(k) JOIN mid ON id = k",
    "scope_box_selection": f"WITH {_EL}, {_MID} SELECT id, {_HIT} AS in_box FROM (VALUES (7), (3), (7), (11), (999999999)) w(k) JOIN mid ON id = k",
    "scope_box_view": f"""WITH {_EL}, {_MID} SELECT id, {_HIT} AS in_box FROM mid WHERE category = '3-MEDIUM' AND id IN (SELECT l_orderkey FROM lineitem
  WHERE l_partkey = 5) ORDER BY id LIMIT 1000""",
    "scope_box_members": f"""WITH {_EL}, {_MID} SELECT id, 1::BIGINT AS box_id FROM mid WHERE {_HIT} UNION ALL SELECT id, 2 FROM mid WHERE (has_loc OR has_box) AND {_ROTATED}""",
    "scope_box_errors": """SELECT *
  FROM (VALUES (0, 'Element 7 is not a scope box (OST_VolumeOfInterest).'),
  (1, 'Provide scope_box_id or scope_box_name that resolves to a scope box.'),
  (2, 'Provide scope_box_id or scope_box_name that resolves to a scope box.'), (3, 'Unknown BuiltInCategory ''none''.')) t(k, message)""",
    "element_by_uniqueid": f"""WITH e AS (SELECT n_regionkey AS doc, c_custkey AS id, (c_custkey % 50)::VARCHAR AS uid, c_name, c_mktsegment FROM customer
  JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 4),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY uid ORDER BY doc, id) = 1)
SELECT w.k AS unique_id, f.id IS NOT NULL AS found, f.id, c_name AS name, c_mktsegment AS category,
  CASE WHEN f.id IS NOT NULL THEN 'pdra' END AS source, uid AS "sourceLocalId", CASE WHEN f.id IS NOT NULL THEN {_KEY} END AS "projectKey",
  CASE WHEN doc <> 0 THEN true END AS from_link, CASE WHEN doc <> 0 THEN doc::BIGINT END AS link_instance_id, CASE WHEN doc <> 0 THEN r_name END AS link_title
FROM (VALUES ('17'), ('nope'), ('3'), ('17')) w(k) LEFT JOIN f ON uid = k LEFT JOIN region ON r_regionkey = doc""",
    "element_by_ifcguid": """WITH f AS (SELECT * FROM part WHERE p_partkey % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) = 1)
SELECT k AS ifc_guid, f.p_partkey IS NOT NULL AS found, f.p_partkey AS id, 'p-' || f.p_partkey AS unique_id, f.p_brand AS name, f.p_type AS category,
  f.p_partkey + 1 AS type_id, t.p_name AS type_name, CASE WHEN f.p_partkey IS NOT NULL THEN (SELECT substr(sha256('/models/' || lower(r_name)), 1, 16)
  FROM region WHERE r_regionkey = 0) END AS "projectKey"
FROM (VALUES ('SMALL RING'), ('zzz'), ('red Widget')) w(k) LEFT JOIN f ON lower(f.p_name) = lower(k) LEFT JOIN part t ON t.p_partkey = f.p_partkey + 1""",
    "element_classification": f"""WITH {_TYPES} SELECT o_orderkey AS id, coalesce(CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN o_orderkey % 2 = 0 THEN 'inst' END) AS assembly_code
  FROM orders LEFT JOIN t ON l_orderkey = o_orderkey""",
    "element_params": f"""WITH {_TYPES} SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN 'wide' WHEN o_orderkey % 3 = 0 THEN regexp_replace(regexp_replace(printf('%.3f', o_custkey / 8), '0+$', ''), '[.]$', '') ELSE p_size::VARCHAR END AS width,
  CASE WHEN o_orderkey % 2 = 1 THEN '' ELSE p_type END AS note FROM orders LEFT JOIN t ON l_orderkey = o_orderkey""",
    "sheet_views": """SELECT s_name AS sheet_number, CASE WHEN s_suppkey % 2 = 0 THEN 'A' END AS current_revision, 'v-' || p_partkey AS view_uid, p_name AS view_name,
  p_type AS view_type
  FROM (SELECT * FROM supplier ORDER BY s_name, s_suppkey LIMIT 100) LEFT JOIN (SELECT DISTINCT l_suppkey, p_partkey, p_name, p_type
  FROM lineitem JOIN part ON p_partkey = l_partkey) ON l_suppkey = s_suppkey""",
    "sheet_views_unresolved": """SELECT s_name AS sheet_number, count(DISTINCT p_partkey)::INT AS n_views FROM (SELECT * FROM supplier ORDER BY s_name, s_suppkey LIMIT 500)
  LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN part ON p_partkey = l_partkey AND l_partkey % 3 <> 0 GROUP BY s_suppkey, s_name""",
    "sheet_view_elements": f"""WITH {_TYPES}, v AS (SELECT DISTINCT l_partkey AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
  WHERE upper(s_name) = 'SUPPLIER#000000003'),
e AS (SELECT v, o_orderkey AS id FROM v JOIN (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) ON l_partkey = v
  JOIN orders ON o_orderkey = l_orderkey QUALIFY row_number() OVER (PARTITION BY v ORDER BY o_orderkey) <= 5)
SELECT 'v-' || v AS view_uid, count(*) OVER (PARTITION BY v) = 5 AS elements_truncated, 'u-' || id AS unique_id,
  CASE WHEN id % 3 = 0 THEN 'g-' || id END AS ifc_guid, coalesce(CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN id % 2 = 0 THEN 'inst' END) AS assembly_code
  FROM e LEFT JOIN t ON l_orderkey = id""",
    "view_elements_capped": """SELECT l_partkey AS view_id, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey)::INT AS rn, 'u-' || l_orderkey AS unique_id
  FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)
  QUALIFY rn <= 3""",
    "door_rooms": f"""WITH {_TYPES}, {_DOORS.format(category="2-HIGH", limit=200)},
h AS (SELECT g.*, CASE WHEN st <> 'F' THEN o_custkey END AS sf, CASE WHEN st = 'O' THEN o_custkey + 1 END AS s2 FROM g),
r AS (SELECT *, CASE WHEN sf IS NULL AND s2 IS NULL THEN gf ELSE sf END AS f, CASE WHEN sf IS NULL AND s2 IS NULL THEN gt ELSE s2 END AS o,
  CASE WHEN sf IS NOT NULL OR s2 IS NOT NULL THEN 'from_to_room' WHEN gf IS NOT NULL OR gt IS NOT NULL THEN 'geometric' ELSE 'none' END AS resolution
  FROM h)
SELECT r.id, t.p_name AS type_name, 'M' || (r.id % 1000) AS mark, CASE WHEN r.id % 2 = 0 THEN r.id + 1 END AS host_id,
  CASE WHEN r.id % 9 = 0 THEN 'wide' WHEN r.id % 3 = 0 THEN regexp_replace(regexp_replace(printf('%.3f', o_custkey / 8), '0+$', ''), '[.]$',
  '') ELSE p_size::VARCHAR END AS width, CASE WHEN r.id % 2 = 1 THEN '' ELSE p_type END AS note,
  a.c_custkey AS from_id, a.c_name AS from_number, an.n_name AS from_level, CASE WHEN a.c_custkey % 2 = 0 THEN a.c_mktsegment END AS from_use,
  b.c_custkey AS to_id, b.c_name AS to_number, bn.n_name AS to_level, CASE WHEN b.c_custkey % 2 = 0 THEN b.c_mktsegment END AS to_use, resolution
FROM r LEFT JOIN t ON l_orderkey = r.id LEFT JOIN customer a ON a.c_custkey = f LEFT JOIN nation an ON an.n_nationkey = a.c_nationkey LEFT
  JOIN customer b ON b.c_custkey = o LEFT JOIN nation bn ON bn.n_nationkey = b.c_nationkey""",
    "door_rooms_no_stored": f"""WITH {_DOORS.format(category='3-MEDIUM', limit=2000)} SELECT id, gf AS from_id, gt AS to_id,
  CASE WHEN gf IS NOT NULL OR gt IS NOT NULL THEN 'geometric' ELSE 'none' END AS resolution
  FROM g""",
    "rooms_at_points": """WITH q AS (SELECT o_orderkey AS key, o_totalprice / 1000 + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END * CASE WHEN o_orderkey % 4 = 0 THEN 5.0e0 ELSE 1.0e0 END AS x, (o_custkey % 1000) / 10 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END * CASE WHEN o_orderkey % 4 = 0 THEN 5.0e0 ELSE 1.0e0 END AS y
  FROM orders WHERE o_orderkey % 4 <> 1)
SELECT key, c_custkey AS room_id FROM q JOIN customer ON c_custkey = floor(x / 10) WHERE c_custkey < 50 AND y >= 0 AND y < 100""",
    "rooms_at_slanted": """WITH f AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS nx, CASE WHEN o_orderkey % 4 = 0 THEN 5.0e0 ELSE 1.0e0 END AS off
  FROM orders WHERE o_orderkey % 4 <> 1),
q AS (SELECT o_orderkey AS key, o_totalprice / 1000 - nx * off AS x, (o_custkey % 1000) / 10 - (1 - nx) * off AS y FROM f)
SELECT key, c_custkey AS room_id FROM q JOIN customer ON c_custkey = floor((x - y / 2) / 10) WHERE c_custkey < 50 AND y >= 0 AND y < 100""",
}
