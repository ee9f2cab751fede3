"""Registered queries over whole tables: answers as JSON lines, lookups of keys that come as a table, levels of all elements."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import functions as F

from girder.operators.spatial import boxes_met, rooms_at_all
from girder.plans.bulk import door_lines, room_lines
from girder.plans.registry import run
from girder.plans.sql import register_functions
from girder.queries.common import with_level_of_all
from girder.queries.lookup import ifc_guids_of, unique_ids_of
from girder.queries.sheets import visible_elements_of_all
from girder.sources.driver_tables import SESSION, boxed_city, building, city, linked, named, odd, renamed
from girder.sources.guid_index import GuidIndex


def shared_folder(spark, name):
    """A new folder below spark.checkpoint.dir, which driver and executors share; unset only where they are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or tempfile.gettempdir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def rooms_json_lines(spark, sf_dir):
    """The JSON of all rooms that are placed."""
    return room_lines(odd(spark, sf_dir)).select("id", "line")


def rooms_json_fields(spark, sf_dir):
    """The JSON of all rooms, cut down to fields; id comes first though it wasn't asked for."""
    return room_lines(odd(spark, sf_dir), include_unplaced=True, fields={"number", "level", "area_user_units"}).select("id", "line")


def door_json_lines(spark, sf_dir):
    """The JSON of all doors; parameters named like a door's own columns take their place, and the resolution takes a parameter's."""
    return door_lines(renamed(spark, sf_dir), "2-HIGH", ["width", "name", "resolution", "note", "none"], ["use"]).select("id", "line")


def unique_ids_bulk(spark, sf_dir):
    """As many keys as there are orders, most of them asked for many times, some that no element has."""
    requests = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("pos"), (F.col("o_custkey") % 60).cast("string").alias("unique_id"))
    found = unique_ids_of(linked(spark, sf_dir), SESSION, requests)
    return found.select("pos", "unique_id", "found", "id", "name", "category", "source", "sourceLocalId", "projectKey", "from_link", "link_instance_id", "link_title")


def ifc_guids_bulk(spark, sf_dir):
    """As many keys as there are parts, in a case of their own; every third is none that an element has."""
    key = F.col("p_partkey")
    guid = F.when(key % 3 == 0, F.concat("p_name", F.lit("?"))).otherwise(F.initcap("p_name"))
    requests = spark.read.parquet(f"{sf_dir}/part.parquet").select(key.alias("pos"), guid.alias("ifc_guid"))
    found = ifc_guids_of(named(spark, sf_dir), SESSION, requests)
    return found.select("pos", "ifc_guid", "found", "id", "unique_id", "name", "category", "type_id", "type_name", "projectKey")


def guid_index_entries(spark, sf_dir):
    """The stored index after half of the elements came later than the first half."""
    model, index = named(spark, sf_dir), GuidIndex(spark, shared_folder(spark, "guid-index"))
    whole, stamp = model.elements, model.documents.select("doc_id", "version_guid", "number_of_saves", "is_modified")
    model.tables["elements"] = whole.where(F.col("id") % 2 == 0)
    index.refresh(model)
    index.add(whole.where(F.col("id") % 2 == 1), stamp.where(F.col("doc_id") == 0))
    return index.current().select("doc_id", "key", "id", "unique_id", "name", "category", "type_id")


def element_levels(spark, sf_dir):
    """The level of every element."""
    model = building(spark, sf_dir)
    slim = model.elements.select("doc_id", "id", "level_id", "params")
    return with_level_of_all(slim, model).select("id", F.col("level.id").alias("level_id"), F.col("level.name").alias("level_name"), F.col("level.elevation_ft").alias("elevation_ft"))


def rooms_at_city(spark, sf_dir):
    """The room around every element, among as many rooms as there are customers; a third of the elements are in one block."""
    model = city(spark, sf_dir)
    return rooms_at_all(model.elements.select("doc_id", F.col("id").alias("key"), "location.x", "location.y", "location.z"), model.rooms)


def box_members_centroid(spark, sf_dir):
    """All elements by all scope boxes of a table, by centroid."""
    model = boxed_city(spark, sf_dir)
    return boxes_met(model.elements, model.scope_boxes).select("id", "box_id")


def box_members_intersects(spark, sf_dir):
    """All elements by all scope boxes of a table, by corners and middle of bounding boxes."""
    model = boxed_city(spark, sf_dir)
    return boxes_met(model.elements, model.scope_boxes, intersects=True).select("id", "box_id")


def box_members_sql(spark, sf_dir):
    """The same by the SQL table function, whose arguments are columns of the table of boxes."""
    model = boxed_city(spark, sf_dir)
    register_functions(model, "city_", ["elements_in_box"])
    return spark.sql("SELECT f.id, b.id AS box_id FROM city_scope_boxes b, LATERAL city_elements_in_box(b.doc_id, b.id) f")


def views_in_order(spark, sf_dir):
    """Views by a collation that sees no case first: by name, then by code points, then by id."""
    found = run(building(spark, sf_dir), SESSION, "get_views", {"collation": "UNICODE_CI", "limit": 1000})
    return found.df.select("id", "name", "view_type")


def view_elements_of_all(spark, sf_dir):
    """The first elements of every view, where one view shows a third of all elements and some elements twice."""
    model = building(spark, sf_dir)
    crowd = model.elements.where(F.col("id") % 3 == 0).select(F.lit(0).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("view_id"), F.col("id").alias("element_id"))
    model.tables["view_elements"] = model.view_elements.unionByName(crowd)
    found = visible_elements_of_all(model, 0, 50)
    return found.select("view_id", "rn", "unique_id", "ifc_guid", F.col("classification.assembly_code").alias("assembly_code"))


NAMES = """rooms_json_lines rooms_json_fields door_json_lines unique_ids_bulk ifc_guids_bulk guid_index_entries element_levels rooms_at_city box_members_centroid
box_members_intersects box_members_sql views_in_order view_elements_of_all""".split()
QUERIES = {name: globals()[name] for name in NAMES}

_KEY = "CASE r_regionkey WHEN 1 THEN 'revit:info-1' WHEN 2 THEN 'revit:info-2' WHEN 3 THEN r_name ELSE substr(sha256('/models/' || lower(r_name)), 1, 16) END"
_LEVEL = """'{"id":' || n_nationkey || ',"name":"' || n_name || '","elevation_ft":' || (n_regionkey * 3.0e0)::VARCHAR || ',"elevation_user_units":"' || (n_regionkey * 3) || ' ft"}'"""
_ROOM = """CASE WHEN {c}.c_custkey IS NULL THEN 'null' ELSE '{{"id":' || {c}.c_custkey || ',"name":"' || {c}.c_mktsegment || '","number":"' || {c}.c_name || '","level_name":"' || {n}.n_name || '"'
    || CASE WHEN {c}.c_custkey % 2 = 0 THEN ',"params":{{"use":"' || {c}.c_mktsegment || '"}}' ELSE '' END || '}}' END"""
_ADDED = """CASE WHEN id % 9 = 0 THEN 'wide' WHEN id % 3 = 0 THEN regexp_replace(regexp_replace(printf('%.3f', o_custkey / 8), '0+$', ''), '[.]$', '') ELSE p_size::VARCHAR END"""
_CITY = """el AS (SELECT o_orderkey AS id, o_orderkey % 5 <> 0 AS has_box, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 17 + (o_orderkey % 7) / 8 ELSE o_custkey % 100 * 10 + o_orderkey % 10 + 0.5e0 END AS x,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 13 + 0.25e0 ELSE o_custkey // 100 * 10 + o_orderkey % 9 + 0.75e0 END AS y, (o_orderkey % 100) / 10 AS z FROM orders)"""
_BOXES = """bx AS (SELECT s_suppkey AS box_id, s_suppkey % 2 = 0 AS turned, (s_suppkey * 37 % 1000)::DOUBLE AS ox, (s_suppkey * 53 % 200)::DOUBLE AS oy,
  CASE WHEN s_suppkey % 10 = 0 THEN 60e0 ELSE 12e0 END AS half FROM supplier),
b AS (SELECT *, CASE WHEN turned THEN 0e0 ELSE ox END AS cx, CASE WHEN turned THEN 0e0 ELSE oy END AS cy, 0.6e0 * -ox + 0.8e0 * -oy AS tx, 0.8e0 * ox + 0.6e0 * -oy AS ty FROM bx)"""
_INSIDE = """CASE WHEN turned THEN 0.6e0 * px + 0.8e0 * py + 0e0 * pz + tx ELSE px END BETWEEN cx - half AND cx + half
  AND CASE WHEN turned THEN -0.8e0 * px + 0.6e0 * py + 0e0 * pz + ty ELSE py END BETWEEN cy - half AND cy + half AND pz BETWEEN 2 AND 8"""
ORACLE_SQL = {
    "rooms_at_city": f"""WITH {_CITY} SELECT id AS key, c_custkey AS room_id FROM el JOIN customer ON c_custkey = floor(x / 10)::BIGINT + 100 * floor(y / 10)::BIGINT AND x < 1000""",
    "box_members_centroid": f"""WITH {_CITY}, {_BOXES}, p AS (SELECT id, x AS px, y AS py, z AS pz FROM el) SELECT id, box_id FROM p JOIN b ON {_INSIDE}""",
    "box_members_sql": f"""WITH {_CITY}, {_BOXES}, p AS (SELECT id, x AS px, y AS py, z AS pz FROM el) SELECT id, box_id FROM p JOIN b ON {_INSIDE}""",
    "views_in_order": """SELECT p_partkey AS id, p_name AS name, p_type AS view_type FROM part WHERE p_size NOT IN (49, 50) ORDER BY lower(p_type), p_type, lower(p_name), p_name, p_partkey LIMIT 1000""",
    "view_elements_of_all": """WITH ty AS (SELECT l_orderkey, min(l_partkey) AS type_id FROM lineitem GROUP BY 1),
v AS (SELECT l_partkey AS view_id, l_orderkey AS id FROM lineitem JOIN part ON p_partkey = l_partkey UNION SELECT 1, o_orderkey FROM orders WHERE o_orderkey % 3 = 0),
r AS (SELECT view_id, id, row_number() OVER (PARTITION BY view_id ORDER BY id)::INT AS rn FROM v JOIN orders ON o_orderkey = id QUALIFY rn <= 50)
SELECT view_id, rn, 'u-' || id AS unique_id, CASE WHEN id % 3 = 0 THEN 'g-' || id END AS ifc_guid,
  coalesce(CASE WHEN p_size > 25 THEN p_brand END, CASE WHEN id % 2 = 0 THEN 'inst' END) AS assembly_code FROM r LEFT JOIN ty ON l_orderkey = id LEFT JOIN part ON p_partkey = type_id""",
    "box_members_intersects": f"""WITH {_CITY}, {_BOXES}, p AS (SELECT id, x + i * 3 AS px, y + j * 3 AS py, z + k AS pz FROM el, (VALUES (-1), (1)) a(i), (VALUES (-1), (1)) c(j), (VALUES (-1), (1)) d(k)
  WHERE has_box UNION ALL SELECT id, ((x - 3) + (x + 3)) * 0.5e0, ((y - 3) + (y + 3)) * 0.5e0, ((z - 1) + (z + 1)) * 0.5e0 FROM el WHERE has_box)
  SELECT DISTINCT id, box_id FROM p JOIN b ON {_INSIDE}""",
    "rooms_json_lines": f"""SELECT c_custkey AS id, '{{"unique_id":"r-' || c_custkey || '","id":' || c_custkey || ',"number":"' || c_name || '","name":"' || c_mktsegment
  || '","area_sf":' || c_acctbal::VARCHAR || ',"level":' || {_LEVEL} || '}}' AS line FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0 AND c_custkey % 5 > 1""",
    "rooms_json_fields": f"""SELECT c_custkey AS id, '{{"id":' || c_custkey || ',"number":"' || c_name || '","level":' || {_LEVEL} || '}}' AS line
  FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "door_json_lines": f"""WITH ty AS (SELECT l_orderkey, min(l_partkey) AS type_id FROM lineitem GROUP BY 1),
q AS (SELECT o_orderkey AS id, o_custkey, o_orderstatus AS st, o_totalprice / 1000 AS x, (o_custkey % 1000) / 10 AS y, o_orderkey % 4 <> 1 AS placed,
  CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS nx, CASE WHEN o_orderkey % 4 = 0 THEN 5.0e0 ELSE 1.0e0 END AS off FROM orders WHERE o_orderkey % 7 <> 3 AND o_orderpriority = '2-HIGH'),
s AS (SELECT *, CASE WHEN st <> 'F' THEN o_custkey END AS sf, CASE WHEN st = 'O' THEN o_custkey + 1 END AS s2, floor((x + nx * off) / 10) AS fx, floor((x - nx * off) / 10) AS tx,
  y + (1 - nx) * off AS fy, y - (1 - nx) * off AS ty FROM q),
r AS (SELECT s.*, st = 'F' AS free, f.c_custkey AS gf, t.c_custkey AS gt FROM s
  LEFT JOIN customer f ON placed AND f.c_custkey < 50 AND f.c_custkey = fx AND fy >= 0 AND fy < 100 LEFT JOIN customer t ON placed AND t.c_custkey < 50 AND t.c_custkey = tx AND ty >= 0 AND ty < 100),
w AS (SELECT r.*, CASE WHEN free THEN gf ELSE sf END AS a, CASE WHEN free THEN gt ELSE s2 END AS b,
  CASE WHEN NOT free THEN 'from_to_room' WHEN gf IS NOT NULL OR gt IS NOT NULL THEN 'geometric' ELSE 'none' END AS how FROM r)
SELECT id, '{{"id":' || id || ',"name":"' || CASE WHEN id % 6 = 0 THEN 'Re \\"named\\" ' || id ELSE 'Order ' || id END || '","type_name":' || coalesce('"' || p_name || '"', 'null')
  || ',"mark":"M' || (id % 1000) || '","host_id":' || CASE WHEN id % 2 = 0 THEN (id + 1)::VARCHAR ELSE 'null' END
  || coalesce(',"width":"' || {_ADDED} || '"', '') || CASE WHEN id % 5 = 0 THEN ',"resolution":"' || how || '"' ELSE '' END
  || coalesce(',"note":"' || CASE WHEN id % 2 = 1 THEN '' ELSE p_type END || '"', '') || ',"from_room":' || {_ROOM.format(c='ca', n='na')} || ',"to_room":' || {_ROOM.format(c='cb', n='nb')}
  || CASE WHEN id % 5 = 0 THEN '' ELSE ',"resolution":"' || how || '"' END || '}}' AS line
FROM w LEFT JOIN ty ON l_orderkey = id LEFT JOIN part ON p_partkey = type_id LEFT JOIN customer ca ON ca.c_custkey = a LEFT JOIN nation na ON na.n_nationkey = ca.c_nationkey
  LEFT JOIN customer cb ON cb.c_custkey = b LEFT JOIN nation nb ON nb.n_nationkey = cb.c_nationkey""",
    "unique_ids_bulk": f"""WITH e AS (SELECT n_regionkey AS doc, c_custkey AS id, (c_custkey % 50)::VARCHAR AS uid, c_name, c_mktsegment FROM customer
  JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 4),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY uid ORDER BY doc, id) = 1)
SELECT o_orderkey AS pos, (o_custkey % 60)::VARCHAR AS unique_id, f.id IS NOT NULL AS found, f.id, c_name AS name, c_mktsegment AS category,
  CASE WHEN f.id IS NOT NULL THEN 'pdra' END AS source, uid AS "sourceLocalId", CASE WHEN f.id IS NOT NULL THEN {_KEY} END AS "projectKey",
  CASE WHEN doc <> 0 THEN true END AS from_link, CASE WHEN doc <> 0 THEN doc::BIGINT END AS link_instance_id, CASE WHEN doc <> 0 THEN r_name END AS link_title
FROM orders LEFT JOIN f ON uid = (o_custkey % 60)::VARCHAR LEFT JOIN region ON r_regionkey = doc""",
    "ifc_guids_bulk": """WITH f AS (SELECT * FROM part WHERE p_partkey % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) = 1),
q AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN p_name || '?' ELSE array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS ifc_guid
  FROM part)
SELECT pos, ifc_guid, f.p_partkey IS NOT NULL AS found, f.p_partkey AS id, 'p-' || f.p_partkey AS unique_id, f.p_brand AS name, f.p_type AS category,
  f.p_partkey + 1 AS type_id, t.p_name AS type_name, CASE WHEN f.p_partkey IS NOT NULL THEN (SELECT substr(sha256('/models/' || lower(r_name)), 1, 16)
  FROM region WHERE r_regionkey = 0) END AS "projectKey" FROM q LEFT JOIN f ON lower(f.p_name) = lower(ifc_guid) LEFT JOIN part t ON t.p_partkey = f.p_partkey + 1""",
    "guid_index_entries": """SELECT 0::BIGINT AS doc_id, upper(p_name) AS key, p_partkey AS id, 'p-' || p_partkey AS unique_id, p_brand AS name, p_type AS category, p_partkey + 1 AS type_id
  FROM part WHERE p_partkey % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY upper(p_name) ORDER BY p_partkey) = 1""",
    "element_levels": """SELECT o_orderkey AS id, n_nationkey::BIGINT AS level_id, n_name AS level_name, n_regionkey * 3.0e0 AS elevation_ft FROM orders LEFT JOIN nation
  ON n_nationkey = CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 40 ELSE o_orderkey % 30 END""",
}
