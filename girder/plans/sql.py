"""The listings, the box test, the identity lookups and doors' rooms as SQL table functions over the model's tables.

A function's arguments can be columns of a table: `FROM boxes b, LATERAL bim_elements_in_box(b.doc_id, b.id)` tests all
elements against all rows of boxes, and Spark plans it as a join. The two box tests read views of girder.operators.spatial's
range join, whose cells are shaped by a sample when the functions are registered; coordinates beyond 10 ** 15 meet no box.
"""

from __future__ import annotations

from collections.abc import Collection

from girder.functions.identity import PROJECT_PREFIX
from girder.functions.text import letters
from girder.operators.spatial import boxes_met
from girder.sources.model import Model

def _folded(text: str) -> str:
    """As girder.functions.text.folded."""
    small, capital = letters()
    return f"CASE WHEN octet_length({text}) = char_length({text}) THEN upper({text}) ELSE translate({text}, '{small}', '{capital}') END"


#: name -> (parameters, columns, body); {p} is the prefix of the tables' views. Rows aren't limited: ORDER BY and LIMIT are the caller's.
FUNCTIONS = {
    "rooms_of": (
        "doc BIGINT, include_unplaced BOOLEAN DEFAULT false",
            "unique_id STRING, id BIGINT, number STRING, name STRING, area_sf DOUBLE, area_user_units STRING, level_id BIGINT",
        "SELECT unique_id, id, number, name, area_sf, area_user_units, level_id FROM {p}rooms WHERE doc_id = rooms_of.doc AND (rooms_of.include_unplaced OR (area_sf > 0 AND NOT isnan(area_sf)))",
    ),
    "levels_of": ("doc BIGINT", "unique_id STRING, id BIGINT, name STRING, elevation_ft DOUBLE, elevation_user_units STRING",
        "SELECT unique_id, id, name, elevation_ft, elevation_user_units FROM {p}levels WHERE doc_id = levels_of.doc"),
    "views_of": (
        "doc BIGINT, kind STRING DEFAULT NULL", "unique_id STRING, id BIGINT, name STRING, view_type STRING, level_id BIGINT",
        "SELECT unique_id, id, name, view_type, level_id FROM {p}views WHERE doc_id = views_of.doc AND NOT is_template AND NOT is_sheet AND (views_of.kind IS NULL OR lower(view_type) = lower(views_of.kind))",
    ),
    "links_of": (
        "doc BIGINT", "unique_id STRING, id BIGINT, name STRING, loaded BOOLEAN, title STRING, project_key STRING",
        f"""SELECT l.unique_id, l.id, l.name, d.doc_id IS NOT NULL, d.title,
            CASE WHEN d.doc_id IS NOT NULL THEN coalesce('{PROJECT_PREFIX}' || nullif(d.project_info.unique_id, ''), substr(sha2(nullif(d.path, ''), 256), 1, 16), d.title, '') END
            FROM {{p}}links l LEFT JOIN {{p}}documents d ON l.target_doc_id = d.doc_id WHERE l.host_doc_id = links_of.doc""",
    ),
    "sheet_views_of": (
        "doc BIGINT", "sheet_number STRING, sheet_id BIGINT, ordinal INT, view_id BIGINT, name STRING, view_type STRING",
        """SELECT s.sheet_number, s.id, v.ordinal, w.id, w.name, w.view_type FROM {p}sheets s LEFT JOIN ({p}viewports v JOIN {p}views w ON w.doc_id = v.doc_id AND w.id = v.view_id)
            ON v.doc_id = s.doc_id AND v.sheet_id = s.id WHERE s.doc_id = sheet_views_of.doc AND NOT s.is_template""",
    ),
    "elements_in_box": (
        "doc BIGINT, box BIGINT", "id BIGINT, name STRING, category STRING",
        "SELECT m.id, m.name, m.category FROM {p}pairs_in m WHERE m.doc_id = elements_in_box.doc AND m.box_id = elements_in_box.box",
    ),
    "elements_meeting_box": (
        "doc BIGINT, box BIGINT", "id BIGINT, name STRING, category STRING",
        "SELECT m.id, m.name, m.category FROM {p}pairs_meeting m WHERE m.doc_id = elements_meeting_box.doc AND m.box_id = elements_meeting_box.box",
    ),
    "element_by_uniqueid": (
        "host BIGINT, uid STRING", "doc_id BIGINT, id BIGINT, name STRING, category STRING, link_instance_id BIGINT",
        """SELECT f.r.doc_id, f.r.id, f.r.name, f.r.category, f.r.link FROM (
            SELECT s.host, e.unique_id, min_by(struct(e.doc_id, e.id, e.name, e.category, s.link), struct(s.link IS NOT NULL, s.ordinal, s.link, e.id)) AS r FROM {p}elements e JOIN (
                SELECT doc_id AS host, doc_id AS doc, CAST(NULL AS BIGINT) AS link, -1 AS ordinal FROM {p}documents
                UNION ALL SELECT host_doc_id, target_doc_id, id, ordinal FROM {p}links WHERE target_doc_id IS NOT NULL) s ON s.doc = e.doc_id
            GROUP BY s.host, e.unique_id) f WHERE f.host = element_by_uniqueid.host AND f.unique_id = element_by_uniqueid.uid""",
    ),
    "element_by_ifcguid": (
        "doc BIGINT, guid STRING", "id BIGINT, unique_id STRING, name STRING, category STRING",
        f"""SELECT f.r.id, f.r.unique_id, f.r.name, f.r.category FROM (
            SELECT doc_id, {_folded("ifc_guid")} AS k, min_by(struct(id, unique_id, name, category), id) AS r FROM {{p}}elements WHERE NOT is_type AND ifc_guid != '' GROUP BY 1, 2) f
            WHERE f.doc_id = element_by_ifcguid.doc AND f.k = {_folded("element_by_ifcguid.guid")}""",
    ),
    "stored_rooms_of": (
        "doc BIGINT, phase BIGINT", "element_id BIGINT, side STRING, room_id BIGINT, number STRING, name STRING, level_name STRING",
        """SELECT o.element_id, o.side, r.id, r.number, r.name, l.name FROM (
                SELECT doc_id, phase_id, element_id, 'from' AS side, from_room_id AS room_id FROM {p}opening_rooms UNION ALL SELECT doc_id, phase_id, element_id, 'to', to_room_id FROM {p}opening_rooms) o
            JOIN {p}rooms r ON r.doc_id = o.doc_id AND r.id = o.room_id LEFT JOIN {p}levels l ON l.doc_id = r.doc_id AND l.id = r.level_id
            WHERE o.doc_id = stored_rooms_of.doc AND o.phase_id = stored_rooms_of.phase""",
    ),
}


#: Functions that read pairs of elements and boxes: the view of pairs, and whether bounding boxes are tested.
PAIRS = {"elements_in_box": ("pairs_in", False), "elements_meeting_box": ("pairs_meeting", True)}


def register_functions(model: Model, prefix: str = "bim_", only: Collection[str] | None = None) -> list[str]:
    """Registers the tables as views and the functions as temporary table functions, all with the prefix; returns the functions' names.

    only: the functions that are needed, without prefix. Each box test reads elements when it is registered, to shape its cells.
    """
    model.register(prefix)
    wanted = {name: FUNCTIONS[name] for name in (FUNCTIONS if only is None else only)}
    for view, intersects in (PAIRS[name] for name in wanted if name in PAIRS):
        boxes_met(model.elements, model.scope_boxes, intersects, keep=("name", "category")).createOrReplaceTempView(prefix + view)
    for name, (parameters, columns, body) in wanted.items():
        text = body.format(p=prefix).replace(f"{name}.", f"{prefix}{name}.")
        model.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE({columns}) RETURN {text}")
    return [prefix + name for name in wanted]
