"""Explicit schemas of the building-model tables. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

_LONG, _INT, _DOUBLE, _STRING, _BOOL = LongType(), IntegerType(), DoubleType(), StringType(), BooleanType()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


POINT = _struct(x=_DOUBLE, y=_DOUBLE, z=_DOUBLE)
BOX = _struct(min=POINT, max=POINT)
#: A parameter's value as a tagged union: storage says which of s, i, d, eid holds it; display is the host's own rendering.
PARAM = _struct(storage=_STRING, s=_STRING, i=_INT, d=_DOUBLE, eid=_LONG, display=_STRING)
PARAMS = MapType(_STRING, PARAM, True)

TABLES: dict[str, StructType] = {
    "documents": _struct(
        doc_id=_LONG, title=_STRING, path=_STRING, version_guid=_STRING, number_of_saves=_INT, is_modified=_BOOL, is_workshared=_BOOL, is_linked=_BOOL, is_active=_BOOL,
        project_info=_struct(unique_id=_STRING, name=_STRING, number=_STRING, client=_STRING, address=_STRING, building=_STRING),
    ),
    "elements": _struct(
        doc_id=_LONG, id=_LONG, unique_id=_STRING, name=_STRING, category=_STRING, category_code=_STRING, type_id=_LONG, is_type=_BOOL, is_family_instance=_BOOL,
            level_id=_LONG,
        ifc_guid=_STRING, location=POINT, bbox=BOX, design_option=_struct(id=_LONG, name=_STRING, is_primary=_BOOL), params=PARAMS,
    ),
    "element_types": _struct(doc_id=_LONG, type_id=_LONG, name=_STRING, params=PARAMS),
    "levels": _struct(doc_id=_LONG, id=_LONG, unique_id=_STRING, name=_STRING, elevation_ft=_DOUBLE, elevation_user_units=_STRING),
    "rooms": _struct(
        doc_id=_LONG, id=_LONG, unique_id=_STRING, number=_STRING, name=_STRING, area_sf=_DOUBLE, area_user_units=_STRING, level_id=_LONG, phase_id=_LONG,
        footprint=ArrayType(_struct(x=_DOUBLE, y=_DOUBLE)), z_min=_DOUBLE, z_max=_DOUBLE, params=PARAMS,
    ),
    "views": _struct(doc_id=_LONG, id=_LONG, unique_id=_STRING, name=_STRING, view_type=_STRING, is_template=_BOOL, is_sheet=_BOOL, level_id=_LONG, phase_id=_LONG,
        params=PARAMS),
    "sheets": _struct(doc_id=_LONG, id=_LONG, unique_id=_STRING, sheet_number=_STRING, sheet_name=_STRING, current_revision=_STRING, is_template=_BOOL),
    "viewports": _struct(doc_id=_LONG, sheet_id=_LONG, view_id=_LONG, ordinal=_INT),
    "view_elements": _struct(doc_id=_LONG, view_id=_LONG, element_id=_LONG),
    "scope_boxes": _struct(doc_id=_LONG, id=_LONG, name=_STRING, min=POINT, max=POINT, inverse=ArrayType(_DOUBLE)),
    "links": _struct(host_doc_id=_LONG, id=_LONG, unique_id=_STRING, name=_STRING, target_doc_id=_LONG, ordinal=_INT),
    "phases": _struct(doc_id=_LONG, id=_LONG, name=_STRING, ordinal=_INT),
    "openings": _struct(doc_id=_LONG, element_id=_LONG, mark=_STRING, host_id=_LONG, host_wall_width=_DOUBLE, facing=POINT),
    "opening_rooms": _struct(doc_id=_LONG, element_id=_LONG, phase_id=_LONG, from_room_id=_LONG, to_room_id=_LONG),
}
