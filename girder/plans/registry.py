"""Queries by name, with their input schemas; a query also answers to its prefixed name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from girder.plans.args import COLLATION, FIELDS, NOTHING, limit_schema, of, schema
from girder.plans.result import Result
from girder.queries import doors, flat, lookup, scope_box, sheets
from girder.sources.model import Model, Session

#: Fixed value: names may carry this prefix.
PREFIX = "pdra_"


@dataclass(frozen=True)
class Query:
    name: str
    description: str
    input_schema: dict
    run: Callable[[Model, Session, dict], Result]
    reversibility: str = "Reversible"
    verifiability: str = "Auto"


_CANDIDATES = {
    "element_ids": of("array", "Elements, in this order.", "integer"),
    "category": of("string", "Code of the category whose instances are asked for."),
    "view_id": of("integer", "Only what this view shows, of a category."),
}
QUERIES = [
    Query("get_rooms", "Rooms by number, with level and area; unplaced ones only if asked for.",
        schema(include_unplaced=of("boolean", "Rooms without an area too."), limit=limit_schema(), fields=FIELDS, collation=COLLATION), flat.get_rooms),
    Query("get_levels", "Levels by elevation.", NOTHING, flat.get_levels),
    Query("get_views", "Views by type and name, without templates and sheets.",
        schema(view_type=of("string", "Only views of this type."), limit=limit_schema(), fields=FIELDS, collation=COLLATION), flat.get_views),
    Query(
        "get_sheets", "Sheets by number, the views on each, and on request the elements visible in them.",
        schema(
            sheet_number=of("string", "Only this sheet."), include_elements=of("boolean", "List the elements of each view."),
            element_limit=of("integer", "Elements of a view at most (default 100, up to 1000)."), limit=limit_schema(100, 500), fields=FIELDS, collation=COLLATION,
        ),
        sheets.get_sheets,
    ),
    Query("get_links", "Linked models by name, and whether they are loaded.", schema(collation=COLLATION), flat.get_links),
    Query(
        "filter_elements_by_scope_box", "Which elements are inside a scope box, whatever its rotation.",
        schema(
            scope_box_id=of("integer", "The box."), scope_box_name=of("string", "The box, by name."), **_CANDIDATES,
                mode=of("string", "centroid (default) or intersects."),
            inside_only=of("boolean", "Only elements inside."), limit=of("integer", "Elements to test at most (default 1000, up to 10000)."),
        ),
        scope_box.filter_elements_by_scope_box,
    ),
    Query("get_element_by_uniqueid", "Elements by unique id, in the host and its loaded links.",
        schema(unique_id=of("string", "One id."), unique_ids=of("array", "Several ids.", "string")), lookup.get_element_by_uniqueid),
    Query("get_element_by_ifcguid", "Elements of the host by IFC id.", schema(ifc_guid=of("string", "One id."), ifc_guids=of("array", "Several ids.", "string")),
        lookup.get_element_by_ifcguid),
    Query(
        "get_door_rooms", "Doors and the rooms that they lead from and to.",
        schema(
            **_CANDIDATES, door_params=of("array", "Parameters to read of each door.", "string"), room_params=of("array", "Parameters to read of each room.", "string"),
            phase=of("string", "Name of the phase."), phase_id=of("integer", "The phase."), limit=of("integer", "Doors at most (default 200, up to 2000)."),
        ),
        doors.get_door_rooms,
    ),
    Query("get_model_revision", "How fresh the model is: version, saves, unsaved changes.", NOTHING, flat.get_model_revision),
    Query("get_project_info", "The project's name, number, client, address and building.", NOTHING, flat.get_project_info),
]
BY_NAME = {name: q for q in QUERIES for name in (q.name, PREFIX + q.name)}


def run(model: Model, session: Session, name: str, args: dict | None = None) -> Result:
    return BY_NAME[name].run(model, session, args or {})


def catalog() -> list[dict]:
    return [{"name": q.name, "description": q.description, "inputSchema": q.input_schema} for q in QUERIES]
