"""The eleven queries on a small model that holds every odd case, compared as parsed JSON."""

import hashlib
import json
import math
import urllib.error
import urllib.request

import numpy as np
import pytest

from girder.plans.args import QueryError
from girder.plans.registry import BY_NAME, QUERIES, catalog, run
from girder.plans.server import Dispatcher, serve
from girder.sources.model import Model, Session, read_model, write_model
from girder.sources.schema import TABLES

HOST, LINK_A, LINK_B = 1, 2, 3


def s(v, display=None):
    return ("String", v, None, None, None, display)


def i(v):
    return ("Integer", None, v, None, None, None)


def d(v, display=None):
    return ("Double", None, None, v, None, display)


def e(v):
    return ("ElementId", None, None, None, v, None)


def element(doc, id, uid, name, category="Doors", code="OST_Doors", type_id=None, is_type=False, fam=True, level=None, ifc=None, at=None, box=None, option=None, params=None):
    return (doc, id, uid, name, category, code, type_id, is_type, fam, level, ifc, at, box, option, params or {})


DATA = {
    "documents": [
        (HOST, "Host", "", "guid-1", 7, True, False, False, True, None),
        (LINK_A, "Link A", "/a.rvt", None, None, False, False, True, False, ("pi-a", "", "2", None, "", "B")),
        (LINK_B, "Link B", "/b.rvt", None, None, False, True, True, False, ("", "Named", None, "C", None, None)),
    ],
    "levels": [(HOST, 10, "l10", "Ground", 0.0, "0"), (HOST, 11, "l11", "First", 10.0, None), (HOST, 12, "l12", "Cellar", -10.0, "-10"), (HOST, 9, "l9", "Also ground", 0.0, ""), (LINK_A, 10, "la", "Link level", 3.0, "3")],
    "rooms": [
        (HOST, 1, "r1", "101", "Hall", 20.0, "20 SF", 10, None, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], 0.0, 9.0, {"use": s("x"), "empty": s("")}),
        (HOST, 2, "r2", "101", "Twin", 30.0, "", None, None, [(10.0, 0.0), (20.0, 0.0), (20.0, 10.0), (10.0, 10.0)], 0.0, 9.0, {"ROOM_LEVEL_ID": e(11)}),
        (HOST, 3, "r3", "002", "Zero", 0.0, None, 10, None, None, None, None, {}),
        (HOST, 4, "r4", "003", "Negative", -1.0, None, 10, None, None, None, None, {}),
        (HOST, 5, "r5", "004", "NaN", math.nan, None, 99, None, None, None, None, {}),
        (LINK_A, 6, "r6", "000", "Other document", 5.0, None, None, None, None, None, None, {}),
    ],
    "views": [
        (HOST, 20, "v20", "Plan", "FloorPlan", False, False, 10, 2, {}), (HOST, 21, "v21", "Plan", "FloorPlan", False, False, 77, None, {}), (HOST, 22, "v22", "A", "Section", False, False, None, None, {}),
        (HOST, 23, "v23", "Template", "FloorPlan", True, False, None, None, {}), (HOST, 24, "v24", "Sheet view", "DrawingSheet", False, True, None, None, {}),
    ],
    "sheets": [(HOST, 30, "s30", "A101", "One", "B", False), (HOST, 31, "s31", "a101", "Two", "", False), (HOST, 32, "s32", "A2", "Three", None, False), (HOST, 33, "s33", "A0", "Template", None, True)],
    "viewports": [(HOST, 30, 22, 1), (HOST, 30, 20, 0), (HOST, 30, 404, 2), (HOST, 30, None, 3), (HOST, 31, 21, 0)],
    "view_elements": [(HOST, 20, 100), (HOST, 20, 101), (HOST, 20, 102), (HOST, 20, 105), (HOST, 22, 100), (HOST, 22, 107)],
    "element_types": [(HOST, 50, "Type", {"UNIFORMAT_CODE": s("B20"), "UNIFORMAT_DESCRIPTION": s(""), "width": d(0.9), "blocked": s("from type")}), (LINK_A, 50, "Link type", {"OMNICLASS_CODE": s("23-1")})],
    "elements": [
        element(HOST, 100, "u100", "Door 0", type_id=50, level=11, ifc="GuId", at=(5.0, 10.0, 1.0), params={"UNIFORMAT_CODE": s("inst"), "UNIFORMAT_DESCRIPTION": s("Doors"), "blocked": s(""), "n": i(3)}),
        element(HOST, 101, "u101", "Door 1", type_id=50, ifc="guid", at=(10.0, 5.0, 1.0), box=((9.0, 4.0, 0.0), (11.0, 6.0, 2.0)), params={"FAMILY_LEVEL_PARAM": e(77), "LEVEL_PARAM": e(12), "width": d(1e-7), "resolution": s("mine"), "name": s("renamed")}),
        element(HOST, 102, "u102", "Door 2", level=77, ifc="", at=(50.0, 50.0, 1.0), option=(1, "Opt", True), params={"LEVEL_PARAM": e(12), "width": d(2.0, "2 m")}),
        element(HOST, 103, "u103", "Not a family", fam=False, at=(1.0, 1.0, 1.0)),
        element(HOST, 104, "u104", "No place", option=(2, "Alt", False), params={"WALL_BASE_CONSTRAINT": i(10)}),
        element(HOST, 105, "u105", "Box only", "Walls", "OST_Walls", fam=False, box=((2.0, 2.0, 0.0), (4.0, 4.0, 2.0))),
        element(HOST, 106, "u106", "Around", "Walls", "OST_Walls", fam=False, box=((-100.0, -100.0, -100.0), (104.0, 104.0, 100.0))),
        element(HOST, 107, "u107", "Uncategorised", None, None, fam=False),
        element(HOST, 108, "u108", "A type", is_type=True, ifc="type-guid"),
        element(HOST, 109, "dup", "In the host", "Walls", "OST_Walls", fam=False),
        element(LINK_A, 100, "dup", "In link A"), element(LINK_B, 100, "dup", "In link B"), element(LINK_A, 200, "both", "A", level=10, type_id=50), element(LINK_B, 1, "both", "B"), element(4, 1, "unloaded", "never"),
    ],
    "scope_boxes": [
        (HOST, 60, "Zone", (0.0, 0.0, 0.0), (10.0, 10.0, 3.0), None), (HOST, 61, "ZONE", (0.0, 0.0, 0.0), (1.0, 1.0, 1.0), None), (HOST, 62, "Turned", (-5.0, -5.0, -5.0), (5.0, 5.0, 5.0), [0.6, 0.8, 0.0, -7.0, -0.8, 0.6, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0]),
        (HOST, 63, "Flat", None, None, None),
    ],
    "links": [(HOST, 70, "k70", "B link", LINK_B, 0), (HOST, 71, "k71", "A link", LINK_A, 1), (HOST, 72, "k72", "A link", None, 2)],
    "phases": [(HOST, 1, "Old", 0), (HOST, 2, "New", 1)],
    "openings": [
        (HOST, 100, "M1", 105, None, (0.0, 1.0, 0.0)), (HOST, 101, None, None, 3.0, (-3.0, 0.0, 5.0)), (HOST, 102, "M3", None, None, (0.0, 0.0, 1.0)), (HOST, 104, None, None, None, (0.0, 1.0, 0.0)),
    ],
    "opening_rooms": [(HOST, 100, 2, 1, None), (HOST, 100, 1, None, None), (HOST, 101, 2, None, None)],
}
SESSION = Session(doc_id=HOST, selection=(102, 100, 102, 4040), active_view_id=20)


@pytest.fixture(scope="module")
def model(spark):
    return Model(spark, {name: spark.createDataFrame(rows, TABLES[name]) for name, rows in DATA.items()})


@pytest.fixture
def ask(model):
    def ask(query, session=SESSION, **args):
        return json.loads(run(model, session, query, args).text())

    return ask


def test_revision_and_project(ask, model):
    assert ask("get_model_revision") == {"title": "Host", "path": None, "version_guid": "guid-1", "number_of_saves": 7, "has_unsaved_changes": True, "is_workshared": False}
    assert ask("get_project_info") == {"name": "Host", "number": "", "client": "", "address": "", "building": "", "title": "Host", "path": ""}
    assert ask("get_project_info", Session(doc_id=LINK_A)) == {"name": "Link A", "number": "2", "client": "", "address": "", "building": "B", "title": "Link A", "path": "/a.rvt"}
    for q in QUERIES:
        with pytest.raises(QueryError, match="No active document."):
            run(model, Session(doc_id=None), q.name, {})


def test_rooms(ask):
    got = ask("get_rooms")
    assert (got["total"], got["count"], got["truncated"]) == (2, 2, False)
    assert got["rooms"] == [
        {"unique_id": "r1", "id": 1, "number": "101", "name": "Hall", "area_sf": 20.0, "area_user_units": "20 SF", "level": {"id": 10, "name": "Ground", "elevation_ft": 0.0, "elevation_user_units": "0"}},
        {"unique_id": "r2", "id": 2, "number": "101", "name": "Twin", "area_sf": 30.0, "level": {"id": 11, "name": "First", "elevation_ft": 10.0, "elevation_user_units": None}},
    ]
    everything = ask("get_rooms", include_unplaced=True)
    assert [r["id"] for r in everything["rooms"]] == [3, 4, 5, 1, 2] and "level" not in everything["rooms"][2]
    assert ask("get_rooms", include_unplaced="true")["total"] == ask("get_rooms", include_unplaced=1)["total"] == 2


@pytest.mark.parametrize(("limit", "count"), [(0, 1), (-1, 1), ("1", 1), (" 1 ", 1), (1.5, 2), ("x", 2), (10**12, 2), (None, 2), (True, 2), (5000, 2)])
def test_limits(ask, limit, count):
    got = ask("get_rooms", limit=limit)
    assert (got["total"], got["count"], got["truncated"]) == (2, count, count < 2)


def test_fields(ask):
    got = ask("get_rooms", fields=["NAME", "area_user_units", 7, "none"])["rooms"]
    assert got == [{"id": 1, "name": "Hall", "area_user_units": "20 SF"}, {"id": 2, "name": "Twin"}]
    assert list(got[0])[0] == "id"
    assert "unique_id" in ask("get_rooms", fields=[])["rooms"][0] and "unique_id" in ask("get_rooms", fields=[1])["rooms"][0]
    assert ask("get_sheets", fields=["sheet_name"])["sheets"][0] == {"sheet_name": "One"}


def test_levels(ask):
    got = ask("get_levels")
    assert got["count"] == 4 and [r["id"] for r in got["levels"]] == [12, 9, 10, 11]
    assert got["levels"][3] == {"unique_id": "l11", "id": 11, "name": "First", "elevation_ft": 10.0, "elevation_user_units": None}


def test_views(ask):
    got = ask("get_views")
    assert [r["id"] for r in got["views"]] == [20, 21, 22] and got["total"] == 3
    assert "level" in got["views"][0] and "level" not in got["views"][1]
    assert [r["id"] for r in ask("get_views", view_type="section")["views"]] == [22]
    assert ask("get_views", view_type="")["total"] == 3
    with pytest.raises(QueryError, match="Unknown ViewType 'Nope'"):
        ask("get_views", view_type="Nope")


def test_links(ask):
    got = ask("get_links")
    assert got["count"] == 3
    assert got["links"] == [
        {"unique_id": "k71", "id": 71, "name": "A link", "loaded": True, "title": "Link A", "project_key": "revit:pi-a"},
        {"unique_id": "k72", "id": 72, "name": "A link", "loaded": False},
        {"unique_id": "k70", "id": 70, "name": "B link", "loaded": True, "title": "Link B", "project_key": hashlib.sha256(b"/b.rvt").hexdigest()[:16]},
    ]


def test_sheets(ask):
    got = ask("get_sheets")
    assert [x["sheet_number"] for x in got["sheets"]] == ["A101", "A2", "a101"] and got["total"] == 3
    assert got["sheets"][0] == {
        "unique_id": "s30", "sheet_number": "A101", "sheet_name": "One", "current_revision": "B",
        "views": [{"unique_id": "v20", "name": "Plan", "view_type": "FloorPlan"}, {"unique_id": "v22", "name": "A", "view_type": "Section"}],
    }
    assert got["sheets"][1]["views"] == [] and "current_revision" not in got["sheets"][2]
    assert [x["unique_id"] for x in ask("get_sheets", sheet_number="A101")["sheets"]] == ["s30", "s31"]
    assert ask("get_sheets", limit=1)["truncated"] is True


def test_sheet_elements(ask):
    views = ask("get_sheets", sheet_number="A101", include_elements=True)["sheets"][0]["views"]
    assert views[0]["elements"] == [
        {"unique_id": "u100", "ifc_guid": "GuId", "classification": {"assembly_code": "B20", "assembly_description": "Doors"}},
        {"unique_id": "u101", "ifc_guid": "guid", "classification": {"assembly_code": "B20"}}, {"unique_id": "u102"}, {"unique_id": "u105"},
    ]
    assert views[0]["elements_truncated"] is False and [x["unique_id"] for x in views[1]["elements"]] == ["u100"]
    capped = ask("get_sheets", sheet_number="a101", include_elements=True, element_limit=4)["sheets"]
    assert capped[0]["views"][0]["elements_truncated"] is True and len(capped[0]["views"][0]["elements"]) == 4
    assert capped[1]["views"][0]["elements"] == [] and capped[1]["views"][0]["elements_truncated"] is False


def test_scope_box(ask):
    got = ask("filter_elements_by_scope_box", scope_box_name="zone", category="OST_Doors")
    assert got["scope_box"] == {"id": 60, "name": "Zone"} and got["mode"] == "centroid"
    assert {r["id"]: r["in_box"] for r in got["elements"]} == {100: True, 101: True, 102: False, 103: True, 104: False}
    assert (got["count_in"], got["count_out"]) == (3, 2)
    row = got["elements"][2]
    assert row == {"id": 102, "name": "Door 2", "category": "Doors", "in_box": False, "design_option": {"id": 1, "name": "Opt", "is_primary": True}, "level": None, "from_link": False, "project": "Host"}
    assert got["elements"][1]["level"]["name"] == "Cellar" and got["elements"][0]["design_option"] is None


def test_scope_box_limit_is_on_what_is_tested(ask):
    got = ask("filter_elements_by_scope_box", scope_box_id=60, category="OST_Doors", inside_only=True, limit=3)
    assert [r["id"] for r in got["elements"]] == [100, 101] and (got["count_in"], got["count_out"]) == (2, 1)
    assert len(ask("filter_elements_by_scope_box", scope_box_id=60, category="OST_Doors", limit="3", inside_only="true")["elements"]) == 5
    with pytest.raises(ValueError, match="1.5"):
        ask("filter_elements_by_scope_box", scope_box_id=60, category="OST_Doors", limit=1.5)


def test_scope_box_modes(ask):
    walls = ask("filter_elements_by_scope_box", scope_box_id="60", category="OST_Walls", mode="INTERSECTS")
    assert {r["id"]: r["in_box"] for r in walls["elements"]} == {105: True, 106: True, 109: False} and walls["mode"] == "intersects"
    # 106 surrounds the small box and has its middle outside: not a full overlap test
    assert {r["id"]: r["in_box"] for r in ask("filter_elements_by_scope_box", scope_box_id=61, category="OST_Walls", mode="intersects")["elements"]} == {105: False, 106: False, 109: False}
    doors = ask("filter_elements_by_scope_box", scope_box_id=60, category="OST_Doors", mode="intersects")
    assert {r["id"]: r["in_box"] for r in doors["elements"]} == {100: False, 101: True, 102: False, 103: False, 104: False}


def test_scope_box_sources(ask):
    ids = lambda **args: [r["id"] for r in ask("filter_elements_by_scope_box", scope_box_id=60, **args)["elements"]]
    assert ids(element_ids=[103, 100, 103, 4040, "100", True]) == [103, 100, 103]
    assert ids(element_ids=[]) == [] and ids(element_ids=[], category="OST_Doors") == []
    assert ids() == [102, 100, 102]
    assert ids(category="OST_Doors", view_id=20) == [100, 101, 102] and ids(category="OST_Doors", view_id=4040) == [100, 101, 102, 103, 104]
    with pytest.raises(QueryError, match="Provide element_ids"):
        ask("filter_elements_by_scope_box", Session(doc_id=HOST), scope_box_id=60)


@pytest.mark.parametrize(
    ("args", "message"),
    [
        ({}, "Provide scope_box_id or scope_box_name"), ({"scope_box_id": 404, "scope_box_name": "Zone"}, "Provide scope_box_id"), ({"scope_box_id": 100}, "Element 100 is not a scope box"),
        ({"scope_box_name": "flat", "category": "nope"}, "has no bounding box"), ({"scope_box_id": 60, "category": "ost_doors"}, "Unknown BuiltInCategory 'ost_doors'"),
    ],
)
def test_scope_box_errors(ask, args, message):
    with pytest.raises(QueryError, match=message):
        ask("filter_elements_by_scope_box", **args)


def test_turned_boxes_against_numpy(spark):
    rng = np.random.default_rng(4)
    angle = 0.7
    turn = np.array([[np.cos(angle), np.sin(angle), 0], [-np.sin(angle), np.cos(angle), 0], [0, 0, 1]])
    inverse = np.hstack([turn, rng.normal(size=(3, 1))])
    points = rng.normal(scale=4, size=(300, 3))
    rows = [element(HOST, k, str(k), "", at=tuple(map(float, p))) for k, p in enumerate(points)]
    box = [(HOST, 1000, "b", (-3.0, -2.0, -4.0), (3.0, 2.0, 4.0), [float(v) for v in inverse.ravel()])]
    model = Model(spark, {"documents": spark.createDataFrame(DATA["documents"], TABLES["documents"]), "elements": spark.createDataFrame(rows, TABLES["elements"]), "scope_boxes": spark.createDataFrame(box, TABLES["scope_boxes"])})
    got = run(model, SESSION, "filter_elements_by_scope_box", {"scope_box_id": 1000, "category": "OST_Doors"}).to_dict()
    local = points @ turn.T + inverse[:, 3]
    expected = (np.abs(local) <= [3, 2, 4]).all(axis=1)
    assert [r["in_box"] for r in got["elements"]] == expected.tolist() and got["count_in"] == expected.sum()
    from girder.operators.spatial import elements_in_boxes

    pairs = elements_in_boxes(model.elements, [{"doc_id": HOST, "id": 1000, "min": box[0][3], "max": box[0][4], "inverse": box[0][5]}], cell=2.0)
    assert sorted(r.id for r in pairs.collect()) == np.flatnonzero(expected).tolist()


def test_by_unique_id(ask):
    got = ask("get_element_by_uniqueid", unique_id="dup", unique_ids=["both", "", 5, "nope", "u100", "dup", "unloaded"])
    assert got["count"] == 6
    found = got["elements"]
    assert [x["unique_id"] for x in found] == ["dup", "both", "nope", "u100", "dup", "unloaded"]
    assert found[2] == {"unique_id": "nope", "found": False} and found[5] == {"unique_id": "unloaded", "found": False}
    assert found[0]["name"] == "In the host" and "from_link" not in found[0] and found[0]["type_id"] is None and found[0]["projectKey"] == "Host"
    assert found[1]["name"] == "B" and (found[1]["from_link"], found[1]["link_instance_id"], found[1]["link_title"]) == (True, 70, "Link B") and found[1]["sourceLocalId"] == "both"
    assert found[3]["level"]["name"] == "First" and found[3]["classification"] == {"assembly_code": "B20", "assembly_description": "Doors"} and found[3]["ifc_guid"] == "GuId"
    with pytest.raises(QueryError, match="Provide 'unique_id'"):
        ask("get_element_by_uniqueid", unique_ids=["", 1])


def test_by_unique_id_agrees_with_a_loop(model):
    keys = [f"u{k}" for k in range(95, 112)] * 40
    got = run(model, SESSION, "get_element_by_uniqueid", {"unique_ids": keys}).to_dict()["elements"]
    names = {x[2]: x[3] for x in DATA["elements"] if x[0] == HOST}
    assert [x.get("name") for x in got] == [names.get(k) for k in keys]


def test_by_ifc_guid(ask):
    got = ask("get_element_by_ifcguid", ifc_guid="GUID", ifc_guids=["guid", "type-guid", "none"])
    assert [(x["ifc_guid"], x["found"], x.get("id")) for x in got["elements"]] == [("GUID", True, 100), ("guid", True, 100), ("type-guid", False, None), ("none", False, None)]
    assert "level" not in got["elements"][0] and got["elements"][0]["type_name"] == "Type" and got["elements"][0]["source"] == "pdra"


def test_doors(ask):
    got = ask("get_door_rooms", category="OST_Doors", door_params=["width", "blocked", "n", "name", "resolution", "none"], room_params=["use", "empty", "none"])
    assert got["phase"] == "New" and got["count"] == 4
    rows = {r["id"]: r for r in got["elements"]}
    assert list(rows) == [100, 101, 102, 104]
    hall = {"id": 1, "name": "Hall", "number": "101", "level_name": "Ground", "params": {"use": "x", "empty": ""}}
    assert rows[100] == {"id": 100, "name": "Door 0", "type_name": "Type", "mark": "M1", "host_id": 105, "width": "0.9", "blocked": "", "n": "3", "from_room": hall, "to_room": None, "resolution": "from_to_room"}
    # facing -x with a wall 3 wide: 2 to either side
    assert rows[101]["resolution"] == "geometric" and rows[101]["from_room"]["id"] == 1 and rows[101]["to_room"] == {"id": 2, "name": "Twin", "number": "101", "level_name": None}
    assert rows[101]["name"] == "renamed" and rows[101]["width"] == "0" and rows[101]["blocked"] == "from type"
    assert rows[102]["resolution"] == "none" and rows[102]["width"] == "2 m" and rows[102]["from_room"] is None
    assert rows[104]["resolution"] == "none" and rows[104]["mark"] is None


def test_door_phases(ask, model):
    phase = lambda session=SESSION, **args: ask("get_door_rooms", session, category="OST_Doors", **args)
    assert phase(phase="old")["phase"] == "Old" and phase(phase_id="1", phase="New")["phase"] == "Old" and phase(phase_id="x", phase=" ")["phase"] == "New"
    assert phase(Session(doc_id=HOST))["phase"] == "New"
    assert phase(phase="old")["elements"][0]["resolution"] == "geometric"
    for args, message in (({"phase_id": 9}, "phase_id 9 is not a Phase."), ({"phase": "none"}, "No phase named 'none'.")):
        with pytest.raises(QueryError, match=message):
            phase(**args)
    without = Model(model.spark, {k: v for k, v in model.tables.items() if k != "phases"})
    got = run(without, SESSION, "get_door_rooms", {"category": "OST_Doors"}).to_dict()
    assert got["phase"] is None and [r["resolution"] for r in got["elements"]] == ["geometric", "geometric", "none", "none"]


def test_door_sources(ask):
    assert [r["id"] for r in ask("get_door_rooms")["elements"]] == [102, 100, 102]
    assert [r["id"] for r in ask("get_door_rooms", Session(doc_id=HOST))["elements"]] == [100, 101, 102, 104]
    assert [r["id"] for r in ask("get_door_rooms", element_ids=[103, 104, 103, 101], limit=2)["elements"]] == [104, 101]


def test_empty_model(spark):
    empty = Model(spark, {"documents": spark.createDataFrame(DATA["documents"], TABLES["documents"])})
    for name in ("get_rooms", "get_views", "get_sheets", "get_levels", "get_links"):
        assert run(empty, SESSION, name, {}).to_dict()["count"] == 0
    assert run(empty, Session(doc_id=HOST), "get_door_rooms", {}).to_dict() == {"count": 0, "phase": None, "elements": []}


def test_stored_models(model, tmp_path):
    write_model(model, str(tmp_path))
    again = read_model(model.spark, str(tmp_path))
    for name, args in (("get_rooms", {}), ("get_sheets", {"include_elements": True}), ("filter_elements_by_scope_box", {"scope_box_id": 60, "category": "OST_Doors"})):
        assert run(again, SESSION, name, args).text() == run(model, SESSION, name, args).text()
    plan = again.of("elements", HOST).where("category_code = 'OST_Doors'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(doc_id" in plan and "category_code" in plan.split("PartitionFilters")[1].split("]")[0]


def test_sql_views(model):
    model.register("bim_")
    assert model.spark.sql("SELECT count(*) n FROM bim_rooms WHERE doc_id = 1").first().n == 5


def test_plans(model):
    """Levels are joined to the page only, and nothing runs Python."""
    for name, args in (("get_rooms", {}), ("get_door_rooms", {"category": "OST_Doors"}), ("get_element_by_uniqueid", {"unique_id": "dup"}), ("get_sheets", {"include_elements": True})):
        plan = run(model, SESSION, name, args).df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dispatcher(model):
    call = Dispatcher(model, SESSION)
    send = lambda **request: json.loads(call(json.dumps(request)))
    assert send(id=1, method="initialize")["result"]["protocolVersion"] == "2024-11-05"
    tools = send(id="x", method="tools/list")["result"]["tools"]
    assert len(tools) == 11 and tools == catalog() and all(t["inputSchema"]["additionalProperties"] is False for t in tools)
    assert all(f"pdra_{t['name']}" in BY_NAME for t in tools)
    got = send(id=2, method="tools/call", params={"name": "pdra_get_levels", "arguments": [1]})
    assert json.loads(got["result"]["content"][0]["text"])["count"] == 4 and "isError" not in got["result"]
    failed = send(id=3, method="tools/call", params={"name": "get_views", "arguments": {"view_type": "?"}})["result"]
    assert failed["isError"] is True and failed["content"][0]["text"].startswith("Unknown ViewType")
    code = lambda **request: send(**request)["error"]["code"]
    assert code(id=4, method="none") == code(id=4, method="tools/call", params={"name": "none"}) == code(id=4, method="tools/call", params={"name": "GET_LEVELS"}) == -32601
    assert code(id=5, method="tools/call") == -32602
    assert code(id=6, method="tools/call", params={"name": "get_door_rooms", "arguments": {"limit": 1.5}}) == -32603
    with pytest.raises(ValueError):
        call("{")


def test_server(model):
    server = serve(model, SESSION, token="t")
    url = f"http://127.0.0.1:{server.server_address[1]}/any"

    def status(method, token="t", body=None):
        request = urllib.request.Request(url, data=body, method=method, headers={"Authorization": f"Bearer {token}"})
        try:
            with urllib.request.urlopen(request, timeout=60) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as error:
            return error.code, error.read()

    try:
        assert status("GET")[0] == 200 and status("GET", "no")[0] == 401 and status("PUT", body=b"")[0] == 405 and status("POST", "no", b"{}")[0] == 401
        assert status("POST", body=b"{")[0] == 500
        code, body = status("POST", body=json.dumps({"id": 1, "method": "tools/call", "params": {"name": "get_levels"}}).encode())
        assert code == 200 and json.loads(body)["id"] == 1
    finally:
        server.shutdown()


def test_slow_queries_are_cancelled(model):
    assert json.loads(Dispatcher(model, SESSION, timeout_s=0.001)(json.dumps({"id": 1, "method": "tools/call", "params": {"name": "get_sheets"}})))["error"]["code"] == -32603
