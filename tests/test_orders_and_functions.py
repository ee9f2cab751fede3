"""Collations of text orders, table functions whose arguments are columns, and elements of views that show very many."""

import json

import pytest
from pyspark.sql import functions as F
from test_queries import HOST, SESSION, element, model, s  # noqa: F401

from girder.operators.spatial import boxes_met
from girder.plans import bulk_queries, driver_queries
from girder.plans.args import QueryError
from girder.plans.registry import run
from girder.plans.sql import FUNCTIONS, register_functions
from girder.queries import sheets
from girder.queries.sheets import visible_elements
from girder.sources.model import Model
from girder.sources.schema import TABLES

NAMES = ["b", "a", "B", "A", "é", "e", "Z", "10", "9", "É", "a"]
BY_CODE = ["10", "9", "A", "B", "Z", "a", "a", "b", "e", "É", "é"]
BY_UNICODE = ["10", "9", "a", "a", "A", "b", "B", "e", "é", "É", "Z"]


@pytest.fixture(scope="module")
def texts(spark, model):  # noqa: F811
    rows = {
        "rooms": [(HOST, k, f"r{k}", n, "", 1.0, None, None, None, None, None, None, {}) for k, n in enumerate(NAMES)],
        "views": [(HOST, k, f"v{k}", n, "Section", False, False, None, None, {}) for k, n in enumerate(NAMES)],
        "sheets": [(HOST, k, f"s{k}", n, "", None, False) for k, n in enumerate(NAMES)],
        "links": [(HOST, k, f"k{k}", n, None, k) for k, n in enumerate(NAMES)],
    }
    return Model(spark, dict(model.tables) | {t: spark.createDataFrame(r, TABLES[t]).repartition(3) for t, r in rows.items()})


@pytest.mark.parametrize(("query", "rows", "name"), [("get_rooms", "rooms", "number"), ("get_views", "views", "name"), ("get_sheets", "sheets", "sheet_number"), ("get_links", "links", "name")])
def test_collations(texts, query, rows, name):
    listed = lambda **args: [r[name] for r in run(texts, SESSION, query, args).to_dict()[rows]]
    assert listed() == listed(collation="") == listed(collation=7) == listed(collation="UTF8_BINARY") == BY_CODE
    assert listed(collation="unicode") == listed(collation="UNICODE") == BY_UNICODE
    if query != "get_links":
        assert listed(collation="UNICODE", limit=4) == BY_UNICODE[:4]
    with pytest.raises(QueryError, match="Unknown collation 'klingon'."):
        listed(collation="klingon")


def test_ties_of_a_collation_go_by_code_point_and_id(texts):
    rows = run(texts, SESSION, "get_rooms", {"collation": "UNICODE_CI_AI"}).to_dict()["rooms"]
    assert [(r["number"], r["id"]) for r in rows] == [("10", 7), ("9", 8), ("A", 3), ("a", 1), ("a", 10), ("B", 2), ("b", 0), ("e", 5), ("É", 9), ("é", 4), ("Z", 6)]


def test_a_collated_page_is_a_top_k(texts):
    from girder.functions.text import in_order

    plan = texts.rooms.orderBy(*in_order("number", "UNICODE"), "id").limit(3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


@pytest.fixture(scope="module")
def functions(model):  # noqa: F811
    assert set(register_functions(model, "fn_")) == {f"fn_{name}" for name in FUNCTIONS}
    return lambda text: sorted((tuple(r) for r in model.spark.sql(text).collect()), key=str)


@pytest.mark.parametrize(("name", "intersects"), [("elements_in_box", False), ("elements_meeting_box", True)])
def test_boxes_of_a_table_in_sql(functions, model, name, intersects):  # noqa: F811
    found = functions(f"SELECT b.doc_id, f.id, b.id FROM fn_scope_boxes b, LATERAL fn_{name}(b.doc_id, b.id) f")
    assert found == sorted((tuple(r) for r in boxes_met(model.elements, model.scope_boxes, intersects).collect()), key=str) and found
    for box in (60, 62):
        asked = {"scope_box_id": box, "element_ids": list(range(100, 110)), "mode": "intersects" if intersects else "centroid", "inside_only": True}
        want = sorted((r["id"],) for r in run(model, SESSION, "filter_elements_by_scope_box", asked).to_dict()["elements"])
        assert functions(f"SELECT id FROM fn_{name}({HOST}, {box})") == want


def test_keys_of_a_table_in_sql(functions, model):  # noqa: F811
    model.spark.createDataFrame([("u100",), ("dup",), ("both",), ("nope",), ("unloaded",), ("dup",)], "uid string").createOrReplaceTempView("asked")
    found = functions(f"SELECT a.uid, f.id, f.link_instance_id FROM asked a, LATERAL fn_element_by_uniqueid({HOST}, a.uid) f")
    page = run(model, SESSION, "get_element_by_uniqueid", {"unique_ids": ["u100", "dup", "both", "nope", "unloaded", "dup"]}).to_dict()["elements"]
    assert found == sorted(((r["unique_id"], r["id"], r.get("link_instance_id")) for r in page if r["found"]), key=str)
    model.spark.createDataFrame([("GUID",), ("x",), ("type-guid",)], "guid string").createOrReplaceTempView("guids")
    assert functions(f"SELECT g.guid, f.id FROM guids g, LATERAL fn_element_by_ifcguid({HOST}, g.guid) f") == [("GUID", 100)]


def test_stored_rooms_in_sql(functions):
    assert functions(f"SELECT element_id, side, room_id, number, level_name FROM fn_stored_rooms_of({HOST}, 2)") == [(100, "from", 1, "101", "Ground")]


def test_lateral_boxes_are_a_join(functions, model):  # noqa: F811
    plan = model.spark.sql("SELECT f.id, b.id FROM fn_scope_boxes b, LATERAL fn_elements_in_box(b.doc_id, b.id) f")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["elements_in_box", "elements_meeting_box"])
def test_lateral_boxes_meet_in_cells(functions, model, name):  # noqa: F811
    """Elements and boxes meet on cells, not on their document alone, which would test all pairs."""
    plan = model.spark.sql(f"SELECT f.id, b.id FROM fn_scope_boxes b, LATERAL fn_{name}(b.doc_id, b.id) f")._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join" in line and line.count(" cx#") + line.count("(cx#") >= 1 and "salt#" in line for line in plan.splitlines())


def test_elements_of_a_crowded_view(spark, model):  # noqa: F811
    """A view shows a third of all elements, some twice; ids are cut off below the shuffle, and what is wide is joined above it."""
    elements = [element(HOST, k, f"u{k}", "n", category=None if k % 5 == 0 else "Walls", ifc=f"g{k}", is_type=k % 7 == 0, params={"UNIFORMAT_CODE": s(f"c{k}")}) for k in range(900)]
    shown = [(HOST, 1, k) for k in range(0, 900, 3)] + [(HOST, 1, k) for k in range(0, 90, 3)] + [(HOST, 2, k) for k in range(4)] + [(HOST, 3, 5)]
    many = Model(spark, dict(model.tables) | {"elements": spark.createDataFrame(elements, TABLES["elements"]), "view_elements": spark.createDataFrame(shown, TABLES["view_elements"]).repartition(4)})
    views = spark.createDataFrame([(1,), (2,), (3,), (3,)], "view_id long")
    found = visible_elements(views, many, HOST, 20)
    listed = [k for k in range(900) if k % 5 and k % 7]
    want = [(1, r, f"u{k}", f"c{k}") for r, k in enumerate([k for k in listed if k % 3 == 0][:20], 1)] + [(2, r, f"u{k}", f"c{k}") for r, k in enumerate([1, 2, 3], 1)]
    assert sorted(tuple(r) for r in found.select("view_id", "rn", "unique_id", "classification.assembly_code").collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda word: [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in plan if word in line]
    limits = [i for i, line in enumerate(plan) if "WindowGroupLimit" in line]
    assert len(limits) == 2 and any("Exchange" in line for line in plan[limits[0] : limits[1]])
    assert all("params" not in line for line in plan[limits[0] : limits[1]]) and depth("WindowGroupLimit")


def test_elements_of_all_views(spark, model, monkeypatch):  # noqa: F811
    """Rows are dealt to as many tasks as they need, not as many as a shuffle has, and what is found is the same: a crowded view, elements shown twice, views that don't exist."""
    elements = [element(HOST, k, f"u{k}", "n", category=None if k % 5 == 0 else "Walls", ifc=f"g{k}" if k % 2 else "", is_type=k % 7 == 0, params={"UNIFORMAT_CODE": s(f"c{k}")} if k % 4 else {}) for k in range(900)]
    shown = [(HOST, 20, k) for k in range(0, 900, 3)] + [(HOST, 20, k) for k in range(0, 90, 3)] + [(HOST, 22, k) for k in range(4)] + [(HOST, 22, 5000), (HOST, 9999, 1)]
    shown += [(HOST, 22, k % 50 + 600) for k in range(100)]
    many = Model(spark, dict(model.tables) | {"elements": spark.createDataFrame(elements, TABLES["elements"]), "view_elements": spark.createDataFrame(shown, TABLES["view_elements"]).repartition(4)})
    columns = ["view_id", "rn", "unique_id", "ifc_guid", "classification"]
    want = sorted(map(str, visible_elements(many.of("views", HOST).select(F.col("id").alias("view_id")), many, HOST, 20).select(*columns).collect()))
    assert len(want) == 40 and "'c9'" in str(want)
    for rows, parts in ((100, 11), (10**6, None)):
        monkeypatch.setattr(sheets, "TASK_ROWS", rows)
        found = sheets.visible_elements_of_all(many, HOST, 20).select(*columns)
        assert sorted(map(str, found.collect())) == want
        assert parts is None or found.rdd.getNumPartitions() == parts


@pytest.mark.parametrize("name", ["view_elements_capped", "view_elements_of_all"])
def test_tasks_of_view_elements_are_bounded(spark, monkeypatch, name):
    """Queries over all views leave no more rows to a task of any shuffle than TASK_ROWS asks for, nearly."""
    monkeypatch.setattr(sheets, "TASK_ROWS", 500, raising=False)
    found = (driver_queries.QUERIES | bulk_queries.QUERIES)[name](spark, "/root/testdata/sf0.001")
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert found.rdd.getNumPartitions() >= 12 and max(sizes) <= 1000


def test_sheets_and_their_elements_are_as_before(model):  # noqa: F811
    got = json.loads(run(model, SESSION, "get_sheets", {"include_elements": True, "element_limit": 2}).text())["sheets"]
    assert [e["unique_id"] for e in got[0]["views"][0]["elements"]] == ["u100", "u101"] and got[0]["views"][0]["elements_truncated"]
