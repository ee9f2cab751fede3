"""Range joins by a tree of cells, against all pairs, and how evenly they are dealt."""

import math
import random

import pytest
from pyspark.sql import functions as F

from girder.functions.geometry import in_footprint
from girder.operators import quadtree, spatial
from girder.operators.spatial import boxes_met, elements_in_boxes, rooms_at, rooms_at_all
from girder.sources.schema import TABLES

POINTS = "doc_id long, key long, x double, y double, z double"


def areas(points):
    return quadtree.finite(points.selectExpr("doc_id", "key", "x", "y", "x x0", "y y0", "x x1", "y y1"))


def table(spark, name, rows):
    """Rows of dicts as a table; columns that they lack are null."""
    names = [f.name for f in TABLES[name]]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLES[name])


def city(seed=1, n=3000):
    """Points of three documents, a third of them in one small place; rooms small and large, slanted, without footprint, and one over another."""
    rng = random.Random(seed)
    points = [(rng.choice([1, 1, 2]), k, *((rng.uniform(3, 9), rng.uniform(-4, 2)) if k % 3 == 0 else (rng.uniform(-500, 500), rng.uniform(-90, 900))), rng.uniform(0, 20)) for k in range(n)]
    points += [(3, n, 1e7, -1e7, 0.0), (3, n + 1, 5.0, 5.0, 1.0), (1, n + 4, math.nan, 0.0, 0.0), (1, n + 5, math.inf, 0.0, 0.0), (4, n + 2, 0.0, 0.0, 0.0), (1, n + 3, 5.0, 0.0, 1.0)]
    rooms = []
    for k in range(300):
        x, y, w, h, s = rng.uniform(-500, 500), rng.uniform(-90, 900), rng.choice([2, 8, 30, 400]), rng.choice([3, 9, 50]), rng.uniform(-3, 3)
        corners = [(x, y), (x + w, y), (x + w + s, y + h), (x + s, y + h)]
        rooms.append({"doc_id": rng.choice([1, 2, 3]), "id": k, "footprint": None if k % 17 == 0 else corners, "z_min": rng.choice([None, 2.0]), "z_max": rng.choice([None, 12.0])})
    rooms += [{"doc_id": 1, "id": 900, "footprint": [(0.0, -5.0), (10.0, -5.0), (10.0, 5.0), (0.0, 5.0)]}, {"doc_id": 3, "id": 901, "footprint": [(1.0, 1.0), (1e6, 1.0), (1e6, 1e6)]}]
    return points, rooms


@pytest.mark.parametrize("growth", [{}, {"parts": 4000, "least": 0.5}, {"sample": 1}])
def test_rooms_of_all_points(spark, growth):
    """Whatever the tree, the rooms are those of the plain test on all pairs."""
    points, rooms = city()
    dots, places = spark.createDataFrame(points, POINTS), table(spark, "rooms", rooms)
    high = (F.col("z") >= F.coalesce("z_min", F.col("z"))) & (F.col("z_max").isNull() | (F.col("z") < F.col("z_max")))
    pairs = dots.join(places.select("doc_id", "id", "footprint", "z_min", "z_max"), "doc_id").where((F.size("footprint") >= 3) & high & in_footprint(F.col("x"), F.col("y"), F.col("footprint")))
    want = {r["key"]: r["room"] for r in pairs.groupBy("key").agg(F.min("id").alias("room")).collect()}
    found = {r["key"]: r["room_id"] for r in rooms_at_all(dots, places, **growth).collect()}
    assert found == want and len(want) > 500


def test_pages_and_tables_agree(spark):
    points, rooms = city(2, 500)
    dots, places = spark.createDataFrame(points, POINTS), table(spark, "rooms", [r for r in rooms if r["id"] != 901])
    assert sorted(map(tuple, rooms_at_all(dots, places).collect())) == sorted(map(tuple, rooms_at(dots, places).collect()))
    assert rooms_at_all(dots.limit(0), places).count() == rooms_at_all(dots, places.limit(0)).count() == 0


def test_each_point_is_dealt_once_and_evenly(spark):
    """A third of all points in one room: the fullest of 32 partitions has no more than three times the rows of the median."""
    points, _ = city(3, 30_000)
    dots = areas(spark.createDataFrame(points, POINTS))
    tree = quadtree.grown(dots, dots.limit(0))
    assert tree.salts and tree.split
    dealt = tree.dealt(dots, F.col("key"), points=True)
    as_areas = tree.dealt(dots, F.col("key"))
    assert sorted(map(tuple, as_areas.select("key", *quadtree.CELL).collect())) == sorted(map(tuple, dealt.select("key", *quadtree.CELL).collect()))
    assert dealt.count() == len(points) - 2 == dealt.where(tree.holds(F.col("x"), F.col("y"))).count()
    sizes = sorted(r["count"] for r in dealt.repartition(32, *quadtree.CELL).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 32 and sizes[-1] <= 3 * sizes[16]
    plain = dots.repartition(32, "doc_id", F.floor(F.col("x") / 10), F.floor(F.col("y") / 10)).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in plain) > 3 * sizes[16]


def test_a_tree_is_bounded(spark):
    points = [(1, k, random.Random(k).gauss(0, 100), random.Random(-k).gauss(0, 100), 0.0) for k in range(5000)]
    dots = areas(spark.createDataFrame(points, POINTS))
    tree = quadtree.grown(dots, dots, parts=16, sample=1000)
    assert len(tree.split) < 16 * 4 * quadtree.DEPTH and all(math.isfinite(tree.width(c[1])) for c in tree.split)
    assert not quadtree.grown(dots.limit(0), dots.limit(0)).split


def boxes_and_elements(seed=4):
    rng = random.Random(seed)
    boxes, elements = [], []
    for k in range(60):
        at, half = [rng.uniform(-100, 300), rng.uniform(-50, 100), rng.uniform(0, 10)], [rng.choice([1, 5, 80]), rng.choice([2, 20]), rng.choice([3, 8])]
        turn = rng.uniform(0, math.pi) if k % 2 else None
        low, high = [-h for h in half] if turn else [a - h for a, h in zip(at, half, strict=True)], half if turn else [a + h for a, h in zip(at, half, strict=True)]
        inverse = None
        if turn:
            c, s = math.cos(turn), math.sin(turn)
            tilt = [[c, s, 0.0], [-s * 0.8, c * 0.8, 0.6], [s * 0.6, -c * 0.6, 0.8]]
            inverse = [v for row in tilt for v in (*row, -sum(r * a for r, a in zip(row, at, strict=True)))]
        boxes.append({"doc_id": rng.choice([1, 2]), "id": k, "name": "b", "min": None if k % 20 == 9 else tuple(map(float, low)), "max": tuple(map(float, high)), "inverse": inverse})
    for k in range(1500):
        at = [rng.uniform(-120, 320), rng.uniform(-60, 110), rng.uniform(-5, 15)] if k % 3 else [rng.uniform(0, 4), rng.uniform(0, 4), rng.uniform(0, 9)]
        half = [rng.choice([0.0, 1.0, 30.0]) for _ in range(3)]
        box = (tuple(a - h for a, h in zip(at, half, strict=True)), tuple(a + h for a, h in zip(at, half, strict=True)))
        elements.append({"doc_id": rng.choice([1, 2, 3]), "id": k, "location": None if k % 5 == 0 else tuple(at), "bbox": None if k % 7 == 0 else box})
    return boxes, elements


def brute(boxes, elements, intersects):
    def tested(e):
        mid = e["bbox"] and tuple((a + b) * 0.5 for a, b in zip(*e["bbox"], strict=True))
        if intersects:
            return [(e["bbox"][i][0], e["bbox"][j][1], e["bbox"][k][2]) for i in (0, 1) for j in (0, 1) for k in (0, 1)] + [mid] if mid else []
        return [p for p in (e["location"] or mid,) if p]

    def inside(b, p):
        if m := b["inverse"]:
            p = [m[4 * i] * p[0] + m[4 * i + 1] * p[1] + m[4 * i + 2] * p[2] + m[4 * i + 3] for i in range(3)]
        return all(lo <= v <= hi for lo, v, hi in zip(b["min"], p, b["max"], strict=True))

    return sorted((e["doc_id"], e["id"], b["id"]) for e in elements for b in boxes if b["doc_id"] == e["doc_id"] and b["min"] and any(inside(b, p) for p in tested(e)))


@pytest.mark.parametrize("intersects", [False, True])
@pytest.mark.parametrize("growth", [{}, {"parts": 2000, "least": 4.0}])
def test_all_elements_by_all_boxes(spark, intersects, growth):
    """Each pair once, though bounds share many cells."""
    boxes, elements = boxes_and_elements()
    found = boxes_met(table(spark, "elements", elements), table(spark, "scope_boxes", boxes), intersects, **growth)
    want = brute(boxes, elements, intersects)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_boxes_of_a_table_as_of_a_list(spark):
    boxes, elements = boxes_and_elements(5)
    boxes = [b for b in boxes if b["min"]]
    rows = table(spark, "elements", elements)
    listed = elements_in_boxes(rows, [{**b, "min": b["min"], "max": b["max"]} for b in boxes])
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, boxes_met(rows, table(spark, "scope_boxes", boxes)).collect()))


def test_pairs_need_no_distinct(spark):
    boxes, elements = boxes_and_elements()
    plan = boxes_met(table(spark, "elements", elements), table(spark, "scope_boxes", boxes), True)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("points", [True, False])
def test_a_cell_holds_few_pairs_whatever_the_size(spark, points):
    """Cells that hold many areas are divided: as many times the areas make as many times the pairs, not their square."""
    pairs = []
    for n in (32, 64):
        many = spark.range(n * n).selectExpr("1L AS doc_id", "id AS key", f"id % {n} * 10 + 5.0D AS x0", f"floor(id / {n}) * 10 + 5.0D AS y0").selectExpr("*", f"x0 + {0 if points else 3} AS x1", f"y0 + {0 if points else 3} AS y1")
        few = spark.range(n * n).selectExpr("1L AS doc_id", "id AS room", f"id % {n} * 10.0D AS x0", f"floor(id / {n}) * 10.0D AS y0").selectExpr("*", "x0 + 9 AS x1", "y0 + 9 AS y1")
        tree = quadtree.grown(many, few, parts=8, points=points)
        dealt, copied = tree.dealt(many, F.col("key"), points=points).select(*quadtree.CELL, "key"), tree.copied(few).select(*quadtree.CELL, "room")
        met = dealt.join(copied, quadtree.CELL)
        pairs.append(met.count() / (n * n))
        assert met.select("key").distinct().count() == n * n and copied.count() <= 5 * n * n and dealt.count() <= 3 * n * n
    assert pairs[0] <= 16 and pairs[1] <= 1.3 * pairs[0]


def test_elements_of_a_short_list_of_boxes_stay_where_they_are(spark):
    """Most elements share a coarse cell: they meet a list's boxes without a shuffle, only pairs are shuffled."""
    boxes, elements = boxes_and_elements(6)
    found = elements_in_boxes(table(spark, "elements", elements), [b for b in boxes if b["min"]])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_rooms_side_by_side_round_alike(spark):
    """(299.65, 99.3) is a little to the left of the slanted edge from (250, 0) to (300, 100); each point near an edge is in the one room that the edge's formula gives."""
    rooms = [{"doc_id": 1, "id": k, "footprint": [(10.0 * k + dx + y / 2, y) for dx, y in ((0, 0.0), (10, 0.0), (10, 100.0), (0, 100.0))]} for k in range(50)]
    points = [(1, 0, 299.65, 99.3, 0.0)] + [(1, 1000 * k + j, round(10 * k + j / 20, 2), j / 10, 0.0) for k in range(1, 50) for j in range(1, 1000, 7)]
    places, dots = table(spark, "rooms", rooms), spark.createDataFrame(points, POINTS)
    want = {key: math.floor((x - y / 2) / 10) for _, key, x, y, _ in points}
    pairs = dots.join(places.select("doc_id", "id", "footprint"), "doc_id").where(in_footprint(F.col("x"), F.col("y"), F.col("footprint")))
    assert pairs.count() == len(points)
    for found in (rooms_at(dots, places), rooms_at_all(dots, places)):
        assert {r["key"]: r["room_id"] for r in found.collect()} == want and want[0] == 24


@pytest.mark.parametrize("intersects", [False, True])
def test_boxes_alike_are_tested_once(spark, intersects):
    """Copies of boxes make as many times the pairs, but no more rows that meet elements; a row holds few ids though very many boxes are alike."""
    boxes, elements = boxes_and_elements(7)
    copies = [{**b, "id": b["id"] + 100 * k} for k in range(20) for b in boxes]
    once, rows = table(spark, "scope_boxes", boxes), table(spark, "scope_boxes", copies)
    sides = [spatial._alike(spatial._world_sides(t.where("min IS NOT NULL"), 1e-9)) for t in (once, rows)]
    assert sides[0].count() == sides[1].count() == len([b for b in boxes if b["min"]])
    ids = lambda side: sorted(i for r in side.select("box_ids").collect() for i in r[0])
    want = sorted(b["id"] for b in copies if b["min"])
    few = spatial._alike(spatial._world_sides(rows.where("min IS NOT NULL"), 1e-9), ids=4)
    assert ids(sides[1]) == ids(few) == want and max(len(r[0]) for r in few.select("box_ids").collect()) <= 13
    found = sorted(map(tuple, boxes_met(table(spark, "elements", elements), rows, intersects).collect()))
    assert found == sorted((d, e, b + 100 * k) for d, e, b in brute(boxes, elements, intersects) for k in range(20))


def test_elements_beyond_all_boxes_stay_where_they_are(spark):
    boxes, _ = boxes_and_elements(8)
    far = [{"doc_id": 1, "id": k, "location": (1e6 + k, 5.0, 1.0)} for k in range(50)] + [{"doc_id": 1, "id": 99, "location": (50.0, 0.0, 1.0)}]
    sides = spatial._world_sides(table(spark, "scope_boxes", boxes).where("min IS NOT NULL"), 1e-9)
    dots = table(spark, "elements", far).selectExpr("doc_id", "id", "location.x x0", "location.y y0", "location.x x1", "location.y y1")
    assert [r["id"] for r in quadtree.reached(dots, sides).collect()] == [99] and quadtree.reached(dots, sides.limit(0)).count() == 0
    assert boxes_met(table(spark, "elements", far[:50]), table(spark, "scope_boxes", boxes)).count() == 0
