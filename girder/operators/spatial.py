"""Range joins in space, by grid cells."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from girder.functions.geometry import in_footprint, midpoint

from .quadtree import CELL as TREE_CELL
from .quadtree import LEAVES, finite, grown, reached

CELL = 10.0
#: Sizes of cells in a row of grids, each so many times the one before. Bounds go to the finest grid in which they span no more than that many cells, so they touch at most (SPAN + 1) ** 2.
GRIDS, SPAN = 5, 16


def _grid(extent: Column, cell: float) -> Column:
    """The grid for bounds of this extent."""
    found = F.lit(GRIDS - 1)
    for g in reversed(range(GRIDS - 1)):
        found = F.when(extent <= cell * SPAN ** (g + 1), g).otherwise(found)
    return found.cast("int")


def _cells(bounds: DataFrame, cell: float) -> DataFrame:
    """bounds (x0, y0, x1, y1) with g, cx and cy: a row for each cell that they touch."""
    size = F.lit(cell) * F.pow(F.lit(float(SPAN)), F.col("g"))
    gridded = bounds.withColumn("g", _grid(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), cell))
    span = lambda a: F.sequence(F.floor(F.col(f"{a}0") / size), F.floor(F.col(f"{a}1") / size))
    return gridded.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y"))).drop("x0", "y0", "x1", "y1")


def _placed(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """points with g, cx and cy: a row for each grid."""
    each = F.array(*[F.struct(F.lit(g).cast("int").alias("g"), F.floor(F.col(x) / (cell * SPAN**g)).alias("cx"),
        F.floor(F.col(y) / (cell * SPAN**g)).alias("cy")) for g in range(GRIDS)])
    return points.withColumn("__cell", F.explode(each)).select("*", "__cell.*").drop("__cell")


def rooms_at(points: DataFrame, rooms: DataFrame, cell: float = CELL) -> DataFrame:
    """key, room_id: the room around each point (key, doc_id, x, y, z), the one with the smallest id if several are; points outside all rooms are left out.

    Rooms are dealt to the grid cells that their bounds touch, large ones to coarser grids, which makes the range join an
    equi-join; the exact tests follow. A room's z bounds are half open, as its footprint is.
    """
    xs, ys = F.transform("footprint", lambda p: p["x"]), F.transform("footprint", lambda p: p["y"])
    bounds = rooms.where(F.size("footprint") >= 3).select("doc_id", F.col("id").alias("room_id"), "footprint", "z_min", "z_max", F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    high = (F.col("z") >= F.coalesce("z_min", F.col("z"))) & (F.col("z_max").isNull() | (F.col("z") < F.col("z_max")))
    met = _placed(points, cell).join(_cells(bounds, cell), ["doc_id", "g", "cx", "cy"]).where(high & in_footprint(F.col("x"), F.col("y"), F.col("footprint")))
    return met.groupBy("key").agg(F.min("room_id").alias("room_id"))


#: Boxes of a list whose cells, at most (SPAN + 1) ** 2 each, are broadcast; longer lists are joined as tables.
LISTED = 100


def elements_in_boxes(elements: DataFrame, boxes: list[dict], cell: float = 50.0) -> DataFrame:
    """Extension: doc_id, id, box_id of elements whose centroid is in one of many boxes of their document (rows of scope_boxes, collected), each pair once.

    Each box becomes a row of cells that its world bounds touch, in a grid coarse enough that they are few. The cells of
    a short list are broadcast, so elements aren't shuffled however many are in one cell; a long list is joined as a table.
    """
    spark = elements.sparkSession
    if len(boxes) > LISTED:
        table = spark.createDataFrame([tuple(b[c] for c in ("doc_id", "id", "min", "max", "inverse")) for b in boxes],
            "doc_id long, id long, min struct<x: double, y: double, z: double>, max struct<x: double, y: double, z: double>, inverse array<double>")
        return boxes_met(elements, table).distinct()
    rows = []
    for b in boxes:
        low, high = _world_bounds(b)
        rows.append((b["doc_id"], b["id"], low[0], low[1], high[0], high[1], [float(v) for a in ("min", "max") for v in b[a]], list(b["inverse"] or [])))
    side = spark.createDataFrame(rows, "doc_id long, box_id long, x0 double, y0 double, x1 double, y1 double, bounds array<double>, inverse array<double>")
    at = F.coalesce("location", F.when(F.col("bbox").isNotNull(), F.struct(*[((F.col(f"bbox.min.{a}") + F.col(f"bbox.max.{a}")) * 0.5).alias(a) for a in "xyz"])))
    placed = _placed(elements.select("doc_id", "id", at.alias("p")).where("p IS NOT NULL"), cell, "p.x", "p.y")
    m = [F.get("inverse", F.lit(i)) for i in range(12)]
    p = F.col("p")
    local = [F.when(F.size("inverse") == 0, p[a]).otherwise(m[4 * i] * p["x"] + m[4 * i + 1] * p["y"] + m[4 * i + 2] * p["z"] + m[4 * i + 3]) for i,
        a in enumerate("xyz")]
    inside = F.lit(True)
    for i, v in enumerate(local):
        inside &= v.between(F.get("bounds", F.lit(i)), F.get("bounds", F.lit(3 + i)))
    return placed.join(F.broadcast(_cells(side, cell)), ["doc_id", "g", "cx", "cy"]).where(inside).select("doc_id", "id", "box_id").distinct()


def _world_bounds(box: dict) -> tuple[list[float], list[float]]:
    """x and y bounds in world coordinates of a box with an inverse transform."""
    corners = np.array(list(itertools.product(*zip(box["min"], box["max"], strict=True))), float)
    if box["inverse"]:
        m = np.array(box["inverse"], float).reshape(3, 4)
        corners = np.linalg.solve(m[:, :3], (corners - m[:, 3]).T).T
    return corners.min(axis=0).tolist(), corners.max(axis=0).tolist()


def rooms_at_all(points: DataFrame, rooms: DataFrame, **growth) -> DataFrame:
    """As rooms_at, for tables of any size and shape: cells are split where a sample of the points is dense, and where one room holds very many, they are dealt over salts.

    A point is in one cell, so it is shuffled once and meets each room once.
    """
    xs, ys = F.transform("footprint", lambda p: p["x"]), F.transform("footprint", lambda p: p["y"])
    bounds = rooms.where(F.size("footprint") >= 3).select("doc_id", F.col("id").alias("room_id"), "footprint", "z_min", "z_max", F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    at = _held(points.select("doc_id", "key", *[F.col(a).alias(f"__{a}") for a in "xyz"]), {a: F.col(f"__{a}") for a in "xyz"})
    dots, bounds = finite(at.selectExpr("doc_id", "key", "x", "y", "z", "x x0", "y y0", "x x1", "y y1")), finite(bounds)
    tree = grown(dots, bounds, points=True, **growth)
    cell = [F.col(c) for c in TREE_CELL]
    dealt = tree.dealt(dots, F.col("key"), points=True).select(*cell, "key", "x", "y", "z")
    edges = ["x0", "y0", "x1", "y1"]
    copied = tree.copied(bounds).select(*cell, "room_id", "footprint", "z_min", "z_max", *edges)
    near = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    high = (F.col("z") >= F.coalesce("z_min", F.col("z"))) & (F.col("z_max").isNull() | (F.col("z") < F.col("z_max")))
    met = dealt.join(copied, TREE_CELL).where(near & high & in_footprint(F.col("x"), F.col("y"), F.col("footprint")))
    return met.groupBy("key").agg(F.min("room_id").alias("room_id"))


def _held(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once: they come out of a generator, so filters on them and uses of them aren't planned as copies of what they are made of."""
    return df.withColumn("__held", F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()])))).select("*", "__held.*").drop("__held")


def _world_sides(boxes: DataFrame, margin: float) -> DataFrame:
    """boxes with x0, y0, x1, y1, their bounds in the world with a margin for rounding, and as numbers turned, m0 to m11 and the bounds lx to hz in their own coordinates.

    The inverse of a turned box's inverse transform is made by cofactors; its middle and half of its extent go through it.
    Each step is on numbers, which stays in generated code.
    """
    m = [f"m{i}" for i in range(12)]
    flat = boxes.select("doc_id", F.col("id").alias("box_id"), (F.coalesce(F.size("inverse"), F.lit(0)) > 0).alias("turned"), *[F.get("inverse", F.lit(i)).alias(c) for i, c in enumerate(m)],
        *[F.col(f"{b}.{a}").alias(f"{e}{a}") for e, b in (("l", "min"), ("h", "max")) for a in "xyz"])
    at = lambda i, j: F.col(m[4 * (i % 3) + j % 3])
    minor = lambda i, j: at(i + 1, j + 1) * at(i + 2, j + 2) - at(i + 1, j + 2) * at(i + 2, j + 1)
    minors = {f"c{i}{j}": minor(i, j) for i in range(3) for j in range(2)}
    det = F.col("m0") * minors["c00"] + F.col("m1") * minors["c01"] + F.col("m2") * minor(0, 2)
    middle = [(F.col(f"l{a}") + F.col(f"h{a}")) / 2 - F.col(m[4 * i + 3]) for i, a in enumerate("xyz")]
    half = [F.abs(F.col(f"h{a}") - F.col(f"l{a}")) / 2 for a in "xyz"]
    sides, seen = _held(flat, minors | {"det": det}), {}
    total = lambda parts: parts[0] + parts[1] + parts[2]
    for k, a in enumerate("xy"):
        column = [F.col(f"c{i}{k}") / F.col("det") for i in range(3)]
        centre = F.when(F.col("turned"), total([c * v for c, v in zip(column, middle, strict=True)])).otherwise((F.col(f"l{a}") + F.col(f"h{a}")) / 2)
        reach = F.when(F.col("turned"), total([F.abs(c) * v for c, v in zip(column, half, strict=True)])).otherwise(half[k])
        # terms may cancel each other out: rounding is in proportion to their sizes
        size = F.when(F.col("turned"), total([F.abs(c * v) for c, v in zip(column, middle, strict=True)])).otherwise(F.lit(0.0)) + F.abs(centre) + reach
        seen |= {f"__c{a}": centre, f"__r{a}": reach + margin * (1 + size)}
    edge = {f"{a}{i}": F.col(f"__c{a}") + sign * F.col(f"__r{a}") for i, sign in ((0, -1), (1, 1)) for a in "xy"}
    return _held(_held(sides, seen), edge).select("doc_id", "box_id", "turned", *m, *[f"{e}{a}" for e in "lh" for a in "xyz"], *edge)


def _in_box(at: dict[str, Column]) -> tuple[Column, Column]:
    """Whether a point is in a box of _world_sides, if it is turned and if it isn't."""
    m = [F.col(f"m{i}") for i in range(12)]
    turned, straight = F.lit(True), F.lit(True)
    for i, a in enumerate("xyz"):
        own = m[4 * i] * at["x"] + m[4 * i + 1] * at["y"] + m[4 * i + 2] * at["z"] + m[4 * i + 3]
        turned &= own.between(F.col(f"l{a}"), F.col(f"h{a}"))
        straight &= at[a].between(F.col(f"l{a}"), F.col(f"h{a}"))
    return turned, straight


#: Ids of boxes alike that one row holds, about.
IDS = 1000


def _alike(sides: DataFrame, ids: int = IDS) -> DataFrame:
    """Boxes of _world_sides with box_ids instead of box_id: one row for all boxes of a document with the same numbers, or as many rows as keep box_ids to about so many each.

    Numbers that more boxes share are dealt over parts by a hash of the id, so neither a row nor a task grows with them.
    """
    spark, numbers = sides.sparkSession, [c for c in sides.columns if c != "box_id"]
    hashed = sides.withColumn("__hash", F.xxhash64(*numbers))
    crowded = hashed.groupBy("__hash").count().where(F.col("count") > ids).orderBy(F.desc("count")).limit(LEAVES).collect()
    parts = spark.createDataFrame([(h, -(-n // ids)) for h, n in crowded], "__hash long, __parts long")
    part = F.pmod(F.xxhash64("box_id"), F.coalesce("__parts", F.lit(1)))
    dealt = hashed.join(F.broadcast(parts), "__hash", "left").withColumn("__part", part)
    same = Window.partitionBy("__hash", "__part", *numbers).orderBy("box_id")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = dealt.select(*numbers, F.collect_list("box_id").over(whole).alias("box_ids"), F.row_number().over(same).alias("__rank"))
    return held.where("__rank = 1").drop("__rank")


def boxes_met(elements: DataFrame, boxes: DataFrame, intersects: bool = False, keep: tuple[str, ...] = (), **growth) -> DataFrame:
    """doc_id, id, box_id, and columns to keep of elements: the elements in each scope box of their document, for tables of any size: by centroid, or by corners and middle of bounding boxes.

    Elements and boxes go to the cells of a tree that their bounds touch. Bounds that overlap do so in several cells, but
    the lower left corner of what they share is in one, and only there a pair is tested, so none comes up twice. Tests are
    on numbers, not arrays, which keeps them in generated code. Boxes with the same numbers are tested once, and only what
    is found is written out for each of them; elements beyond the bounds of all boxes aren't dealt out.
    """
    sides = _alike(finite(_world_sides(boxes.where("min IS NOT NULL AND max IS NOT NULL"), 1e-9)))
    if intersects:
        named = {f"{e}{a}": F.col(f"bbox.{b}.{a}") for e, b in (("p", "min"), ("q", "max")) for a in "xyz"}
        corners_of = _held(elements.where("bbox IS NOT NULL").select("doc_id", "id", *keep, "bbox"), named).drop("bbox")
        edges = {f"{a}{i}": edge(f"p{a}", f"q{a}") for i, edge in enumerate((F.least, F.greatest)) for a in "xy"}
        kept = _held(corners_of, edges)
    else:
        at = F.coalesce("location", F.when(F.col("bbox").isNotNull(), midpoint(F.col("bbox"))))
        named = {f"p{a}": F.col(f"what.{a}") for a in "xyz"}
        kept = _held(elements.select("doc_id", "id", *keep, at.alias("what")).where("what IS NOT NULL"), named).drop("what").selectExpr("*", "px x0", "py y0", "px x1", "py y1")
    slim = reached(finite(kept), sides)
    tree = grown(slim, sides, points=not intersects, **growth)
    edges = ["x0", "y0", "x1", "y1"]
    few = tree.copied(sides).withColumnsRenamed({c: f"b_{c}" for c in edges})
    both = tree.dealt(slim, F.col("id"), points=not intersects).join(few, TREE_CELL)
    x, y = F.greatest("x0", "b_x0"), F.greatest("y0", "b_y0")
    here = (x <= F.least("x1", "b_x1")) & (y <= F.least("y1", "b_y1")) & tree.holds(x, y)
    p = {a: F.col(f"p{a}") for a in "xyz"}
    if intersects:
        q = {a: F.col(f"q{a}") for a in "xyz"}
        turned, straight = _in_box({a: (p[a] + q[a]) * 0.5 for a in "xyz"})
        either = F.lit(True)  # of a box along the axes: a corner is in it if one of either coordinate is, along each
        for a in "xyz":
            either &= p[a].between(F.col(f"l{a}"), F.col(f"h{a}")) | q[a].between(F.col(f"l{a}"), F.col(f"h{a}"))
        straight |= either
        for k, j, i in itertools.product((p, q), repeat=3):
            turned |= _in_box({"x": i["x"], "y": j["y"], "z": k["z"]})[0]
    else:
        turned, straight = _in_box(p)
    # one generated method with all nine points is too long for the JVM to compile; beside a lambda, Spark makes a method of each part of a condition instead
    is_turned = F.exists(F.array("turned"), lambda t: t) if intersects else F.col("turned")
    return both.where(here).where(F.when(is_turned, turned).otherwise(straight)).select("doc_id", "id", F.explode("box_ids").alias("box_id"), *keep)
