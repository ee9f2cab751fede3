"""Points, boxes and footprints, as expressions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def midpoint(box: Column) -> Column:
    return point(*[(box["min"][a] + box["max"][a]) * 0.5 for a in "xyz"])


def to_local(p: Column, inverse: list[float] | None) -> Column:
    """World to box coordinates. inverse: rows of a 3 x 4 affine matrix, or none."""
    if not inverse:
        return p
    row = lambda i: F.lit(inverse[4 * i]) * p["x"] + F.lit(inverse[4 * i + 1]) * p["y"] + F.lit(inverse[4 * i + 2]) * p["z"] + F.lit(inverse[4 * i + 3])
    return point(row(0), row(1), row(2))


def point_in_box(p: Column, least: dict, most: dict) -> Column:
    """All six faces belong to the box."""
    inside = F.lit(True)
    for a in "xyz":
        inside &= p[a].between(F.lit(least[a]), F.lit(most[a]))
    return inside


def centroid_in_box(location: Column, bbox: Column, least: dict, most: dict, inverse: list[float] | None) -> Column:
    """The location, else the middle of the bounding box, is inside; an element with neither isn't."""
    at = F.coalesce(location, F.when(bbox.isNotNull(), midpoint(bbox)))
    return F.coalesce(point_in_box(to_local(at, inverse), least, most), F.lit(False))


def corners(bbox: Column) -> Column:
    return F.array(*[point(bbox[i]["x"], bbox[j]["y"], bbox[k]["z"]) for k in ("min", "max") for j in ("min", "max") for i in ("min", "max")])


def intersects_box(bbox: Column, least: dict, most: dict, inverse: list[float] | None) -> Column:
    """A corner of the bounding box, or its middle, is inside. Not a full overlap test: an element around the box can be out."""
    inside = lambda p: point_in_box(to_local(p, inverse), least, most)
    hit = F.exists(corners(bbox), inside) | inside(midpoint(bbox))
    return F.coalesce(bbox.isNotNull() & hit, F.lit(False))


def facing_normal(facing: Column) -> tuple[Column, Column]:
    """The facing direction in the plane, of length 1; +y where it has none."""
    length = F.hypot(facing["x"], facing["y"])
    flat = length > 1e-6
    return F.when(flat, facing["x"] / length).otherwise(F.lit(0.0)), F.when(flat, facing["y"] / length).otherwise(F.lit(1.0))


def probes(location: Column, facing: Column, wall_width: Column) -> tuple[Column, Column]:
    """Points a little beyond either face of an opening: (from, to)."""
    nx, ny = facing_normal(facing)
    offset = F.coalesce(wall_width / 2 + 0.5, F.lit(1.0))
    return point(location["x"] + nx * offset, location["y"] + ny * offset, location["z"]), point(location["x"] - nx * offset, location["y"] - ny * offset, location["z"])


def in_footprint(x: Column, y: Column, footprint: Column) -> Column:
    """Whether a point is in a polygon, by ray casting. Of an edge the lower end belongs to it and the upper doesn't, so of rooms side by side one holds each point.

    An edge is taken from its lower end up, whichever way the polygon goes round, and the point is moved along it to that
    end: rooms on either side of an edge round alike.
    """
    n = F.size(footprint)
    after = F.concat(F.slice(footprint, 2, F.greatest(n - 1, F.lit(0))), F.slice(footprint, 1, 1))
    moved = lambda a, b: x - (b["x"] - a["x"]) / (b["y"] - a["y"]) * (y - F.least(a["y"], b["y"]))
    crossed = F.zip_with(footprint, after, lambda a,
        b: F.when(((a["y"] > y) != (b["y"] > y)) & (moved(a, b) < F.when(a["y"] < b["y"], a["x"]).otherwise(b["x"])), 1).otherwise(0))
    return F.when(n >= 3, F.aggregate(crossed, F.lit(0), lambda acc, c: acc + c) % 2 == 1).otherwise(F.lit(False))
