"""Which elements are inside a scope box."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from girder.functions.geometry import centroid_in_box, intersects_box
from girder.functions.text import same_text
from girder.operators.listing import page
from girder.operators.lookup import enrich
from girder.plans import args as A
from girder.plans.args import QueryError
from girder.plans.result import Result
from girder.sources.model import Model, Session

from .common import active, candidates, with_level


#: Where a document's ids are.
IDS = {"elements": "id", "element_types": "type_id", "levels": "id", "rooms": "id", "views": "id", "sheets": "id", "phases": "id", "links": "id"}


def _names_something(model: Model, doc: int, number: int) -> bool:
    found = [model.of(t, doc).where(F.col(c) == number).select(F.col(c).alias("id")) for t, c in IDS.items()]
    return not reduce(DataFrame.union, found).limit(1).isEmpty()


def resolve_box(model: Model, session: Session, args: dict) -> Row:
    """The box asked for, by id or else by name; a given id that resolves to nothing isn't followed by the name."""
    doc = active(session)
    boxes = model.of("scope_boxes", doc)
    number, name = A.long(args, "scope_box_id"), A.text(args, "scope_box_name")
    if number is not None:
        box = boxes.where(F.col("id") == number).first()
        if box is None and _names_something(model, doc, number):
            raise QueryError(f"Element {number} is not a scope box (OST_VolumeOfInterest).")
    else:
        box = boxes.where(same_text(F.col("name"), name)).orderBy("id").first() if name is not None else None
    if box is None:
        raise QueryError("Provide scope_box_id or scope_box_name that resolves to a scope box.")
    if box["min"] is None or box["max"] is None:
        raise QueryError(f"Scope box {box['id']} has no bounding box.")
    return box


def in_box(box: Row, intersects: bool):
    """The membership test of a box, as an expression over location and bbox with the box's numbers as literals."""
    least, most = box["min"].asDict(), box["max"].asDict()
    if intersects:
        return intersects_box(F.col("bbox"), least, most, box["inverse"])
    return centroid_in_box(F.col("location"), F.col("bbox"), least, most, box["inverse"])


def tested(model: Model, session: Session, args: dict, limit: int) -> tuple[Row, bool, DataFrame]:
    """The box, whether bounding boxes are tested, and the candidates within the limit, each with in_box."""
    box = resolve_box(model, session, args)
    intersects = (A.text(args, "mode") or "").lower() == "intersects"
    rows = candidates(model, session, args, None).withColumn("in_box", in_box(box, intersects))
    slim = rows.select("pos", "doc_id", "id", "name", "category", "in_box", "design_option", "level_id", "params")
    found = page(slim, ["pos", "id"], limit).df
    return box, intersects, found


def filter_elements_by_scope_box(model: Model, session: Session, args: dict) -> Result:
    box, intersects, found = tested(model, session, args, A.number_limit(args, 1000, 10_000))
    n_in, n = found.agg(F.count_if("in_box"), F.count(F.lit(1))).first()
    if A.flag(args, "inside_only"):
        found = found.where("in_box")
    numbered = found.withColumn("__pos", F.struct("pos", "id"))
    full = enrich(with_level(numbered, model), model.documents, {"doc_id": "doc_id"}, [F.col("is_linked").alias("from_link"), F.col("title").alias("project")])
    rows = full.orderBy("__pos").select("id", "name", "category", "in_box", "design_option", "level", "from_link", "project")
    envelope = {"scope_box": {"id": box["id"], "name": box["name"]}, "mode": "intersects" if intersects else "centroid", "count_in": n_in, "count_out": n - n_in}
    return Result(rows, envelope, "elements")
