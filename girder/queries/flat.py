"""Revision, project information, rooms, levels, views and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from girder.functions.identity import document_key
from girder.functions.text import blank, filled, in_order
from girder.operators.listing import page
from girder.plans import args as A
from girder.plans.args import QueryError
from girder.plans.result import Result, drop_empty, projected
from girder.sources.model import Model, Session

from .common import NO_DOCUMENT, active, collation, with_level


def _document(model: Model, session: Session) -> DataFrame:
    df = model.of("documents", active(session))
    if df.limit(1).isEmpty():
        raise QueryError(NO_DOCUMENT)
    return df


def get_model_revision(model: Model, session: Session, args: dict) -> Result:
    df = _document(model, session)
    return Result(df.select("title", filled(F.col("path")).alias("path"), "version_guid", "number_of_saves", F.col("is_modified").alias("has_unsaved_changes"),
        "is_workshared"))


def get_project_info(model: Model, session: Session, args: dict) -> Result:
    df = _document(model, session)
    info = F.col("project_info")
    name = F.coalesce(filled(info["name"]), blank(F.col("title"))).alias("name")
    return Result(df.select(name, *[blank(info[c]).alias(c) for c in ("number", "client", "address", "building")], blank(F.col("title")).alias("title"),
        blank(F.col("path")).alias("path")))


def _listing(df: DataFrame, order: list, limit: int, model: Model) -> tuple[DataFrame, dict]:
    """A page with levels, which are looked up for its rows only, and the envelope's counts."""
    found = page(df, order, limit)
    numbered = found.df.withColumn("__pos", F.row_number().over(Window.orderBy(*order)))
    return with_level(numbered, model).orderBy("__pos"), {"total": found.total, "count": found.count, "truncated": found.count < found.total}


def get_rooms(model: Model, session: Session, args: dict) -> Result:
    rooms = model.of("rooms", active(session)).drop("footprint")
    if not A.flag(args, "include_unplaced"):
        rooms = rooms.where((F.col("area_sf") > 0) & ~F.isnan("area_sf"))
    df, envelope = _listing(rooms, [*in_order("number", collation(model, args)), "id"], A.limit(args), model)
    fields = A.fields(args)
    rows = df.select("unique_id", "id", "number", "name", "area_sf", "area_user_units", "level")
    return Result(rows, envelope, "rooms", lambda r: projected(drop_empty(r, "area_user_units", "level"), fields))


def get_levels(model: Model, session: Session, args: dict) -> Result:
    df = model.of("levels", active(session)).orderBy("elevation_ft", "id").select("unique_id", "id", "name", "elevation_ft", "elevation_user_units")
    return Counted(df, {}, "levels")


class Counted(Result):
    """A listing without a limit: count is how many rows it has."""

    def to_dict(self) -> dict:
        rows = super().to_dict()[self.rows_key]
        return {"count": len(rows), **self.envelope, self.rows_key: rows}


def get_views(model: Model, session: Session, args: dict) -> Result:
    views = model.of("views", active(session)).where(~F.col("is_template") & ~F.col("is_sheet"))
    if wanted := A.text(args, "view_type"):
        kind = next((v for v in session.view_types if v.lower() == wanted.strip().lower()), None)
        if kind is None:
            raise QueryError(f"Unknown ViewType '{wanted}'. Valid values: {', '.join(session.view_types)}.")
        views = views.where(F.col("view_type") == kind)
    by = collation(model, args)
    df, envelope = _listing(views, [*in_order("view_type", by), *in_order("name", by), "id"], A.limit(args), model)
    fields = A.fields(args)
    return Result(df.select("unique_id", "id", "name", "view_type", "level"), envelope, "views", lambda r: projected(drop_empty(r, "level"), fields))


def get_links(model: Model, session: Session, args: dict) -> Result:
    links = model.of("links", active(session))
    targets = model.documents.select(F.col("doc_id").alias("__doc"), F.col("title"), document_key().alias("project_key"))
    df = links.join(targets, links["target_doc_id"] == targets["__doc"], "left").select("unique_id", "id", "name", F.col("__doc").isNotNull().alias("loaded"),
        "title", "project_key").orderBy(*in_order("name", collation(model, args)), "id")

    def row(r: dict) -> dict:
        return r if r["loaded"] else {k: r[k] for k in ("unique_id", "id", "name", "loaded")}

    return Counted(df, {}, "links", row)

