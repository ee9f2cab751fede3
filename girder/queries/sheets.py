"""Sheets with their views, and the elements visible in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from girder.functions import params as P
from girder.functions.text import filled, in_order, same_text
from girder.operators.listing import page
from girder.plans import args as A
from girder.plans.result import Result, drop_empty, projected
from girder.sources.model import Model, Session

from .common import active, collation


def placed_views(sheets: DataFrame, model: Model, doc: int) -> DataFrame:
    """Viewports of a bounded page of sheets, with their views; those that resolve to no view are left out."""
    ports = model.of("viewports", doc).join(F.broadcast(sheets.select(F.col("id").alias("sheet_id"))), "sheet_id", "left_semi").select("sheet_id", "view_id", "ordinal")
    views = model.of("views", doc).select(F.col("id").alias("view_id"), F.col("unique_id"), F.col("name"), "view_type")
    return ports.join(views, "view_id")


def visible_elements(views: DataFrame, model: Model, doc: int, cap: int) -> DataFrame:
    """view_id, rn, unique_id, ifc_guid, classification: the first cap elements with a category of each view, in ascending id.

    Only ids are ranked, and in each task before they are shuffled, so a view that shows a third of all elements sends cap
    rows from each task. What else is known of elements meets the rows that are left.
    """
    shown = model.of("view_elements", doc).join(views.select("view_id").distinct(), "view_id", "left_semi").select("view_id", "element_id")
    listed = model.of("elements", doc).where(~F.col("is_type") & F.col("category").isNotNull())
    known = shown.join(listed.select(F.col("id").alias("element_id")), "element_id", "left_semi")
    rank = F.dense_rank().over(Window.partitionBy("view_id").orderBy("element_id")).alias("rn")  # an element that a view shows twice has one rank
    ranked = known.select("view_id", "element_id", rank).where(F.col("rn") <= cap).distinct()
    elements = listed.select(F.col("id").alias("__element"), "unique_id", "ifc_guid", "type_id", "params")
    types = model.of("element_types", doc).select(F.col("type_id").alias("__type"), F.col("params").alias("type_params"))
    full = ranked.join(elements, F.col("element_id") == F.col("__element")).join(types, F.col("type_id") == F.col("__type"), "left")
    return full.select("view_id", "rn", "unique_id", filled(F.col("ifc_guid")).alias("ifc_guid"),
        P.classification(F.col("type_params"), F.col("params")).alias("classification"))


#: Rows of views' elements, and elements, for each task.
TASK_ROWS = 1_000_000


def _dealt(df: DataFrame, parts: int, *by: str) -> DataFrame:
    """df in so many parts, which AQE doesn't put together again, and in no fewer than a shuffle has, as joins would take that number instead; where one would do, Spark decides."""
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *by) if parts > 1 else df


def visible_elements_of_all(model: Model, doc: int, cap: int) -> DataFrame:
    """As visible_elements, for all views of a document: what a task sorts is bounded, whatever the number of rows and the session's number of partitions.

    Rows are counted and dealt to as many tasks as they need. A view's elements are ranked in stripes first, each of which
    goes to a task of its own, so a view that shows a third of all elements sends cap rows from each stripe. Views are
    looked up for the rows that are left, and of parameters only labels meet them.
    """
    shown = model.of("view_elements", doc).select("view_id", "element_id")
    listed = model.of("elements", doc).where(~F.col("is_type") & F.col("category").isNotNull())
    parts = -(-(shown.count() + listed.count()) // TASK_ROWS)
    # inner joins: Spark moves a semi-join below what deals out its rows. Pairs that come twice by them have one rank and stay once
    known = _dealt(shown, parts, "element_id").join(listed.select(F.col("id").alias("element_id")), "element_id")
    striped = _dealt(known.withColumn("stripe", F.pmod(F.hash("element_id"), F.lit(max(1, parts)))), parts, "view_id", "stripe")
    first = F.dense_rank().over(Window.partitionBy("view_id", "stripe").orderBy("element_id"))
    left = _dealt(striped.withColumn("rn", first).where(F.col("rn") <= cap).select("view_id", "element_id"), parts, "view_id")
    viewed = left.join(model.of("views", doc).select(F.col("id").alias("view_id")), "view_id")
    whole = Window.partitionBy("view_id").orderBy("element_id")
    ranks = viewed.withColumns({"rn": F.dense_rank().over(whole), "again": F.coalesce(F.lag("element_id").over(whole) == F.col("element_id"), F.lit(False))})
    ranked = ranks.where((F.col("rn") <= cap) & ~F.col("again")).drop("again")
    types = model.of("element_types", doc).select(F.col("type_id").alias("__type"), P.labels(F.col("params")).alias("__of_type"))
    elements = listed.select(F.col("id").alias("__element"), "unique_id", filled(F.col("ifc_guid")).alias("ifc_guid"), "type_id", P.labels(F.col("params")).alias("__own"))
    described = elements.join(types, F.col("type_id") == F.col("__type"), "left").select("__element", "unique_id", "ifc_guid",
        P.classified(F.col("__of_type"), F.col("__own")).alias("classification"))
    full = _dealt(ranked, parts, "element_id").join(_dealt(described, parts, "__element"), F.col("element_id") == F.col("__element"))
    return full.select("view_id", "rn", "unique_id", "ifc_guid", "classification")


def get_sheets(model: Model, session: Session, args: dict) -> Result:
    doc = active(session)
    sheets = model.of("sheets", doc).where(~F.col("is_template"))
    if number := A.text(args, "sheet_number"):
        sheets = sheets.where(same_text(F.col("sheet_number"), number))
    order = [*in_order("sheet_number", collation(model, args)), "id"]
    found = page(sheets, order, A.limit(args, 100, 500))
    with_elements, cap, fields = A.flag(args, "include_elements"), A.limit(args, 100, 1000, "element_limit"), A.fields(args)
    views = placed_views(found.df, model, doc)
    columns = [F.col("unique_id"), F.col("name"), F.col("view_type")]
    if with_elements:
        each = visible_elements(views, model, doc,
            cap).groupBy("view_id").agg(F.sort_array(F.collect_list(F.struct("rn", "unique_id", "ifc_guid", "classification"))).alias("elements"))
        views = views.join(each, "view_id", "left").withColumn("elements", F.coalesce("elements", F.array().cast(each.schema["elements"].dataType)))
        columns += [F.col("elements"), (F.size("elements") == cap).alias("elements_truncated")]
    per_sheet = views.groupBy("sheet_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "view_id", F.struct(*columns).alias("view")))).alias("views"))
    df = found.df.join(per_sheet, F.col("id") == F.col("sheet_id"), "left").orderBy(*order).select("unique_id", "sheet_number", "sheet_name",
        "current_revision", "views")

    def element(e: dict) -> dict:
        cls = e["classification"]
        return drop_empty({"unique_id": e["unique_id"], "ifc_guid": e["ifc_guid"], "classification": cls and {k: v for k, v in cls.items() if v is not None}},
            "ifc_guid", "classification")

    def row(r: dict) -> dict:
        views = [v["view"] for v in r.pop("views") or []]
        for v in views:
            if "elements" in v:
                v["elements"] = [element(e) for e in v["elements"]]
        return projected(drop_empty(r, "current_revision") | {"views": views}, fields)

    return Result(df, {"total": found.total, "count": found.count, "truncated": found.count < found.total}, "sheets", row)
