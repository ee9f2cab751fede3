"""Steps that queries share: candidate sources, levels, types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.functions import params as P
from girder.operators.listing import with_positions
from girder.operators.lookup import enrich
from girder.plans import args as A
from girder.plans.args import QueryError
from girder.sources.model import Model, Session

#: Collations by Spark's names without a locale, with those that see no case or no accents.
OWN_COLLATIONS = {f"UNICODE{a}{b}" for a in ("", "_CI") for b in ("", "_AI")} | {"UTF8_BINARY", "UTF8_LCASE"}
#: Fixed value: an error text.
NO_DOCUMENT = "No active document."


def active(session: Session) -> int:
    if session.doc_id is None:
        raise QueryError(NO_DOCUMENT)
    return session.doc_id


def collation(model: Model, args: dict) -> str | None:
    """The collation asked for, by one of the names that Spark knows; without one, texts are in the order of code points."""
    if not (asked := A.text(args, "collation")):
        return None
    known = model.spark.sql("SELECT name FROM collations()").where(F.lower("name") == asked.lower()).first()
    if known is None and asked.upper() not in OWN_COLLATIONS:
        raise QueryError(f"Unknown collation '{asked}'.")
    return known["name"] if known else asked.upper()


def _level_ids() -> Column:
    """Where a row's level may be: level_id alone if there is one, else what its level parameters hold."""
    own = F.col("level_id").isNotNull() & (F.col("level_id") != -1)
    return F.when(own, F.array("level_id")).otherwise(P.level_candidates(F.col("params")))


def with_level(page: DataFrame, model: Model) -> DataFrame:
    """A bounded page (with doc_id, __pos, level_id, params) and level: that of level_id; where there is none, the first level parameter that names a level."""
    asked = page.select("__pos", "doc_id", F.posexplode(_level_ids()).alias("__i", "__level"))
    level = F.struct(F.col("id"), F.col("name"), F.col("elevation_ft"), F.col("elevation_user_units"))
    found = enrich(asked, model.levels, {"doc_id": "doc_id", "__level": "id"}, [level.alias("level")]).where("level IS NOT NULL")
    first = found.groupBy(F.col("__pos").alias("__p")).agg(F.min_by("level", "__i").alias("level"))
    return page.join(F.broadcast(first), F.col("__pos") == F.col("__p"), "left").drop("__p")


def with_level_of_all(rows: DataFrame, model: Model) -> DataFrame:
    """As with_level, for rows of any number: a document's levels meet its rows as one map, so rows are shuffled once at most, and wherever they are many AQE splits a document's."""
    level = F.struct(F.col("id"), F.col("name"), F.col("elevation_ft"), F.col("elevation_user_units"))
    each = model.levels.groupBy(F.col("doc_id").alias("__doc"), "id").agg(F.min(level).alias("level"))
    by_document = each.groupBy("__doc").agg(F.map_from_entries(F.collect_list(F.struct("id", "level"))).alias("__levels"))
    known = F.filter(_level_ids(), lambda i: F.map_contains_key("__levels", i))
    met = rows.join(by_document, F.col("doc_id") == F.col("__doc"), "left")
    return met.withColumn("level", F.try_element_at("__levels", F.get(known, F.lit(0)))).drop("__doc", "__levels")


def with_type(page: DataFrame, model: Model) -> DataFrame:
    """A bounded page with type_name and type_params."""
    return enrich(page, model.element_types, {"doc_id": "doc_id", "type_id": "type_id"}, [F.col("name").alias("type_name"), F.col("params").alias("type_params")])


def with_classification(page: DataFrame) -> DataFrame:
    return page.withColumn("classification", P.classification(F.col("type_params"), F.col("params")))


def by_ids(model: Model, doc: int, wanted: list[int]) -> DataFrame:
    """Elements in the order of wanted, duplicates included; unknown ids are dropped."""
    request = with_positions(wanted, "wanted long", model.spark)
    return model.of("elements", doc).join(F.broadcast(request), F.col("id") == F.col("wanted")).drop("wanted")


def _is_view(model: Model, doc: int, view: int) -> bool:
    views, sheets = (model.of(t, doc).where(F.col("id") == view).select("id") for t in ("views", "sheets"))
    return not views.union(sheets).limit(1).isEmpty()


def by_category(model: Model, doc: int, category: str, view: int | None) -> DataFrame:
    """Instances of a category in ascending id, of one view if it is one; else of the whole document."""
    found = model.of("elements", doc).where((F.col("category_code") == category) & ~F.col("is_type"))
    if view is not None and _is_view(model, doc, view):
        seen = model.of("view_elements", doc).where(F.col("view_id") == view).select(F.col("element_id").alias("id"))
        found = found.join(seen, "id", "left_semi").select(*found.columns)
    return found.withColumn("pos", F.lit(0))


def candidates(model: Model, session: Session, args: dict, default: str | None) -> DataFrame:
    """Ids, else a category, else the selection, else the default category; pos and id order the rows."""
    doc = active(session)
    if (ids := A.ids(args)) is not None:
        return by_ids(model, doc, ids)
    view = A.long(args, "view_id")
    if (category := A.text(args, "category")) is not None:
        if not model.knows(category):
            raise QueryError(f"Unknown BuiltInCategory '{category}'.")
        return by_category(model, doc, category, view)
    if session.selection:
        return by_ids(model, doc, list(session.selection))
    if default is None:
        raise QueryError("Provide element_ids[], category, or a current selection to test.")
    return by_category(model, doc, default, view)
