"""Elements by identity: the unique id in the host and its links, the IFC id in the host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.functions.identity import SOURCE, document_key
from girder.functions.text import filled, folded
from girder.operators.listing import with_positions
from girder.operators.keys import answered, first_of_each
from girder.operators.lookup import enrich, first_matches
from girder.plans import args as A
from girder.plans.args import QueryError
from girder.plans.result import Result
from girder.sources.model import Model, Session

from .common import active, with_classification, with_level, with_level_of_all, with_type

#: So many keys at most go into the scan as a filter; more are joined.
PUSHED = 500


def _asked(rows: DataFrame, key: Column, keys: list[str], model: Model, fold: bool = False) -> DataFrame:
    """The rows whose key is asked for: few keys reach the Parquet scan, many are broadcast as the request's bounded list."""
    distinct, as_key = sorted(set(keys)), folded if fold else lambda c: c
    if len(distinct) <= PUSHED:
        return rows.where(key.isin(*[as_key(F.lit(k)) for k in distinct]))
    request = model.spark.createDataFrame([(k,) for k in distinct], "__asked string")
    return rows.join(F.broadcast(request), key == as_key(F.col("__asked")), "left_semi")


def _answered(model: Model, keys: list[str], name: str, hits: DataFrame) -> DataFrame:
    """One row for each key asked for, in order; hits has one row for each __key."""
    request = with_positions(keys, f"{name} string", model.spark).withColumnRenamed("pos", "__pos")
    found = request.join(F.broadcast(hits), (folded(F.col(name)) if name == "ifc_guid" else F.col(name)) == F.col("__key"), "left")
    page = model.spark.createDataFrame(found.collect(), found.schema)
    return page.withColumn("found", F.col("id").isNotNull())


def _spine(df: DataFrame, model: Model) -> DataFrame:
    keyed = enrich(df, model.documents, {"doc_id": "doc_id"}, [document_key().alias("projectKey"), F.col("title").alias("__title")])
    return keyed.withColumns({"source": F.when(F.col("found"), F.lit(SOURCE)), "sourceLocalId": filled(F.col("__uid")), "projectKey": filled(F.col("projectKey"))})


#: The fields of an answer, in their order.
BY_UNIQUE_ID = ("found", "id", "name", "category", "type_id", "type_name", "ifc_guid", "source", "sourceLocalId", "projectKey", "level", "classification",
    "from_link", "link_instance_id", "link_title")
BY_IFC_GUID = ("found", "id", "unique_id", "name", "category", "type_id", "type_name", "source", "sourceLocalId", "projectKey")
_OMITTED = {"ifc_guid", "source", "sourceLocalId", "projectKey", "level", "classification", "from_link", "link_instance_id", "link_title"}


def _row(key: str):
    def row(r: dict) -> dict:
        if not r["found"]:
            return {key: r[key], "found": False}
        out = {k: v for k, v in r.items() if k not in _OMITTED or v is not None}
        if out.get("classification"):
            out["classification"] = {k: v for k, v in out["classification"].items() if v is not None}
        return out

    return row


def unique_id_rows(model: Model, session: Session, keys: list[str]) -> DataFrame:
    """Rows of get_element_by_uniqueid: the host's element, else the first loaded link's; links in the order of ordinal."""
    host = active(session)
    links = model.of("links", host).where("target_doc_id IS NOT NULL").select(F.col("target_doc_id").alias("__doc"), F.col("id").alias("__link"),
        F.col("ordinal").alias("__ordinal"))
    documents = model.spark.createDataFrame([(host, None, -1)], "__doc long, __link long, __ordinal int").unionByName(links)
    elements = _asked(model.elements, F.col("unique_id"), keys, model).join(F.broadcast(documents), F.col("doc_id") == F.col("__doc"))
    hits = first_matches(elements, F.col("unique_id"), F.struct(F.col("__link").isNotNull(), "__ordinal", "__link", "id")).withColumn("__uid",
        F.col("unique_id")).drop("unique_id", "__doc")
    page = with_classification(with_level(with_type(_answered(model, keys, "unique_id", hits), model), model))
    linked = _spine(page, model).withColumns({"ifc_guid": filled(F.col("ifc_guid")), "link_instance_id": F.col("__link")})
    return linked.withColumns({"from_link": F.when(F.col("__link").isNotNull(), F.lit(True)),
        "link_title": F.when(F.col("__link").isNotNull(), F.col("__title"))}).orderBy("__pos").select("unique_id", *BY_UNIQUE_ID)


def ifc_guid_rows(model: Model, session: Session, keys: list[str]) -> DataFrame:
    """Rows of get_element_by_ifcguid: host instances only; ids that differ only by case are one, and its first element wins."""
    elements = model.of("elements", active(session)).where(~F.col("is_type") & filled(F.col("ifc_guid")).isNotNull())
    asked = _asked(elements, folded(F.col("ifc_guid")), keys, model, fold=True)
    hits = first_matches(asked, folded(F.col("ifc_guid")), F.col("id")).drop("ifc_guid").withColumn("__uid", F.col("unique_id"))
    return _spine(with_type(_answered(model, keys, "ifc_guid", hits), model), model).orderBy("__pos").select("ifc_guid", *BY_IFC_GUID)


def get_element_by_uniqueid(model: Model, session: Session, args: dict) -> Result:
    active(session)
    if not (keys := A.keys(args, "unique_id", "unique_ids")):
        raise QueryError("Provide 'unique_id' (string) or 'unique_ids' (array of strings).")
    return Result(unique_id_rows(model, session, keys), {"count": len(keys)}, "elements", _row("unique_id"))


def get_element_by_ifcguid(model: Model, session: Session, args: dict) -> Result:
    active(session)
    if not (keys := A.keys(args, "ifc_guid", "ifc_guids")):
        raise QueryError("Provide 'ifc_guid' (string) or 'ifc_guids' (array of strings).")
    return Result(ifc_guid_rows(model, session, keys), {"count": len(keys)}, "elements", _row("ifc_guid"))


def _spine_of_all(hits: DataFrame, model: Model) -> DataFrame:
    """Hits of any number with type_name, level, classification and the keys of their own documents."""
    types = model.element_types.select(F.col("doc_id").alias("__doc"), F.col("type_id").alias("__type"), F.col("name").alias("type_name"), F.col("params").alias("type_params"))
    typed = hits.join(types, (F.col("doc_id") == F.col("__doc")) & (F.col("type_id") == F.col("__type")), "left").drop("__doc", "__type")
    documents = model.documents.select(F.col("doc_id").alias("__doc"), document_key().alias("projectKey"), F.col("title").alias("__title"))
    keyed = with_classification(typed).join(documents, F.col("doc_id") == F.col("__doc"), "left").drop("__doc", "type_params")
    return keyed.withColumns({"source": F.lit(SOURCE), "sourceLocalId": filled(F.col("unique_id")), "projectKey": filled(F.col("projectKey")), "ifc_guid": filled(F.col("ifc_guid"))})


_SOUGHT = ["doc_id", "id", "unique_id", "name", "category", "type_id", "level_id", "ifc_guid", "params"]


def unique_ids_of(model: Model, session: Session, requests: DataFrame) -> DataFrame:
    """requests (unique_id and whatever else) of any number with the columns of get_element_by_uniqueid, one row for each request."""
    host = active(session)
    links = model.of("links", host).where("target_doc_id IS NOT NULL").select(F.col("target_doc_id").alias("__doc"), F.col("id").alias("__link"), F.col("ordinal").alias("__ordinal"))
    documents = model.spark.createDataFrame([(host, None, -1)], "__doc long, __link long, __ordinal int").unionByName(links)
    elements = model.elements.select(*_SOUGHT).join(F.broadcast(documents), F.col("doc_id") == F.col("__doc")).drop("__doc")
    order = F.struct(F.col("__link").isNotNull(), "__ordinal", "__link", "id")
    hits = first_of_each(requests, F.col("unique_id"), elements, F.col("unique_id"), order)
    linked = F.col("__link").isNotNull()
    full = with_level_of_all(_spine_of_all(hits, model), model).withColumns({"link_instance_id": F.col("__link"), "from_link": F.when(linked, F.lit(True)),
        "link_title": F.when(linked, F.col("__title"))})
    answers = full.select("__key", *[c for c in BY_UNIQUE_ID if c != "found"])
    found = answered(requests, F.col("unique_id"), answers)
    return found.withColumn("found", F.col("id").isNotNull()).select(*requests.columns, *BY_UNIQUE_ID)


def ifc_guids_of(model: Model, session: Session, requests: DataFrame) -> DataFrame:
    """requests (ifc_guid and whatever else) of any number with the columns of get_element_by_ifcguid, one row for each request."""
    elements = model.of("elements", active(session)).where(~F.col("is_type") & filled(F.col("ifc_guid")).isNotNull()).select(*_SOUGHT)
    key = folded(F.col("ifc_guid"))
    hits = first_of_each(requests, key, elements, key, F.col("id"))
    answers = _spine_of_all(hits, model).select("__key", *[c for c in BY_IFC_GUID if c != "found"])
    found = answered(requests, key, answers)
    return found.withColumn("found", F.col("id").isNotNull()).select(*requests.columns, *BY_IFC_GUID)
