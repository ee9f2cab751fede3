"""Answers for whole tables: the rows of a query's JSON answer for all documents, as lines that tasks write in order.

A page's answer is made on the driver (result.py), which its limit allows. Here the same rules are expressions: which
names are left out when empty, id first in a projection, and parameters that take the place of a row's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.functions.json_text import json_text, object_text, or_null, projected
from girder.queries.common import with_level_of_all
from girder.queries.doors import DOOR_PARAMS, ROOM_PARAMS, doors_of_all
from girder.sources.model import Model


def _writes(df: DataFrame, names: list[str], omitted: set[str]) -> list[tuple[str, Column, Column]]:
    """(name, JSON, value) of columns; those of omitted are left out when null or an empty text."""
    out = []
    for name in names:
        kind, value = df.schema[name].dataType, F.col(name)
        text = json_text(value, kind)
        if name in omitted:
            text = F.when(value != "", text) if kind.simpleString() == "string" else text
        else:
            text = or_null(text)
        out.append((name, text, value))
    return out


def lines(df: DataFrame, key: list[str], names: list[str], omitted: set[str] = frozenset(), fields: set[str] | None = None) -> DataFrame:
    """key and line: each row's JSON."""
    return df.select(*key, projected(_writes(df, names, set(omitted)), fields).alias("line"))


def room_lines(model: Model, include_unplaced: bool = False, fields: set[str] | None = None) -> DataFrame:
    """doc_id, number, id, line of all rooms of all documents."""
    rooms = model.rooms.drop("footprint")
    if not include_unplaced:
        rooms = rooms.where((F.col("area_sf") > 0) & ~F.isnan("area_sf"))
    names = ["unique_id", "id", "number", "name", "area_sf", "area_user_units", "level"]
    return lines(with_level_of_all(rooms, model), ["doc_id", "number", "id"], names, {"area_user_units", "level"}, fields)


def view_lines(model: Model, fields: set[str] | None = None) -> DataFrame:
    """doc_id, view_type, name, id, line of all views that are neither templates nor sheets."""
    views = with_level_of_all(model.views.where(~F.col("is_template") & ~F.col("is_sheet")), model)
    return lines(views, ["doc_id", "view_type", "name", "id"], ["unique_id", "id", "name", "view_type", "level"], {"level"}, fields)


def level_lines(model: Model) -> DataFrame:
    """doc_id, elevation_ft, id, line of all levels."""
    return lines(model.levels, ["doc_id", "elevation_ft", "id"], ["unique_id", "id", "name", "elevation_ft", "elevation_user_units"])


def door_line(df: DataFrame, door_params: list[str]) -> Column:
    """A door's JSON. Parameters are written after its own columns, and rooms and resolution after those, to the place where a name stands already."""
    text = lambda name: or_null(json_text(F.col(name), df.schema[name].dataType))
    own = [(name, text(name)) for name in ("id", "name", "type_name", "mark", "host_id")]
    values = [(n, json_text(F.try_element_at("values", F.lit(n)), df.schema["values"].dataType.valueType)) for n in dict.fromkeys(door_params)]

    def room(name: str) -> Column:
        kind = df.schema[name].dataType
        whole = [(f.name, or_null(json_text(F.col(name)[f.name], f.dataType))) for f in kind.fields if f.name != "params"]
        params = F.when(F.size(F.col(name)["params"]) > 0, json_text(F.col(name)["params"], kind["params"].dataType))
        return F.when(F.col(name).isNotNull(), object_text([*whole, ("params", params)]))

    return object_text([*own, *values, *[(n, or_null(room(n))) for n in ("from_room", "to_room")], ("resolution", text("resolution"))])


def door_lines(model: Model, category: str = "OST_Doors", door_params: list[str] = DOOR_PARAMS, room_params: list[str] = ROOM_PARAMS) -> DataFrame:
    """doc_id, id, line of all doors of all documents, each in its document's last phase."""
    doors = doors_of_all(model, category, door_params, room_params)
    return doors.select("doc_id", "id", door_line(doors, door_params).alias("line"))


def write_lines(df: DataFrame, path: str, by_document: bool = False, mode: str = "errorifexists") -> None:
    """Writes line in the order of the columns before it: files in the order of their names hold the whole in order. by_document: a folder for each document."""
    order = [c for c in df.columns if c != "line"]
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = ordered.select(*(["doc_id"] if by_document else []), F.col("line").alias("value"))
    writer = kept.write.mode(mode)
    (writer.partitionBy("doc_id") if by_document else writer).text(path)
