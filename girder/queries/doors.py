"""Doors and the rooms on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from girder.functions import params as P
from girder.functions.geometry import probes
from girder.functions.text import same_text
from girder.operators.listing import held, page
from girder.operators.lookup import enrich
from girder.operators.spatial import rooms_at, rooms_at_all
from girder.plans import args as A
from girder.plans.args import QueryError
from girder.plans.result import Result
from girder.sources.model import Model, Session

from .common import active, candidates, with_type

#: Parameters read when none are asked for.
DOOR_PARAMS = ["NLRS_C_breedte_01"]
ROOM_PARAMS = ["NLRS_C_ruimtefunctie", "gebruiksfunctie"]


def resolve_phase(model: Model, session: Session, args: dict) -> Row | None:
    """By id, else by name, else the active view's phase, else the last; none if the document has none."""
    phases = model.of("phases", active(session))
    if (number := A.long(args, "phase_id")) is not None:
        if (found := phases.where(F.col("id") == number).first()) is None:
            raise QueryError(f"phase_id {number} is not a Phase.")
        return found
    if (name := A.text(args, "phase") or "").strip():
        if (found := phases.where(same_text(F.col("name"), name)).orderBy("ordinal", "id").first()) is None:
            raise QueryError(f"No phase named '{name}'.")
        return found
    if session.active_view_id is not None:
        view = model.of("views", session.doc_id).where(F.col("id") == session.active_view_id).select("phase_id").first()
        if view and view["phase_id"] is not None and (found := phases.where(F.col("id") == view["phase_id"]).first()):
            return found
    return phases.orderBy(F.desc("ordinal"), "id").first()


def _sides(doors: DataFrame, *keys: str) -> DataFrame:
    """keys, side, stored_id, p (a point beyond the opening), stored (either side has a stored room), placed, for both sides of each door."""
    ends = zip(("from", "to"), probes(F.col("location"), F.col("facing"), F.col("host_wall_width")), strict=True)
    each = F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"{side}_id").alias("stored_id"), p.alias("p")) for side, p in ends])
    stored = (F.col("from_id").isNotNull() | F.col("to_id").isNotNull()).alias("stored")
    return doors.select(*keys, stored, F.col("location").isNotNull().alias("placed"), F.explode(each).alias("e")).select(*keys, "stored", "placed", "e.*")


def _rooms_of_sides(room: Column) -> list[Column]:
    """from_room, to_room and resolution, aggregated over both sides of a door."""
    of_side = lambda side: F.first(F.when(F.col("side") == side, room), ignorenulls=True).alias(f"{side}_room")
    how = F.when(F.first("stored"), "from_to_room").when(F.max(F.col("room_id").isNotNull()), "geometric").otherwise("none")
    return [of_side("from"), of_side("to"), how.alias("resolution")]


def room_sides(doors: DataFrame, model: Model, doc: int, phase: int | None) -> DataFrame:
    """__pos, doc_id, side, stored, room_id for both sides of each of a bounded page of doors (__pos, location, facing, host_wall_width, from_id, to_id).

    The stored rooms count if either side has one; only doors without any are resolved by where they are.
    """
    sides = _sides(doors, "__pos", "doc_id")
    points = sides.where(~F.col("stored") & F.col("placed")).select("doc_id", F.struct("__pos", "side").alias("key"), "p.*")
    rooms = model.of("rooms", doc)
    if phase is not None:
        rooms = rooms.where(F.col("phase_id").isNull() | (F.col("phase_id") == phase))
    met = rooms_at(points, rooms).select(F.col("key.__pos").alias("__at"), F.col("key.side").alias("__side"), F.col("room_id").alias("met_id"))
    both = sides.join(F.broadcast(met), (F.col("__pos") == F.col("__at")) & (F.col("side") == F.col("__side")), "left")
    return both.select("__pos", "doc_id", "side", "stored", F.coalesce("stored_id", "met_id").alias("room_id"))


def texts(names: list[str], value) -> Column:
    """Names and their values as a map, without those that have none."""
    distinct = list(dict.fromkeys(names))
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, distinct)), F.array(*[value(n) for n in distinct])), lambda k, v: v.isNotNull())


def with_rooms(doors: DataFrame, model: Model, doc: int, phase: int | None, names: list[str]) -> DataFrame:
    """Doors with from_room and to_room (id, name, number, level_name, params) and resolution; rooms and their levels are looked up once for both sides."""
    sides = room_sides(doors, model, doc, phase)
    room_columns = [F.col("id"), F.col("name"), F.col("number"), F.col("level_id").alias("__level"),
        texts(names, lambda n: P.param_text(P.param(F.col("params"), n))).alias("params")]
    known = enrich(sides, model.of("rooms", doc), {"doc_id": "doc_id", "room_id": "id"}, room_columns)
    leveled = enrich(known, model.of("levels", doc), {"doc_id": "doc_id", "__level": "id"}, [F.col("name").alias("level_name")])
    room = F.when(F.col("id").isNotNull(), F.struct("id", "name", "number", "level_name", "params"))
    per_door = leveled.groupBy(F.col("__pos").alias("__at")).agg(*_rooms_of_sides(room))
    return doors.join(F.broadcast(per_door), F.col("__pos") == F.col("__at"), "left").drop("__at")


def get_door_rooms(model: Model, session: Session, args: dict) -> Result:
    doc = active(session)
    door_params, room_params = A.names(args, "door_params", DOOR_PARAMS), A.names(args, "room_params", ROOM_PARAMS)
    phase = resolve_phase(model, session, args)
    limit = A.number_limit(args, 200, 2000)
    doors = candidates(model, session, args, "OST_Doors").where("is_family_instance").select("pos", "doc_id", "id", "name", "type_id", "location", "params")
    found = page(doors, ["pos", "id"], limit)
    numbered = found.df.withColumn("__pos", F.struct("pos", "id"))
    opened = enrich(numbered, model.of("openings", doc), {"doc_id": "doc_id", "id": "element_id"},
        [F.col("mark"), F.col("host_id"), F.col("host_wall_width"), F.col("facing")])
    if phase is None:
        stored = opened.withColumns({"from_id": F.lit(None).cast("long"), "to_id": F.lit(None).cast("long")})
    else:
        of_phase = model.of("opening_rooms", doc).where(F.col("phase_id") == phase["id"])
        stored = enrich(opened, of_phase, {"doc_id": "doc_id", "id": "element_id"}, [F.col("from_room_id").alias("from_id"), F.col("to_room_id").alias("to_id")])
    values = texts(door_params, lambda n: P.instance_or_type(n, F.col("params"), F.col("type_params")))
    columns = ["__pos", "doc_id", "id", "name", "type_name", "mark", "host_id", "location", "facing", "host_wall_width", "from_id", "to_id"]
    typed = held(with_type(stored, model).select(*columns, values.alias("values")))
    resolved = with_rooms(typed, model, doc, phase and phase["id"], room_params)
    df = resolved.orderBy("__pos").select("id", "name", "type_name", "mark", "host_id", "values", "from_room", "to_room", "resolution")

    def row(r: dict) -> dict:
        rooms = {k: (dict(v) if v.get("params") else {x: y for x, y in v.items() if x != "params"}) if (v := r.pop(k)) else None for k in ("from_room", "to_room")}
        values, resolution = r.pop("values") or {}, r.pop("resolution")
        return r | {n: values[n] for n in door_params if n in values} | rooms | {"resolution": resolution}

    return Result(df, {"count": found.count, "phase": phase and phase["name"]}, "elements", row)


def doors_of_all(model: Model, category: str, door_params: list[str], room_params: list[str]) -> DataFrame:
    """doc_id and the columns of get_door_rooms for all doors of all documents, each in its document's last phase.

    Doors meet their openings, stored rooms and sides on (doc_id, id), so those joins share one partitioning; types, rooms and levels meet them by their own keys.
    """
    of_door = lambda df, *columns: df.select(F.col("doc_id").alias("__doc"), F.col("element_id").alias("__id"), *columns)
    same_door = (F.col("doc_id") == F.col("__doc")) & (F.col("id") == F.col("__id"))
    phases = model.phases.groupBy(F.col("doc_id").alias("p_doc")).agg(F.max_by("id", F.struct("ordinal", -F.col("id"))).alias("phase"))
    doors = model.elements.where((F.col("category_code") == category) & ~F.col("is_type") & F.col("is_family_instance"))
    opened = doors.select("doc_id", "id", "name", "type_id", "location", "params").join(of_door(model.openings, "mark", "host_id", "host_wall_width", "facing"),
        same_door, "left").drop("__doc", "__id")
    stored = model.opening_rooms.join(phases, (F.col("doc_id") == F.col("p_doc")) & (F.col("phase_id") == F.col("phase")), "left_semi")
    placed = opened.join(of_door(stored, F.col("from_room_id").alias("from_id"), F.col("to_room_id").alias("to_id")), same_door, "left").drop("__doc", "__id")
    types = model.element_types.select(F.col("doc_id").alias("__doc"), F.col("type_id").alias("__type"), F.col("name").alias("type_name"), F.col("params").alias("type_params"))
    typed = placed.join(types, (F.col("doc_id") == F.col("__doc")) & (F.col("type_id") == F.col("__type")), "left")
    values = texts(door_params, lambda n: P.instance_or_type(n, F.col("params"), F.col("type_params")))
    full = typed.select("doc_id", "id", "name", "type_name", "mark", "host_id", "location", "facing", "host_wall_width", "from_id", "to_id", values.alias("values"))

    sides = _sides(full, "doc_id", "id")
    points = sides.where(~F.col("stored") & F.col("placed")).select("doc_id", F.struct("doc_id", "id", "side").alias("key"), "p.*")
    in_phase = model.rooms.join(phases, F.col("doc_id") == F.col("p_doc"), "left").where(F.col("phase").isNull() | F.col("phase_id").isNull() | (F.col("phase_id") == F.col("phase")))
    met = rooms_at_all(points, in_phase).select(F.col("key.doc_id").alias("__doc"), F.col("key.id").alias("__id"), F.col("key.side").alias("__side"), F.col("room_id").alias("met_id"))
    both = sides.join(met, same_door & (F.col("side") == F.col("__side")), "left").select("doc_id", "id", "side", "stored", F.coalesce("stored_id", "met_id").alias("room_id"))
    levels = model.levels.select(F.col("doc_id").alias("l_doc"), F.col("id").alias("l_id"), F.col("name").alias("level_name"))
    rooms = model.rooms.select(F.col("doc_id").alias("__doc"), F.col("id").alias("r_id"), F.col("name").alias("r_name"), "number", F.col("level_id").alias("r_level"),
        texts(room_params, lambda n: P.param_text(P.param(F.col("params"), n))).alias("r_params"))
    leveled = rooms.join(levels, (F.col("__doc") == F.col("l_doc")) & (F.col("r_level") == F.col("l_id")), "left")
    known = both.join(leveled, (F.col("doc_id") == F.col("__doc")) & (F.col("room_id") == F.col("r_id")), "left")
    room = F.when(F.col("r_id").isNotNull(), F.struct(F.col("r_id").alias("id"), F.col("r_name").alias("name"), "number", "level_name", F.col("r_params").alias("params")))
    per_door = known.groupBy(F.col("doc_id").alias("__doc"), F.col("id").alias("__id")).agg(*_rooms_of_sides(room))
    return full.join(per_door, same_door, "left").select("doc_id", "id", "name", "type_name", "mark", "host_id", "values", "from_room", "to_room", "resolution")
