"""Building models as views of the star-schema tables, so that queries can be compared with SQL over the same tables.

The mapping is ours. A table is planned, and its files opened, when a query first asks for it.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import Model, Session
from .schema import PARAM, TABLES

VIEW_TYPES = ("STANDARD", "MEDIUM", "PROMO", "LARGE", "SMALL", "ECONOMY")
SESSION = Session(doc_id=0, selection=(7, 3, 7, 11, 999_999_999), view_types=VIEW_TYPES)
#: Scope boxes: one along the axes, one turned.
BOXES = [
    (0, 1, "Zone A", (100.0, 10.0, 1.0), (300.0, 60.0, 8.0), None),
    (0, 2, "Zone B", (-60.0, -60.0, 1.0), (60.0, 60.0, 8.0), [0.6, 0.8, 0.0, -160.0, -0.8, 0.6, 0.0, 130.0, 0.0, 0.0, 1.0, 0.0]),
]
PHASES = [(0, 1, "Existing", 0), (0, 2, "New Construction", 1)]


def _param(storage: str, value: Column, display: Column | None = None) -> Column:
    at = {"String": "s", "Integer": "i", "Double": "d", "ElementId": "eid"}[storage]
    parts = {f.name: F.lit(None).cast(f.dataType) for f in PARAM} | {"storage": F.lit(storage),
        at: value.cast(PARAM[at].dataType)} | ({"display": display} if display is not None else {})
    return F.struct(*[parts[f.name].alias(f.name) for f in PARAM])


def _params(**values: Column) -> Column:
    """A map of the parameters that aren't null."""
    whole = F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*values.values()))
    return F.map_filter(whole, lambda k, v: v.isNotNull())


def _shaped(df: DataFrame, name: str) -> DataFrame:
    """df with the columns and types of a table; those that it lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name]])


def _point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), z.cast("double").alias("z"))


def _around(x: Column, y: Column, z: Column) -> Column:
    return F.struct(_point(x - 3, y - 3, z - 1).alias("min"), _point(x + 3, y + 3, z + 1).alias("max"))


def building(spark: SparkSession, sf_dir: str, place: tuple[Column, Column] | None = None) -> Model:
    """Orders as elements, parts as types and views, customers as rooms, suppliers as sheets, nations as levels, regions as documents.

    place: location and bounding box of elements in columns of orders, if not the building's own.
    """
    read = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    key, okey, ckey = F.col("r_regionkey"), F.col("o_orderkey"), F.col("c_custkey")

    def documents() -> DataFrame:
        saved = read("events").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last"),
            F.count_if(F.col("event_type") == "purchase").alias("saves"),
            F.max(F.when(F.col("event_type").isin("click", "signup"), F.col("ts"))).alias("touched")).withColumn("__doc", F.lit(0))
        info = F.struct(F.concat(F.lit("info-"), key).alias("unique_id"), F.when(key == 2, F.concat(F.lit("Project "), F.col("r_name"))).otherwise("").alias("name"),
            F.concat(F.lit("N"), key).alias("number"), F.lit(None).cast("string").alias("client"), F.lit("").alias("address"), F.when(key == 1, "Main").alias("building"))
        return read("region").join(F.broadcast(saved), key == F.col("__doc"), "left").select(
            key.alias("doc_id"), F.col("r_name").alias("title"), F.when(key == 3, "").otherwise(F.concat(F.lit("/models/"), F.lower("r_name"))).alias("path"),
            F.when(key == 0, F.md5(F.date_format("last", "yyyy-MM-dd HH:mm:ss"))).alias("version_guid"), F.when(key == 0, F.col("saves")).alias("number_of_saves"),
                F.coalesce(F.when(key == 0, F.col("touched") > F.col("last")), F.lit(False)).alias("is_modified"),
            (key % 2 == 0).alias("is_workshared"), (key != 0).alias("is_linked"), (key == 0).alias("is_active"), F.when(key.isin(1, 2), info).alias("project_info"),
        )

    def elements() -> DataFrame:
        x, y, z = F.col("o_totalprice") / 1000, (F.col("o_custkey") % 1000) / 10, (okey % 100) / 10
        location, bbox = place or (F.when(okey % 4 != 1, _point(x, y, z)), F.when(okey % 5 != 0, _around(x, y, z)))
        type_of = read("lineitem").groupBy(F.col("l_orderkey").alias("__order")).agg(F.min("l_partkey").alias("type_id"))
        return read("orders").join(type_of, okey == F.col("__order"), "left").select(
            F.lit(0).alias("doc_id"), okey.alias("id"), F.concat(F.lit("u-"), okey).alias("unique_id"), F.concat(F.lit("Order "), okey).alias("name"),
                F.col("o_orderpriority").alias("category"), F.col("o_orderpriority").alias("category_code"), "type_id",
            F.lit(False).alias("is_type"), (okey % 7 != 3).alias("is_family_instance"), F.when(okey % 2 == 0, F.col("o_custkey") % 40).alias("level_id"),
                F.when(okey % 3 == 0, F.concat(F.lit("g-"), okey)).alias("ifc_guid"),
            location.alias("location"), bbox.alias("bbox"),
            F.when(okey % 10 == 0, F.struct((okey % 3).alias("id"), F.lit("Option").alias("name"), (okey % 20 == 0).alias("is_primary"))).alias("design_option"),
            _params(
                UNIFORMAT_CODE=F.when(okey % 2 == 0, _param("String", F.lit("inst"))), FAMILY_LEVEL_PARAM=F.when(okey % 3 == 0, _param("ElementId", F.lit(99))),
                    LEVEL_PARAM=_param("ElementId", okey % 30),
                width=F.when(okey % 3 == 0, _param("Double", F.col("o_custkey") / 8, F.when(okey % 9 == 0, F.lit("wide")))),
                    note=F.when(okey % 2 == 1, _param("String", F.lit(""))),
            ).alias("params"),
        )

    def types() -> DataFrame:
        return read("part").select(
            F.lit(0).alias("doc_id"), F.col("p_partkey").alias("type_id"), F.col("p_name").alias("name"),
            _params(UNIFORMAT_CODE=_param("String", F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")), width=_param("Integer", F.col("p_size")),
                note=_param("String", F.col("p_type"))).alias("params"),
        )

    def rooms() -> DataFrame:
        corner = lambda dx, dy: F.struct((ckey * 10 + dx).cast("double").alias("x"), F.lit(float(dy)).alias("y"))
        return read("customer").select(
            F.lit(0).alias("doc_id"), ckey.alias("id"), F.concat(F.lit("r-"), ckey).alias("unique_id"), F.col("c_name").alias("number"),
                F.col("c_mktsegment").alias("name"), F.col("c_acctbal").alias("area_sf"), F.col("c_nationkey").alias("level_id"),
            F.when(ckey < 50, F.array(corner(0, 0), corner(10, 0), corner(10, 100), corner(0, 100))).alias("footprint"),
                _params(use=F.when(ckey % 2 == 0, _param("String", F.col("c_mktsegment")))).alias("params"),
        )

    def views() -> DataFrame:
        return read("part").select(F.lit(0).alias("doc_id"), F.col("p_partkey").alias("id"), F.concat(F.lit("v-"), "p_partkey").alias("unique_id"),
            F.col("p_name").alias("name"), F.col("p_type").alias("view_type"), (F.col("p_size") == 50).alias("is_template"),
            (F.col("p_size") == 49).alias("is_sheet"), (F.col("p_size") % 30).alias("level_id"))

    tables = {
        "documents": documents, "elements": elements, "element_types": types, "rooms": rooms, "views": views,
        "links": lambda: read("region").where(key != 0).select(F.lit(0).alias("host_doc_id"), key.alias("id"), F.concat(F.lit("l-"), key).alias("unique_id"),
            F.col("r_name").alias("name"), F.when(key != 4, key).alias("target_doc_id"), key.alias("ordinal")),
        "levels": lambda: read("nation").select(F.lit(0).alias("doc_id"), F.col("n_nationkey").alias("id"), F.concat(F.lit("n-"), "n_nationkey").alias("unique_id"),
            F.col("n_name").alias("name"), (F.col("n_regionkey") * 3.0).alias("elevation_ft"),
            F.concat((F.col("n_regionkey") * 3).cast("string"), F.lit(" ft")).alias("elevation_user_units")),
        "sheets": lambda: read("supplier").select(F.lit(0).alias("doc_id"), F.col("s_suppkey").alias("id"), F.concat(F.lit("s-"), "s_suppkey").alias("unique_id"),
            F.col("s_name").alias("sheet_number"), F.lit("Sheet").alias("sheet_name"), F.when(F.col("s_suppkey") % 2 == 0, "A").alias("current_revision"),
            F.lit(False).alias("is_template")),
        "viewports": lambda: read("lineitem").select(F.lit(0).alias("doc_id"), F.col("l_suppkey").alias("sheet_id"), F.col("l_partkey").alias("view_id"),
            F.col("l_partkey").alias("ordinal")).distinct(),
        "view_elements": lambda: read("lineitem").select(F.lit(0).alias("doc_id"), F.col("l_partkey").alias("view_id"),
            F.col("l_orderkey").alias("element_id")),  # an element that a view shows twice is told apart where it matters
        "openings": lambda: read("orders").select(F.lit(0).alias("doc_id"), okey.alias("element_id"), F.concat(F.lit("M"), okey % 1000).alias("mark"),
            F.when(okey % 2 == 0, okey + 1).alias("host_id"), F.when(okey % 4 == 0, F.lit(9.0)).alias("host_wall_width"),
            _point(F.when(okey % 3 == 0, 0.0).otherwise(2.0), F.lit(0.0), F.lit(1.0)).alias("facing")),
        "opening_rooms": lambda: read("orders").select(F.lit(0).alias("doc_id"), okey.alias("element_id"), F.lit(2).alias("phase_id"),
            F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("from_room_id"),
            F.when(F.col("o_orderstatus") == "O", F.col("o_custkey") + 1).alias("to_room_id")),
    }
    shaped = {name: lambda name=name, made=made: _shaped(made(), name) for name, made in tables.items()}
    given = {name: lambda name=name, rows=rows: spark.createDataFrame(rows, TABLES[name]) for name, rows in (("scope_boxes", BOXES), ("phases", PHASES))}
    return Model(spark, shaped | given, frozenset(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]))


def odd(spark: SparkSession, sf_dir: str) -> Model:
    """The building with rooms of no area or none that is a number, slanted footprints, doors that face nowhere, and viewports of views that don't exist."""
    model = building(spark, sf_dir)
    ckey = F.col("id")
    corner = lambda dx, y: F.struct((ckey * 10 + dx + y / 2).cast("double").alias("x"), F.lit(float(y)).alias("y"))
    area = F.when(ckey % 5 == 0, F.lit(float("nan"))).when(ckey % 5 == 1, 0.0).otherwise(F.col("area_sf"))
    slanted = F.when(ckey < 50, F.array(corner(0, 0), corner(10, 0), corner(10, 100), corner(0, 100)))
    model.tables["rooms"] = model.rooms.withColumns({"area_sf": area, "footprint": slanted})
    model.tables["viewports"] = model.viewports.withColumn("view_id", F.when(F.col("view_id") % 3 != 0, F.col("view_id")))
    nowhere = F.struct(*[F.lit(0.0).alias(a) for a in "xyz"])
    model.tables["openings"] = model.openings.withColumn("facing", F.when(F.col("element_id") % 2 == 0, nowhere).otherwise(F.col("facing")))
    return model


def linked(spark: SparkSession, sf_dir: str) -> Model:
    """Customers as elements of the documents of their regions; ids that repeat in and across documents."""
    model = building(spark, sf_dir)
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    nation = read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    ckey = F.col("c_custkey")
    people = read("customer").join(nation, "c_nationkey").select(F.col("n_regionkey").alias("doc_id"), ckey.alias("id"),
        (ckey % 50).cast("string").alias("unique_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("category"), F.lit(False).alias("is_type"))
    model.tables["elements"] = _shaped(people, "elements")
    return model


def named(spark: SparkSession, sf_dir: str) -> Model:
    """Parts as elements whose IFC ids repeat; some differ only by case."""
    model = building(spark, sf_dir)
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_partkey")
    parts = part.select(F.lit(0).alias("doc_id"), key.alias("id"), F.concat(F.lit("p-"), key).alias("unique_id"), F.col("p_brand").alias("name"),
        F.col("p_type").alias("category"), (key % 10 == 0).alias("is_type"), F.when(key % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("ifc_guid"),
        (key + 1).alias("type_id"))
    model.tables["elements"] = _shaped(parts, "elements")
    return model


def renamed(spark: SparkSession, sf_dir: str) -> Model:
    """The building with element parameters that are named like columns of a door's answer."""
    model = building(spark, sf_dir)
    key = F.col("id")
    own = _params(name=F.when(key % 6 == 0, _param("String", F.concat(F.lit('Re "named" '), key))), resolution=F.when(key % 5 == 0, _param("String", F.lit("mine"))))
    model.tables["elements"] = model.elements.withColumn("params", F.map_concat("params", own))
    return model

#: Rooms of the city stand in rows of so many, each as wide and deep as this.
ROW, ROOM = 100, 10


def city(spark: SparkSession, sf_dir: str) -> Model:
    """Every customer as a room with a footprint, in rows of a city; orders as elements in their customers' rooms, but a third of all in one block of a few rooms."""
    key, order, custkey = F.col("id"), F.col("o_orderkey"), F.col("o_custkey")
    crowd = order % 3 == 0
    x = F.when(crowd, custkey % 17 + (order % 7) / 8).otherwise(custkey % ROW * ROOM + order % 10 + 0.5)
    y = F.when(crowd, order % 13 + 0.25).otherwise(F.floor(custkey / ROW) * ROOM + order % 9 + 0.75)
    z = (order % 100) / 10
    model = building(spark, sf_dir, (_point(x, y, z), F.when(order % 5 != 0, _around(x, y, z))))
    corner = lambda dx, dy: F.struct((key % ROW * ROOM + dx).cast("double").alias("x"), (F.floor(key / ROW) * ROOM + dy).cast("double").alias("y"))
    model.tables["rooms"] = model.rooms.withColumn("footprint", F.array(corner(0, 0), corner(ROOM, 0), corner(ROOM, ROOM), corner(0, ROOM)))
    return model


def boxed_city(spark: SparkSession, sf_dir: str) -> Model:
    """The city with a scope box for each supplier: every other one is turned, some are large."""
    model = city(spark, sf_dir)
    k = F.col("s_suppkey")
    x, y, half = (k * 37 % 1000).cast("double"), (k * 53 % 200).cast("double"), F.when(k % 10 == 0, 60.0).otherwise(12.0)
    m = [0.6, 0.8, 0.0, 0.6 * -x + 0.8 * -y, -0.8, 0.6, 0.0, 0.8 * x + 0.6 * -y, 0.0, 0.0, 1.0, 0.0]
    turned = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in m])
    own = lambda v: F.when(k % 2 == 0, 0.0).otherwise(v)
    low, high = _point(own(x) - half, own(y) - half, F.lit(2.0)), _point(own(x) + half, own(y) + half, F.lit(8.0))
    boxes = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.lit(0).alias("doc_id"), k.alias("id"), F.col("s_name").alias("name"), low.alias("min"), high.alias("max"),
        F.when(k % 2 == 0, turned).alias("inverse"))
    model.tables["scope_boxes"] = _shaped(boxes, "scope_boxes")
    return model
