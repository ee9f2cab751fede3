"""A building model: one lazy DataFrame for each table, and the session that queries run in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import TABLES

#: The names of view types that a filter accepts.
VIEW_TYPES = (
    "FloorPlan", "CeilingPlan", "Elevation", "Section", "Detail", "ThreeD", "Schedule", "DraftingView", "Legend", "EngineeringPlan", "AreaPlan", "Walkthrough",
        "Rendering",
    "DrawingSheet", "ProjectBrowser", "Report", "SystemBrowser", "CostReport", "LoadsReport", "PresureLossReport", "PanelSchedule", "ColumnSchedule", "Internal",
        "Undefined",
)
#: Category codes that need no element to be known.
CATEGORIES = frozenset(["OST_Doors", "OST_VolumeOfInterest"])


@dataclass(frozen=True)
class Session:
    """What the host holds besides data: the active document, the selection in its order, and the active view."""

    doc_id: int | None = 0
    selection: tuple[int, ...] = ()
    active_view_id: int | None = None
    view_types: tuple[str, ...] = VIEW_TYPES


@dataclass
class Model:
    """Tables by name, or functions that make them when a query first asks; those not given are empty. Every table keeps the schema of schema.TABLES."""

    spark: SparkSession
    tables: dict[str, DataFrame | Callable[[], DataFrame]] = field(default_factory=dict)
    #: Category codes besides those that elements have.
    codes: frozenset[str] = CATEGORIES

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        found = self.tables.get(name)
        if not isinstance(found, DataFrame):
            found = self.tables[name] = found() if found else self.spark.createDataFrame([], TABLES[name])
        return found

    def of(self, name: str, doc_id: int) -> DataFrame:
        """A table's rows of one document; the filter reaches the scan."""
        df = getattr(self, name)
        return df.where(F.col("host_doc_id" if name == "links" else "doc_id") == doc_id)

    def knows(self, code: str) -> bool:
        """Whether a category filter accepts a code: a given one, or one that some element has, which its partition or the scan's filter tells."""
        return code in self.codes or not self.elements.where(F.col("category_code") == code).select("id").limit(1).isEmpty()

    def register(self, prefix: str = "") -> None:
        """Temp views for SQL."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(prefix + name)


def read_model(spark: SparkSession, path: str) -> Model:
    """A model stored as one Parquet table for each name; the schemas are given, not inferred. Missing tables are empty."""
    jvm = spark._jvm
    found = {}
    for name, schema in TABLES.items():
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.parquet")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            found[name] = spark.read.schema(schema).parquet(f"{path}/{name}.parquet")
    return Model(spark, found)


#: How tables are laid out: pruned by document (and category), and clustered by what lookups join on.
LAYOUT = {"elements": (["doc_id", "category_code"], ["unique_id"]), "view_elements": (["doc_id"], ["view_id"]), "viewports": (["doc_id"], ["sheet_id"]),
    "opening_rooms": (["doc_id"], ["element_id"])}


def write_model(model: Model, path: str, mode: str = "errorifexists") -> None:
    """Writes the given tables as Parquet, partitioned and sorted by LAYOUT."""
    for name in list(model.tables):
        df = getattr(model, name)
        by, within = LAYOUT.get(name, (["doc_id"] if "doc_id" in df.columns else [], ["id"] if "id" in df.columns else []))
        writer = (df.sortWithinPartitions(*by, *within) if by or within else df).write.mode(mode)
        (writer.partitionBy(*by) if name in LAYOUT else writer).parquet(f"{path}/{name}.parquet")
