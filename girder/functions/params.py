"""Parameters of elements, types and rooms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filled

#: Parameters that may point at an element's level, in the order in which they are asked.
LEVEL_PARAMS = (
    "WALL_BASE_CONSTRAINT", "FAMILY_LEVEL_PARAM", "FAMILY_BASE_LEVEL_PARAM", "SCHEDULE_LEVEL_PARAM", "INSTANCE_REFERENCE_LEVEL_PARAM",
    "INSTANCE_SCHEDULE_ONLY_LEVEL_PARAM", "ROOM_LEVEL_ID", "LEVEL_PARAM", "STAIRS_BASE_LEVEL_PARAM", "GROUP_LEVEL",
)
#: The labels of a classification and the parameters that hold them.
CLASSIFICATION = {"assembly_code": "UNIFORMAT_CODE", "assembly_description": "UNIFORMAT_DESCRIPTION", "omniclass_code": "OMNICLASS_CODE",
    "omniclass_description": "OMNICLASS_DESCRIPTION"}


def param(params: Column, name: str) -> Column:
    return F.try_element_at(params, F.lit(name))


def param_text(p: Column) -> Column:
    """A parameter as text: the host's rendering if there is one, else its value; up to six decimals, no trailing zeros."""
    number = F.regexp_replace(F.call_function("format_number", p["d"], F.lit("0.######")), "^-0$", "0")
    by_storage = F.when(p["storage"] == "String", p["s"]).when(p["storage"] == "Integer", p["i"].cast("string")).when(p["storage"] == "Double",
        number).when(p["storage"] == "ElementId", p["eid"].cast("string"))
    return F.coalesce(filled(p["display"]), by_storage)


def string_value(p: Column) -> Column:
    """The raw text of a text parameter, null of any other."""
    return F.when(p["storage"] == "String", p["s"])


def instance_or_type(name: str, instance: Column, of_type: Column) -> Column:
    """An instance's parameter as text, else its type's. An empty text is a value and hides the type's."""
    return F.coalesce(param_text(param(instance, name)), param_text(param(of_type, name)))


def labels(params: Column) -> Column:
    """What parameters alone hold of a classification: a text or null for each label."""
    return F.struct(*[filled(string_value(param(params, p))).alias(label) for label, p in CLASSIFICATION.items()])


def classified(of_type: Column, instance: Column) -> Column:
    """A classification from the labels of a type and those of an instance: for each the type's, else the instance's; null if there is none at all."""
    values = [F.coalesce(of_type[label], instance[label]).alias(label) for label in CLASSIFICATION]
    return F.when(F.coalesce(*values).isNotNull(), F.struct(*values))


def classification(of_type: Column, instance: Column) -> Column:
    """For each label the type's text, else the instance's, empty ones skipped; null if there is none at all."""
    return classified(labels(of_type), labels(instance))


def level_candidates(params: Column) -> Column:
    """Ids that the level parameters hold, in order; none that isn't an element id."""
    ids = [F.when(param(params, p)["storage"] == "ElementId", param(params, p)["eid"]) for p in LEVEL_PARAMS]
    return F.filter(F.array(*ids), lambda i: i.isNotNull() & (i != -1))
