"""Keys of documents and elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, filled

#: The constant in the source column, and the prefix of project keys that stem from project information.
SOURCE = "pdra"
PROJECT_PREFIX = "revit:"


def project_key(info_uid: Column, path: Column, title: Column) -> Column:
    """The project information's id, else 16 hex digits of the path's SHA-256, else the title, else empty."""
    hashed = F.substring(F.sha2(filled(path), 256), 1, 16)
    return F.coalesce(F.concat(F.lit(PROJECT_PREFIX), filled(info_uid)), hashed, blank(title))


def document_key() -> Column:
    """project_key of a row of documents."""
    return project_key(F.col("project_info.unique_id"), F.col("path"), F.col("title"))
