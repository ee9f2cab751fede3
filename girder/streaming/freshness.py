"""Extension: the freshness stamps of documents from a stream of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamps(snapshots: DataFrame) -> DataFrame:
    """The latest stamp of each document, from rows of documents as a stream (or a batch): one state row for each document.

    The version changes only on a save, so of snapshots with as many saves the one with unsaved changes is the later.
    """
    order = F.struct(F.coalesce("number_of_saves", F.lit(-1)).alias("saves"), F.col("is_modified").alias("modified"))
    stamp = F.struct("title", "version_guid", "number_of_saves", F.col("is_modified").alias("has_unsaved_changes"))
    return snapshots.groupBy("doc_id").agg(F.max_by(stamp, order).alias("stamp"), F.count("*").alias("snapshots")).select("doc_id", "stamp.*", "snapshots")
