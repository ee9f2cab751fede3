"""A stored index of elements by their IFC id, folded: the first element of each id and document, in buckets by the id's hash.

Each document's part has a version of its own below the index's folder. Which version holds is in a small table of
stamps, of which the latest generation counts; a part is written in full before the stamps name it, so a reader sees the
old or the new one, and a lost job leaves nothing half done. A lookup reads one bucket of one document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.functions.text import filled, folded

from .model import Model

#: Buckets of a document's part.
BUCKETS = 256
COLUMNS = ("id", "unique_id", "name", "category", "type_id")
ENTRY = "key string, id long, unique_id string, name string, category string, type_id long, doc_id long, version string, bucket int"
STAMP = "doc_id long, version string, version_guid string, number_of_saves int, is_modified boolean"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def bucket_of(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS))


def partials(elements: DataFrame) -> DataFrame:
    """doc_id, key and the first element (the least id) of each folded id: of all elements, or of some, to be merged with others'."""
    own = elements.where(~F.col("is_type")).select("doc_id", folded(filled(F.col("ifc_guid"))).alias("key"), *COLUMNS).where("key IS NOT NULL")
    return merged(own)


def merged(entries: DataFrame) -> DataFrame:
    """One entry for each document and id out of several: the least."""
    first = F.min_by(F.struct(*COLUMNS), F.col("id")).alias("first")
    return entries.groupBy("doc_id", "key").agg(first).select("doc_id", "key", "first.*")


class GuidIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _generations(self) -> list[int]:
        fs, at = self._fs(f"{self.path}/stamps")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        done = [int(n.partition("=")[2]) for n in names if n.startswith("generation=")]
        return sorted(g for g in done if fs.exists(self._fs(f"{self.path}/stamps/generation={g}/_SUCCESS")[1]))

    def stamps(self) -> DataFrame:
        """What the index holds: for each document the version of its part, and the model's stamp when that was made."""
        if not (found := self._generations()):
            return self.spark.createDataFrame([], STAMP)
        return self.spark.read.schema(STAMP).parquet(f"{self.path}/stamps/generation={found[-1]}")

    def entries(self) -> DataFrame:
        """All parts, of whatever version."""
        fs, at = self._fs(f"{self.path}/entries")
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries") if fs.exists(at) else self.spark.createDataFrame([], ENTRY)

    def current(self) -> DataFrame:
        """The entries that hold: a semi-join with one row for each document."""
        held = self.stamps().select(F.col("doc_id").alias("__doc"), F.col("version").alias("__version"))
        return self.entries().join(held, (F.col("doc_id") == F.col("__doc")) & (F.col("version") == F.col("__version")), "left_semi")

    def _put(self, entries: DataFrame, version: str) -> None:
        laid = entries.withColumns({"version": F.lit(version), "bucket": bucket_of(F.col("key"))})
        ordered = laid.repartition("doc_id", "bucket").sortWithinPartitions("doc_id", "bucket", "key")
        ordered.select(*_names(ENTRY)).write.partitionBy("doc_id", "version", "bucket").mode("append").parquet(f"{self.path}/entries")

    def _stamped(self, stamps: DataFrame) -> None:
        generation = (self._generations() or [0])[-1] + 1
        stamps.select(*_names(STAMP)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/stamps/generation={generation}")

    def changed(self, model: Model) -> DataFrame:
        """The documents' stamps that the index lacks or has otherwise."""
        now = model.documents.select("doc_id", "version_guid", "number_of_saves", "is_modified")
        held = self.stamps().select(*[F.col(c).alias(f"h_{c}") for c in now.columns])
        same = F.lit(True)
        for c in now.columns:
            same &= F.col(c).eqNullSafe(F.col(f"h_{c}"))
        return now.join(held, same, "left_anti")

    def refresh(self, model: Model) -> bool:
        """Reads the documents whose stamp has changed, and only those, and replaces their parts. Whether there were any."""
        changed = self.changed(model)
        if changed.isEmpty():
            return False
        version = uuid.uuid4().hex
        before = self.stamps()
        asked = changed.select(F.col("doc_id").alias("__doc"))
        self._put(partials(model.elements.join(asked, F.col("doc_id") == F.col("__doc"), "left_semi")), version)
        kept = before.join(model.documents.select("doc_id"), "doc_id", "left_semi").join(asked, F.col("doc_id") == F.col("__doc"), "left_anti")
        self._stamped(kept.unionByName(changed.withColumn("version", F.lit(version))))
        return True

    def add(self, elements: DataFrame, stamps: DataFrame) -> None:
        """Merges the entries of elements that came to documents (none changed, none went) with what the index holds of those documents.

        stamps: the documents' stamps after that (doc_id, version_guid, number_of_saves, is_modified).
        """
        version = uuid.uuid4().hex
        before = self.stamps()
        asked = stamps.select(F.col("doc_id").alias("__doc"))
        old = self.current().join(asked, F.col("doc_id") == F.col("__doc"), "left_semi").select("doc_id", "key", *COLUMNS)
        self._put(merged(old.unionByName(partials(elements).select("doc_id", "key", *COLUMNS))), version)
        self._stamped(before.join(asked, F.col("doc_id") == F.col("__doc"), "left_anti").unionByName(stamps.withColumn("version", F.lit(version))))

    def _part(self, doc_id: int) -> DataFrame:
        """A document's part that holds; no other folder is listed."""
        held = self.stamps().where(F.col("doc_id") == doc_id).select("version").first()
        path = f"{self.path}/entries/doc_id={doc_id}/version={held['version'] if held else ''}"
        fs, at = self._fs(path)
        if held is None or not fs.exists(at):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).option("basePath", f"{self.path}/entries").parquet(path)

    def lookup(self, doc_id: int, ifc_guid: str) -> DataFrame:
        """The entry of an id in a document, if there is one; reads one bucket of the part that holds."""
        key = folded(F.lit(ifc_guid))
        return self._part(doc_id).where((F.col("bucket") == bucket_of(key)) & (F.col("key") == key)).select("doc_id", "key", *COLUMNS)

    def lookups(self, doc_id: int, requests: DataFrame) -> DataFrame:
        """Requests (ifc_guid and whatever else) of any number with their entries."""
        part = self._part(doc_id).select("key", *COLUMNS)
        return requests.join(part, folded(F.col("ifc_guid")) == F.col("key"), "left").drop("key")

    def vacuum(self) -> None:
        """Deletes parts and stamps that no longer hold."""
        held = {(r["doc_id"], r["version"]) for r in self.stamps().select("doc_id", "version").toLocalIterator()}
        fs, at = self._fs(f"{self.path}/entries")
        for doc in fs.listStatus(at) if fs.exists(at) else ():
            number = doc.getPath().getName().partition("=")[2]
            for part in fs.listStatus(doc.getPath()) if doc.isDirectory() and "=" in doc.getPath().getName() else ():
                if (int(number), part.getPath().getName().partition("=")[2]) not in held:
                    fs.delete(part.getPath(), True)
        for g in self._generations()[:-1]:
            fs.delete(self._fs(f"{self.path}/stamps/generation={g}")[1], True)
