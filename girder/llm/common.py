"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Java patterns of what separates words: the six ASCII blanks; all ASCII but letters and digits.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most rows and bytes of a side that is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
#: Spark's setting by which shuffle files go with the job that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of how many rows go to Python at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's setting of how many bytes go to Python at once, and its value where rows are large.
BATCH_BYTES, AT_MOST = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


#: Names of the folders that were made for tables here.
_MADE: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is computed once although body refers to it often, also in lambdas."""
    return F.transform(F.array(value), body)[0]


def laid_out(parts: Column, length: Callable[[Column], Column], make: Callable[[Column, Column], Column], kind: str) -> Column:
    """make(x, at) of each x of parts, of type kind, where at is the sum of the lengths before it; nulls are left out.

    Spark copies an array to append to it, so parts are folded in blocks of 256, and the blocks' results then appended.
    """
    none = F.array().cast(f"array<{kind}>")
    zero = lambda at, out: F.struct(at.alias("at"), out.alias("out"))
    step = lambda acc, x: zero(acc["at"] + length(x), F.concat(acc["out"], F.array(make(x, acc["at"]))))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(256)), lambda i: F.slice(parts, i + 1, 256))
    whole = lambda acc, block: let(F.aggregate(block, zero(acc["at"], none), step), lambda b: zero(b["at"], F.concat(acc["out"], F.array(b["out"]))))
    folded = F.aggregate(blocks, zero(F.lit(0).cast("long"), F.array().cast(f"array<array<{kind}>>")), whole, lambda acc: acc["out"])
    return F.filter(F.flatten(folded), lambda x: x.isNotNull())


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def blank_words(text: Column) -> Column:
    """The words between ASCII blanks; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def alnum_words(text: Column) -> Column:
    """The maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case; none of a null text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM), "")


def label(value: Column) -> Column:
    """A text for a value of any type, in which null differs from every value, also from an empty text."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def text_key(text: Column) -> Column:
    """With doc_id, tells apart rows that share an id but not the text."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(7))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir. Only where driver and executors are one process may that be unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    own = f"{name}-{uuid.uuid4().hex}"
    _MADE.add(own)
    return f"{base.rstrip('/')}/{own}"


def _setting(spark: SparkSession, name: str) -> str | None:
    """A setting's value, also where that is Spark's own; None where this version of Spark doesn't know it."""
    try:
        return spark.conf.get(name)
    except PySparkException:
        return None


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Spark's settings for what runs within; those that this version of Spark doesn't know are left out."""
    names = {"cleanup": CLEANUP, "batch": BATCH, "batch_bytes": BATCH_BYTES}
    before = {names[k]: _setting(spark, names[k]) for k in values}
    known = {names[k]: v for k, v in values.items() if before[names[k]] is not None}
    try:
        for k, v in known.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in known:
            spark.conf.set(k, before[k])


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """df, computed once: written as Parquet to the shared folder and read from there, so that no lost executor can take it along.

    The job's shuffle files go when it is over. batch: most rows that go to Python at once, where rows are large.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    with settings(spark, cleanup="true", **({"batch": str(batch), "batch_bytes": str(AT_MOST)} if batch else {})):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        for folder in _folders(df):
            delete(df.sparkSession, folder)


def passed_on(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """df, written; the written tables that it was made from go. Only for what nothing else reads them for."""
    spark, found = df.sparkSession, written(df, name, batch)
    for folder in _folders(df):
        if folder.rsplit("/", 1)[1] in _MADE:
            delete(spark, folder)
    return found


def small(df: DataFrame, row_bytes: int | Column) -> bool:
    """Whether a written table is within the bounds of a broadcast. row_bytes: of each row, or what each row has."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A written table, marked for broadcast if its counted rows and bytes are within the bounds; else the join shuffles and AQE splits hot keys."""
    return F.broadcast(df) if small(df, row_bytes) else df
