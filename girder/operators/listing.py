"""Bounded pages of ordered rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: No page is larger: the largest limit that any query accepts.
LARGEST = 10_000


@dataclass
class Page:
    """The first rows of an ordered result, held as a local relation of at most LARGEST rows, and how many rows there were."""

    df: DataFrame
    count: int
    total: int


def page(df: DataFrame, order: list, limit: int) -> Page:
    """The first limit rows in order (which must be total), planned as top-k without a full sort. The rows are counted as they pass by, so the input is read once."""
    limit = min(limit, LARGEST)
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n")).orderBy(*order).limit(limit).collect()
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return Page(local, len(rows), seen.get.get("n", 0))


def held(df: DataFrame) -> DataFrame:
    """A page with what was looked up for it, as a local relation again, so that what follows is planned without the lookups."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def with_positions(values: list, df_schema: str, spark) -> DataFrame:
    """A request's keys in order, duplicates included."""
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"pos int, {df_schema}")
