"""Lookups with fallbacks and first matches. The small side is always the bounded page or request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(page: DataFrame, side: DataFrame, on: dict[str, str], columns: list[Column]) -> DataFrame:
    """A bounded page with columns of a table (one row for each key), left outer. on: page column -> table column.

    The table is first cut down to the page's keys, by a broadcast of the page; what is left has at most as many rows as
    the page and is broadcast in turn. So the table is scanned once and never shuffled, whatever its size.
    """
    keys = page.select(*[F.col(k).alias(f"__{v}") for k, v in on.items()]).distinct()
    cut = side.join(F.broadcast(keys), [side[v] == keys[f"__{v}"] for v in on.values()], "left_semi")
    picked = cut.select(*[F.col(v).alias(f"__{v}") for v in on.values()], *columns)
    return page.join(F.broadcast(picked), [page[k] == picked[f"__{v}"] for k, v in on.items()], "left").drop(*[f"__{v}" for v in on.values()])


def first_matches(rows: DataFrame, key: Column, order: Column) -> DataFrame:
    """One row for each key: the least in order. Aggregated before the shuffle, so a key's many rows cost no more than one."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key.alias("__key")).agg(F.min_by(whole, order).alias("__row")).select("__key", "__row.*")
