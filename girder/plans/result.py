"""Results: a DataFrame of bounded rows and an envelope; JSON is made at the edge."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def drop_empty(row: dict, *names: str) -> dict:
    """The row without those of the named keys that hold null or an empty text."""
    return {k: v for k, v in row.items() if k not in names or v not in (None, "", {})}


def projected(row: dict, fields: set[str] | None) -> dict:
    """The row cut down to fields: id first, if it has one; nulls go; the rest keeps its order."""
    if not fields:
        return row
    first = {"id": row["id"]} if row.get("id") is not None else {}
    return first | {k: v for k, v in row.items() if k != "id" and k.lower() in fields and v is not None}


@dataclass
class Result:
    df: DataFrame
    envelope: dict = field(default_factory=dict)
    rows_key: str | None = None
    row: Callable[[dict], dict] = dict

    def to_dict(self) -> dict:
        rows = [self.row(r.asDict(recursive=True)) for r in self.df.collect()]
        return {**self.envelope, self.rows_key: rows} if self.rows_key else rows[0]

    def text(self) -> str:
        return json.dumps(self.to_dict(), separators=(",", ":"), ensure_ascii=False)
