"""Arguments of queries: plain JSON values, read on the driver. A value of the wrong type mostly counts as absent."""

from __future__ import annotations

import re

_WHOLE = re.compile(r"\s*[+-]?\d+\s*")


#: Its texts, in the queries, are fixed values: what a caller is told.
class QueryError(Exception):
    """A query that can't be answered; the message goes to the caller."""


def text(args: dict, name: str) -> str | None:
    return v if isinstance(v := args.get(name), str) else None


def _whole(args: dict, name: str, bits: int) -> int | None:
    v = args.get(name)
    if isinstance(v, str) and _WHOLE.fullmatch(v):
        v = int(v)
    return v if isinstance(v, int) and not isinstance(v, bool) and -(1 << bits - 1) <= v < 1 << bits - 1 else None


def long(args: dict, name: str) -> int | None:
    """A whole number or its text."""
    return _whole(args, name, 64)


def int32(args: dict, name: str) -> int | None:
    return _whole(args, name, 32)


def double(args: dict, name: str) -> float | None:
    v = args.get(name)
    if isinstance(v, bool) or not isinstance(v, (int, float, str)):
        return None
    try:
        return float(v)
    except ValueError:
        return None


def flag(args: dict, name: str) -> bool:
    """Only true counts, not 1 or "true"."""
    return args.get(name) is True


def limit(args: dict, default: int = 200, most: int = 1000, name: str = "limit") -> int:
    n = int32(args, name)
    return default if n is None else max(1, min(most, n))


def number_limit(args: dict, default: int, most: int) -> int:
    """Texts are ignored; a fraction, or a number beyond 32 bits, is a fault."""
    v = args.get("limit")
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return default
    return max(1, min(most, _exact(v, 32)))


def _exact(v: float, bits: int) -> int:
    if not isinstance(v, int) or not -(1 << bits - 1) <= v < 1 << bits - 1:
        raise ValueError(f"{v} is not a whole number of {bits} bits.")
    return v


def ids(args: dict, name: str = "element_ids") -> list[int] | None:
    """The numbers of an array, in order and with duplicates; other items are dropped. None if there is no array."""
    v = args.get(name)
    return [_exact(x, 64) for x in v if isinstance(x, (int, float)) and not isinstance(x, bool)] if isinstance(v, list) else None


def keys(args: dict, one: str, many: str) -> list[str]:
    """The single key, then the array's, in order and with duplicates; empty ones and those that aren't texts are dropped."""
    v = args.get(many)
    return [x for x in [args.get(one), *(v if isinstance(v, list) else [])] if isinstance(x, str) and x]


def names(args: dict, name: str, default: list[str]) -> list[str]:
    """The texts of an array that aren't blank; the default if there are none."""
    v = args.get(name)
    return [x for x in v if isinstance(x, str) and x.strip()] or default if isinstance(v, list) else default


def fields(args: dict) -> set[str] | None:
    """Columns to keep, without regard to case; None for all."""
    v = args.get("fields")
    return {x.lower() for x in v if isinstance(x, str)} or None if isinstance(v, list) else None


#: Fragments of input schemas.
NOTHING = {"type": "object", "properties": {}, "additionalProperties": False}
FIELDS = {"type": "array", "items": {"type": "string"}, "description": "Columns to keep in each row; id always stays."}

COLLATION = {"type": "string", "description": "Order of texts, by the name of a collation (such as UNICODE or en); by code points if there is none."}


def limit_schema(default: int = 200, most: int = 1000) -> dict:
    return {"type": "integer", "description": f"Rows to return at most (default {default}, up to {most})."}


def schema(**properties) -> dict:
    return {"type": "object", "properties": properties, "additionalProperties": False}


def of(kind: str, description: str, items: str | None = None) -> dict:
    return {"type": kind, **({"items": {"type": items}} if items else {}), "description": description}
