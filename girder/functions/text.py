"""Nulls, blanks and case."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that an ordinal comparison leaves as they are although they have a capital, which is ASCII.
KEPT = "ıſ"


def filled(c: Column) -> Column:
    """Null instead of an empty string."""
    return F.nullif(c, F.lit(""))


def blank(c: Column) -> Column:
    """An empty string instead of null."""
    return F.coalesce(c, F.lit(""))


def _capital(letter: str) -> str:
    """The one code point that is a letter's capital; the letter where there is none, or only one of several code points."""
    return next((x for x in (letter.upper(), letter.title()) if len(x) == 1), letter) if letter not in KEPT else letter


@cache
def letters() -> tuple[str, str]:
    """Letters that have a capital, and those capitals."""
    pairs = [(chr(i), _capital(chr(i))) for i in range(0x20000) if not 0xD800 <= i < 0xE000]
    changed = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in changed), "".join(b for _, b in changed)


def folded(c: Column) -> Column:
    """Text as an ordinal comparison without regard to case sees it: each code point by itself in upper case, so that no text changes its length."""
    return F.when(F.octet_length(c) == F.char_length(c), F.upper(c)).otherwise(F.translate(c, *letters()))


def same_text(a: Column, b: Column | str) -> Column:
    """Equal without regard to case, as an ordinal comparison folds it."""
    return folded(a) == folded(F.lit(b) if isinstance(b, str) else b)


def in_order(name: str, collation: str | None) -> list[Column]:
    """What orders rows by a text: its code points, or a collation's order and, where that sees no difference, code points."""
    return [F.collate(F.col(name), collation), F.col(name)] if collation else [F.col(name)]
