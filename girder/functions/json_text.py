"""JSON texts as expressions: compact, in a given order of names, with nulls left out or kept by name. What the driver writes for a page, tasks write for a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, MapType, StringType, StructType

#: Control characters that have a short form.
SHORT = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is computed once although body refers to it often."""
    return F.transform(F.array(value), body)[0]


def quoted(c: Column) -> Column:
    """A text in quotes; null stays null."""
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escapes = {chr(i): SHORT.get(chr(i), f"\\u{i:04x}") for i in range(32)} | {"\\": "\\\\", '"': '\\"'}
    table = F.create_map(*[F.lit(x) for pair in escapes.items() for x in pair])
    one_by_one = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    return F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x1f]"), one_by_one).otherwise(plain), F.lit('"'))


def number(c: Column) -> Column:
    """A double in the fewest digits that tell it apart: in full from 0.0001 up to 10 ** 16, else with an exponent of two digits at least."""

    def in_e(parts: Column) -> Column:
        """From sign, digits without a point, and exponent."""
        sign, digits, exponent = parts["sign"], parts["digits"], parts["exponent"]
        after = lambda n: F.substring(digits, n, F.lit(400))
        in_full = F.concat(sign, F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, "0"), F.lit("."), F.coalesce(F.nullif(after(exponent + 2), F.lit("")), F.lit("0")))
        small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
        point = F.when(F.length(digits) > 1, ".").otherwise("")
        scientific = F.concat(sign, F.substring(digits, 1, 1), point, after(F.lit(2)), F.lit("e"), F.format_string("%+03d", exponent))
        return F.when(exponent.between(0, 15), in_full).when(exponent.between(-4, -1), small).otherwise(scientific)

    def parted(text: Column) -> Column:
        """Of a text with an exponent."""
        digits = F.rtrim(F.translate(F.regexp_replace(text, "[eE].*", ""), "-.", ""), F.lit("0"))
        return F.struct(F.when(c < 0, "-").otherwise("").alias("sign"), digits.alias("digits"), F.regexp_extract(text, "[eE](.*)", 1).cast("int").alias("exponent"))

    def written(text: Column) -> Column:
        # the JVM may print 17 or 18 digits where fewer do
        exact = [F.when(x.cast("double") == c, x) for x in (F.format_string(f"%.{n}e", c) for n in (14, 15, 16))]
        shorter = F.when(F.length(F.translate(F.regexp_replace(text, "E.*", ""), "-.", "")) >= 17, F.coalesce(*exact))
        with_e = F.coalesce(shorter, F.when(F.contains(text, F.lit("E")), text))
        return F.when(with_e.isNull(), text).otherwise(let(parted(with_e), in_e))

    return let(c.cast("string"), written)


def json_text(c: Column, kind: DataType) -> Column:
    """The JSON of a value; null of null. Nulls inside it are kept."""
    if isinstance(kind, StringType):
        return quoted(c)
    if isinstance(kind, (DoubleType, FloatType)):
        return number(c)
    if isinstance(kind, BooleanType):
        return c.cast("string")
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), object_text([(f.name, or_null(json_text(c[f.name], f.dataType))) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        items = F.transform(c, lambda x: or_null(json_text(x, kind.elementType)))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.concat(quoted(e["key"]), F.lit(":"), or_null(json_text(e["value"], kind.valueType))))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    return c.cast("string")


def or_null(text: Column) -> Column:
    return F.coalesce(text, F.lit("null"))


def object_text(writes: Sequence[tuple[str, Column]]) -> Column:
    """An object from writes (name, JSON text or null) in order. A null leaves the name out. What is written to a name again takes the place of its first write."""
    by_name: dict[str, list[Column]] = {}
    for name, text in writes:
        by_name.setdefault(name, []).append(text)
    seen: dict[str, int] = {}
    parts = []
    for name, text in writes:
        k = seen[name] = seen.get(name, -1) + 1
        own = by_name[name]
        last = F.coalesce(*reversed(own)) if len(own) > 1 else text
        first_here = reduce(lambda acc, earlier: acc & earlier.isNull(), own[:k], text.isNotNull())
        parts.append(F.when(first_here, F.concat(quoted(F.lit(name)), F.lit(":"), last)))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def projected(writes: Sequence[tuple[str, Column, Column]], fields: set[str] | None) -> Column:
    """An object from (name, JSON text or null to leave it out, value), cut down to fields if there are any: id first; nulls go, also those that are else kept."""
    if not fields:
        return object_text([(name, text) for name, text, _ in writes])
    chosen = [w for w in writes if w[0] == "id"] + [w for w in writes if w[0] != "id" and w[0].lower() in fields]
    return object_text([(name, F.when(value.isNotNull(), text)) for name, text, value in chosen])
