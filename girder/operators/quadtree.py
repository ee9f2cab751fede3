"""Cells that split where there is much: a tree of squares from a bounded sample, which deals out points and areas for range joins."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Points of a sample, and the share of them, one in so many, that a cell holds before it is split. A tree has at most about PARTS * 4 * DEPTH cells, whatever the tables' size.
SAMPLE, PARTS, DEPTH = 40_000, 512, 40
#: Cells are split down to this width (in feet); a smaller one that holds too much is salted instead.
LEAST = 10.0
#: An unsplit cell is divided evenly, as finely as areas of the smaller side stay in so many parts of it on average, and those of the larger side in so many.
#: That is asked of at most LEAVES cells, those where the smaller side has most.
FEW_COPIES, MANY_COPIES, LEAVES = 4.0, 2.25, 20_000


@dataclass
class Tree:
    """Squares by level: those of level 0 have the width size and tile the plane; each that is split has four of half the width in the next level."""

    spark: SparkSession
    size: float
    #: (doc_id, level, cx, cy) of the cells that are split.
    split: set[tuple] = field(default_factory=set)
    #: (doc_id, level, cx, cy) -> tasks that a cell is spread over, where it is more than one.
    salts: dict[tuple, int] = field(default_factory=dict)
    #: (doc_id, level, cx, cy) of unsplit cells -> levels that they are divided by, where it isn't 0.
    depths: dict[tuple, int] = field(default_factory=dict)

    def width(self, level: int) -> float:
        return self.size / 2**level

    def _table(self, rows: list[tuple], extra: str) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(rows, f"__doc long, __level int, __cx long, __cy long{extra}"))

    def placed(self, areas: DataFrame) -> DataFrame:
        """areas (doc_id, x0, y0, x1, y1, ...) with level, cx, cy: a row for each unsplit cell that they touch; a point (x0 = x1, y0 = y1) has one."""
        span = lambda a, w: F.sequence(F.floor(F.col(f"{a}0") / w), F.floor(F.col(f"{a}1") / w))
        found = areas.withColumn("level", F.lit(0)).withColumn("cx", F.explode(span("x", self.size))).withColumn("cy", F.explode(span("y", self.size)))
        for level in sorted({c[1] for c in self.split}):
            cells = self._table([c for c in self.split if c[1] == level], "")
            met = found.join(cells, self._same_cell(), "left")
            low = lambda a: F.greatest(2 * F.col(f"c{a}"), F.floor(F.col(f"{a}0") / self.width(level + 1)))  # noqa: B023, E731
            high = lambda a: F.least(2 * F.col(f"c{a}") + 1, F.floor(F.col(f"{a}1") / self.width(level + 1)))  # noqa: B023, E731
            inner = lambda a: F.when(F.col("__doc").isNull(), F.array(F.col(f"c{a}"))).otherwise(F.sequence(low(a), high(a)))  # noqa: B023, E731
            deeper = F.when(F.col("__doc").isNull(), F.col("level")).otherwise(level + 1)
            halves = met.withColumns({"__xs": inner("x"), "__ys": inner("y"), "level": deeper}).drop("cx", "cy")
            found = halves.withColumn("cx", F.explode("__xs")).withColumn("cy", F.explode("__ys")).drop("__xs", "__ys", "__doc", "__level", "__cx", "__cy")
        return found

    def _leaves(self) -> list[tuple]:
        """(doc_id, level, cx, cy, unsplit, salts, depth) of the cells below split ones, of salted and divided ones, and of split ones of level 0."""
        below = {(d, level + 1, 2 * x + i, 2 * y + j) for d, level, x, y in self.split for i in (0, 1) for j in (0, 1)}
        known = below | set(self.salts) | set(self.depths) | {c for c in self.split if c[1] == 0}
        return [(*c, c not in self.split, self.salts.get(c, 1), self.depths.get(c, 0)) for c in known if c not in self.split or c[1] == 0]

    def placed_points(self, points: DataFrame) -> DataFrame:
        """points (doc_id, x0, y0, ...) with level, cx, cy of the unsplit cell that each is in, __n, its salts, and __d, its depth: of a point's cells in all levels one stays."""
        at = lambda level: F.struct(F.lit(level).alias("level"), F.floor(F.col("x0") / self.width(level)).alias("cx"), F.floor(F.col("y0") / self.width(level)).alias("cy"))
        deepest = max((c[1] + 1 for c in self.split), default=0)
        each = points.withColumn("__at", F.explode(F.array(*map(at, range(deepest + 1))))).select("*", "__at.*").drop("__at")
        cells = self._table(self._leaves(), ", __unsplit boolean, __n int, __d int")
        met = each.join(cells, self._same_cell(), "left").where(F.coalesce("__unsplit", F.col("level") == 0))
        return met.withColumns({"__n": F.coalesce("__n", F.lit(1)), "__d": F.coalesce("__d", F.lit(0))}).drop("__doc", "__level", "__cx", "__cy", "__unsplit")

    @staticmethod
    def _same_cell() -> Column:
        return (F.col("doc_id") == F.col("__doc")) & (F.col("level") == F.col("__level")) & (F.col("cx") == F.col("__cx")) & (F.col("cy") == F.col("__cy"))

    def _salted(self, placed: DataFrame) -> DataFrame:
        """placed areas with __n, the salts of their cell, and __d, its depth."""
        cells = self._table([(*c, self.salts.get(c, 1), self.depths.get(c, 0)) for c in set(self.salts) | set(self.depths)], ", __n int, __d int")
        met = placed.join(cells, self._same_cell(), "left")
        return met.withColumns({"__n": F.coalesce("__n", F.lit(1)), "__d": F.coalesce("__d", F.lit(0))}).drop("__doc", "__level", "__cx", "__cy")

    def _part(self) -> tuple[Column, Column]:
        """Parts of a divided cell along each side, and their width."""
        parts = F.pow(F.lit(2.0), F.col("__d")).cast("long")
        return parts, F.lit(self.size) / F.pow(F.lit(2.0), F.col("level")) / parts

    def _divided(self, placed: DataFrame) -> DataFrame:
        """Areas in unsplit cells: a row for each part of the cell that they touch, as a cell of the level of the parts."""
        parts, width = self._part()
        span = lambda a: F.sequence(F.greatest(F.col(f"c{a}") * parts, F.floor(F.col(f"{a}0") / width)), F.least(F.col(f"c{a}") * parts + parts - 1, F.floor(F.col(f"{a}1") / width)))
        inner = placed.withColumns({"__xs": span("x"), "__ys": span("y"), "level": F.col("level") + F.col("__d")}).drop("cx", "cy", "__d")
        return inner.withColumn("cx", F.explode("__xs")).withColumn("cy", F.explode("__ys")).drop("__xs", "__ys")

    def dealt(self, many: DataFrame, by: Column, points: bool = False) -> DataFrame:
        """The larger side with level, cx, cy and salt: one salt for each row, by a hash of what tells rows apart. points: its areas are points."""
        if points:
            _, width = self._part()
            at = {f"c{a}": F.floor(F.col(f"{a}0") / width) for a in "xy"} | {"level": F.col("level") + F.col("__d")}
            placed = self.placed_points(many).withColumns(at).drop("__d")
        else:
            placed = self._divided(self._salted(self.placed(many)))
        return placed.withColumn("salt", F.pmod(F.hash(by), F.col("__n"))).drop("__n")

    def copied(self, few: DataFrame) -> DataFrame:
        """The smaller side with level, cx, cy and salt: a row for each salt of a cell."""
        return self._divided(self._salted(self.placed(few))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")

    def _sums(self, areas: DataFrame) -> DataFrame:
        """For each unsplit cell how many areas touch it, and the sums of widths, heights and products of both, of what of them is in the cell."""
        width = F.lit(self.size) / F.pow(F.lit(2.0), F.col("level"))
        side = lambda a: F.greatest(F.lit(0.0), F.least(F.col(f"{a}1"), (F.col(f"c{a}") + 1) * width) - F.greatest(F.col(f"{a}0"), F.col(f"c{a}") * width))
        sides = self.placed(areas.select("doc_id", "x0", "y0", "x1", "y1")).select("doc_id", "level", "cx", "cy", side("x").alias("w"), side("y").alias("h"))
        return sides.groupBy("doc_id", "level", "cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum("h").alias("h"), F.sum(F.col("w") * F.col("h")).alias("wh"))

    def divide(self, many: DataFrame | None, few: DataFrame, leaves: int = LEAVES) -> None:
        """Sets depths. A cell of one in so many points still holds more areas the more areas there are; its parts hold as few as its areas' sizes let them.

        many: the larger side, unless its areas are points, which are in one part whatever its size.
        """
        rows = self._sums(few).orderBy(F.desc("n")).limit(leaves)
        if many is not None:
            key = ["doc_id", "level", "cx", "cy"]
            rows = rows.join(self._sums(many).select(*key, *[F.col(c).alias(f"m_{c}") for c in ("n", "w", "h", "wh")]), key, "left")

        def copies(r: dict, side: str, c: float) -> float:
            n, w, h, wh = (r.get(side + k) or 0 for k in ("n", "w", "h", "wh"))
            return 1 + (w / c + h / c + wh / c / c) / n if n else 1

        for r in map(lambda r: r.asDict(), rows.collect()):
            d, width = 0, self.width(r["level"])
            while 4**d < 4 * r["n"] and copies(r, "", width / 2 ** (d + 1)) <= FEW_COPIES and copies(r, "m_", width / 2 ** (d + 1)) <= MANY_COPIES:
                d += 1
            if d:
                self.depths[r["doc_id"], r["level"], r["cx"], r["cy"]] = d

    def holds(self, x: Column, y: Column) -> Column:
        """Whether a point is in the row's own cell."""
        width = F.lit(self.size) / F.pow(F.lit(2.0), F.col("level"))
        return (F.floor(x / width) == F.col("cx")) & (F.floor(y / width) == F.col("cy"))


#: What rows of both sides meet on.
CELL = ["doc_id", "level", "cx", "cy", "salt"]


def _reach(areas: DataFrame) -> Column:
    """How far from the origin areas (x0, y0, x1, y1) reach."""
    return F.coalesce(F.max(F.greatest(*[F.abs(F.col(c)) for c in ("x0", "y0", "x1", "y1")])), F.lit(0.0))


def finite(areas: DataFrame) -> DataFrame:
    """The areas whose bounds are numbers within 10 ** 15."""
    kept = F.lit(True)
    for c in ("x0", "y0", "x1", "y1"):
        kept &= F.abs(F.col(c)) <= 1e15  # NaN is larger than any number
    return areas.where(kept)


def reached(areas: DataFrame, others: DataFrame) -> DataFrame:
    """The areas that touch the bounds of all others; the rest meets none of them."""
    low_x, low_y, high_x, high_y = map(F.lit, others.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first())
    return areas.where((F.col("x1") >= low_x) & (F.col("x0") <= high_x) & (F.col("y1") >= low_y) & (F.col("y0") <= high_y))


def grown(many: DataFrame, few: DataFrame, parts: int = PARTS, sample: int = SAMPLE, least: float = LEAST, points: bool = False) -> Tree:
    """A tree for two sides of areas (doc_id, x0, y0, x1, y1): of the larger one no unsplit cell, or salt of one, holds much more than one in parts.

    A sample of that side, of at most about the given size, and sums over cells are all that the driver sees. They decide
    who does what, never what is found. Cells of level 0 are so wide that no area touches more than 65 * 65. points: areas
    of the larger side are points.
    """
    n, reach = many.agg(F.count(F.lit(1)), _reach(many)).first()
    extent = max(reach, few.agg(_reach(few)).first()[0], least)
    tree = Tree(many.sparkSession, max(2.0 ** math.ceil(math.log2(extent / 32)), least))
    middle = [((F.col(f"{a}0") + F.col(f"{a}1")) / 2).alias(a) for a in "xy"]
    left = [tuple(r) for r in many.select("doc_id", *middle).sample(min(1.0, sample / max(n, 1)), seed=7).limit(2 * sample).collect()]
    most, level = max(1, len(left) // parts), 0
    while left:
        cell = lambda p: (p[0], level, math.floor(p[1] / tree.width(level)), math.floor(p[2] / tree.width(level)))  # noqa: B023, E731
        counts = Counter(map(cell, left))
        full = {c: k for c, k in counts.items() if k > most}
        if level == DEPTH or tree.width(level + 1) < least:
            tree.salts |= {c: -(-k // most) for c, k in full.items()}
            break
        tree.split |= set(full)
        left, level = [p for p in left if cell(p) in full], level + 1
    tree.divide(None if points else many, few)
    return tree
