"""Prefix doubling of all positions, as it stands in books: a reference for tests, and what README's figures of it were measured with."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from girder.llm.common import written


def repeated_windows(docs: DataFrame, length: int = 200, start: int = 8) -> DataFrame:
    """d (of the row), p: where a string of length bytes starts that also starts elsewhere. A round sorts pairs of ranks, of strings of n bytes at p and at p + n or less; what is unique goes."""
    texts = written(docs.select(F.monotonically_increasing_id().alias("d"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("b")), "texts")
    places = texts.where(F.octet_length("b") >= length).select("d", "b", F.explode(F.sequence(F.lit(0), F.octet_length("b") - start)).alias("p"))
    ranks, n = written(places.select("d", "p", F.conv(F.hex(F.substring("b", F.col("p") + 1, F.lit(start))), 16, -10).cast("long").alias("r")), "ranks"), start
    while n < length:
        step = min(n, length - n)
        after = ranks.select("d", (F.col("p") - step).alias("p"), F.col("r").alias("r2"))
        pairs = ranks.join(after, ["d", "p"])
        same = Window.partitionBy("r", "r2")
        place = F.shiftleft("d", 20) + F.col("p")
        ranked = pairs.select("d", "p", F.count("*").over(same).alias("n"), F.min(place).over(same).alias("rank"))
        ranks, n = written(ranked.where("n > 1").select("d", "p", F.col("rank").alias("r")), "ranks"), n + step
    return ranks.select("d", "p")
