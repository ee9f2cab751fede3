"""Mixing sources to target weights by Poisson replication.

A source with weight w of all weights W should make up w / W of the mix, so each of its n documents is repeated w * N /
(W * n) times on average (N: documents of the mix). How often one document is repeated is the inverse of the Poisson
distribution with that mean at a uniform number made of a hash of seed and doc_id: it needs no state, gives the same
mix when a task runs again, and doesn't depend on partitions. Replicas are then dealt out by a second hash and sorted
by it, which shuffles them globally, whatever source holds a third of all rows.

Without given weights, a source of n documents weighs n ** TEMPERATURE. A source without a given weight weighs 0; a
null source is a source of its own, other than that of an empty name (in weights, None names it); a row without doc_id
is hashed as an empty id. Rows that share an id get the same number of replicas, and null, empty and very long texts
are rows like others. An empty table stays empty. Input columns named replica or shuffle_key are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, label, passed_on, table, written

TEMPERATURE = 0.7
SEED = 17


def _uniform(*parts: Column | str) -> Column:
    """In [0, 1), with 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def poisson_steps(means: DataFrame) -> DataFrame:
    """means (rows of rate) with __steps: the cumulative Poisson probabilities of 0, 1, 2, ... up to where they are 1 in all digits that matter.

    Each source has a row for each of its steps, and running sums over them. Its steps then are one array, about as long
    as its rate, so rates (repetitions of one document) are bounded by a task's memory: some tens of millions.
    """
    most = F.when(F.col("rate") > 0, F.col("rate") + 12 * F.sqrt("rate") + 20).otherwise(0).cast("long")
    each = means.select("__source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), most)).alias("k"))
    so_far = Window.partitionBy("__source").orderBy("k")
    log = F.when(F.col("rate") > 0, F.sum(F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log(F.col("rate") / F.col("k")))).over(so_far)).otherwise(0.0)
    summed = each.withColumn("p", F.exp(log)).withColumn("total", F.sum("p").over(so_far))
    steps = F.transform(F.sort_array(F.collect_list(F.struct("k", "total"))), lambda s: s["total"])
    return summed.groupBy("__source").agg(F.first("rate").alias("rate"), steps.alias("__steps"))


def rates(docs: DataFrame, by: str, weights: dict[str | None, float] | None, total: int | None) -> DataFrame:
    """__source, rate, __steps of each source."""
    counts = written(docs.groupBy(label(F.col(by)).alias("__source")).agg(F.count("*").alias("n")), "sources")
    if weights is None:
        weighed = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE)))
    else:
        chosen = F.lit(0.0)
        for name, w in weights.items():
            chosen = F.when(F.col("__source") == label(F.lit(name)), float(w)).otherwise(chosen)
        weighed = counts.withColumn("w", chosen)
    all_n, all_w = weighed.agg(F.sum("n"), F.sum("w")).first()
    size = float(total if total is not None else all_n or 0)
    rate = F.col("w") * size / (F.lit(all_w) * F.col("n")) if all_w else F.lit(0.0)
    return poisson_steps(weighed.select("__source", rate.alias("rate")))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, by: str = "source", seed: int = SEED) -> DataFrame:
    """docs, each row as often as its Poisson number says, with replica (from 1) and shuffle_key, in the order of shuffle_key within each partition."""
    per_source = broadcast_if_small(passed_on(rates(docs, by, weights, total), "rates"), 64 + F.octet_length("__source") + 8 * F.size("__steps"))
    columns = [c for c in docs.columns if c not in ("replica", "shuffle_key")]
    joined = docs.join(per_source, label(docs[by]) == per_source["__source"])
    doc_id = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    times = F.size(F.filter(F.transform(per_source["__steps"], lambda s: s <= _uniform(F.lit(str(seed)), doc_id)), lambda x: x))
    chosen = joined.select(*[docs[c] for c in columns], times.alias("__times")).where("__times > 0")
    replicas = chosen.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("replica"))
    keyed = replicas.withColumn("shuffle_key",
        F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("replica").cast("string"))))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op3_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def mix_sql(view: str, columns: str) -> str:
    """The mix of a view in DuckDB SQL."""
    return f"""
n_src AS (SELECT coalesce('=' || source, '-') AS s, count(*) AS n, pow(count(*)::DOUBLE, {TEMPERATURE}::DOUBLE) AS w FROM {view} GROUP BY 1),
rate AS (SELECT s, w * (SELECT sum(n) FROM n_src)::DOUBLE / ((SELECT sum(w) FROM n_src) * n) AS rate FROM n_src),
steps AS (SELECT s, list(p ORDER BY k) AS steps FROM (SELECT s, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1.0))) OVER (PARTITION BY s ORDER BY k) AS p FROM rate, unnest(range((rate + 12 * sqrt(rate) + 20)::INT + 1)) t(k)) GROUP BY s),
times AS (SELECT v.*, len(list_filter(steps, lambda x: x <= ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)) AS times FROM {view} v JOIN steps ON coalesce('=' || v.source, '-') = steps.s)
SELECT {columns}, k::INT AS replica, md5('{SEED}-order:' || coalesce(doc_id::VARCHAR, '') || ':' || k) AS shuffle_key FROM times, unnest(range(1, times + 1)) t(k)
"""


ORACLE_SQL = "WITH " + mix_sql("documents", "doc_id, text, lang, source, n_chars").lstrip()
