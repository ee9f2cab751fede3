"""Line dedup: lines that many sites share are kept in one document and removed from the others.

A line's spread is the number of distinct sites (sources) that hold it; lines of MIN_SITES (10) sites or more go. The
threshold is fixed: a corpus of fewer sites loses no line. One aggregation merges HyperLogLog sketches per
line hash, from partial sketches made before the shuffle, so that a line in a third of all documents costs no more than
another. Lines whose estimate is clear of the threshold are decided; those near it get exact distinct counts. Only
spread lines reach the documents again, as hashes; that join shuffles the texts once, at every size.

Lines are what line feeds separate; a line without a word is never removed. Line hashes have 96 bits. The document
with the smallest doc_id that holds a line keeps it (all rows of that id do), also several times; rows without doc_id
keep it only if no row with one holds it. A null source is a site of its own, other than that of an empty name. A null
text stays null; if all lines go, the text is empty. Rows that repeat count once for their site. An empty table stays
empty. Texts of any length are worked through whole; other columns stay as they are, but for input columns named n_lines
or n_removed, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, drop, label, table, text_key, written

MIN_SITES = 10
LG_BUCKETS = 12
#: Estimates within this share of the threshold, and one more, are counted exactly: six standard errors of the sketch.
MARGIN = 6 * 1.04 / 2 ** (LG_BUCKETS / 2)


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"))


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))


def lines(docs: DataFrame, site: str) -> DataFrame:
    """h1, h2, site, doc_id, key, pos: each line with a word, and its place in the text."""
    each = docs.select("doc_id", text_key(F.col("text")).alias("key"), label(F.col(site)).alias("site"), F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    found = each.where(_has_word(F.col("line"))).select(_hash(F.col("line")).alias("h"), "site", "doc_id", "key", "pos")
    return found.select("h.*", "site", "doc_id", "key", "pos")


def spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2 and first (the smallest doc_id) of the lines that min_sites sites or more hold."""
    low, high = min_sites * (1 - MARGIN) - 1, min_sites * (1 + MARGIN) + 1
    each = lines(docs, site)
    sketched = each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.hll_sketch_agg("site", LG_BUCKETS).alias("sketch"))
    estimated = written(sketched.where(F.col("n") >= min_sites).select("h1", "h2", "first",
        F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low), "spread")
    near = written(estimated.where(F.col("sites") <= high).select("h1", "h2"), "near")
    exact = each.join(broadcast_if_small(near, 48), ["h1", "h2"], "left_semi").groupBy("h1",
        "h2").agg(F.count_distinct("site").alias("exact")).where(F.col("exact") >= min_sites)
    counted = estimated.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    found = written(estimated.where(F.col("sites") > high).select("h1", "h2", "first").unionByName(counted), "boilerplate")
    drop(estimated, near)
    return found


def _without(items: Column, places: Column) -> Column:
    """items without those at places (from 0, in order): what stands between one place and the next, so that each item is looked at once."""
    before, after = F.concat(F.array(F.lit(-1)), places), F.concat(places, F.array(F.size(items)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(items, a + 2, b - a - 1)))


def without_spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """docs with the spread lines taken out of text, and n_lines and n_removed (input columns of these names are replaced)."""
    spread = broadcast_if_small(spread_lines(docs, site, min_sites), 56)
    hits = lines(docs, site).join(spread, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    per_doc = hits.groupBy(F.col("doc_id").alias("__doc"), F.col("key").alias("__key")).agg(F.sort_array(F.collect_set("pos")).alias("__gone")).hint("merge")
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["__doc"]) & (text_key(docs["text"]) == per_doc["__key"]), "left")
    gone = per_doc["__gone"]
    kept = _without(_split(docs["text"]), gone)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.coalesce(F.size(_split(docs["text"])), F.lit(0)).cast("long")
    text = F.when(gone.isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    n_removed = F.when(gone.isNull(), 0).otherwise(F.size(_split(docs["text"])) - F.size(kept)).cast("long")
    return joined.select(*[text.alias(c) if c == "text" else docs[c] for c in columns], n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_spread_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The text without its spread lines, from a view docs(r, doc_id, text, source); r tells rows apart.
CLEANED = rf"""
each_line AS (SELECT r, doc_id, coalesce('=' || source, '-') AS site, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM docs),
spread AS (SELECT line, min(doc_id) AS first FROM each_line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
kept AS (SELECT r, count(*) FILTER (WHERE s.line IS NULL OR e.doc_id IS NOT DISTINCT FROM s.first) AS n_kept, count(*) AS n_lines,
  string_agg(e.line, chr(10) ORDER BY i) FILTER (WHERE s.line IS NULL OR e.doc_id IS NOT DISTINCT FROM s.first) AS text
  FROM each_line e LEFT JOIN spread s ON e.line = s.line GROUP BY r),
cleaned AS (SELECT d.r, d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_lines - n_kept, 0)::BIGINT AS n_removed FROM docs d LEFT JOIN kept k USING (r))
"""
ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, source FROM documents), {CLEANED}
SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM cleaned
"""
