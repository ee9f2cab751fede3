"""Benchmark decontamination: a positional inverted index of the corpus, intersected from the rarest terms on.

The corpus is cut into words once, for the index: the postings (text, position) of every term of the benchmark, hot
ones too. The index tells how often each term occurs. For each benchmark window the list of its rarest term, moved by
its offset, is intersected with that of the next one, give or take SLACK. What is left is confirmed in the whole text:

exact      all words of the window stand one after the other
proximity  at least SHARE of the window's words stand within SLACK of their places, counted from the rarest one that
           occurs in the corpus (of equally rare ones the first), and the next rarest is among them; a place starts at
           the text's first word or later, and its words don't all stand exactly

Besides the texts, which meet their candidates in one shuffle at every size, only terms of the benchmark reach a shuffle.
The benchmark is a stated query set; its tables are broadcast only if their counted rows and bytes are within the bounds
of common.py, and joined by shuffle beyond.

A null or empty text has no words, and an item without words no window. Rows that repeat are judged each by itself, also
where they share a doc_id but not the text. Texts of any length are read whole; extra columns are kept, but for those
named like a column of the result, which are replaced. An empty benchmark contaminates nothing; of an empty table the
result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_ALNUM, alnum_words, ascii_lower, broadcast_if_small, drop, let, table, text_key, written

WINDOW = 10
#: So many of a window's rarest terms have their lists intersected.
RAREST = 2
#: How far from its place a word may stand to count for proximity, and which share of the words must.
SLACK, SHARE = 3, 0.8


def cut(text: Column) -> Column:
    """The words of a text, in the case that they have there."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_ALNUM), "")


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row for each distinct window: w, terms, n, and the items that hold it."""
    words = items.select("item_id", alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    each = words.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at") + 1, width).alias("terms"))
    return each.groupBy("terms").agg(F.collect_set("item_id").alias("items")).select(F.monotonically_increasing_id().alias("w"), "terms", F.size("terms").alias("n"),
        "items")


def index_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """t, doc_id, key, pos: where the terms (term, t) stand in the corpus."""
    each = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.posexplode(cut(F.col("text"))).alias("pos", "word"))
    return each.select("doc_id", "key", "pos", ascii_lower(F.col("word")).alias("term")).join(terms, "term").select("t", "doc_id", "key", "pos")


def needed(n: Column, share: float) -> Column:
    return F.ceil(n * F.lit(share) - 1e-9)


def rarest_first(found: DataFrame, terms: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Windows of whose terms the corpus holds enough for proximity, with rare: (tf, at, t) of the RAREST rarest that occur."""
    each = found.select("w", F.posexplode("terms").alias("at", "term")).join(terms, "term").join(counts, "t")
    rare = each.groupBy("w").agg(F.sort_array(F.collect_list(F.struct("tf", "at", "t"))).alias("rare"))
    return found.join(rare, "w").where(F.size("rare") >= needed(F.col("n"), share)).withColumn("rare", F.slice("rare", 1, RAREST))


def intersect(index: DataFrame, found: DataFrame, slack: int) -> DataFrame:
    """doc_id, key, start, w: where a window's rarest term stands at its offset and the others give or take slack."""
    first = found.select("w", "rare", F.col("rare")[0]["t"].alias("t"), F.col("rare")[0]["at"].alias("at"))
    at = index.join(broadcast_if_small(first, 96), "t").select("doc_id", "key", (F.col("pos") - F.col("at")).alias("start"), "w", "rare").where("start >= 0")
    # positions meet in cells, so that one row, or two, looks for all that are near
    cell = lambda pos: F.floor(pos / (4 * slack + 1)).cast("int")
    other = index.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("t").alias("o"), F.col("pos").alias("p"), cell(F.col("pos")).alias("c"))
    for i in range(1, RAREST):
        step = F.get("rare", F.lit(i))
        alone = at.where(step.isNull())
        here = F.col("start") + step["at"]
        cells = F.array_distinct(F.array(cell(F.greatest(here - slack, F.lit(0))), cell(here + slack)))
        wanted = at.where(step.isNotNull()).select("*", step["t"].alias("t"), here.alias("pos"), F.explode(cells).alias("cell"))
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("t") == F.col("o")) & (F.col("cell") == F.col("c")) & (F.abs(F.col("p") - F.col("pos")) <= slack)
        at = wanted.join(other, same, "left_semi").select("doc_id", "key", "start", "w", "rare").unionByName(alone)
    return at.drop("rare")


def places(docs: DataFrame, items: DataFrame, width: int, slack: int, share: float) -> DataFrame:
    """__doc, __key, __places: for each text that has some, where windows may stand, as (start, n, terms, items). Written."""
    found = written(windows(items, width), "windows")
    terms = written(found.select(F.explode("terms").alias("term")).distinct().select("term", F.monotonically_increasing_id().alias("t")), "terms")
    by_term = broadcast_if_small(terms, 16 + F.octet_length("term"))
    index = written(index_of(docs, by_term), "index")
    counts = written(index.groupBy("t").agg(F.count("*").alias("tf")), "counts")
    chosen = written(rarest_first(found, terms, counts, share), "chosen")
    rare = written(chosen.select(F.explode("rare").alias("r")).select("r.t").distinct(), "rare")
    postings = written(index.join(broadcast_if_small(rare, 16), "t"), "postings")
    size = 64 + 16 * F.size("terms") + F.octet_length(F.array_join("terms", "")) + 16 * F.size("items")
    candidates = intersect(postings, chosen, slack).join(broadcast_if_small(chosen.select("w", "n", "terms", "items"), size), "w")
    per_doc = candidates.groupBy(F.col("doc_id").alias("__doc"),
        F.col("key").alias("__key")).agg(F.collect_set(F.struct("start", "n", "terms", "items")).alias("__places"))
    per_doc = written(per_doc, "places")
    drop(found, terms, index, counts, chosen, rare, postings)
    return per_doc


def _covered(spans: Column) -> Column:
    """Words in the union of spans (start, n) in the order of start; n may differ."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
        (acc["n"] + F.greatest(s["start"] + s["n"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"))
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, slack: int = SLACK, share: float = SHARE) -> DataFrame:
    """docs with n_words, n_hit and item_ids (of the items that have a window in the text), n_near and near_ids (places, and items, that proximity finds besides); input columns of these names are replaced."""
    per_doc = places(docs, items, width, slack, share)
    side = per_doc.hint("merge")
    both = docs.join(side, docs["doc_id"].eqNullSafe(side["__doc"]) & (text_key(docs["text"]) == side["__key"]), "left")
    no_ids = F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>")
    ids = lambda found: F.array_distinct(F.flatten(F.transform(found, lambda h: h["items"])))

    def near(w: Column, c: Column) -> Column:
        here = lambda i: F.array_contains(F.slice(w, F.greatest(c["start"] + i - slack, F.lit(0)) + 1,
            F.lit(2 * slack + 1) + F.least(c["start"] + i - slack, F.lit(0))), F.get(c["terms"], i))
        return F.size(F.filter(F.sequence(F.lit(0), c["n"] - 1), here)) >= needed(c["n"], share)

    def confirmed(w: Column) -> Column:
        exact = F.filter(side["__places"], lambda c: F.slice(w, c["start"] + 1, c["n"]) == c["terms"])
        close = F.filter(side["__places"], lambda c: (F.slice(w, c["start"] + 1, c["n"]) != c["terms"]) & near(w, c))
        return let(
            F.struct(F.sort_array(exact).alias("hits"), close.alias("close")),
            lambda x: F.struct(F.size(w).cast("long").alias("n_words"), _covered(x["hits"]).alias("n_hit"), ids(x["hits"]).alias("item_ids"),
                F.size(x["close"]).cast("long").alias("n_near"), ids(x["close"]).alias("near_ids")),
        )

    none = F.struct(F.size(cut(docs["text"])).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), no_ids.alias("item_ids"),
        F.lit(0).cast("long").alias("n_near"), no_ids.alias("near_ids"))
    own = ("n_words", "n_hit", "item_ids", "n_near", "near_ids")
    columns = [c for c in docs.columns if c not in own]
    found = F.when(side["__places"].isNull(), none).otherwise(let(alnum_words(docs["text"]), confirmed))
    return both.select(*[docs[c] for c in columns], found.alias("__found")).select(*columns, *[f"__found.{c}" for c in own])


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near_ids").cast("long").alias("n_near_items"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
win AS (SELECT item_id, len(words[k:k+9]) AS n, array_to_string(words[k:k+9], ' ') AS phrase FROM b, unnest(range(1, greatest(len(words) - 8, 2))) t(k) WHERE len(words) > 0),
phrases AS (SELECT DISTINCT n, phrase FROM win),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
grams AS (SELECT r, n, k, array_to_string(words[k:k+n-1], ' ') AS phrase FROM d, (SELECT DISTINCT n FROM phrases) l, unnest(range(1, len(words) - n + 2)) t(k)),
hit AS (SELECT r, n, k, phrase FROM grams JOIN phrases USING (n, phrase)),
cov AS (SELECT r, count(DISTINCT k + o) AS n_hit FROM hit, unnest(range(0, n)) t(o) GROUP BY r),
tf AS (SELECT term, count(*) AS tf FROM (SELECT unnest(words) AS term FROM d) GROUP BY term),
terms AS (SELECT w.*, rank() OVER (PARTITION BY n, phrase ORDER BY tf, i) AS place, count(*) OVER (PARTITION BY n, phrase) AS n_known FROM (SELECT n, phrase, string_split(phrase, ' ') AS terms, unnest(string_split(phrase, ' ')) AS term, unnest(range(n)) AS i FROM phrases) w JOIN tf USING (term)),
known AS (SELECT n, phrase, any_value(terms) AS terms, arg_min(term, place) AS term, arg_min(i, place) AS i, max(i) FILTER (WHERE place = 2) AS i2 FROM terms WHERE n_known >= ceil(n * {SHARE} - 1e-9) GROUP BY n, phrase),
placed AS (SELECT r, words, pos - i AS start, n, phrase, terms, i2 FROM (SELECT r, words, unnest(words) AS term, unnest(range(len(words))) AS pos FROM d) JOIN known USING (term) WHERE pos >= i),
close AS (SELECT r, n, phrase, start FROM placed WHERE (i2 IS NULL OR list_contains(words[greatest(start + i2 - {SLACK}, 0) + 1 : start + i2 + {SLACK} + 1], terms[i2 + 1]))
  AND len(list_filter(range(n), lambda j: list_contains(words[greatest(start + j - {SLACK}, 0) + 1 : start + j + {SLACK} + 1], terms[j + 1]))) >= ceil(n * {SHARE} - 1e-9) AND words[start + 1 : start + n] <> terms),
cl AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM close JOIN win USING (phrase) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit JOIN win USING (phrase) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r) LEFT JOIN cl USING (r)
"""
