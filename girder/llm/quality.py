"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Nothing shuffles: each row is judged by itself. A null or empty text has no words and fails. A text of any length
is read whole; repeated rows get equal verdicts; an empty table has an empty result; other columns of the input are
neither read nor touched, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blank_words, let, table

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: How a line of a list begins.
BULLET = r"^[\x20\x09]*[-*•]"
#: Frequent words of four languages.
STOP_WORDS = ("the of and to in is that for with was de la que el en los las un una por le les des et est du dans pour der die das und den von zu mit ist ein eine nicht").split()
#: (rule, metric, least, most, words that a text has at least for the rule to hold). Metrics are the columns of metrics().
RULES = [
    ("length", "n_words", 10, 1_000_000, 0),
    ("word_length", "mean_word_chars", 2.0, 14.0, 0),
    ("symbols", "symbol_ratio", None, 0.1, 0),
    ("shouting", "exclaim_ratio", None, 0.3, 0),
    ("stop_words", "stop_ratio", 0.01, None, 80),
    ("dup_lines", "dup_line_ratio", None, 0.5, 0),
    ("bullets", "bullet_line_ratio", None, 0.9, 0),
    ("ellipses", "ellipsis_line_ratio", None, 0.3, 0),
    ("line_length", "mean_line_words", 1.5, None, 30),
]


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of five words that occurs twice or more. Sorts the window hashes only of texts that repeat some."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    two = lambda h: F.zip_with(h, F.slice(h, 2, F.size(h)), lambda a, b: F.xxhash64(a, b))
    four = lambda h: let(two(h), lambda d: F.zip_with(d, F.slice(d, 3, F.size(d)), lambda a, b: F.xxhash64(a, b)))
    five = lambda h: F.slice(F.zip_with(four(h), F.slice(h, WINDOW, F.size(h)), lambda a, b: F.xxhash64(a, b)), 1, F.size(h) - 4)

    def places(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def equal_to_neighbour(s: Column) -> Column:
            after = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.struct(a.alias("a"), (F.coalesce(a["h"] == b["h"], F.lit(False))).alias("same")))
            return let(
                after,
                lambda x: F.filter(
                    F.zip_with(x, F.concat(F.array(F.lit(False)), F.transform(x, lambda y: y["same"])), lambda y, before: F.when(y["same"] | before, y["a"]["i"])),
                    lambda i: i.isNotNull(),
                ),
            )

        return F.sort_array(let(pairs, equal_to_neighbour))

    covered = lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0),
        lambda n, x: n + x)
    counted = let(let(hashes, five), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(let(places(w), covered)))
    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(counted)


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at."""
    text = F.coalesce("text", F.lit(""))
    words = blank_words(F.col("text"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        "doc_id",
        text.alias("text"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                F.size(F.filter(x, lambda line: F.rlike(line, F.lit(BULLET)))).alias("n_bullets"),
                    F.size(F.filter(x, lambda line: F.endswith(line, F.lit("...")) | F.endswith(line, F.lit("…")))).alias("n_ellipses"),
            ),
        ).alias("x"),
    )
    per_word = lambda n: n / F.greatest(F.col("w.n_words"), F.lit(1))
    return base.select(
        "doc_id", "w.n_words", "w.word_chars", F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), "x.n_dup_lines", "w.n_repeat_words",
        per_word(F.col("w.word_chars")).alias("mean_word_chars"),
        per_word(F.regexp_count("text", F.lit("!"))).alias("exclaim_ratio"),
        per_word(F.regexp_count("text", F.lit(r"(?i)(?<![^\x20\x09-\x0D])(?:" + "|".join(STOP_WORDS) + r")(?![^\x20\x09-\x0D.,;:!?])"))).alias("stop_ratio"),
        *[(F.col(f"x.{n}") / F.greatest(F.col("x.n_lines"), F.lit(1))).alias(ratio) for n,
            ratio in (("n_dup_lines", "dup_line_ratio"), ("n_bullets", "bullet_line_ratio"), ("n_ellipses", "ellipsis_line_ratio"))],
        (F.col("w.n_words") / F.greatest(F.col("x.n_lines"), F.lit(1))).alias("mean_line_words"),
    )


def verdict(rules: list[tuple] = RULES) -> Column:
    """The table of thresholds as one condition: true if no rule is broken."""
    kept = []
    for _, metric, least, most, from_words in rules:
        within = F.lit(True)
        if least is not None:
            within &= F.col(metric) >= least
        if most is not None:
            within &= F.col(metric) <= most
        kept.append(within | (F.col("n_words") < from_words))
    return reduce(Column.__and__, kept)


def quality(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """doc_id, the metrics, base_failed and kept."""
    found = metrics(docs).withColumn("symbol_ratio", F.col("n_symbols") / F.greatest("n_words", F.lit(1)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM d),
win AS (SELECT r, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o END AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM win WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(0, 5) t(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup, count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09]*[-*•]')) AS n_bul, count(*) FILTER (WHERE line LIKE '%...' OR line LIKE '%…') AS n_ell FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
st AS (SELECT r, count(*) AS n FROM w WHERE regexp_matches(w, '^(?i:{"|".join(STOP_WORDS)})([.,;:!?]|$)') GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '!')) AS n_ex,
  coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_bul, 0) AS n_bul, coalesce(n_ell, 0) AS n_ell, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(st.n, 0) AS n_stop
  FROM d LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN st USING (r)),
j AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, greatest(n_words, 1) AS n FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND n_words BETWEEN 10 AND 1000000 AND word_chars / n BETWEEN 2.0 AND 14.0 AND n_symbols / n <= 0.1 AND n_ex / n <= 0.3
   AND (n_stop / n >= 0.01 OR n_words < 80) AND n_dup_lines / greatest(n_lines, 1) <= 0.5
   AND n_bul / greatest(n_lines, 1) <= 0.9 AND n_ell / greatest(n_lines, 1) <= 0.3 AND (n_words / greatest(n_lines, 1) >= 1.5 OR n_words < 30)) AS kept
FROM j
"""
