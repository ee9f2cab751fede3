"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, and a linear classifier.

1. A bounded sample of labelled rows (PER_CLASS of each class, by hash; learning rows only) yields lexicons: words and
   word beginnings that toxic texts hold RATIO times as often as others, significantly. Each is a voter; the PATTERNS,
   which were written without looking at labels, are further ones. A voter that doesn't fire abstains; that no lexicon
   fires is a vote of its own, for clean. A pattern votes for the class in which it fires more often. Of near copies in
   the sample one counts.
2. The label model treats the true class as hidden and generates the votes from it: within a class, voters form a tree,
   the one along which they tell most about each other, and each fires with a chance that depends on the class and on
   whether its parent fired. So voters that go together count once. Expectation maximisation estimates these chances
   (the voters' accuracies and correlations) and the posterior of each row. Labels lend their weight to the chances of
   all rows, but are no vote on their own row: where voters contradict a label, the posterior follows the voters.
3. A logistic classifier on the votes is trained on the posteriors. It scores every whole text.

Texts are cut into features on executors; votes, as numbers, and voters are all that reaches the driver. Nothing but the
text is an input of a score. An empty or null text fires no voter and gets the score of the intercept. A doc_id with
labels of both kinds counts as toxic; of its rows in docs, the text with the least hash is read. Without learning rows of
both classes there are no lexicons and every score is the intercept's. Repeated rows get equal scores, an empty table has
an empty result, other columns are ignored, and texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import drop, table, text_key, written

#: Most labelled rows of each class that the model is fitted on.
PER_CLASS = 3000
MOST_VOTERS = 400
#: How much more often a lexicon's word is in toxic texts, in how many of them at least, and how significantly (twice the gain in log-likelihood).
RATIO, LEAST, GAIN = 20, 4, 12.0
#: What a label weighs against a posterior in the chances of the label model.
TRUST = 1.0
#: Share of rows held out: crc32(doc_id as text) mod FOLDS is 0.
FOLDS = 5
BEGINNINGS = (4, 5, 6)

#: Words of insults.
INSULTS = "bastard bastards clown clowns creep creeps disgusting dumb fool fools idiot idiots imbecile imbeciles jerk jerks loser losers moron morons pathetic scum stupid trash ugly useless worthless"
#: Pattern voters: words of which a text must hold one (none: any text), and the pattern.
PATTERNS = {
    "~insult": (INSULTS, ""),
    "~at_you": ("you", rf"(?i)\byou(?: are|'re| all)? (?:an? |such an? |so |all )?(?:{INSULTS.replace(' ', '|')})\b"),
    "~threat": ("kill hurt destroy hunt beat die", r"(?i)\b(?:kill|hurt|destroy|hunt|beat) (?:you|him|her|them|yourself)\b|\byou (?:should|will|must) die\b"),
    "~send_off": ("shut go get hate", r"(?i)\bshut up\b|\bgo away\b|\bget lost\b|\bhate (?:you|them|him|her)\b"),
    "~masked": ("", r"\b[A-Za-z]{1,3}\*{2,}[A-Za-z]{0,3}\b"),
    "~polite": ("please thank thanks welcome regards", ""),
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PATTERNS = {name: (frozenset(words.split()), p and re.compile(p)) for name, (words, p) in PATTERNS.items()}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def features(text: str | None) -> set[str]:
    """The words of a text, the beginnings of longer words (with a star behind), and the patterns (with a wave before) that it holds."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    patterns = {name for name, (needed, p) in _PATTERNS.items() if (not needed or needed & words) and (not p or p.search(text))}
    return words | {f"{w[:n]}*" for w in words for n in BEGINNINGS if len(w) > n} | patterns


def prints(text: str | None) -> list[int]:
    """A few least shingle hashes; near copies share one."""
    words = (text or "").lower().split()
    grams = {" ".join(words[i : i + 4]).encode() for i in range(max(1, len(words) - 3))}
    return [min(xxhash.xxh3_64_intdigest(g, seed) for g in grams) >> 1 for seed in range(3)]


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "prints": [prints(t) for t in batch["text"]],
            "features": [sorted(features(t)) for t in batch["text"]]})


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """doc_id, toxic, features of the bounded sample without near copies, and the share of toxic labels; held-out rows are never read."""
    valid = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = valid.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    picked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("__id", F.lit(11)), "__id").limit(PER_CLASS) for y in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), F.col("doc_id") == F.col("__id"))
    one = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(text_key(F.col("text")).alias("key"), "text"))["text"].alias("text"))
    described = written(one.mapInPandas(_described, "doc_id long, toxic int, prints array<long>, features array<string>"), "toxic-sample")
    seen: set[tuple[int, int]] = set()
    alone = []
    for doc_id, h in sorted(map(tuple, described.select("doc_id", "prints").collect())):
        if not seen & set(enumerate(h)):
            alone.append((doc_id,))
        seen |= set(enumerate(h))
    kept = described.join(F.broadcast(docs.sparkSession.createDataFrame(alone, "doc_id long")), "doc_id").select("doc_id", "toxic", "features")
    total = sum(counts.values())
    kept = written(kept, "toxic-features")
    drop(described)
    return kept, min(0.9, max(0.001, counts.get(1, 0) / total)) if total else 0.1


def lexicons(rows: DataFrame) -> list[str]:
    """The words and beginnings that separate, best first."""
    n1, n = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if n1 in (0, n):
        return []
    n0 = n - n1
    each = rows.select("toxic", F.explode("features").alias("f")).where(~F.startswith("f", F.lit("~")))
    counted = each.groupBy("f").agg(F.sum("toxic").alias("k"), F.sum(1 - F.col("toxic")).alias("z")).where(F.col("k") >= max(LEAST, 0.004 * n1))
    both = (F.col("k") + F.col("z")) / n
    gain = 2 * (F.col("k") * F.log(F.col("k") / n1 / both) + F.when(F.col("z") > 0, F.col("z") * F.log(F.col("z") / n0 / both)).otherwise(0.0))
    often = (F.col("k") + 0.5) / (n1 + 1) > RATIO * (F.col("z") + 0.5) / (n0 + 1)
    best = counted.where(often).withColumn("gain", F.round(gain, 9)).where(F.col("gain") > GAIN).orderBy(F.desc("gain"), F.desc(F.length("f")), "f").limit(MOST_VOTERS)
    return [r.f for r in best.collect()]


def votes(rows: DataFrame, voters: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The votes of the sample as a matrix, and the labels."""
    at = {f: i for i, f in enumerate(voters)}
    found = rows.select("doc_id", "toxic",
        F.array_intersect("features", F.array(*map(F.lit, voters)) if voters else F.array().cast("array<string>")).alias("f")).orderBy("doc_id").collect()
    out = np.zeros((len(found), len(voters)), np.float32)
    for row, r in zip(out, found, strict=True):
        row[[at[f] for f in r.f]] = 1
    return out, np.array([r.toxic for r in found], bool)


def parents(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
    """The tree of the voters (a forest; -1: a root): as many as possible of the strongest ties, by mutual information given the class, that are significant."""
    info = np.zeros((votes.shape[1],) * 2)
    for p in (post, 1 - post):
        both = (votes.T @ (votes * p[:, None])).astype(float)
        one, total = np.diag(both), p.sum()
        cells = (both, one, one), (one[:, None] - both, one, total - one), (one - both, total - one, one), (total - one[:, None] - one + both, total - one, total - one)
        for cell, a, b in cells:
            cell = np.maximum(cell, 0)
            info += 2 * cell * np.log((cell * total + 1e-9) / (np.outer(a, b) + 1e-9))
    x, y = np.nonzero(np.triu(info, 1) > 4 * np.log(max(2, len(votes))))
    root, near = list(range(len(info))), [[] for _ in info]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for k in np.argsort(-info[x, y], kind="stable"):
        i, j = int(x[k]), int(y[k])
        if find(i) != find(j):
            root[find(i)] = find(j)
            near[i].append(j)
            near[j].append(i)
    parent, seen = np.full(len(info), -1), set()
    for start in range(len(info)):
        stack = [start] if start not in seen else []
        seen.add(start)
        while stack:
            i = stack.pop()
            for j in near[i]:
                if j not in seen:
                    seen.add(j)
                    parent[j] = i
                    stack.append(j)
    return parent


def label_model(votes: np.ndarray, labels: np.ndarray, prior: float, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class per row, and the voters' tree. The last column of votes is the vote that no lexicon fires."""
    gold = labels.astype(float)
    post = gold.copy()
    tree = np.full(votes.shape[1], -1)
    for k in range(rounds):
        mixed = (post + TRUST * gold) / (1 + TRUST)
        if k % 5 == 0:
            tree = parents(votes[:, :-1], mixed)
            tree = np.append(tree, -1)
            above = votes[:, tree] * (tree >= 0)
        odds = np.full(len(votes), np.log(prior / (1 - prior)))
        for sign, p in ((1, mixed), (-1, 1 - mixed)):
            fired, above_fired, with_above = p @ votes, p @ above, p @ (votes * above)
            marginal = (fired + 0.5) / (p.sum() + 1)
            rate_with, rate_without = (with_above + marginal) / (above_fired + 1), (fired - with_above + 0.5) / (p.sum() - above_fired + 1)
            odds += sign * (votes * np.where(above > 0, np.log(rate_with), np.log(rate_without))).sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, tree


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights and intercept (last) of a logistic regression on soft labels, by Newton steps; the intercept isn't shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    weights: dict[str, float]
    intercept: float

    def score(self, text: str | None) -> float:
        odds = self.intercept
        for f in features(text) & self.weights.keys():
            odds += self.weights[f]
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the bounded sample; rows that are held out are never read."""
    rows, share = sample(docs, labels)
    words = lexicons(rows)
    if not words:
        drop(rows)
        return Model({}, float(np.log(share / (1 - share))))
    voters = words + list(PATTERNS)
    fired, toxic = votes(rows, voters)
    drop(rows)
    silent = fired[:, : len(words)].sum(axis=1) == 0
    post, _ = label_model(np.column_stack([fired, silent.astype(np.float32)]), toxic, share)
    w = logistic(fired, post)
    return Model(dict(zip(voters, w[:-1].tolist(), strict=True)), float(w[-1]))


def scorer(model: Model):
    """A column function from text to score."""

    @F.pandas_udf(DoubleType())
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in text], dtype="float64")

    return score


def without_toxic(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows of docs that score below most."""
    return docs.where(scorer(model)(docs["text"]) < most)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = scorer(train(docs, table(spark, sf_dir, "labels")))
    found = docs.select("doc_id", score("text").alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
