"""MinHash near-dedup with SetSketch registers.

1. Sketch: each text becomes the set of its word shingles (64-bit hashes) and 128 registers, exponentially spaced
   truncated minima: register i is floor(1 - log_b(x_i)), x_i the least of the set's exponential draws at rate a.
   Registers of a union are the maxima of the parts' registers. At rate a = 20 a register is 0 with a chance of e^-20,
   also of a set of one shingle.
2. Texts with equal sets are one class from here on; classes carry their smallest doc_id.
3. Bands of four registers make buckets. Each bucket has a pivot, the member with the least share of shingles that no
   other candidate holds: among copies with edits, the original or the copy nearest to it. Each class is first compared
   with the pivot that it shares most buckets with, then with its other pivots. Confirmed links join classes to
   components.
4. Then only pairs that share a bucket but not yet a component, and of which neither is the bucket's pivot, are
   compared, so that a group of n copies costs about n comparisons, not n * n. Shingles that no other class of the
   large buckets holds bound what a class can share with any of those (and with no one else), which rules out heavily
   edited copies exactly, as classes against a large bucket and as pairs of classes that both have one. What is left of
   a bucket, once for all buckets with the same members, is dealt to pairs of blocks of bounded size, which return the
   links that join components and no other pairs.
5. Before a pair is confirmed on full sets, its similarity is estimated jointly: the likelihood of how many registers
   are greater, less and equal, given both sizes, is greatest at the estimate. A pair whose estimate is below the
   threshold goes if the threshold is less likely by a factor of e^DOUBT.
6. Links become components by alternating least-neighbour steps, written to the shared folder at each step.

What is lost: with 32 bands of four registers, a pair at similarity 0.85 misses all buckets with a probability of 1e-10,
at 0.80 of 5e-8; by the likelihood, a pair at the threshold goes with one of at most e^-DOUBT, 6e-8 (Chernoff's bound).
Both are for one pair: a link between components is lost only if all pairs that would join them are. Tables that the
result doesn't read are deleted before it is returned.

An empty table has an empty result. Texts of any length are read whole; of a bucket's members so many meet in one task as
have about ELEMENTS shingles in all, and two more. Other columns are ignored by near_duplicates and kept by
deduplicated, whatever their names. Texts without words (null, empty) have empty sets and are linked with nothing. Rows that repeat are one class;
rows that share the smallest doc_id of a component are all kept. A row without doc_id never names a component unless
all of its component lack one; then component_id is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from girder.operators.keys import flagged, prefiltered

from .common import drop, table, text_key, written

REGISTERS, ROWS = 128, 4
BASE, RATE, TOP = 1.001, 20.0, 65_534
#: Members of a bucket, and their shingles, in one block on average; larger buckets are dealt to pairs of blocks.
BLOCK, ELEMENTS = 256, 1 << 20
#: Texts, or sets, that go to Python at once.
AT_ONCE = 1000
#: Shingles of their own are counted for, and among, classes in buckets of more than so many members; they bound what two of these share.
LARGE = 8
#: A pair is compared on full sets unless its registers are less likely at the threshold than at their estimate by so much in logarithms.
DOUBT = 16.6

_MULTIPLY = np.random.default_rng(20240601).integers(1 << 32, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = np.random.default_rng(20240602).integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; words are what ASCII blanks separate, A-Z in lower case."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) <= width:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes() + bytes([len(h)]))], np.uint64)
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch of a set that isn't empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 256):
        part = (hashes[i : i + 256, None] ^ _FLIP) * _MULTIPLY
        np.minimum(least, part.min(axis=0), out=least)
    draws = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(draws) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _sketcher(width: int):
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "key": batch["key"], "n_shingles": [len(s) for s in sets],
                "set_id": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sketch": [registers(s).tobytes() if len(s) else None for s in sets],
            })

    return sketch


def _set_maker(width: int):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"set_id": batch["set_id"], "hashes": [shingle_set(t, width).tobytes() for t in batch["text"]]})

    return make


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = REGISTERS // ROWS
    for batch in batches:
        if len(batch):
            r = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(len(batch), n, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(n, dtype=np.uint64), (len(batch), n)).copy()
            for i in range(ROWS):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + r[:, :, i])
            yield pd.DataFrame({"bucket": key.ravel().astype(np.int64), "set_id": batch["set_id"].repeat(n).to_numpy()})


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = [len(h) // 8 for h in batch["hashes"]]
        halves = np.frombuffer(b"".join(batch["set_id"]), ">i8").astype(np.int64).reshape(len(batch), 2).repeat(sizes, axis=0)
        yield pd.DataFrame({"h": np.frombuffer(b"".join(batch["hashes"]), np.int64), "c1": halves[:, 0], "c2": halves[:, 1]})


def _greater(x: np.ndarray) -> np.ndarray:
    """Chance that a register is greater than another's, from x: the share of the union that only its own set holds."""
    return -np.log1p(-np.clip(x, 0, 1) * (1 - 1 / BASE)) / np.log(BASE)


def log_likelihood(j, n_a, n_b, more, less) -> np.ndarray:
    """Of similarity j, for sets of n_a and n_b elements of which more registers of the first are greater, less are less, and the rest are equal."""
    u = n_a / (n_a + n_b)
    p, q = _greater(u - (1 - u) * j), _greater((1 - u) - u * j)
    at = lambda count, chance: np.where(count > 0, count * np.log(np.maximum(chance, 1e-12)), 0.0)
    return at(more, p) + at(less, q) + at(REGISTERS - more - less, 1 - p - q)


def estimate(n_a, n_b, more, less) -> np.ndarray:
    """The similarity of greatest likelihood, in the limit of a base of 1, from which BASE is too near to tell."""
    u = n_a / (n_a + n_b)
    v, equal = 1 - u, REGISTERS - more - less
    x, y = u**2 * (equal + less), v**2 * (equal + more)
    return (x + y - np.sqrt((x - y) ** 2 + 4 * more * less * u**2 * v**2)) / (2 * REGISTERS * u * v)


def likely(threshold: float, n_a, n_b, more, less) -> np.ndarray:
    """Whether sizes and registers leave it open that a pair is at the threshold or above."""
    best = np.clip(estimate(n_a, n_b, more, less), 0, 1)
    sizes = np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) * (1 - 1e-12)
    return sizes & ((best >= threshold) | (log_likelihood(best, n_a, n_b, more, less) - log_likelihood(threshold, n_a, n_b, more, less) <= DOUBT))


def _same(percent: int):
    """Filters pairs of sketches by their joint likelihood, given the sizes of the sets."""

    @F.pandas_udf(BooleanType())
    def same(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), REGISTERS) for s in (a, b))
        return pd.Series(likely(percent / 100, n_a.to_numpy(float), n_b.to_numpy(float), (x > y).sum(axis=1), (x < y).sum(axis=1)))

    return same


def _linked(percent: int):
    @F.pandas_udf(BooleanType())
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: bytes, y: bytes) -> bool:
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            return 100 * both >= percent * (len(p) + len(q) - both)

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    return linked


def _block_linker(percent: int):
    """Links between members of two blocks of a bucket (or within one) that aren't of one component yet, as a forest: of links that join the same parts one is enough."""

    def links(block, n, own, label, sketch, hashes) -> list[tuple[int, int]]:
        """Rows of one pair of blocks as arrays; pairs of row numbers."""
        left, right = np.flatnonzero(block == block[0]), np.flatnonzero(block == block[-1])
        found: list[tuple[int, int]] = []
        for at in range(0, len(left), 64):
            part = left[at : at + 64]
            both = np.minimum.outer((n - own)[part], (n - own)[right])
            maybe = (label[part, None] != label[right]) & (100 * both >= percent * (n[part, None] + n[right] - both))
            p, q = np.nonzero(maybe)
            if len(p):
                more, less = (np.concatenate([test(sketch[part][p[i : i + 8192]], sketch[right][q[i : i + 8192]]).sum(axis=1) for i in range(0, len(p),
                    8192)]) for test in (np.greater, np.less))
                open_ = likely(percent / 100, n[part][p].astype(float), n[right][q].astype(float), more, less)
                p, q = p[open_], q[open_]
            if len(p):
                shared = _intersections([hashes[i] for i in part], [hashes[i] for i in right], p, q)
                ok = 100 * shared >= percent * (n[part][p] + n[right][q] - shared)
                found += zip(part[p[ok]].tolist(), right[q[ok]].tolist(), strict=True)
        root = dict(zip(label.tolist(), label.tolist(), strict=True))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for p, q in found:
            x, y = find(label[p]), find(label[q])
            if x != y:
                root[x] = y
                out.append((p, q))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in the order of their pairs of blocks; the last pair waits for the next batch."""
        wait = None
        for batch in chain(batches, (None,)):
            parts = [x for x in (wait, batch) if x is not None and len(x)]
            if not parts:
                continue
            rows = pd.concat(parts, ignore_index=True)
            key = rows[["bucket", "i", "j"]].to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(rows))
            if batch is not None:
                cuts = cuts[:-1]
                wait = rows.iloc[cuts[-1] :]
            a, hashes = rows["a"].to_numpy(), rows["hashes"].to_numpy()
            label = pd.factorize(rows["r"])[0]
            sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(len(rows), REGISTERS)
            columns = [rows[c].to_numpy() for c in ("block", "n", "own")] + [label, sketch, hashes]
            out = [(a[s + p], a[s + q]) for s, e in pairwise(cuts.tolist()) for p, q in links(*[c[s:e] for c in columns])]
            yield pd.DataFrame(out, columns=["a", "b"])

    return run


def _intersections(left: list[bytes], right: list[bytes], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left[p] and right[q]: one by one if they are few, else as a product of membership matrices."""
    rows, cols = np.unique(p), np.unique(q)
    sets = [np.frombuffer(left[i], np.uint64) for i in rows] + [np.frombuffer(right[i], np.uint64) for i in cols]
    if len(p) <= 2 * len(sets):
        return np.array([len(np.intersect1d(np.frombuffer(left[i], np.uint64), np.frombuffer(right[k], np.uint64), assume_unique=True)) for i,
            k in zip(p, q, strict=True)], np.int64)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = count[code] > 1
    owner, (_, code) = owner[common], np.unique(code[common], return_inverse=True)
    shared = np.zeros((len(rows), len(cols)), np.float64)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        x, y = np.searchsorted(code, (start, start + 4096))
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[x:y], code[x:y] - start] = 1
        shared += m[: len(rows)] @ m[len(rows) :].T
    return shared[np.searchsorted(rows, p), np.searchsorted(cols, q)].astype(np.int64)


def components(links: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """node, root: the least node of each node's component, for nodes that have links (a, b). scratch gets the table that is read."""
    sums = ("count(*) n", "coalesce(bit_xor(xxhash64(a, b)), 0) x")
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    seen = edges.selectExpr(*sums).first()
    while seen["n"]:
        # large star: each node's larger neighbours point to its least neighbour; small star: smaller ones do
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        after = written(small, "edges")
        before, seen = seen, after.selectExpr(*sums).first()
        drop(edges)
        edges = after
        if seen == before:
            break
    scratch.append(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, key (of the text), n_shingles, component_id for each row of docs."""
    scratch: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(written(df, name, AT_ONCE))
        return scratch[-1]

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    sketches = kept(keyed.mapInPandas(_sketcher(width), "doc_id long, key long, n_shingles long, set_id binary, sketch binary"), "sketches")
    classes = kept(sketches.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "key")).alias("at"),
        F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    buckets = kept(classes.select("set_id", "sketch").mapInPandas(_bands, "bucket long, set_id binary"), "bands")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = kept(buckets.join(shared, "bucket").select("bucket", F.col("set_id").alias("a"), "size"), "members")

    largest = members.groupBy(F.col("a").alias("set_id")).agg(F.max("size").alias("size"))
    wanted = kept(largest.join(classes, "set_id").select("set_id", "size", "n", "sketch", F.col("at.doc_id").alias("w_doc"), F.col("at.key").alias("w_key")), "wanted")
    # one plan at any size: what a filter of bounded size lets pass meets the classes by a merge join
    at = wanted.select("set_id", "w_doc", "w_key")
    possible = prefiltered(keyed, F.xxhash64("doc_id", "key"), at.select(F.xxhash64("w_doc", "w_key").alias("id")), F.col("id"))
    same_text = F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("key") == F.col("w_key"))
    texts = possible.join(at.hint("merge"), same_text).select("set_id", "text")
    sets = kept(texts.mapInPandas(_set_maker(width), "set_id binary, hashes binary").dropDuplicates(["set_id"]), "sets")
    crowded = sets.join(wanted.where(F.col("size") > LARGE).select("set_id"), "set_id", "left_semi")
    once = crowded.mapInPandas(_hashes, "h long, c1 long, c2 long").groupBy("h").agg(F.count("*").alias("df"), F.bit_xor("c1").alias("c1"),
        F.bit_xor("c2").alias("c2")).where("df = 1")
    alone = once.groupBy("c1", "c2").agg(F.count("*").alias("own"))
    half = lambda k: F.conv(F.hex(F.substring("set_id", 8 * k + 1, 8)), 16, -10).cast("long")
    known = wanted.withColumns({"c1": half(0), "c2": half(1)}).join(alone, ["c1", "c2"], "left")
    info = kept(known.select("set_id", "n", F.coalesce("own", F.lit(0)).alias("own"), (F.col("size") > LARGE).alias("crowded"), "sketch"), "info")

    def possible(n: Column, own: Column, other_n: Column, other_own: Column) -> Column:
        """Whether two sets, given what each has for its own, can be alike enough."""
        both = F.least(n - own, other_n - other_own)
        return 100 * both >= percent * (n + other_n - both)

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda x: info.select(F.col("set_id").alias(x), F.col("n").alias(f"n{x}"), F.col("own").alias(f"o{x}"), F.col("crowded").alias(f"c{x}"),
            F.col("sketch").alias(f"s{x}"))
        own = lambda x: F.when(F.col("ca") & F.col("cb"), F.col(f"o{x}")).otherwise(0)
        sized = pairs.join(side("a"), "a").join(side("b"), "b").where(possible(F.col("na"), own("a"), F.col("nb"), own("b")))
        likely_ones = sized.where(_same(percent)("sa", "sb", "na", "nb")).select("a", "b")
        full = lambda x: sets.select(F.col("set_id").alias(x), F.col("hashes").alias(f"h{x}"))
        return likely_ones.join(full("a"), "a").join(full("b"), "b").where(_linked(percent)("ha", "hb")).select("a", "b")

    sized = members.join(info.select(F.col("set_id").alias("a"), "n", "own"), "a")
    pivots = sized.groupBy("bucket").agg(F.min(F.struct(F.col("own") / F.col("n"), "a")).alias("p"), F.min("n").alias("least_n")).select("bucket",
        F.col("p.a").alias("b"), "least_n")
    # all members of a large bucket are among those that own was counted for; of a smaller one some may not be
    placed = kept(sized.join(pivots, "bucket").where("a != b").withColumn("own", F.when(F.col("size") > LARGE, F.col("own")).otherwise(0)).drop("size"), "placed")
    most = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    stars = kept(placed.groupBy("a", "b").agg(F.count("*").alias("n")).select("a", "b", (F.row_number().over(most) == 1).alias("best")), "stars")
    first = kept(confirmed(stars.where("best").select("a", "b")), "links")
    roots = kept(components(first, scratch), "roots")

    root = lambda x: F.coalesce(f"r{x}", x)
    of = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    apart = stars.where("NOT best").join(of("a"), "a", "left").join(of("b"), "b", "left").where(root("a") != root("b")).select("a", "b")
    links = kept(first.union(confirmed(apart)), "links")
    roots = kept(components(links, scratch), "roots")
    # pairs with a pivot are done; a bucket whose other members are of one component holds nothing more to find, nor does a class that can't be alike to any in it
    able = placed.where(possible(F.col("n"), F.col("own"), F.greatest("least_n", F.col("n") - F.col("own")), F.lit(0))).select("bucket", "a", "n", "own")
    labelled = kept(able.join(of("a"), "a", "left").withColumn("r", root("a")), "labelled")
    same_members = (F.count("*").alias("size"), F.sum("n").alias("elements"), F.bit_xor(F.xxhash64("a")).alias("x1"), F.bit_xor(F.xxhash64("a", F.lit(1))).alias("x2"))
    open_ = labelled.groupBy("bucket").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), *same_members, F.max("own").alias("own")).where("lo != hi")
    once = open_.groupBy("size", "x1", "x2").agg(F.min(F.struct("own", "bucket")).alias("o"), F.first("elements").alias("elements")).select("o.bucket",
        F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("elements") / ELEMENTS)).cast("int").alias("k"))
    blocks = labelled.select("bucket", "a", "r", "own").join(once, "bucket").withColumn("block", F.pmod(F.hash("a", F.lit(3)), "k"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("bucket", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), "block", "a", "r", "own")
    whole = info.join(sets, "set_id").select(F.col("set_id").alias("a"), "n", "sketch", "hashes")
    more = kept(blocks.join(whole, "a").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block").mapInPandas(_block_linker(percent),
        "a binary, b binary").distinct(), "links")
    roots = components(links.union(more), scratch) if not more.isEmpty() else roots

    named = classes.select("set_id", "least_id").join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root",
        F.coalesce("root", "set_id"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = named.join(least, "root").select("set_id", "component_id")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = written(sketches.drop("sketch").join(by_set, "set_id", "left").select("doc_id", "key", "n_shingles", component.alias("component_id")), "found")
    drop(*scratch)
    return found


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs but those of a component that aren't its smallest doc_id."""
    found = near_duplicates(docs, width, percent)
    gone = written(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key")).distinct(), "gone")
    drop(found)
    return without(docs, gone)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but the rows that a written table (__doc, __key) names. Rows that are surely not named stay where they are read; the others meet it by a merge join."""
    keyed = docs.withColumn("__text_key", text_key(F.col("text")))
    marked = flagged(keyed, F.xxhash64("doc_id", "__text_key"), gone.select(F.xxhash64("__doc", "__key").alias("id")), F.col("id"))
    named = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text_key") == F.col("__key"))
    rest = marked.where("__maybe").join(gone.hint("merge"), named, "left_anti")
    return marked.where("NOT __maybe").union(rest).select(*docs.columns)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[k:k+2], ' ') END AS g FROM d, unnest(range(1, greatest(len(w) - 1, 2))) t(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT e.a, r.seen FROM r JOIN e ON e.b = r.node),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""
