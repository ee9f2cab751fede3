"""SimHash near-dedup: fingerprints of 64 bits, linked where at most four bits differ.

1. Fingerprint: a bit is 1 if it is set in over half of the hashes of a text's word shingles, repeats included.
2. Texts with equal fingerprints are one class from here on, so that exact copies meet in no bucket.
3. Pigeonhole blocks: of six blocks of bits, a pair within four bits has two alike. Each class goes into one bucket for
   each choice of two blocks (15, by 20 to 22 bits), and pairs in a bucket are verified by their Hamming distance.
4. Of buckets with over CROWD classes, the members that are within four bits of the bucket's pivot are linked with it,
   by a join. A bucket with others besides is left open, and the members of open buckets are linked by what is between
   them: two fingerprints differ in at most four bits exactly if some number differs from both in at most two. Each
   member names its 2,081 such numbers (hubs); those that share one are linked with the least of them. So what a crowded
   bucket costs grows with its members, not with their pairs, and nothing is capped.
5. Links become components by alternating least-neighbour steps.

All links are found: 3 and 4 are exact. With n classes of unlike texts a bucket has about n / 2 ** 21 members.

An empty table has an empty result. Texts are read whole, whatever their length. Null and empty texts, and those of
blanks, have the fingerprint zero, and are linked like any other. Rows that repeat are one class. Other columns are
ignored by fingerprints_linked and kept by deduplicated, whatever their names. A row without doc_id never names a
component unless all of its component lack one; then component_id is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, drop, table, text_key, written
from .near_dup import components, without

WIDTH, SEED, BITS, DISTANCE = 4, 42, 64, 4
#: Blocks of bits, and how many of them a bucket has alike: as many as DISTANCE leaves.
BLOCKS = 6
ALIKE = BLOCKS - DISTANCE
#: Classes of a bucket that are compared in one task, pair by pair.
CROWD = 1000
#: Texts that go to Python at once, and hashes whose bits are counted at once.
AT_ONCE, HASHES = 1000, 1 << 14


def fingerprint(text: str | None) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - WIDTH + 1)
    starts = np.append(0, ends[: n - 1]).tolist()
    stops = (ends[min(WIDTH, len(words)) - 1 :] - 1).tolist()
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, HASHES):
        part = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[i : i + HASHES], stops[i : i + HASHES], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch["text"]], np.uint64).view(np.int64)
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "fp": found})


def blocks() -> list[int]:
    """The bits of each block, as a mask."""
    cuts = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    return [(1 << b) - (1 << a) for a, b in pairwise(cuts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bucketed(classes: DataFrame) -> DataFrame:
    """t, bits, fp: a row for each bucket of each class; t says which blocks are alike, and bits holds them."""
    masks = [_signed(sum(chosen)) for chosen in combinations(blocks(), ALIKE)]
    each = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(masks)])
    return classes.select("fp", F.explode(each).alias("e")).select("e.t", "e.bits", "fp")


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _forest(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is within DISTANCE: each step takes all that the ones before reached, and what is near to them."""
    left = np.arange(len(fps))
    while len(left) > 1:
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            d = np.bitwise_count(fps[reached, None] ^ fps[left]) <= DISTANCE
            hit = d.any(axis=0)
            yield fps[reached[d[:, hit].argmax(axis=0)]], fps[left[hit]]
            reached, left = left[hit], left[~hit]


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in the order of their buckets; the last bucket waits for the next batch."""
    wait = None
    for batch in chain(batches, (None,)):
        parts = [x for x in (wait, batch) if x is not None and len(x)]
        if not parts:
            continue
        rows = pd.concat(parts, ignore_index=True)
        t, bits, fps = (rows[c].to_numpy() for c in ("t", "bits", "fp"))
        cuts = np.append(np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (bits[1:] != bits[:-1]))), len(rows))
        if batch is not None:
            cuts = cuts[:-1]
            wait = rows.iloc[cuts[-1] :]
        found = [link for i in np.flatnonzero(np.diff(cuts) > 1) for link in _forest(fps[cuts[i] : cuts[i + 1]].view(np.uint64))]
        if found:
            yield pd.DataFrame({c: np.concatenate(x).view(np.int64) for c, x in zip("ab", zip(*found, strict=True), strict=True)})


def _hub_masks() -> np.ndarray:
    """Which bits a fingerprint's hubs differ in."""
    one = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    i, j = np.triu_indices(BITS, 1)
    return np.concatenate([np.zeros(1, np.uint64), one, one[i] | one[j]])


def _hubs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    masks = _hub_masks()
    for batch in batches:
        fps = batch["fp"].to_numpy().view(np.uint64)
        for i in range(0, len(fps), 256):
            part = fps[i : i + 256]
            yield pd.DataFrame({"hub": (part[:, None] ^ masks).ravel().view(np.int64), "fp": part.repeat(len(masks)).view(np.int64)})


def hub_links(classes: DataFrame) -> DataFrame:
    """Links of classes within DISTANCE of each other: with the least one at each hub. The least at a hub is settled before rows are sent on."""
    hubs = written(classes.mapInPandas(_hubs, "hub long, fp long").groupBy("hub").agg(F.min("fp").alias("a"), F.max("fp").alias("most")), "hubs")
    several = hubs.where("a != most").select("hub", "a")
    return classes.mapInPandas(_hubs, "hub long, fp long").join(several, "hub").where("a != fp").select("a", F.col("fp").alias("b")).distinct()


def links(classes: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """a, b: fingerprints within DISTANCE of each other, enough of them to join what all such pairs join."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(written(df, name))
        return scratch[-1]

    buckets = bucketed(classes)
    pivots = kept(buckets.groupBy("t", "bits").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where(F.col("n") > CROWD), "crowded")
    crowded = broadcast_if_small(pivots, 28)
    small = buckets.join(crowded, ["t", "bits"], "left_anti").repartition("t", "bits").sortWithinPartitions("t", "bits")
    found = kept(small.mapInPandas(_bucket_links, "a long, b long"), "links")
    if pivots.isEmpty():
        return found
    starred = kept(buckets.join(crowded, ["t", "bits"]).select("t", "bits", "fp", "pivot", near(F.col("fp"), F.col("pivot")).alias("near")), "starred")
    to_pivot = starred.where("near AND fp != pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct()
    open_ = broadcast_if_small(kept(starred.where("NOT near").select("t", "bits").distinct(), "open"), 16)
    members = kept(starred.join(open_, ["t", "bits"], "left_semi").select("fp").distinct(), "members")
    return found.union(to_pivot).union(kept(hub_links(members), "links"))


def fingerprints_linked(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), fp, component_id for each row of docs."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    rows = written(keyed.mapInPandas(_fingerprints, "doc_id long, key long, fp long"), "fingerprints", AT_ONCE)
    scratch = [rows]
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    scratch.append(classes)
    roots = components(links(classes.select("fp"), scratch), scratch).select(F.col("node").alias("fp"), "root")
    named = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = written(rows.join(named.join(least, "root").select("fp", "component_id"), "fp"), "found")
    drop(*scratch)
    return found.select("doc_id", "key", "fp", "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs but those of a component that aren't its smallest doc_id."""
    found = fingerprints_linked(docs)
    gone = written(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key")).distinct(), "gone")
    drop(found)
    return without(docs, gone)


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints_linked(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
