"""SimHash near-dedup against brute force: all hashes bit by bit, all pairs by their distance."""

import random
import re

import pytest
import xxhash
from cases import edited, prose
from pyspark.sql import functions as F

from girder.llm import simhash
from girder.llm.near_dup import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), seed=42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """The smallest position reachable from each, over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def expected(texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(fps)
    least = {}
    for (doc_id, _), r in zip(texts, roots, strict=True):
        least[r] = doc_id if least.get(r) is None else least[r] if doc_id is None else min(doc_id, least[r])
    return sorted(((i, f"{fp:016x}", least[r]) for (i, _), fp, r in zip(texts, fps, roots, strict=True)), key=str)


def got(df):
    return sorted(((r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in df.collect()), key=str)


def test_odd_rows(docs, texts):
    assert got(simhash.fingerprints_linked(docs)) == expected([(i, t) for i, t, _ in texts])


def test_near_copies(spark):
    base = [prose(k, 300) for k in range(5)]
    rows = [(100 - k, edited(base[k % 5], k, 1 + k % 3)) for k in range(60)] + [(k + 200, b) for k, b in enumerate(base)]
    want = expected(rows)
    assert len({c for _, _, c in want}) < 40
    assert got(simhash.fingerprints_linked(spark.createDataFrame(rows, "doc_id long, text string"))) == want


@pytest.mark.parametrize("crowd", [1000, 8])
def test_links_of_dense_groups(spark, monkeypatch, crowd):
    """Groups whose members are near to each other but not all to one; with a low CROWD they are linked by hubs."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for base in list(fps)[:3]:
        chain = base
        for _ in range(60):
            chain ^= sum(1 << b for b in rng.sample(range(64), rng.randint(3, 5)))
            near = base ^ sum(1 << b for b in rng.sample(range(16), rng.randint(1, 7)))
            fps |= {chain, near}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    scratch = []
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), scratch)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in links.collect())
    root = {r["node"]: r["root"] for r in components(links, scratch).collect()}
    found, want = [root.get(f, f) for f in signed], brute_components(fps)
    assert len({*zip(found, want, strict=True)}) == len({*found}) == len({*want})
    assert any("hubs" in "".join(x.inputFiles()) or crowd == 1000 or "members" in "".join(x.inputFiles()) for x in scratch)


def test_copies_go(docs, texts, empty):
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    want = [i for i, _, c in expected([(i, t) for i, t, _ in texts]) if i == c]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, want))
    assert simhash.fingerprints_linked(empty).count() == 0


def test_plan_has_no_pairs_of_documents(spark, tmp_path):
    """Documents meet classes by their fingerprint only."""
    df = simhash.bucketed(spark.range(10).select(F.col("id").alias("fp")))
    assert df.count() == 150 and df.select("t").distinct().count() == 15
