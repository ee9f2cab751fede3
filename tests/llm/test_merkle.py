"""The manifest against a tree built in memory, on odd rows and on stretches that begin and end anywhere."""

import hashlib
import random
import zlib

import duckdb
from cases import SCHEMA
from pyspark.sql import functions as F

from girder.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def climbed(levels, i, proof, digest):
    for level in levels[:-1]:
        run, p = level[i // 8 * 8 : i // 8 * 8 + 8], i % 8
        proof += run[:p] + run[p + 1 :]
        digest, i = sha("".join(run[:p]) + digest + "".join(run[p + 1 :])), i // 8
    return digest


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {g: levels_of([leaf(r, r["text"]) for r in groups[g]]) for g in order}
    top = levels_of([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            text = r["text"].translate(LOWER) if hit and r["text"] is not None else r["text"]
            proof = []
            digest = climbed(top, k, proof, climbed(trees[g], i, proof, leaf(r, text)))
            root = top[-1][0]
            out.append((r["doc_id"], trees[g][0][i], trees[g][-1][0], root, "".join(proof), digest, digest == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")


def got(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return sorted((tuple(r) for r in merkle.manifest(docs, tampered).select(*COLUMNS).collect()), key=str)


def test_odd_rows(docs):
    assert got(docs) == expected([r.asDict() for r in docs.collect()])


def test_stretches(spark):
    """Groups of 1, 8, 9, 64 and 700 rows and one without a language, over as many partitions as make ends meet anywhere."""
    rng = random.Random(3)
    sizes = {None: 70, "": 1, "a": 8, "b": 9, "ä": 64, "zz": 700, "c": 513}
    rows = [(rng.randrange(10**6), f"Text {rng.random()}", g, f"s{k % 3}", k) for g, n in sizes.items() for k in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = expected([r.asDict() for r in df.collect()])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "30"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert got(df.repartition(3)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stack_hands_out_runs_and_edges():
    out = []
    stack = merkle._Stack("g", 20, out)
    for i in range(5, 20):
        stack.add(i, merkle._node(str(i)))
    stack.close()
    assert [(level, run, whole, len(nodes), first) for _, level, run, whole, nodes, first in out] == [
        (0, 0, False, 3, 5), (0, 1, True, 8, 8), (0, 2, True, 4, 16), (1, 0, False, 2, 1)]


def test_few_rows(spark, docs, empty):
    assert merkle.manifest(empty).count() == 0
    one = spark.createDataFrame([(5, "Some TEXT", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(one, F.lit(True)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof"] == "" and not row["verified"]
    assert merkle.manifest(one).first()["verified"]


def test_root_tells_any_change(spark):
    rows = [(k, f"text {k}", "en", None, 6) for k in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    root = lambda rows: merkle.manifest(spark.createDataFrame(rows, schema)).first()["root"]
    first = root(rows)
    assert root(rows[::-1]) == first
    for changed in (rows[:-1], [*rows, (40, None, "en", None, 6)], [(*rows[0][:2], "de", None, 6), *rows[1:]], [(*r[:3], "x", r[4]) for r in rows[:1]] + rows[1:]):
        assert root(changed) != first


def test_sql(docs):
    con = duckdb.connect()
    documents = docs.toPandas()[["doc_id", "text", "lang", "source", "n_chars"]].astype({"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841
    con.register("documents", documents)
    rows = [r[:4] + r[5:] for r in got(docs)]
    found = con.execute(merkle.ORACLE_SQL).fetchall()
    assert sorted((r[:4] + r[5:] for r in found), key=str) == sorted(rows, key=str)
    assert len(SCHEMA.split(",")) == len(docs.columns)
