"""Merkle dataset manifest: a tree of SHA-256 digests over all rows, eight children a node, one subtree for each language.

1. Each row becomes its leaf in one projection. Leaves are sorted by range and written; a partition's first position in
   its group follows from the partitions' row counts, so each leaf knows its index in the group without a global sort.
2. Each task reads a stretch of leaves in order and keeps a stack, one stretch of unfinished nodes a level, like a range
   of mountains. A node that completes a run of eight carries: the run is written with its children, and its digest goes
   one level up. Runs that begin before the stretch or end beyond it stay unfinished; their nodes are sent out as edges.
   As a group's size is known, its last run is complete with fewer nodes, and is hashed without padding.
3. Edges are merged by (group, level, run), level by level; there are at most 14 for each level of each stretch.
4. Subroots are the leaves of one more tree, made in the same way.
5. Downwards, each run hands its children what a proof needs from there up: what stands left and right of them. Runs of
   one level are joined with their parents, so a run's eight rows share one such path, and rows never meet one by one.

Where an executor is lost, its stretch is read again: indexes and tie-breaks are read from written tables.

An empty table has an empty result. Nulls have a leaf of their own (see leaf_text), and a null language is a group of
its own, the first; a null doc_id is the first in its group. Texts are hashed whole. Rows that share a language and a
doc_id are in the order of their leaves, so the result doesn't depend on how the table is stored. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, drop, table, written

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of the number that a row has in a sorted table: the bits below are its place in its partition.
PLACE = 33
#: Stands for the level of a group of one leaf.
ALONE = -1
PATH = "array<struct<left:string,right:string>>"
NODE = "struct<doc_id:long,digest:string,other:string>"
RUN = f"g string, level int, run long, whole boolean, nodes array<{NODE}>, first long"


def sha(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf_text(columns: dict[str, Column]) -> Column:
    """What a leaf is the hash of: each column in turn, `-` if null, else its length in UTF-8 bytes, a colon, and its value."""
    text = {n: c.cast("string") for n, c in columns.items()}
    return F.concat(*[F.coalesce(F.concat(F.octet_length(text[n]).cast("string"), F.lit(":"), text[n]), F.lit("-")) for n in COLUMNS])


def lowered(text: Column) -> Column:
    """A-Z in lower case."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, letters, letters.lower()))


def leaves(docs: DataFrame, tampered: Column | None = None, change: Callable[[Column], Column] = lowered) -> DataFrame:
    """g, doc_id, digest, other (the leaf of the changed text, of rows that are tampered with), salt (a number for each row)."""
    columns = {n: F.col(n) for n in COLUMNS}
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, sha(leaf_text(columns | {"text": change(F.col("text"))})))
    return docs.select(F.col("lang").alias("g"), "doc_id", sha(leaf_text(columns)).alias("digest"), other.alias("other"), F.monotonically_increasing_id().alias("salt"))


def indexed(rows: DataFrame, order: list[str], scratch: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows with n (rows of the group g) and i (place in it, from 0), in order in each partition; g and n of each stretch).

    rows is a written table. What order leaves open must not matter.
    """
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    scratch.append(ordered := written(numbered, "ordered"))
    part = F.shiftright("at", PLACE)
    spans = ordered.groupBy(F.col("g").alias("s_g"), part.alias("s_part")).agg(F.count("*").alias("size"), F.min("at").alias("least"))
    group = Window.partitionBy("s_g")
    shift = F.sum("size").over(group.orderBy("s_part")) - F.col("size") - F.col("least")
    scratch.append(placed := written(spans.select("s_g", "s_part", F.sum("size").over(group).alias("n"), shift.alias("shift")), "placed"))
    side = broadcast_if_small(placed, F.octet_length(F.coalesce("s_g", F.lit(""))) + 32)
    found = ordered.join(side, F.col("g").eqNullSafe(F.col("s_g")) & (part == F.col("s_part")))
    return found.withColumn("i", F.col("at") + F.col("shift")).sortWithinPartitions("g", "i"), placed.select("s_g", "n")


def height(n: int) -> int:
    """Levels of runs above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


class _Stack:
    """The unfinished runs of one group's stretch, one for each level; finished ones, and edges, go to out as they come up."""

    def __init__(self, g: str | None, n: int, out: list[tuple]):
        self.g, self.out, self.sizes = g, out, [n]
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // FANOUT))
        self.first, self.open = [0] * len(self.sizes), [[] for _ in self.sizes]

    def add(self, i: int, node: dict) -> None:
        for level in range(len(self.sizes) - 1):
            nodes = self.open[level]
            if not nodes:
                self.first[level] = i
            nodes.append(node)
            ends = i % FANOUT == FANOUT - 1 or i == self.sizes[level] - 1
            if not ends or not self.send(level):
                return
            node, i = _node(hashlib.sha256("".join(x["digest"] for x in nodes).encode()).hexdigest()), i // FANOUT

    def send(self, level: int) -> bool:
        """Sends what a level holds; whether it is a whole run, whose end is known to be reached unless the stretch ends."""
        nodes, first = self.open[level], self.first[level]
        whole = first % FANOUT == 0 and (len(nodes) == FANOUT or first + len(nodes) == self.sizes[level])
        self.out.append((self.g, level, first // FANOUT, whole, nodes, first))
        self.open[level] = []
        return whole

    def close(self) -> None:
        for level, nodes in enumerate(self.open):
            if nodes:
                self.send(level)


def _node(digest: str, doc_id: int | None = None, other: str | None = None) -> dict:
    return {"doc_id": doc_id, "digest": digest, "other": other}


def _stacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs, whole ones and edges, of leaves that come in order; where the order breaks, a new stretch begins. A group of one leaf has no run: it is sent as ALONE."""
    stack, at, out = None, None, []
    for batch in chain(batches, (None,)):
        if batch is None:
            if stack:
                stack.close()
        else:
            ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"].astype("Int64")]
            groups, others = (batch[c].astype(object).where(batch[c].notna(), None) for c in ("g", "other"))
            for g, n, i, doc_id, digest, other in zip(groups, batch["n"].tolist(), batch["i"].tolist(), ids, batch["digest"], others, strict=True):
                node = _node(digest, doc_id, other)
                if n == 1:
                    out.append((g, ALONE, 0, True, [node], 0))
                    continue
                if stack is None or at != (g, i):
                    if stack:
                        stack.close()
                    stack = _Stack(g, n, out)
                stack.add(i, node)
                at = (g, i + 1)
        if out:
            yield pd.DataFrame(out, columns=["g", "level", "run", "whole", "nodes", "first"])
            out.clear()


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def runs(placed: DataFrame, levels: int, scratch: list[DataFrame]) -> dict[int, DataFrame]:
    """level -> g, run, nodes of all its runs, from indexed leaves."""
    scratch.append(found := written(placed.select("g", "n", "i", "doc_id", "digest", "other").mapInPandas(_stacked, RUN), "runs"))
    whole = lambda level: found.where((F.col("level") == level) & F.col("whole")).select("g", "run", "nodes")
    empty = F.lit(None)
    node = F.struct(empty.cast("long").alias("doc_id"), sha(_joined(F.col("nodes"))).alias("digest"), empty.cast("string").alias("other"))
    out, carried = {ALONE: whole(ALONE)}, None
    for level in range(levels):
        edges = found.where((F.col("level") == level) & ~F.col("whole")).select("g", "first", "nodes")
        if carried is not None:
            edges = edges.union(carried.select("g", F.col("run").alias("first"), F.array(node).cast(f"array<{NODE}>").alias("nodes")))
        pieces = edges.groupBy("g", F.expr(f"first div {FANOUT}").alias("run")).agg(F.sort_array(F.collect_list(F.struct("first", "nodes"))).alias("p"))
        carried = written(pieces.select("g", "run", F.flatten(F.transform("p", lambda x: x["nodes"])).alias("nodes")), "merged")
        scratch.append(carried)
        out[level] = whole(level).union(carried)
    return out


def step(nodes: Column, p: Column) -> Column:
    """What stands left and right of a run's child."""
    right = F.slice(nodes, p + 2, F.greatest(F.size(nodes) - p - 1, F.lit(0)))
    return F.struct(_joined(F.slice(nodes, F.lit(1), p)).alias("left"), _joined(right).alias("right"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the nodes beside its path make up."""
    return F.aggregate(path, leaf, lambda acc, s: sha(F.concat(s["left"], acc, s["right"])))


def siblings(path: Column) -> Column:
    """The digests beside a path, from the leaf's run up to the root's, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def tree(rows: DataFrame, order: list[str], tops: Callable[[DataFrame], DataFrame] | None, scratch: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, other and path of each row, and its group g; g and subroot of each group).

    tops: makes the subroots' own paths (t_g, path) from the subroots, where there is more above them.
    """
    placed, sizes = indexed(rows, order, scratch)
    sizes = sizes.distinct()
    levels = height(sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    by_level = runs(placed, levels, scratch)
    tall = sum((F.when(F.col("n") > FANOUT**k, 1).otherwise(0) for k in range(levels)), F.lit(0))
    heights = sizes.select(F.col("s_g").alias("t_g"), tall.alias("height"))

    def at_top(level: int) -> DataFrame:
        """The last run of each group that ends at this level."""
        ends = heights.where(F.col("height") == level + 1)
        return by_level[level].where("run = 0").join(ends, F.col("g").eqNullSafe(F.col("t_g")), "left_semi")

    roots = [at_top(k).select("g", sha(_joined(F.col("nodes"))).alias("subroot")) for k in range(levels)]
    roots.append(by_level[ALONE].select("g", F.col("nodes")[0]["digest"].alias("subroot")))
    scratch.append(subroots := written(reduce(DataFrame.union, roots), "subroots"))
    above = tops(subroots) if tops else subroots.select(F.col("g").alias("t_g"), F.array().cast(PATH).alias("path"))

    def with_paths(level: int, tails: DataFrame | None) -> DataFrame:
        """A level's runs with what their parents hand them, or what is above their group."""
        ends = heights.where(F.col("height") == level + 1).select(F.col("t_g").alias("h_g"))
        begun = above.join(ends, F.col("t_g").eqNullSafe(F.col("h_g")), "left_semi").select("t_g", F.lit(0).cast("long").alias("t_run"), "path")
        tails = begun if tails is None else begun.union(tails)
        meet = F.col("g").eqNullSafe(F.col("t_g")) & (F.col("run") == F.col("t_run"))
        return by_level[level].join(tails, meet).select("g", "run", "nodes", "path", F.lit(level != ALONE).alias("several"))

    handed = None
    for level in reversed(range(1, levels)):
        known = with_paths(level, handed).select("*", F.explode(F.sequence(F.lit(0), F.size("nodes") - 1)).alias("p"))
        down = F.concat(F.array(step(F.col("nodes"), F.col("p"))), "path").cast(PATH)
        handed = known.select(F.col("g").alias("t_g"), (F.col("run") * FANOUT + F.col("p")).alias("t_run"), down.alias("path"))
    lowest = with_paths(ALONE, None)
    scratch.append(per_run := written(with_paths(0, handed).union(lowest) if levels else lowest, "paths"))
    each = per_run.select("g", "nodes", "path", "several", F.posexplode("nodes").alias("p", "x"))
    path = F.when(F.col("several"), F.concat(F.array(step(F.col("nodes"), F.col("p"))), "path").cast(PATH)).otherwise(F.col("path"))
    return each.select("g", "x.doc_id", "x.digest", "x.other", path.alias("path")), subroots


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """lang, doc_id, leaf, subroot, root, proof (the digests beside the path to the root), folded_root and verified for each row.

    tampered: which rows are checked as if their text had changed, to see that the root tells.
    """
    scratch: list[DataFrame] = []
    roots: list[str] = []

    def tops(subroots: DataFrame) -> DataFrame:
        """Subroots in the order of their languages are the leaves of one more tree."""
        none = F.lit(None)
        as_rows = subroots.select(none.cast("string").alias("g"), none.cast("long").alias("doc_id"), F.col("subroot").alias("digest"), F.col("g").alias("other"))
        paths, root = tree(as_rows, ["other"], None, scratch)
        roots.extend(r["subroot"] for r in root.collect())  # one digest, or none of an empty table
        scratch.append(found := written(paths.select(F.col("other").alias("t_g"), "path"), "tops"))
        return found

    scratch.append(rows := written(leaves(docs, tampered), "leaves"))
    each, subroots = tree(rows, ["g", "doc_id", "digest", "salt"], tops, scratch)
    of = broadcast_if_small(subroots, F.octet_length(F.coalesce("g", F.lit(""))) + 64).select(F.col("g").alias("s_g"), "subroot")
    root = F.lit(roots[0] if roots else None).cast("string")
    found = each.join(of, F.col("g").eqNullSafe(F.col("s_g"))).withColumn("folded_root", folded(F.coalesce("other", "digest"), F.col("path")))
    result = found.select(F.col("g").alias("lang"), "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), siblings(F.col("path")).alias("proof"), "folded_root",
        (F.col("folded_root") == root).alias("verified"))
    read = {*result.inputFiles()}
    drop(*[x for x in scratch if not {*x.inputFiles()} & read])
    return result


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return found.select("doc_id", "leaf", "subroot", "root", sha(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


#: crc32 of a text bit by bit, the tree as one recursion up, the proofs as another.
ORACLE_SQL = r"""
WITH RECURSIVE f AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)) AS crc FROM documents),
h AS (SELECT lang, doc_id, doc_id IS NOT NULL AND xor(crc, 4294967295::UBIGINT) % 3 = 0 AS hit,
  coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
  coalesce(strlen(text) || ':' || text, '-') AS t, coalesce(strlen(low) || ':' || low, '-') AS l FROM f),
leaf AS (SELECT lang, doc_id, sha256(front || t) AS leaf, CASE WHEN hit THEN sha256(front || l) ELSE sha256(front || t) END AS now,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(front || t)) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM h),
up AS (SELECT lang, 0 AS lv, i, n, leaf AS d FROM leaf UNION ALL
  SELECT lang, lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lang, lv, i // 8, n),
s AS (SELECT lang, d AS subroot, lv AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, i, n, subroot AS d FROM s UNION ALL SELECT lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lv, i // 8, n),
runs AS (SELECT lang, false AS above, lv, i // 8 AS run, list(d ORDER BY i) AS ds FROM up WHERE n > 1 GROUP BY lang, lv, i // 8
  UNION ALL SELECT NULL, true, lv, i // 8, list(d ORDER BY i) FROM top WHERE n > 1 GROUP BY lv, i // 8),
steps AS (SELECT leaf.lang, leaf.doc_id, leaf.i AS ix, r.lv, r.ds, (leaf.i // (8 ** r.lv)::BIGINT) % 8 AS p FROM leaf JOIN runs r
    ON NOT r.above AND r.lang IS NOT DISTINCT FROM leaf.lang AND r.run = leaf.i // (8 ** (r.lv + 1))::BIGINT
  UNION ALL SELECT leaf.lang, leaf.doc_id, leaf.i, s.height + r.lv, r.ds, (s.i // (8 ** r.lv)::BIGINT) % 8 FROM leaf JOIN s ON s.lang IS NOT DISTINCT FROM leaf.lang
    JOIN runs r ON r.above AND r.run = s.i // (8 ** (r.lv + 1))::BIGINT),
proof AS (SELECT lang, ix, string_agg(array_to_string(ds[:p] || ds[p + 2:], ''), '' ORDER BY lv) AS text,
  list(struct_pack(x := array_to_string(ds[:p], ''), y := array_to_string(ds[p + 2:], '')) ORDER BY lv) AS path FROM steps GROUP BY lang, ix),
back AS (SELECT leaf.*, coalesce(text, '') AS proof, coalesce(path, []) AS path FROM leaf LEFT JOIN proof ON proof.lang IS NOT DISTINCT FROM leaf.lang AND proof.ix = leaf.i),
fold AS (SELECT doc_id, lang, i, 1 AS k, now AS d, path FROM back UNION ALL SELECT doc_id, lang, i, k + 1, sha256(path[k].x || d || path[k].y), path FROM fold WHERE k <= len(path))
SELECT b.doc_id, leaf, subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(proof) AS proof_sha256, fold.d AS folded_root, fold.d = (SELECT d FROM top WHERE n = 1) AS verified
FROM back b JOIN s ON s.lang IS NOT DISTINCT FROM b.lang JOIN fold ON fold.lang IS NOT DISTINCT FROM b.lang AND fold.i = b.i AND fold.k = len(b.path) + 1
"""
