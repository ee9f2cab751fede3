"""Suffix-array dedup: every byte covered by a 200-byte string that also starts elsewhere, by distributed prefix doubling.

A suffix array would rank all positions of the corpus; its ranks of 8 bytes each are many times the text (README has
figures). Here ranks are 64-bit fingerprints, doubled from 1 to 64, then 96, 128 and 200 bytes inside each text, and
Spark sorts pairs of ranks of sampled positions, in three rounds for strings of 96, 193 and 200 bytes and what extends
them; each round goes on with the positions that are neither unique nor past the threshold:

1. Each 200-byte window picks an anchor, its 96-byte string of least fingerprint. Equal windows pick equal anchors at
   the same offset, so windows whose anchor string is unique in the corpus are done. About one position in 53 is one.
2. The windows of one anchor are consecutive. Their pair of first and last rank names the string that they make up
   together. Spark sorts the pairs (anchor's rank, that rank); where neighbours are equal, all the windows repeat.
3. What is left is split into blocks of eight windows at fixed offsets to the anchor and sorted again: a block whose
   string repeats is done, and so is one whose core (the bytes that all its windows share) is unique.
4. The windows of the blocks left are ranked and sorted one by one, by two independent fingerprints of 64 bits.

Steps 3 and 4 take one representative of each class of equal strings, so a passage that a third of all texts share
costs as much as one that two share; and what repeats within a task is settled there and sends one row. Sorted rows
are read as a stream: no group of equal ranks is ever held, however large. Of an anchor that stands in many contexts,
each batch of texts sorts two and hands the others on to the next round, so that no task gets all of them. Nothing is
capped: each step either proves a window repeated, or unique, or hands it on.

An empty table has an empty result; other columns are ignored, whatever their names. A null text is empty. Texts below 200 bytes lose nothing. Rows that repeat are two texts that repeat each other, also
when they share a doc_id. Texts are worked through in pieces of a million windows, so memory stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.operators.keys import flagged, prefiltered

from .common import drop, table, written

LENGTH, ANCHOR, BLOCK = 200, 96, 8
#: Anchors are chosen among so many places of a window.
PLACES = LENGTH - ANCHOR + 1
PIECE = 1 << 20
#: Texts that go to Python at once with their runs; in the first round, where they go without, Spark's setting holds.
AT_ONCE = 500

_OFFSETS = (1, 2, 4, 8, 16, 32, 64, 65, 72, 96)
#: What a fingerprint is made with: a number for each byte, and one for each offset. There are two, independent of each other.
_NUMBERS = [np.random.default_rng(seed).integers(0, 1 << 63, 256 + len(_OFFSETS), dtype=np.uint64) * np.uint64(2) + np.uint64(1) for seed in (20240603, 20240604)]
_BYTES = [x[:256] for x in _NUMBERS]
_FACTORS = [dict(zip(_OFFSETS, x[256:], strict=True)) for x in _NUMBERS]
_FACTOR = _FACTORS[0]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pair(h: np.ndarray, offset: int, kind: int = 0, factor: np.uint64 | None = None) -> np.ndarray:
    """Ranks of longer strings, from the pairs of ranks at this offset."""
    out = h[:-offset] * (factor or _FACTORS[kind][offset])
    out += h[offset:]
    out ^= out >> np.uint64(29)
    return out


def ranks(data: np.ndarray, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the 64-byte and the 128-byte strings at each position; data has at least 128 bytes."""
    h = _BYTES[kind][data]
    for n in (1, 2, 4, 8, 16, 32):
        h = _pair(h, n, kind)
    return h, _pair(h, 64, kind)


def window_ranks(h128: np.ndarray, kind: int = 0) -> np.ndarray:
    return _pair(h128, LENGTH - 128, kind)


def anchored(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """first and last window, anchor, its rank, and the rank of what the windows make up, of each run of windows with one anchor."""
    h64, h128 = ranks(data)
    h200, h96 = window_ranks(h128), _mix(_pair(h64, ANCHOR - 64, factor=_FACTOR[96]))
    least = (h96 & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h96), dtype=np.uint64)
    n = 1
    while 2 * n <= PLACES:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    at = (np.minimum(least[: len(h200)], least[PLACES - n :]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    last = np.append(first[1:] - 1, len(at) - 1)
    union = _mix(h200[first] * _FACTOR[1] + _mix(h200[last] * _FACTOR[2] + (last - first).astype(np.uint64)))
    return first, last, at[first], h96[at[first]], union


#: A run of windows in one number: its first window, how many follow, and how far its anchor is from the first.
def _packed(lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (lo.astype(np.int64) << 32) | ((hi - lo).astype(np.int64) << 16) | (at - lo).astype(np.int64)


def _unpacked(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    run = np.asarray(run, np.int64)
    lo = run >> 32
    return lo, lo + (run >> 16 & 0xFFFF), lo + (run & 0xFFFF)


#: Rows that are gathered before they are reduced and sent on.
GATHERED = 100_000


class _Rows:
    """Columns of rows of many texts, gathered as arrays until they are many."""

    def __init__(self, *names: str):
        self.names = names
        self._clear()

    def _clear(self) -> None:
        self.parts, self.ids, self.counts, self.size = [], [], [], 0

    def add(self, doc_id, key: int, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.ids.append((doc_id, key))
        self.counts.append(len(columns[0]))
        self.size += len(columns[0])

    def frames(self, least: int = 1) -> Iterator[pd.DataFrame]:
        """What is gathered, if it has so many rows."""
        if self.size >= least:
            ids = pd.DataFrame(self.ids, columns=["doc_id", "key"]).astype({"doc_id": "Int64"})
            columns = {n: np.concatenate(c).view(np.int64) for n, c in zip(self.names, zip(*self.parts, strict=True), strict=True)}
            gathered = pd.concat([pd.DataFrame(columns), ids.loc[ids.index.repeat(self.counts)].reset_index(drop=True)], axis=1)
            self._clear()
            yield _combined(gathered)


#: Rows of one core that a batch sorts, if it has more.
SORTED = 2
#: What n says of a row. Not sorted: its string repeats, or is left to the next round. Sorted: it stands for itself, or for equal ones; with MORE added, its core has others that are handed on.
SETTLED, HANDED_ON, ONE, MANY, MORE = 0, -1, 1, 2, 4


def _combined(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows with n. Rows with equal ranks repeat each other and are settled; a representative of them is left. Of a core's rows that are left SORTED are sorted and the others handed on."""
    rows = rows.iloc[np.lexsort((rows["union"], rows["core"]))].reset_index(drop=True)
    core, union = rows["core"].to_numpy(), rows["union"].to_numpy()
    same = np.append(False, (core[1:] == core[:-1]) & (union[1:] == union[:-1]))
    again = same | np.append(same[1:], False)
    rows["n"], dealt = np.where(again, MANY, ONE), core ^ rows["run"].to_numpy() * 0x9E3779B97F4A7C1 ^ rows["doc_id"].fillna(0).to_numpy(np.int64)
    settled = rows[again].assign(core=dealt[again], n=SETTLED)  # rows that aren't sorted are dealt out at random
    rows, core, dealt = rows[~same], core[~same], dealt[~same]
    start = np.searchsorted(core, core)
    crowded = np.searchsorted(core, core, side="right") - start > SORTED
    on = crowded & (np.arange(len(core)) - start >= SORTED)
    n = np.where(on, HANDED_ON, rows["n"].to_numpy() + np.where(crowded, MORE, 0))
    return pd.concat([rows.assign(core=np.where(on, dealt, core), n=n), settled])


def _texts(batch: pd.DataFrame) -> Iterator[tuple]:
    ids = batch["doc_id"].astype("Int64")
    for i in range(len(batch)):
        yield ids.iat[i], batch["key"].iat[i], np.frombuffer((batch["text"].iat[i] or "").encode(), np.uint8)


ROW = "core long, union long, run long, doc_id long, key int, n int"


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = _Rows("core", "union", "run")
        for doc_id, key, data in _texts(batch):
            for i in range(0, len(data) - LENGTH + 1, PIECE):
                first, last, at, core, union = anchored(data[i : i + PIECE + LENGTH - 1])
                rows.add(doc_id, key, core, union, _packed(first + i, last + i, at + i))
                yield from rows.frames(GATHERED)
        yield from rows.frames()


def _slices(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, kind: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each run of windows: its number, and the ranks of its strings of 128 and 200 bytes."""
    for i in range(0, len(lo), 4096):
        part = [data[a : b + LENGTH] for a, b in zip(lo[i : i + 4096].tolist(), hi[i : i + 4096].tolist(), strict=True)]
        h128 = ranks(np.concatenate(part), kind)[1]
        h200 = window_ranks(np.append(h128, np.zeros(LENGTH, np.uint64)), kind)
        start = 0
        for k, x in enumerate(part):
            yield i + k, h128[start : start + len(x) - 127], h200[start : start + len(x) - LENGTH + 1]
            start += len(x)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Splits runs of windows into blocks at fixed offsets to the anchor. The core is what the windows of the full block share, also where the run holds but some of them: the 193 bytes from its last window's start on."""
    for batch in batches:
        rows = _Rows("core", "union", "run")
        for (doc_id, key, data), runs in zip(_texts(batch), batch["runs"], strict=True):
            los, his, ats = _unpacked(runs)
            for k, h128, h200 in _slices(data, los, his):
                lo, hi, at = los[k], his[k], ats[k]
                most = at - BLOCK * np.arange((at - hi) // BLOCK, (at - lo) // BLOCK + 1)
                p, q = np.maximum(most - BLOCK + 1, lo), np.minimum(most, hi)
                core = _mix(h128[most - lo] * _FACTOR[65] + h128[most - lo + 65])
                place = ((q - p) * 2 * BLOCK + most - p).astype(np.uint64)
                union = _mix(h200[p - lo] * _FACTOR[1] + _mix(h200[q - lo] * _FACTOR[2] + place))
                rows.add(doc_id, key, core, union, _packed(p, q, most))
                yield from rows.frames(GATHERED)
        yield from rows.frames()


def _single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Both ranks of each window of the runs."""
    for batch in batches:
        rows = _Rows("core", "union", "run")
        for (doc_id, key, data), runs in zip(_texts(batch), batch["runs"], strict=True):
            los, his, _ = _unpacked(runs)
            for (k, _, h200), (*_, other) in zip(_slices(data, los, his), _slices(data, los, his, 1), strict=True):
                at = los[k] + np.arange(len(h200))
                rows.add(doc_id, key, h200, other, _packed(at, at, at))
                yield from rows.frames(GATHERED)
        yield from rows.frames()


def spans(runs: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of bytes that runs of windows, in order, cover."""
    lo, hi, _ = _unpacked(runs)
    end = np.maximum.accumulate(hi + LENGTH)
    cut = np.flatnonzero(lo[1:] > end[:-1]) + 1
    return list(zip(lo[np.append(0, cut)].tolist(), end[np.append(cut - 1, len(end) - 1)].tolist(), strict=True))


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cuts the runs of windows, which are in order, out of the texts."""
    for batch in batches:
        out = []
        for text, runs in zip(batch["text"], batch["runs"], strict=True):
            data, cut = (text or "").encode(), [] if runs is None else spans(runs)
            kept, end = hashlib.sha256(), 0
            for a, b in cut:
                kept.update(data[end:a])
                end = b
            kept.update(data[end:])
            out.append((len(data), sum(b - a for a, b in cut), len(cut), kept.hexdigest(), [{"start": a, "end": b} for a, b in cut]))
        yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])], axis=1)


def _per_text(runs: DataFrame) -> DataFrame:
    """The runs of each text as one array, in order. A text's runs are fewer than its bytes."""
    return written(runs.groupBy(F.col("doc_id").alias("r_doc"), F.col("key").alias("r_key")).agg(F.sort_array(F.collect_list("run")).alias("runs")), "runs")


def _id(doc_id: str, key: str) -> Column:
    return F.xxhash64(doc_id, key)


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The texts that have runs, with them: by one plan at any size, a merge join of what a filter of bounded size lets pass."""
    possible = prefiltered(docs, _id("doc_id", "key"), runs.select(_id("r_doc", "r_key").alias("id")), F.col("id"))
    same = F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("key") == F.col("r_key"))
    return possible.join(runs.hint("merge"), same).select("doc_id", "key", "text", "runs")


def _classified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows in the order of their ranks: runs whose string repeats (split false), and representatives of what must be split further.

    A core is split if it has several classes of equal strings and one of them is alone, or if rows of it were handed on. Only the rows of the last core
    wait for the next batch. If those become many, all but the last class go on, and the core counts as one to be split.
    """
    wait, many = None, None
    for batch in _and_end(batches):
        parts = [x for x in (wait, batch) if x is not None]
        if not parts:
            return
        rows, wait = pd.concat(parts, ignore_index=True), None
        n = rows["n"].to_numpy()
        if (n <= SETTLED).any():
            yield rows.loc[n <= SETTLED, RUN].assign(split=n[n <= SETTLED] == HANDED_ON)
            rows = rows[n > SETTLED].reset_index(drop=True)
        if not len(rows):
            continue
        core, union = rows["core"].to_numpy(), rows["union"].to_numpy()
        new_core = np.append(True, core[1:] != core[:-1])
        new_class = new_core | np.append(True, union[1:] != union[:-1])
        end, forced = len(rows), core == many
        if batch is not None:
            end = np.flatnonzero(new_core)[-1]
            if len(rows) - end > HELD:
                many, end = core[-1], np.flatnonzero(new_class)[-1]
                forced |= core == many
            wait = rows.iloc[end:]
            if len(wait) > HELD:  # one class, which repeats: one row stands for it
                yield wait.loc[wait["n"] % MORE == ONE, RUN].assign(split=False)
                wait = wait.iloc[:1].assign(n=MANY)
        if end:
            yield from _class_rows(rows.iloc[:end], new_core[:end], new_class[:end], forced[:end])


def _class_rows(rows: pd.DataFrame, new_core: np.ndarray, new_class: np.ndarray, forced: np.ndarray) -> Iterator[pd.DataFrame]:
    n, more = rows["n"].to_numpy() % MORE, rows["n"].to_numpy() >= MORE
    at_class, at_core = np.flatnonzero(new_class), np.flatnonzero(new_core)
    size, first_class = np.add.reduceat(n, at_class), np.searchsorted(at_class, at_core)
    per_core = np.diff(np.append(first_class, len(at_class)))
    alone = np.add.reduceat((size == 1).astype(np.int64), first_class)
    split = np.repeat(((per_core > 1) & (alone > 0)) | forced[at_core] | np.logical_or.reduceat(more, at_core), per_core)
    repeats = np.repeat(size > 1, np.diff(np.append(at_class, len(n)))) & (n == ONE)
    yield rows.loc[repeats, RUN].assign(split=False)
    yield rows.iloc[at_class[split]][RUN].assign(split=True)


RUN = ["doc_id", "key", "run"]
#: Rows of one core that wait for the next batch at most.
HELD = 100_000


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _settled(rows: DataFrame, batch: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs whose string repeats, representatives of what must be split further), each as runs per text; and the table below both."""
    ordered = rows.repartition("core").sortWithinPartitions("core", "union")
    found = written(ordered.mapInPandas(_classified, "doc_id long, key int, run long, split boolean"), "settled", batch)
    return found.where("NOT split"), _per_text(found.where("split")), found


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, key, runs (lo, hi: windows, by their first byte, that repeat) of the texts that have some. docs: doc_id, key, text."""
    whole, left, first = _settled(docs.where(F.octet_length("text") >= LENGTH).mapInPandas(_anchors, ROW))
    in_blocks, smaller, second = _settled(_with_runs(docs, left).mapInPandas(_blocks, ROW), AT_ONCE)
    alone, _, third = _settled(_with_runs(docs, smaller).mapInPandas(_single, ROW), AT_ONCE)
    all_runs = _per_text(reduce(DataFrame.unionByName, [x.select("doc_id", "key", "run") for x in (whole, in_blocks, alone)]))
    drop(first, second, third, left, smaller)
    return all_runs


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (bytes, end exclusive) of each row.

    Texts that surely have no runs are hashed where they are read; the others meet their runs.
    """
    keyed = docs.select("doc_id", F.hash(F.coalesce("text", F.lit(""))).alias("key"), "text")
    runs = repeated(keyed)
    marked = flagged(keyed, _id("doc_id", "key"), runs.select(_id("r_doc", "r_key").alias("id")), F.col("id"))
    same = F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("key") == F.col("r_key"))
    cut = marked.where("__maybe").join(runs.hint("merge"), same, "left").select("doc_id", "text", "runs").mapInPandas(_removed, REMOVED)
    whole, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    kept = marked.where("NOT __maybe").select("doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2(whole, 256).alias("kept_sha256"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    found = written(cut.union(kept), "removed", AT_ONCE)
    drop(runs)
    return found


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
