"""Operator 4 — near-duplicate documents by circulant MinHash, exact Jaccard verification and components.

A document's set holds its distinct ``SHINGLE``-word shingles (A-Z lower-cased).  One permutation sends a shingle to a
place in ``[0, 2**32)``; a second one, shifted circularly by k, gives coordinate k of the signature: two permutations
make all ``BANDS * ROWS`` coordinates.  Documents that agree in a band are candidates, and a link is confirmed on the
full sets.  At similarity 0.75 a pair shares no band with probability ``(1 - 0.75**4)**32 < 6e-6``.

Documents with equal sets are one node, its smallest id.  The members of a band bucket are first checked against one
*centre*, the member that shares most buckets (in a group of copies: the original), so a bucket of n costs n checks.
A bucket whose members are then in one component is done: further links inside add nothing.  Of the others, the
members outside the bucket's largest component are compared with all its members, in chunks of packed sets, so no
pair becomes a row.  A shingle that no other candidate holds is in no intersection; it bounds the size of the sets that
a set can be linked with, and members that can't be linked with any other are left out.  No candidate is dropped.

Edge cases: a text of fewer than ``SHINGLE`` words is one shingle; without words (or null) the set is empty and linked
with nothing; documents with a null id are linked with nothing and kept; repeated rows share their component; rows of
one id with different texts count as connected; an empty table gives an empty result; very long texts are one row
each; other columns are ignored by ``near_duplicates`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.blocks import U, answer, buckets_for, group_order, group_sizes, joined, mix, question, squeeze, unsqueeze, with_answers
from starmetrics.llm.common import frugal, stage, table
from starmetrics.llm.repeats import Sequence, _ask, more_than_once, per_block, window_hash

SHINGLE = 5
BANDS, ROWS = 32, 4
#: A link: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Sets that are compared at once in round 2.
CHUNK_SETS = 512
#: Documents (and bytes of text) hashed at once.
SLICE_DOCS, SLICE_BYTES = 500, 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SIGMA = U(0x2545F4914F6CDD1D)


class _Texts:
    """Some documents' texts, lower-cased, in the form of a block."""

    def __init__(self, texts: pa.Array):
        t = texts.fill_null("").cast(pa.large_string())
        off = np.frombuffer(t.buffers()[1], np.int64)[t.offset: t.offset + len(t) + 1]
        raw = np.frombuffer(t.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        self.data = _LOWER[raw]
        self.starts, self.ends = off[:-1] - off[0], off[1:] - off[0]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, document after document and ascending in each, and the documents' borders."""
    seq = Sequence(_Texts(texts), True, second=False)
    n = seq.ends - seq.starts
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    start = np.repeat(seq.starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    h = window_hash(seq.h1, start, start + np.repeat(np.minimum(n, SHINGLE), count))
    ends = np.cumsum(count)
    for a, b in zip((ends - count).tolist(), ends.tolist()):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def _permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of [0, 2**32)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def signatures(h: np.ndarray, border: np.ndarray) -> np.ndarray:
    """(documents, BANDS * ROWS) uint32; all sets non-empty."""
    place = (mix(h ^ _SIGMA) >> U(32)).astype(np.uint32)
    out = np.empty((len(border) - 1, BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(_permute(place - np.uint32(k)), border[:-1])
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, BANDS): one 64-bit key for each band and its rows."""
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15), s.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key + s[:, :, r] * U(0xD6E8FEB86659FD93) + U(r + 1))
    return key


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE_BYTES, side="right"))
        hi = min(max(hi, lo + 1), lo + SLICE_DOCS, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, fp1, fp2, bands``: the size of the set, a 128-bit fingerprint of it, and its band keys
    (empty for an empty set)."""

    def run(batches):
        for batch in batches:
            for b in _slices(batch, "text"):
                h, border = shingle_sets(b.column("text"))
                n = np.diff(border)
                full = np.flatnonzero(n)
                keys = band_keys(signatures(h, np.append(border[:-1][full], border[-1]))) if len(full) else np.empty((0, BANDS), np.uint64)
                fp = np.zeros((2, len(n)), np.uint64)
                for i in range(2):
                    if len(full):
                        fp[i, full] = np.add.reduceat(mix(h + U(i + 1) * _SIGMA), border[:-1][full])
                off = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(x.view(np.int64)) for x in fp], pa.ListArray.from_arrays(off, keys.reshape(-1).view(np.int64))],
                    ["doc_id", "n_shingles", "fp1", "fp2", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(run), "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>")


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, label``: the smallest node that each node of ``links(a, b)`` reaches.

    Every round takes the smallest label among the neighbours and then the label of that label."""
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), name + "-links")
    label = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), name + "-labels")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        far = label.select(F.col("node").alias("far"), F.col("label").alias("far_label"))
        step = stage(step.join(far, F.col("mid") == F.col("far")).select("node", "old", F.least("mid", "far_label").alias("label")), name + "-labels")
        label = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return label


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs(a, b)`` that are links; ``sets(node, shingles, …)``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            keep, last, y = [], None, None
            for k in range(batch.num_rows):
                raw = batch.column("y")[k].as_py()
                if raw != last:
                    last, y = raw, unsqueeze(raw, np.uint64)
                x = unsqueeze(batch.column("x")[k].as_py(), np.uint64)
                same = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                keep.append(100 * same >= SIMILAR * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(frugal(run), "a long, b long")


def shingle_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, shared, shingles`` of the documents in ``nodes(node)``: the set (packed), its size, and how many of its
    shingles other sets hold as well (asked between blocks of sets; a few unique ones may pass for shared, none the
    other way round).  Only shared shingles can be in an intersection."""

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in _slices(batch, "text"):
                h, border = shingle_sets(b.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + seq]), *[pa.array([squeeze(x)], pa.binary()) for x in (
                    b.column("node").to_numpy(zero_copy_only=False), np.diff(border), h)]], ["block", "nodes", "sizes", "shingles"])
                seq += 1

    picked = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node").dropDuplicates(["node", "text"])
    sets = stage(picked.select("node", "text").mapInArrow(frugal(run), "block long, nodes binary, sizes binary, shingles binary"), "near-blocks")
    buckets = buckets_for((sets.agg(F.sum(F.length("shingles"))).first()[0] or 0) // 6)

    def distinct(row):
        h = unsqueeze(row["shingles"], np.uint64)
        order, new = group_order(h)
        return h, order, new

    def ask(row):
        h, order, new = distinct(row)
        u = h[order[new]]
        return question(row["block"], u, [u.astype(np.uint32)], buckets)

    flags = answer(_ask(sets, ask, 1), buckets, [np.uint32], more_than_once)
    both = with_answers(sets, flags)

    def count(row):
        h, order, new = distinct(row)
        many = (joined(row["a0"], np.uint8) > 0) | (group_sizes(new) > 1)
        shared = np.empty(len(h), np.int64)
        shared[order] = np.repeat(many, group_sizes(new))
        size = unsqueeze(row["sizes"], np.int64)
        border = np.concatenate([[0], np.cumsum(size)])
        total = np.concatenate([[0], np.cumsum(shared)])
        return pa.RecordBatch.from_arrays([
            pa.array(unsqueeze(row["nodes"], np.int64)), pa.array(size), pa.array(total[border[1:]] - total[border[:-1]]),
            pa.array([squeeze(h[x:y]) for x, y in zip(border[:-1], border[1:])], pa.binary())], ["node", "n", "shared", "shingles"])

    return stage(per_block(both.select("block", "nodes", "sizes", "shingles", "a0"), count, "node long, n long, shared long, shingles binary"), "near-sets")


def linked(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, label``: components of the ``nodes(node, n, bands)`` under confirmed links (nodes with a link only)."""
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    size = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stage(spread.join(size, "bucket"), "near-members")
    sets = shingle_table(docs, members.select("node").distinct())
    # the largest set that a set can be linked with: 100 * shared >= SIMILAR * (n + m - shared)
    most = F.floor((100 + SIMILAR) * F.col("shared") / SIMILAR) - F.col("n")
    able = sets.filter(100 * F.col("shared") >= SIMILAR * F.col("n")).select("node", "n", most.alias("most"))
    degree = stage(members.groupBy("node").agg(F.sum("size").alias("degree")).join(able, "node"), "near-degrees")
    members = members.drop("size").join(degree, "node")
    # round 1: every bucket against its centre
    centre = members.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("node")).alias("minus"), "n", "most")).alias("top"))
    pairs = members.join(centre, "bucket").select(F.col("node").alias("a"), "n", "most", (-F.col("top.minus")).alias("b"), F.col("top.n").alias("m"), F.col("top.most").alias("bmost"))
    # sizes alone rule out pairs that can't be similar enough
    fits = (100 * F.least("n", "m") >= SIMILAR * F.greatest("n", "m")) & (F.col("m") <= F.col("most")) & (F.col("n") <= F.col("bmost"))
    star = stage(verify(pairs.filter(fits & (F.col("a") != F.col("b"))).select("a", "b").distinct(), sets), "near-links")
    label = components(star, "near")
    # round 2: what is not in the largest component of its bucket against the whole bucket
    rows = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = rows.groupBy("bucket").agg(F.min("n").alias("least"))
    rows = rows.join(least, "bucket").filter("most >= least").select("bucket", "node", "label")
    main = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(
        F.max(F.struct("c", (-F.col("label")).alias("minus"))).alias("top"), F.count(F.lit(1)).alias("labels"))
    main = main.filter("labels > 1").select("bucket", (-F.col("top.minus")).alias("main"))
    rows = stage(rows.join(main, "bucket").select("main", "node", "label").distinct(), "near-open")
    rest = stage(against(rows.filter("label <> main"), rows, sets), "near-rest")
    return components(star.union(rest), "near") if not rest.isEmpty() else label


def _packed(rows: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """``main, <name>``: the sets of ``rows(main, node, label)`` in chunks of about CHUNK_SETS (a struct of packed
    nodes, labels, sizes and shingles)."""
    parts = rows.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / CHUNK_SETS).alias("parts"))
    chunk = F.pmod(F.xxhash64("node"), F.col("parts")).alias("chunk")
    dealt = rows.join(parts, "main").select("main", "node", "label", chunk).join(sets.select("node", "shingles"), "node")

    def pack(t: pa.Table) -> pa.Table:
        h = [unsqueeze(x.as_py(), np.uint64) for x in t.column("shingles")]
        cols = [t.column("node").to_numpy(), t.column("label").to_numpy(), np.array([len(x) for x in h], np.int64), np.concatenate(h)]
        return pa.table({"main": t.column("main").slice(0, 1), **{f"{name}{i}": pa.array([squeeze(c)], pa.binary()) for i, c in enumerate(cols)}})

    return dealt.groupBy("main", "chunk").applyInArrow(pack, "main long" + "".join(f", {name}{i} binary" for i in range(4)))


def against(queries: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` of the ``queries(main, node, label)`` with the ``rows`` of the same ``main``, compared chunk by
    chunk through the queries' inverted index; for each query one link to every component that it meets in a chunk."""
    both = _packed(queries, sets, "q").join(_packed(rows, sets, "t"), "main")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                q, ql, qn, qh, t, tl, tn, th = (unsqueeze(batch.column(f"{c}{i}")[k].as_py(), d) for c in "qt" for i, d in enumerate((np.int64, np.int64, np.int64, np.uint64)))
                owner = np.repeat(np.arange(len(q)), qn)
                order, new = group_order(qh)
                u, first, owner = qh[order[new]], np.append(np.flatnonzero(new), len(qh)), owner[order]
                end = np.cumsum(tn)
                found: dict[tuple[int, int], int] = {}
                for j in range(len(t)):
                    x = th[end[j] - tn[j]:end[j]]
                    at = np.minimum(np.searchsorted(u, x), len(u) - 1)
                    at = at[u[at] == x]
                    n = first[at + 1] - first[at]
                    hit = owner[np.repeat(first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(at) else owner[:0]
                    same = np.bincount(hit, minlength=len(q))
                    for i in np.flatnonzero((100 * same >= SIMILAR * (qn + tn[j] - same)) & (ql != tl[j])).tolist():
                        found.setdefault((int(q[i]), int(tl[j])), int(t[j]))
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array(list(found.values()), pa.int64())], ["a", "b"])

    return both.mapInArrow(frugal(run), "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the smallest id it reaches over links, itself
    included) and ``kept`` (it has that id)."""
    rows = stage(sketches(docs), "near-sketches")
    key = ["fp1", "fp2", "n_shingles"]
    classes = rows.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    label = linked(docs, classes.filter("node is not null").select("node", F.col("n_shingles").alias("n"), "bands"))
    named = classes.drop("bands").join(label, "node", "left").select(*key, F.coalesce("label", "node").alias("component"))
    out = rows.drop("bands").join(named, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """Pipeline stage: ``docs`` without the documents that another one of their component stands for; one of repeated
    rows stays."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id"))).dropDuplicates(["doc_id", "text"]).select("row.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
