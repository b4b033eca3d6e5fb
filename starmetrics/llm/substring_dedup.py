"""Operator 2 — removal of repeated word passages by suffix automata.

A word goes if it lies in ``L`` consecutive words of a document that also stand in a document with a smaller id.

The reference of a document is all documents before it, so it grows with the corpus: its automata can't be broadcast
with a proven bound, and streaming every document through every shard would take quadratic time.  Instead the windows
are first traced to the earliest document that holds them (``repeats.py``).  The passages that a document lends to
later ones are its *reference shard*; it is joined with the passages of later documents that point to it (one row per
lender and block, an equi-join whose hot keys Spark can split).  A task builds the suffix automaton of a shard, streams
those passages through it for their matching statistics, and reports the maximal spans that match at least ``L``
words.  The automaton compares real words, so it also rules out hash collisions.

Edge cases: a null text has no words; windows never cross documents; documents with the same id (repeated rows) don't
remove each other's words; null ids count as larger than all others; documents of fewer than ``L`` words stay; a very
long text is a block of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.blocks import NO_ID, Block, squeeze, unsqueeze
from starmetrics.llm.common import stage, table
from starmetrics.llm.repeats import L, Sequence, _out, candidates, covered, per_block, replay, resolve, runs

#: Words in the automata that a task keeps.
HELD_WORDS = 400_000


class SuffixAutomaton:
    """Of several passages (lists of words); no match crosses from one to the next."""

    def __init__(self, passages: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for k, words in enumerate(passages):
            for w in words:
                last = self._add(last, w)
            last = self._add(last, k)  # a separator: no word is a number
        self.words = sum(map(len, passages))

    def _add(self, last: int, w) -> int:
        nxt, link, length = self.next, self.link, self.length
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        return cur

    def spans(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans of ``words`` made of matches of at least ``least`` words, from the matching statistics."""
        nxt, link, length = self.next, self.link, self.length
        out: list[list[int]] = []
        at, n = 0, 0
        for i, w in enumerate(words):
            to = nxt[at].get(w)
            while to is None and at:
                at = link[at]
                n = length[at]
                to = nxt[at].get(w)
            if to is None:
                n = 0
                continue
            at, n = to, n + 1
            if n >= least:
                a = i + 1 - n
                if out and a <= out[-1][1]:
                    out[-1][0], out[-1][1] = min(a, out[-1][0]), i + 1
                else:
                    out.append([a, i + 1])
        return [(a, b) for a, b in out]


def _passage(seq: Sequence, a: int, b: int) -> bytes:
    return seq.block.data[seq.word_from[a]:seq.word_to[b - 1]].tobytes()


def _runs_by(seq: Sequence, start: np.ndarray, end: np.ndarray, who: np.ndarray):
    """(who, starts, ends): the given runs, joined where they touch, for each value of ``who``."""
    order = np.lexsort((start, who))
    start, end, who = start[order], end[order], who[order]
    cut = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.empty(0, int)
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(who)]):
        a, b = start[lo:hi], np.maximum.accumulate(end[lo:hi])
        doc = np.searchsorted(seq.ends, a, side="right")
        new = np.concatenate([[True], (a[1:] > b[:-1]) | (doc[1:] != doc[:-1])])
        yield who[lo], a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]


_LIST = pa.list_(pa.binary())


def passages(found: DataFrame) -> DataFrame:
    """``lent, owner, block, starts, texts``: what a document lends, and what documents of a block have from it."""
    names = ["lent", "owner", "block", "starts", "texts"]
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), _LIST]

    def lend(row):
        c, start, end, owner, (s, e) = replay(row, True)
        seq, rows = c.seq, []
        for who, a, z in _runs_by(seq, start, end, owner):
            rows.append((False, int(who), row["block"], squeeze(a), [_passage(seq, x, y) for x, y in zip(a.tolist(), z.tolist())]))
        doc = np.searchsorted(seq.ends, s, side="right")
        for who, a, z in _runs_by(seq, s, e, doc):
            i = int(c.block.ids[who])
            rows.append((True, i, row["block"], squeeze(a), [_passage(seq, x, y) for x, y in zip(a.tolist(), z.tolist())]))
        return _out(names, kinds, rows)

    return per_block(found, lend, "lent boolean, owner long, block long, starts binary, texts array<binary>")


def match(parts: DataFrame) -> DataFrame:
    """``block, start, end``: spans of at least ``L`` words that the lender's automaton matches."""
    lent = parts.filter("lent").select(F.col("owner").alias("lender"), F.col("texts").alias("reference"))
    # repeated rows of one id lend the same text
    lent = lent.groupBy("lender").agg(F.array_distinct(F.flatten(F.collect_list("reference"))).alias("reference"))
    both = parts.filter("not lent").join(lent, F.col("owner") == F.col("lender")).select("owner", "block", "starts", "texts", "reference")

    def run(batches):
        held: OrderedDict[int, SuffixAutomaton] = OrderedDict()
        size = 0
        for b in batches:
            blocks, at, to = [], [], []
            for k in range(b.num_rows):
                owner = b.column("owner")[k].as_py()
                auto = held.get(owner)
                if auto is None:
                    auto = held[owner] = SuffixAutomaton([t.split() for t in b.column("reference")[k].as_py()])
                    size += auto.words
                    while size > HELD_WORDS and len(held) > 1:
                        size -= held.popitem(last=False)[1].words
                block = b.column("block")[k].as_py()
                for s, t in zip(unsqueeze(b.column("starts")[k].as_py(), np.int64).tolist(), b.column("texts")[k].as_py()):
                    for x, y in auto.spans(t.split(), L):
                        blocks.append(block), at.append(s + x), to.append(s + y)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(at, pa.int64()), pa.array(to, pa.int64())], ["block", "start", "end"])

    return both.mapInArrow(run, "block long, start long, end long")


_SCHEMA = "doc_id long, kept string, n_words long, spans array<struct<start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(ids, kept, sizes, spans) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([None if i == NO_ID else i for i in ids], pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS)],
        ["doc_id", "kept", "n_words", "spans"])


def remove_passages(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``kept`` (the words left, joined by one space), ``n_words`` (before) and
    ``spans`` (maximal removed runs as word offsets)."""
    clean, cand = candidates(docs, True, "words")
    found = resolve(cand, True, "words")
    parts = stage(passages(found), "words-passages")
    spans = match(parts).groupBy("block").agg(F.collect_list("start").alias("a"), F.collect_list("end").alias("z"))
    final = cand.select("block", "ids", "ends", "data").join(spans, "block", "left")

    def whole(row):
        block = Block(row["ids"], row["ends"], row["data"])
        words = [block.text(k).split() for k in range(len(block.ids))]
        return _batch(block.ids.tolist(), [b" ".join(w) for w in words], list(map(len, words)), [[]] * len(words))

    def cut(row):
        block = Block(row["ids"], row["ends"], row["data"])
        seq = Sequence(block, True, second=False)
        mask = covered(seq, np.array(row["a"] or [], np.int64), np.array(row["z"] or [], np.int64))
        a, z = runs(seq, mask)
        doc = np.searchsorted(seq.ends, a, side="right")
        every = np.arange(len(block.ids))
        lo, hi = np.searchsorted(doc, every, "left"), np.searchsorted(doc, every, "right")
        kept, sizes, spans = [], [], []
        for k, (s, e) in enumerate(zip(seq.starts.tolist(), seq.ends.tolist())):
            words, own = block.text(k).split(), slice(lo[k], hi[k])
            sizes.append(len(words))
            spans.append([{"start": x - s, "end": y - s} for x, y in zip(a[own].tolist(), z[own].tolist())])
            kept.append(b" ".join(compress(words, (~mask[s:e]).tolist())))
        return _batch(block.ids.tolist(), kept, sizes, spans)

    return per_block(clean, whole, _SCHEMA).unionByName(per_block(final, cut, _SCHEMA))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def sql() -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p+{L - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {L - 2})) AS p FROM d WHERE len(w) >= {L})
), m AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS first FROM s) WHERE first < doc_id
), g AS (
  SELECT doc_id, p, coalesce(max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {L}, 0) AS done FROM m
), r AS (
  SELECT doc_id, sum(p + {L} - greatest(p, done))::BIGINT AS n_removed FROM g GROUP BY doc_id
), u AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + {L})) AS i FROM m
), k AS (
  SELECT d.doc_id, string_agg(t.v, ' ' ORDER BY t.i) AS kept
  FROM (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM d) t JOIN d USING (doc_id) LEFT JOIN u ON u.doc_id = t.doc_id AND u.i = t.i
  WHERE u.i IS NULL GROUP BY d.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""
