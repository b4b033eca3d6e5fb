"""Operator 6 — removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers parse the texts into phrases (``repeats.py``).  Equal phrases collapse into a *dictionary* of
distinct ones with the smallest document of each, so highly repetitive text is looked at once.  What is left is to
bring the suffixes of the dictionary phrases, each cut to the first ``L`` bytes, into one order for the whole
corpus: every bucket sorts the suffixes dealt to it, equal ones end up side by side, and the smallest document
that starts one of them decides for all.  A byte is removed if it is covered by an ``L``-byte string that also starts
in a document with a smaller id.

The order is by fingerprints of the suffixes instead of their bytes: only equal neighbours matter here, and bytes
would be four times as much to shuffle.

Edge cases: a null text is empty; matches never cross documents; documents with the same id (repeated rows) don't
remove each other's bytes; null ids count as larger than all others; texts shorter than ``L`` bytes stay; a very long
text is a block of its own; an empty table gives an empty result; other columns are ignored by ``remove_repeats``
and kept by ``dedup``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.blocks import NO_ID, Block, unpack_rows
from starmetrics.llm.common import SPACES, frugal, table
from starmetrics.llm.repeats import candidates, covered, per_block, replay, resolve, runs

_SCHEMA = "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(ids, kept, sizes, spans, rest: bytes | None) -> pa.RecordBatch:
    cols = [pa.array([None if i == NO_ID else i for i in ids], pa.int64()), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS)]
    return pa.RecordBatch.from_arrays([*cols, *([unpack_rows(rest)] if rest else [])], ["doc_id", "kept", "n_bytes", "spans", *(["row"] if rest else [])])


def remove_repeats(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``kept`` (the bytes left), ``n_bytes`` (before) and ``spans`` (maximal removed
    runs as byte offsets); with ``carry``, a struct of columns of ``docs``, also ``row``."""
    clean, cand = candidates(docs, False, "bytes", carry)
    found = resolve(cand, False, "bytes")
    schema = _SCHEMA if carry is None else f"{_SCHEMA}, row {docs.select(carry.alias('row')).schema[0].dataType.simpleString()}"

    def whole(row):
        block = Block(row["ids"], row["ends"], row["data"])
        return _batch(block.ids.tolist(), [block.text(k) for k in range(len(block.ids))], (block.ends - block.starts).tolist(), [[]] * len(block.ids), row["rest"])

    def cut(row):
        c, start, end, _, _ = replay(row, False)
        block = c.block
        mask = covered(c.seq, start, end)
        a, z = runs(c.seq, mask)
        doc = np.searchsorted(block.ends, a, side="right")
        lo, hi = np.searchsorted(doc, np.arange(len(block.ids)), "left"), np.searchsorted(doc, np.arange(len(block.ids)), "right")
        kept, spans = [], []
        for k, (s, e) in enumerate(zip(block.starts.tolist(), block.ends.tolist())):
            own = slice(lo[k], hi[k])
            spans.append([{"start": x - s, "end": y - s} for x, y in zip(a[own].tolist(), z[own].tolist())])
            kept.append(block.data[s:e][~mask[s:e]].tobytes())
        return _batch(block.ids.tolist(), kept, (block.ends - block.starts).tolist(), spans, row["rest"])

    return per_block(clean, whole, schema).unionByName(per_block(found, cut, schema))


def dedup(docs: DataFrame) -> DataFrame:
    """Pipeline stage: ``docs`` with the repeated bytes removed from the text; bytes of characters that a cut has split
    are dropped, and so are documents of which nothing but white space is left."""
    same = [c for c in docs.columns if c not in ("text", "n_chars")]
    rows = remove_repeats(docs, F.struct(*same, F.col("text").isNull().alias("_null")))
    schema = docs.select(F.struct(*same, F.lit(True).alias("_null")).alias("row"), F.col("text")).schema

    def decode(batches):
        for b in batches:
            # a whole text is valid UTF-8; a cut one may start or end inside a character
            text = [k.decode("utf-8", "ignore") for k in b.column("kept").to_pylist()]
            keep = [not n or bool(t.strip(SPACES)) for n, t in zip(b.column("cut").to_pylist(), text)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(text, pa.string())], ["row", "text"]).filter(pa.array(keep, pa.bool_()))

    out = rows.select("row", "kept", (F.size("spans") > 0).alias("cut")).mapInArrow(frugal(decode), schema)
    text = F.when(~F.col("row._null"), F.col("text"))
    cols = {**{c: F.col("row")[c] for c in same}, "text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[cols[c].alias(c) for c in docs.columns])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
