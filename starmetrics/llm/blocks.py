"""Blocks of documents, and questions between blocks.

Repeats between documents need every document compared with every other.  Here the corpus is cut into *blocks* of
some megabytes; a block asks about keys (hashes of windows of its texts) and gets an answer for each of them.  Keys
are dealt to *buckets* by value.  A block sends each key once, however often it holds it, so a key that a third of
the corpus shares costs one entry a block; a bucket sorts its entries and sends one answer string back to each
block.  All of it travels packed: a row holds the keys of one block for one bucket.

The number of buckets follows the number of keys, so the memory of a task stays the same at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmetrics.llm.common import frugal, release, stage

#: Bytes of text in a block (a longer document is a block of its own).
BLOCK_BYTES = 1 << 19
#: Keys that a bucket sorts at once, about.
BUCKET_KEYS = 750_000
#: Stands for a null doc_id: later than all others.
NO_ID = np.iinfo(np.int64).max

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def group_order(h1: np.ndarray, h2: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order ascending in h1 that puts equal (h1, h2) side by side, and where each group starts (a mask).

    Sorts plain numbers (the high bits of h1 and the position), which is several times faster than an argsort; runs
    of equal high bits that hold different keys are sorted again."""
    n = len(h1)
    low = U((1 << max(1, (n - 1).bit_length())) - 1)
    key = np.sort((h1 & ~low) | np.arange(n, dtype=np.uint64))
    order = (key & low).astype(np.int64)

    def borders():
        a = h1[order]
        d = a[1:] != a[:-1]
        if h2 is not None:
            b = h2[order]
            d |= b[1:] != b[:-1]
        return d

    differ = borders()
    same = (key[1:] & ~low) == (key[:-1] & ~low)
    clash = differ & same
    if clash.any():
        run = np.concatenate([[0], np.cumsum(~same)])
        at = np.flatnonzero(np.isin(run, run[1:][clash]))
        sub = order[at]
        order[at] = sub[np.lexsort((h2[sub] if h2 is not None else sub, h1[sub], run[at]))]
        differ = borders()
    return order, np.concatenate([[True], differ]) if n else np.zeros(0, bool)


def group_sizes(new: np.ndarray) -> np.ndarray:
    return np.diff(np.append(np.flatnonzero(new), len(new)))


def squeeze(a: np.ndarray | bytes, level: int = 1) -> bytes:
    """Compressed bytes with their length in front.  Numbers are stored byte plane by byte plane: the high bytes of
    sorted keys and of small numbers then take next to no room."""
    if isinstance(a, bytes):
        raw = a
    else:
        raw = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", level).compress(raw, asbytes=True)


def unsqueeze(b: bytes, dtype=np.uint8) -> np.ndarray:
    n, size = int.from_bytes(b[:8], "little"), np.dtype(dtype).itemsize
    raw = pa.decompress(b[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""
    flat = np.frombuffer(raw, np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).reshape(-1).view(dtype) if size > 1 else flat.view(dtype)


def pack_rows(rows: pa.StructArray) -> bytes:
    batch = pa.RecordBatch.from_struct_array(rows)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack_rows(b: bytes) -> pa.StructArray:
    return pa.ipc.open_stream(b).read_next_batch().to_struct_array()


def pack(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
         carry: Column | None = None) -> DataFrame:
    """``block, ids, ends, data, size, rest``: the documents' ids (int64), the ends of their texts, and the texts as UTF-8
    (null: empty), compressed; written once, so that every later question is about the same blocks.  ``carry``: a
    struct of other columns that travels along in ``rest`` (else null)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"), *([carry.alias("r")] if carry is not None else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        texts: list[bytes] = []
        size, lens = 0, []
        rest: list[pa.StructArray] = []

        def flush():
            nonlocal seq, size
            row = [[(part << 32) + seq], [squeeze(np.concatenate(ids))], [squeeze(np.cumsum(lens))], [squeeze(b"".join(texts), 5)], [size], [pack_rows(pa.concat_arrays(rest)) if rest else None]]
            seq, size = seq + 1, 0
            ids.clear(), texts.clear(), lens.clear(), rest.clear()
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], ["block", "ids", "ends", "data", "size", "rest"])

        for b in batches:
            i = b.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
            t = b.column(1).cast(pa.large_string())
            off = np.frombuffer(t.buffers()[1], np.int64)[t.offset: t.offset + len(t) + 1]
            raw = t.buffers()[2] or pa.py_buffer(b"")
            lo = 0
            while lo < len(i):  # as many documents as fit, one at least
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + block_bytes - size, side="right")) - 1)
                hi = min(hi, len(i))
                ids.append(i[lo:hi])
                lens.extend(np.diff(off[lo:hi + 1]).tolist())
                texts.append(raw[int(off[lo]):int(off[hi])].to_pybytes())
                if b.num_columns > 2:
                    rest.append(b.column(2).slice(lo, hi - lo))
                size += int(off[hi] - off[lo])
                lo = hi
                if size >= block_bytes * 3 // 4:
                    yield flush()
        if ids:
            yield flush()

    return stage(docs.mapInArrow(frugal(run), "block long, ids binary, ends binary, data binary, size long, rest binary"), name)


class Block:
    """One row of ``pack``: ``ids``, ``starts`` and ``ends`` (bytes) of the documents, and ``data``."""

    def __init__(self, ids: bytes, ends: bytes, data: bytes):
        self.ids = unsqueeze(ids, np.int64)
        self.ends = unsqueeze(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.data = unsqueeze(data)

    def text(self, k: int) -> bytes:
        return self.data[self.starts[k]:self.ends[k]].tobytes()


def buckets_for(keys: int) -> int:
    return max(1, -(-keys // BUCKET_KEYS))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the top 32 bits: sorted keys lie in ascending buckets."""
    return ((keys >> U(32)) * U(buckets)) >> U(32)


def question(block: int, keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Rows ``bucket, block, n, c0, c1, ...``: the columns for the sorted ``keys``, cut by bucket."""
    cut = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    own = np.flatnonzero(np.diff(cut))
    parts = [[squeeze(c[cut[b]:cut[b + 1]]) for b in own] for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int32()), pa.array([block] * len(own), pa.int64()), pa.array(np.diff(cut)[own], pa.int64()), *[pa.array(p, pa.binary()) for p in parts]],
        ["bucket", "block", "n", *[f"c{i}" for i in range(len(columns))]])


def answer(questions: DataFrame, buckets: int, dtypes: list, judge: Callable[[list[np.ndarray]], list[np.ndarray]], answers: int = 1) -> DataFrame:
    """``block, bucket, n, a0, ...``: ``judge`` gets the columns of one bucket, of all blocks one after the other, and
    gives as many answer columns of the same length; each block gets its part back."""

    def one(t: pa.Table) -> pa.Table:
        n = t.column("n").to_numpy()
        cols = [np.concatenate([unsqueeze(x.as_py(), d) for x in t.column(f"c{i}")]) for i, d in enumerate(dtypes)]
        out = judge(cols)
        cut = np.concatenate([[0], np.cumsum(n)])
        parts = [pa.array([squeeze(a[cut[k]:cut[k + 1]]) for k in range(len(n))], pa.binary()) for a in out]
        del cols, out
        release()
        return pa.Table.from_arrays([t.column("block"), t.column("bucket"), t.column("n"), *parts], names=["block", "bucket", "n", *[f"a{i}" for i in range(answers)]])

    schema = "block long, bucket int, n long" + "".join(f", a{i} binary" for i in range(answers))
    return questions.groupBy("bucket").applyInArrow(one, schema)


def with_answers(blocks: DataFrame, answers: DataFrame, n: int = 1) -> DataFrame:
    """``blocks`` with ``a0, ...``: the list of its answer parts in order of bucket (null without any)."""
    per = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", *[f"a{i}" for i in range(n)]))).alias("_a"))
    return blocks.join(per, "block", "left").withColumns({f"a{i}": F.col(f"_a.a{i}") for i in range(n)}).drop("_a")


def joined(parts: list[bytes] | None, dtype) -> np.ndarray:
    return np.concatenate([unsqueeze(p, dtype) for p in parts]) if parts else np.empty(0, dtype)
