"""Windows of ``L`` symbols (bytes or words) that repeat between documents — the search shared by operators 2 and 6.

Rolling-hash triggers cut each document into phrases.  A trigger is the smallest hash of the ``GRAM``-symbol strings
in some window, so every window holds a trigger and equal windows hold the same one.  Four questions between blocks
(``blocks.py``), each on less than the one before:

1. triggers: which trigger strings occur more than once in the corpus?  Windows without such a trigger are unique;
   documents without another window are done.
2. phrases: which extended phrases (from one mark to the next and ``L - 1`` symbols on; marks are every fourth
   trigger, by hash) also start in a document with a smaller id?  All windows of those repeat.  The first
   occurrences that are left make up the *dictionary* of distinct phrases.
3. and 4. windows of the dictionary: which occur in several phrases, and in a document with a smaller id?

Equality is that of a 96-bit hash (two polynomial hashes over random symbol values); in question 1 and 3 a shorter
key only lets a few unique strings pass on to the next question.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmetrics.llm.blocks import Block, U, answer, buckets_for, group_order, group_sizes, joined, mix, pack, pack_rows, question, squeeze, unpack_rows, unsqueeze, with_answers
from starmetrics.llm.common import SPACES, frugal, stage

L = 50
GRAM = 25
SPAN = L - GRAM + 1
MARK_EVERY = 4

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_RNG = np.random.Generator(np.random.PCG64(50))
_T1 = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_T2 = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_LEN = U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i mod 2**64, for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(r), np.uint64)])) for r in (_R, _R_INV)]
    return _POWERS[0], _POWERS[1]


def prefix_sums(x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x) + 1, np.uint64)
    out[0] = 0
    np.cumsum(x * powers(len(x) + 1)[0][: len(x)], out=out[1:])
    return out


def window_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of symbols [start, end), the same wherever they stand."""
    inv = powers(len(h))[1]
    return mix((h[end] - h[start]) * inv[start] + (end - start).astype(np.uint64) * _LEN)


class Sequence:
    """Symbols of a block: ``starts``/``ends`` of the documents in symbols, and prefix hashes.

    With words, ``word_from``/``word_to`` are their bytes."""

    def __init__(self, block: Block, words: bool, second: bool = True):
        self.block = block
        data = block.data
        if words:
            h = prefix_sums(_T1[data])
            solid = ~_SPACE[data]
            edge = np.zeros(len(data) + 1, bool)  # a document starts here
            edge[block.starts] = True
            edge[len(data)] = True
            before = np.concatenate([[False], solid[:-1]]) & ~edge[:-1]
            after = np.concatenate([solid[1:], [False]]) & ~edge[1:]
            self.word_from = np.flatnonzero(solid & ~before)
            self.word_to = np.flatnonzero(solid & ~after) + 1
            self.hash = window_hash(h, self.word_from, self.word_to)
            x1, x2 = self.hash, mix(self.hash ^ _LEN) if second else None
            self.starts = np.searchsorted(self.word_from, block.starts)
            self.ends = np.searchsorted(self.word_from, block.ends)
        else:
            x1, x2 = _T1[data], _T2[data] if second else None
            self.starts, self.ends = block.starts, block.ends
        self.n = len(x1)
        self.h1 = prefix_sums(x1)
        self.h2 = prefix_sums(x2) if second else None

    def window_starts(self) -> np.ndarray:
        """Mask over symbols: L symbols of one document start here."""
        left = np.repeat(self.ends, self.ends - self.starts) - np.arange(self.n)
        return left >= L

    def triggers(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the trigger strings."""
        n = self.n
        if n < L:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        g = mix((self.h1[GRAM:] - self.h1[:-GRAM]) * powers(n + 1)[1][: n - GRAM + 1])
        low = _slide(g, SPAN, np.minimum)
        low[~self.window_starts()[: len(low)]] = 0
        pad = np.zeros(len(low) + 2 * (SPAN - 1), np.uint64)
        pad[SPAN - 1: SPAN - 1 + len(low)] = low
        at = np.flatnonzero(_slide(pad, SPAN, np.maximum) == g)
        return at, g[at]


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every run of ``width`` values."""
    done, out = 1, x.copy()
    while 2 * done <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return op(out[:-rest], out[rest:]) if rest else out


def _distinct(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of equal (h1, h2), in ascending order of h1: one entry, the smallest id, the group of each entry, the sizes."""
    order, new = group_order(h1, h2)
    at = np.flatnonzero(new)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], at) if len(at) else ids[:0]
    return order[at], least, group, group_sizes(new)


# ---------------------------------------------------------------- what buckets answer
def more_than_once(cols: list[np.ndarray]) -> list[np.ndarray]:
    key = np.sort((cols[0].astype(np.uint64) << U(32)) | np.arange(len(cols[0]), dtype=np.uint64))
    order, top = (key & U(0xFFFFFFFF)).astype(np.int64), key >> U(32)
    twice = top[1:] == top[:-1]
    out = np.zeros(len(key), np.uint8)
    out[order[1:][twice]] = 1
    out[order[:-1][twice]] = 1
    return [out]


def earliest(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Per entry: 2 if a smaller id has the key, 1 if only larger ones do, else 0; and the smallest id (0 unless 2)."""
    h1, h2, ids = cols
    _, least, group, size = _distinct(h1, h2, ids)
    least = least[group]
    code = np.where(ids > least, 2, np.where(size[group] > 1, 1, 0)).astype(np.uint8)
    return [code, np.where(code == 2, least, 0)]


# ---------------------------------------------------------------- passes over blocks
class Candidates:
    """A block of candidate documents: which windows may repeat, and the phrases that hold such windows."""

    def __init__(self, row: dict, words: bool):
        self.block = Block(row["ids"], row["ends"], row["data"])
        self.seq = s = Sequence(self.block, words)
        shared, marks = unsqueeze(row["shared"], np.int32), unsqueeze(row["marks"], np.int32)
        may = _near(s, shared)
        if not len(s.starts) or not may.any():
            cut = np.empty(0, np.int64)
        else:
            cut = np.unique(np.concatenate([s.starts[s.ends > s.starts], marks]))
        doc = np.searchsorted(s.ends, cut, side="right")
        stop = np.minimum(np.append(cut[1:], s.n), s.ends[doc] - L + 1) if len(cut) else cut
        seen = np.concatenate([[0], np.cumsum(may)])
        good = (stop > cut) & (seen[np.maximum(stop, cut)] > seen[cut])
        self.may = may
        self.start, self.stop, self.doc = cut[good], stop[good], doc[good]  # windows start in [start, stop)
        self.end = self.stop + L - 1
        self.id = self.block.ids[self.doc]
        self.h1 = window_hash(s.h1, self.start, self.end)
        self.h2 = window_hash(s.h2, self.start, self.end).astype(np.uint32)
        self.first, self.least, self.group, self.size = _distinct(self.h1, self.h2, self.id)

    def phrases_answered(self, code: np.ndarray, owner: np.ndarray) -> None:
        """Settles the phrases that start in a smaller document; the windows of the others are asked about."""
        self.owner = np.where(code == 2, owner, self.least)[self.group]
        self.settled = (self.id > self.least[self.group]) | (code == 2)[self.group]
        self.held_by_others = (~self.settled) & ((code == 1) | (self.size > 1))[self.group]
        open_ = ~self.settled
        size = (self.stop - self.start)[open_]
        at = np.repeat(self.start[open_] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if open_.any() else np.empty(0, np.int64)
        ids = np.repeat(self.id[open_], size)
        keep = self.may[at]
        self.at, self.at_id = at[keep], ids[keep]
        s = self.seq
        self.w1 = window_hash(s.h1, self.at, self.at + L)
        self.w2 = window_hash(s.h2, self.at, self.at + L).astype(np.uint32)
        self.w_first, self.w_least, self.w_group, self.w_size = _distinct(self.w1, self.w2, self.at_id)

    def windows_flagged(self, flags: np.ndarray) -> None:
        """Which distinct windows to ask about in full."""
        self.asked = np.flatnonzero((flags > 0) | (self.w_size > 1))

    def windows_answered(self, code: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Repeated runs as (start, end, owner) of symbols, and the runs that others repeat as their starts and ends."""
        full = np.zeros(len(self.w_first), np.uint8)
        who = np.zeros(len(self.w_first), np.int64)
        full[self.asked], who[self.asked] = code, owner
        by = np.where(full == 2, who, self.w_least)[self.w_group]
        hit = (self.at_id > self.w_least[self.w_group]) | (full == 2)[self.w_group]
        lent = ~hit & ((full == 1) | (self.w_size > 1))[self.w_group]
        rep = (np.concatenate([self.start[self.settled], self.at[hit]]), np.concatenate([self.end[self.settled], self.at[hit] + L]),
               np.concatenate([self.owner[self.settled], by[hit]]))
        src = (np.concatenate([self.start[self.held_by_others], self.at[lent]]), np.concatenate([self.end[self.held_by_others], self.at[lent] + L]))
        return (*rep, src)


def _near(s: Sequence, shared: np.ndarray) -> np.ndarray:
    """Mask over symbols: a window starts here and holds a shared trigger."""
    mark = np.zeros(s.n + SPAN + 1, np.int32)
    mark[shared + 1] = 1
    seen = np.cumsum(mark)
    return s.window_starts() & (seen[SPAN: SPAN + s.n] > seen[: s.n])


def covered(seq: Sequence, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask over symbols: inside one of the runs."""
    edge = np.zeros(seq.n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge)[:-1] > 0


def runs(seq: Sequence, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the mask inside documents."""
    first = np.zeros(seq.n + 1, bool)
    first[seq.starts] = True
    last = np.zeros(seq.n + 1, bool)
    last[seq.ends] = True
    start = np.flatnonzero(mask & (first[:-1] | ~np.concatenate([[False], mask[:-1]])))
    end = np.flatnonzero(mask & (last[1:] | ~np.concatenate([mask[1:], [False]]))) + 1
    return start, end


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}


def _out(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names)


def per_block(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row)`` gives a record batch for each block; what it works with is free again before the next block."""
    def run(batches):
        for b in batches:
            for row in _rows(b):
                out = fn(row)
                if out.num_rows:
                    yield out

    return df.mapInArrow(frugal(run), schema)


def _ask(df: DataFrame, fn, columns: int) -> DataFrame:
    """Questions of every block."""
    return per_block(df, fn, "bucket int, block long, n long" + "".join(f", c{i} binary" for i in range(columns)))


def candidates(docs: DataFrame, words: bool, name: str, carry: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, cand): blocks ``block, ids, ends, data, rest`` of the documents without any repeated window, and of the
    others with ``shared`` and ``marks`` (positions of repeated triggers and of marks, in symbols of the block)."""
    blocks = pack(docs, name + "-blocks", carry=carry)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = buckets_for(total * 2 // (SPAN + 1) // (6 if words else 1))

    def ask(row):
        _, key = Sequence(Block(row["ids"], row["ends"], row["data"]), words, second=False).triggers()
        u = np.unique(key)
        return question(row["block"], u, [u.astype(np.uint32)], buckets)

    flags = answer(_ask(blocks, ask, 1), buckets, [np.uint32], more_than_once)
    both = with_answers(blocks, flags)

    def split(row):
        block = Block(row["ids"], row["ends"], row["data"])
        s = Sequence(block, words, second=False)
        at, key = s.triggers()
        order, new = group_order(key)
        twice = (joined(row["a0"], np.uint8) > 0) | (group_sizes(new) > 1)
        shared = at[order[np.repeat(twice, group_sizes(new))]]
        may = np.concatenate([[0], np.cumsum(_near(s, shared))])
        dirty = may[s.ends] > may[s.starts]
        rest = unpack_rows(row["rest"]) if row["rest"] else None
        marks = at[mix(key ^ _LEN) % U(MARK_EVERY) == 0]
        size = s.ends - s.starts
        rows = []
        for part, pick in ((False, np.flatnonzero(~dirty)), (True, np.flatnonzero(dirty))):
            if not len(pick):
                continue
            ends = np.cumsum((block.ends - block.starts)[pick])
            data = b"".join(block.text(k) for k in pick.tolist())
            pos = []
            if part:  # positions in the new block
                shift = np.concatenate([[0], np.cumsum(size[pick])[:-1]]) - s.starts[pick]
                new = np.zeros(len(size), np.int64)
                new[pick] = shift
                for p in (shared, marks):
                    d = np.searchsorted(s.ends, p, side="right")
                    ok = dirty[d]
                    pos.append(squeeze((p + new[d])[ok].astype(np.int32)))
            rows.append((row["block"], part, squeeze(block.ids[pick]), squeeze(ends), squeeze(data, 5),
                         pack_rows(rest.take(pa.array(pick))) if rest is not None else None, *(pos or [None, None])))
        return _out(["block", "dirty", "ids", "ends", "data", "rest", "shared", "marks"], [pa.int64(), pa.bool_(), *[pa.binary()] * 6], rows)

    parts = stage(per_block(both.select("block", "ids", "ends", "data", "rest", "a0"), split, "block long, dirty boolean, ids binary, ends binary, data binary, rest binary, shared binary, marks binary"), name + "-split")
    return parts.filter("not dirty").select("block", "ids", "ends", "data", "rest"), parts.filter("dirty").drop("dirty")


def resolve(cand: DataFrame, words: bool, name: str) -> DataFrame:
    """``cand`` with the answers ``e0, e1`` (phrases), ``f0`` (window flags) and ``w0, w1`` (windows); ``replay`` turns
    a row of it into runs."""
    size = cand.agg(F.sum(F.length("data")), F.count(F.lit(1))).first()
    est = (size[0] or 0) * 4 // (6 if words else 1)
    # first occurrences are a small part of the candidates, and windows that several of them hold a smaller one
    eb, fb, wb = buckets_for(est // (SPAN // 2) // MARK_EVERY), buckets_for(est // 5), buckets_for(est // 15)

    def ask_phrases(row):
        c = Candidates(row, words)
        f = c.first
        return question(row["block"], c.h1[f], [c.h1[f], c.h2[f], c.least], eb)

    e = stage(answer(_ask(cand, ask_phrases, 3), eb, [np.uint64, np.uint32, np.int64], earliest, 2), name + "-phrases")
    two = with_answers(cand, e, 2).withColumnsRenamed({"a0": "e0", "a1": "e1"})

    def ask_flags(row):
        c = Candidates(row, words)
        c.phrases_answered(joined(row["e0"], np.uint8), joined(row["e1"], np.int64))
        k = c.w1[c.w_first]
        return question(row["block"], k, [k.astype(np.uint32)], fb)

    f = stage(answer(_ask(two, ask_flags, 1), fb, [np.uint32], more_than_once), name + "-flags")
    three = with_answers(two, f).withColumnRenamed("a0", "f0")

    def ask_windows(row):
        c = Candidates(row, words)
        c.phrases_answered(joined(row["e0"], np.uint8), joined(row["e1"], np.int64))
        c.windows_flagged(joined(row["f0"], np.uint8))
        p = c.w_first[c.asked]
        return question(row["block"], c.w1[p], [c.w1[p], c.w2[p], c.w_least[c.asked]], wb)

    w = stage(answer(_ask(three, ask_windows, 3), wb, [np.uint64, np.uint32, np.int64], earliest, 2), name + "-windows")
    return with_answers(three, w, 2).withColumnsRenamed({"a0": "w0", "a1": "w1"})


def replay(row: dict, words: bool):
    """(candidates, starts, ends, owners, (starts, ends) of runs that later documents repeat) of one resolved row."""
    c = Candidates(row, words)
    c.phrases_answered(joined(row["e0"], np.uint8), joined(row["e1"], np.int64))
    c.windows_flagged(joined(row["f0"], np.uint8))
    return c, *c.windows_answered(joined(row["w0"], np.uint8), joined(row["w1"], np.int64))
