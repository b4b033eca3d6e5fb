"""Operator 12 — byte-level BPE by monoid tree reduction.

A text is cut into the matches of a pattern, and each match is encoded by itself: adjacent parts whose bytes together
are a token merge, lowest rank first, leftmost first among equals.  Here a match is encoded by halves.  The codes of
the halves form a monoid: two neighbours are joined by encoding the bytes of a window around their border anew, and
the window grows on a side until its outermost token is the old one again.  Tokens beyond it then stay as they are,
because a sequence of tokens is the code of its bytes exactly if every two neighbours are (and inside each half they
were).  Leaves and windows are short, so their merges are found directly; a match of any length takes some
n log n steps, where rescanning all parts for every merge would take n².

Matches repeat a lot, so each task keeps the codes of those it has met (a bounded table, emptied when full).
Decoding concatenates the tokens' bytes up a tree as well: leaves of some thousand ids, then neighbours.

Edge cases: a null text counts as empty and gives no token; special tokens are ordinary text; a match that is a token
is that token; very long texts and matches are one row each; repeated rows are encoded each on its own; an empty table
gives an empty result; other columns are kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmetrics.llm.common import table

#: Codes of matches, and of windows, that a task keeps at once.
CACHE_WORDS = 600_000
CACHE_WINDOWS = 200_000
#: Bytes of a leaf, tokens on each side of a first window, ids of a leaf when decoding.
LEAF = 12
WINDOW = 2
DECODE_LEAF = 1 << 14
_NONE = 1 << 60


class ByteBpe:
    """Ranks of one vocabulary file (a token in base 64 and its rank a line) under one pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.words: dict[str, bytes] = {}
        self.windows: dict[bytes, list[int]] = {}
        self.length = np.zeros(max(self.bytes_of) + 1, np.int64)
        for r, t in self.bytes_of.items():
            self.length[r] = len(t)
        self.offsets = np.concatenate([[0], np.cumsum(self.length)])
        self.blob = np.frombuffer(b"".join([self.bytes_of.get(r, b"") for r in range(len(self.length))]), np.uint8)

    def merges(self, piece: bytes) -> list[int]:
        """The code of a short piece, merge by merge."""
        if len(piece) > 256:
            return self.merges_of_many(piece)
        ranks = self.ranks
        parts = [piece[k:k + 1] for k in range(len(piece))]
        pairs = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == _NONE:
                break
            k = pairs.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], _NONE)
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], _NONE)
        return [ranks[p] for p in parts]

    def merges_of_many(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs (rank, start): for windows that had to grow over all of a long match."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here; end 0: none does

        def pair(k: int) -> tuple[int, int, int] | None:
            m = end[k]
            r = ranks.get(piece[k:end[m]]) if m < n else None
            return None if r is None else (r, k, end[m])

        heap = [p for p in map(pair, range(n)) if p]
        heapq.heapify(heap)
        while heap:
            _, k, stop = heapq.heappop(heap)
            m = end[k]
            if not m or m >= n or end[m] != stop:
                continue  # one of the two has merged since
            end[k], end[m] = stop, 0
            if stop < n:
                before[stop] = k
            for q in (k, before[k]):
                if q >= 0 and (p := pair(q)):
                    heapq.heappush(heap, p)
        out, k = [], 0
        while k < n:
            out.append(ranks[piece[k:end[k]]])
            k = end[k]
        return out

    def window(self, piece: bytes) -> list[int]:
        code = self.windows.get(piece)
        if code is None:
            if len(self.windows) >= CACHE_WINDOWS:
                self.windows.clear()
            code = self.windows[piece] = self.merges(piece) if len(piece) <= 4 * LEAF else self.tree(piece)
        return code

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The code of the bytes of both.  The window takes i tokens of the left code and j of the right one."""
        if not left or not right:
            return left + right
        i, j = min(WINDOW, len(left)), min(WINDOW, len(right))
        while True:
            old = left[len(left) - i:] + right[:j]
            piece = b"".join([self.bytes_of[t] for t in old])
            # a window of everything would be this very join again: its merges are found directly
            new = self.merges(piece) if i == len(left) and j == len(right) else self.window(piece)
            stays_left = i == len(left) or new[0] == old[0]
            stays_right = j == len(right) or new[-1] == old[-1]
            if stays_left and stays_right:
                return left[:len(left) - i] + new + right[j:]
            i = i if stays_left else min(2 * i, len(left))
            j = j if stays_right else min(2 * j, len(right))

    def tree(self, piece: bytes) -> list[int]:
        """Codes of the leaves, then of neighbours joined, level by level."""
        level = [self.window(piece[k:k + LEAF]) for k in range(0, len(piece), LEAF)]
        while len(level) > 1:
            level = [self.join(level[k], level[k + 1]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]

    def encode_match(self, match: str) -> bytes:
        """Ids of one match, little-endian."""
        piece = match.encode()
        whole = self.ranks.get(piece)
        return np.array([whole] if whole is not None else self.tree(piece), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        matches, words = self.split.findall(text), self.words
        new = set(matches).difference(words)
        if len(words) + len(new) > CACHE_WORDS:
            words.clear()
            new = set(matches)
        for m in new:
            words[m] = self.encode_match(m)
        return b"".join([words[m] for m in matches])

    def decode(self, ids: bytes) -> bytes:
        i = np.frombuffer(ids, "<u4")
        level = [self._bytes(i[k:k + DECODE_LEAF]) for k in range(0, len(i), DECODE_LEAF)]
        while len(level) > 1:
            level = [b"".join(level[k:k + 2]) for k in range(0, len(level), 2)]
        return level[0] if level else b""

    def _bytes(self, i: np.ndarray) -> bytes:
        size = self.length[i]
        end = np.cumsum(size)
        return self.blob[np.arange(end[-1]) + np.repeat(self.offsets[i] - end + size, size)].tobytes()


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: What ``encode`` can add to a document.
OUTPUTS = {"n_tokens": (T.LongType(), pa.int64(), lambda ids, back: len(ids) // 4),
           "ids": (T.BinaryType(), pa.binary(), lambda ids, back: ids),
           "decoded": (T.BinaryType(), pa.binary(), lambda ids, back: back),
           "ids_sha256": (T.StringType(), pa.string(), lambda ids, back: hashlib.sha256(ids).hexdigest()),
           "decoded_sha256": (T.StringType(), pa.string(), lambda ids, back: hashlib.sha256(back).hexdigest())}


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None,
           outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """``docs`` without its text, plus the ``outputs`` (names of ``OUTPUTS``; a column of that name is replaced): the
    ids as little-endian unsigned 32-bit integers, the bytes they decode to, the SHA-256 of both.

    ``path`` and ``pattern``: a rank file, present on every node and read once by each worker, and what cuts a text."""
    if path is None or pattern is None:
        own = vocabulary()
        path, pattern = path or own[0], pattern or own[1]
    keep = [c for c in docs.columns if c not in (*outputs, text)]
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(n, OUTPUTS[n][0]) for n in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                cols: list[list] = [[] for _ in outputs]
                for t in part.column(part.num_columns - 1).to_pylist():
                    ids = bpe.encode(t or "")
                    back = bpe.decode(ids)
                    for c, n in zip(cols, outputs):
                        c.append(OUTPUTS[n][2](ids, back))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(c, OUTPUTS[n][1]) for c, n in zip(cols, outputs)]], [*keep, *outputs])

    return docs.select(*keep, text).mapInArrow(run, schema)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
