"""Operator 8 — document fingerprints by consistent weighted sampling.

A text is a bag of terms (its words), weighted by their counts.  For every sample k each term has two gamma(2, 1)
variables and a uniform one, all derived from a hash of (term, k).  They turn the term's weight into a step
``t = floor(ln w / r + beta)`` and an arrival ``ln a = ln c - r (t - beta) - r``; the term with the smallest arrival
and its step are the sample.  Two bags agree in a sample with a probability equal to their generalised Jaccard
similarity ``sum min(w) / sum max(w)``, so the share of equal samples estimates it (K samples: standard error at
most ``0.5 / sqrt(K)``).  A fingerprint holds 16 bits of each sample.

``fingerprint`` is row-wise.  ``edit_likeness`` gives each document the following one in ascending id: ranges of ids
are dealt to tasks by range number, and the first document of every range is also sent to the range before it, so
neighbours always meet; nothing is collected but one id per range.

Edge cases: a text without words (null, empty, blank) has the fingerprint of the empty bag, likeness 1 to another
empty bag and 0 to any other; null ids sort first; documents with the same id are ordered by text; a single
document is its own next; an empty table gives an empty result; very long texts are one row each and are sampled
in chunks of terms; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.common import shuffle_partitions, table

K = 128
#: Terms whose variables a task keeps for good (the first it meets), and those that it keeps for a while.
KEPT_TERMS, RECENT_TERMS = 16_384, 8_192
#: Terms sampled at once.
CHUNK = 4096

_EMPTY = b"\0" * (2 * K)
_U = np.uint64
_F = np.float32


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_A, _B = (_mix(np.arange(1, 4 * K + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.uint32).reshape(2, 2, K)


def _gamma2(u: float, x: float) -> float:
    """Where the distribution function 1 - (1 + x) exp(-x) reaches u, by Newton's steps from a point below."""
    for _ in range(60):
        step = (1.0 - (1.0 + x) * math.exp(-x) - u) / (x * math.exp(-x))
        x -= step
        if abs(step) < 1e-12 * x:
            break
    return x


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) values of 2^16 equal steps of probability (the middle of each), logarithms of such values at their
    borders with 2^-16 of the way to the next, and logarithms of small counts.  Made with the scalar functions, whose results don't depend on a CPU's
    vector instructions, so equal texts have equal fingerprints on every machine."""
    n = 1 << 16
    middle, border, x = [], [], math.sqrt(0.5 / n)
    for i in range(n):
        x = _gamma2((i or 0.25) / n, x)
        border.append(math.log(x))
        x = _gamma2((i + 0.5) / n, x)
        middle.append(x)
    border.append(math.log(_gamma2((n - 0.25) / n, x)))
    at = np.array(border, _F)
    return np.array(middle, _F), at[:-1].copy(), np.diff(at) * _F(2.0**-16), np.array([0.0, *[math.log(i) for i in range(1, 4096)]], _F)


def variables(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and beta of each term hash and sample: (n, K) float32.  ln c takes 32 random bits (a border of the table
    and the way to the next), r and beta 16 each."""
    low, high = terms.astype(np.uint32)[:, None], (terms >> _U(32)).astype(np.uint32)[:, None]
    middle, border, way, _ = tables()

    def bits(lane):
        x = (low ^ _A[lane]) * np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x += high ^ _B[lane]
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        return x

    x = bits(0)
    at = x >> np.uint32(16)
    lnc = border.take(at)
    part = way.take(at)
    x &= np.uint32(0xFFFF)
    part *= x.astype(_F)
    lnc += part
    x = bits(1)
    r = middle.take(x >> np.uint32(16))
    x &= np.uint32(0xFFFF)
    beta = x.astype(_F)
    beta += _F(0.5)
    beta *= _F(2.0**-16)
    return r, lnc, beta


def log_counts(n: np.ndarray) -> np.ndarray:
    logs = tables()[3]
    if n.max(initial=0) < len(logs):
        return logs[n]
    return np.array([math.log(x) for x in n.tolist()], _F)


class Sampler:
    """Samples bags of words; keeps the variables of the terms it has met first, and of recent ones in two halves of
    which the older is given up when the newer is full."""

    def __init__(self):
        n = KEPT_TERMS + 2 * RECENT_TERMS
        self.where: dict[bytes, int] = {}  # rows of all terms in the tables
        self.kept = 0
        self.young: list[bytes] = []
        self.old: list[bytes] = []
        self.base = KEPT_TERMS
        self.hash, self.once = np.empty(n, np.uint64), np.empty((n, K), _F)  # once: the arrival at weight 1
        self.r, self.lnc, self.beta = (np.empty((KEPT_TERMS, K), _F) for _ in range(3))

    def _rows(self, words: list[bytes]) -> np.ndarray:
        """Rows of the terms in the tables, at most CHUNK of them."""
        if len(self.young) + len(words) > RECENT_TERMS:
            for w in self.old:
                del self.where[w]
            self.old, self.young = self.young, []
            self.base = 2 * KEPT_TERMS + RECENT_TERMS - self.base
        got = list(map(self.where.get, words))
        new = [w for w, r in zip(words, got) if r is None]
        if new:
            room, at = min(KEPT_TERMS - self.kept, len(new)), self.base + len(self.young)
            h = np.array(list(map(xxhash.xxh3_64_intdigest, new)), np.uint64)
            r, lnc, beta = variables(h)
            if room:
                rows = slice(self.kept, self.kept + room)
                self.r[rows], self.lnc[rows], self.beta[rows] = r[:room], lnc[:room], beta[:room]
            beta *= r
            beta += lnc
            beta -= r
            for part, start in ((slice(0, room), self.kept), (slice(room, len(new)), at)):
                rows = slice(start, start + part.stop - part.start)
                self.where.update(zip(new[part], range(rows.start, rows.stop)))
                self.hash[rows], self.once[rows] = h[part], beta[part]
            self.kept += room
            self.young += new[room:]
            got = list(map(self.where.__getitem__, words))
        return np.array(got)

    def _variables(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the kept terms from the tables; those of a recent term, which rarely comes twice in a text, are made anew."""
        recent = rows >= KEPT_TERMS
        if not recent.any():
            return self.r[rows], self.lnc[rows], self.beta[rows]
        at = np.where(recent, 0, rows)
        r, lnc, beta = self.r[at], self.lnc[at], self.beta[at]
        r[recent], lnc[recent], beta[recent] = variables(self.hash[rows[recent]])
        return r, lnc, beta

    def fingerprint(self, text: str) -> bytes:
        bag = Counter(text.encode().split())  # bytes split at the ASCII white space that separates words
        if not bag:
            return _EMPTY
        best = np.full(K, np.inf, _F)
        pick = np.zeros(K, np.uint64)

        def offer(arrival, name):
            least = arrival.min(axis=0)
            i, k = np.nonzero(arrival == least)
            first = least[k] < best[k]
            i, k = i[first], k[first]
            pick[k] = name(i, k)
            np.minimum(best, least, out=best)

        words, counts = list(bag), np.array(list(bag.values()))
        for lo in range(0, len(words), CHUNK):
            rows = self._rows(words[lo:lo + CHUNK])
            weight = counts[lo:lo + CHUNK]
            one = rows[weight == 1]
            if len(one):
                offer(self.once[one], lambda i, k: _mix(self.hash[one[i]]))
            some = rows[weight > 1]
            if len(some):
                r, lnc, beta = self._variables(some)
                t = log_counts(weight[weight > 1])[:, None] / r
                t += beta
                np.floor(t, out=t)
                offer(lnc - r * (t - beta) - r,
                      lambda i, k: _mix(self.hash[some[i]] + t[i, k].astype(np.int64).astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
        return np.maximum((pick >> _U(48)).astype(np.uint16), 1).astype(">u2").tobytes()  # 0 is the empty bag's


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal samples."""
    return float(np.count_nonzero(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2"))) / K


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of each text as a hex string (a column of that name is replaced)."""
    docs = docs.drop(out)
    schema = docs.schema.simpleString()[7:-1] + f",{out}:string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for b in batches:
            got = [sampler.fingerprint(t or "").hex() for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Per document the contract's columns; see the module's docstring for order and edge cases."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    found = ids.filter("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = sorted({int(c) for c in found})

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = np.searchsorted(cuts, b.column("doc_id").fill_null(-2**63).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r, pa.int32())], [*b.schema.names, "_range"])

    # the smallest id of each range: one row per range
    first = ids.mapInArrow(ranges, "doc_id long, _range int").groupBy("_range").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none")).collect()
    first = sorted((r["_range"], None if r["none"] else r["least"]) for r in first)
    order = [r for r, _ in first]
    before = {least: order[(i - 1) % len(order)] for i, (_, least) in enumerate(first)}
    slot = {r: i for i, r in enumerate(order)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.column("doc_id").to_pylist()
            own = [slot[bisect.bisect_right(cuts, -2**63 if x is None else x)] for x in i]
            extra = [k for k, x in enumerate(i) if x in before]
            rows = pa.concat_arrays([pa.array(range(len(i)), pa.int32()), pa.array(extra, pa.int32())])
            ahead = [False] * len(i) + [True] * len(extra)
            to = own + [slot[before[i[k]]] for k in extra]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), b.column("text").take(rows), pa.array(to, pa.int32()), pa.array(ahead)],
                                             ["doc_id", "text", "_range", "_ahead"])

    dealt = docs.mapInArrow(deal, "doc_id long, text string, _range int, _ahead boolean")
    dealt = dealt.repartitionById(max(1, len(order)), F.col("_range")).sortWithinPartitions("_range", "_ahead", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        held = None  # (range, id, text, fingerprint) waiting for its next document
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
            rows.clear()
            return out

        def judged(own, text, fp):
            _, i, t, f = own
            m = len(t) // 2
            edited = t[: len(t) - m] + text[:m]
            e = sampler.fingerprint(edited)
            return i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f.hex(), e.hex(), likeness(f, e), likeness(f, fp)

        for b in batches:
            for lo in range(0, b.num_rows, 512):
                s = b.slice(lo, 512)
                for i, t, r, ahead in zip(*[s.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_ahead")]):
                    fp = sampler.fingerprint(t)
                    if held is not None and held[0] == r:
                        rows.append(judged(held, t, fp))
                    held = None if ahead else (r, i, t, fp)
                if rows:
                    yield flush()

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))
