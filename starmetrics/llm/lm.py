"""Operator 5 — language-model scores from a hidden Markov model.

Tokens are the words of a text (A-Z lower-cased) and one end.  The model has ``STATES`` hidden states.  A state emits
an emission class, and the class a word: each of the ``OWN`` most frequent training words is a class of its own, the
others fall into ``RARE`` classes by hash, inside which a word has its smoothed share of the class's count.  So the
trained parameters have a fixed size, while every word's count over the whole training corpus enters the score.

*Counts.*  Blocks of documents ask buckets of the vocabulary for the corpus counts of their distinct words
(``blocks.py``); nothing but the most frequent words and sums per class reaches the driver.

*Baum-Welch.*  Each of ``ROUNDS`` rounds runs the scaled forward-backward recursion over all training documents,
vectorised over the documents of a block, and adds the expected counts of all partitions in Spark (as fixed-point
numbers, so the sum doesn't depend on its order).

*Scoring* is the scaled forward recursion alone: log10 of the exact probability of the token sequence.

Edge cases: a null or empty text is one end token; a null id counts as held out; repeated rows are scored each on its
own and count each in training; without training documents the base score is 0 a token and the model stays uniform; an
empty table gives an empty result; very long texts are a block of their own; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.blocks import NO_ID, Block, U, answer, buckets_for, group_order, joined, mix, pack, question, squeeze, unsqueeze, with_answers
from starmetrics.llm.common import stage, table
from starmetrics.llm.minhash import _LOWER
from starmetrics.llm.repeats import Sequence, _ask, _out, _rows, per_block

STATES = 8
OWN, RARE = 3584, 512
CLASSES = OWN + RARE + 1
END = CLASSES - 1
ROUNDS = 5
SMOOTH = 0.1
BLOCK_BYTES = 2 << 20
#: Expected counts travel as multiples of this.
UNIT = 2.0**-16


# ---------------------------------------------------------------- counts
def held_out(ids: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i == NO_ID else b"%d" % i) % 10 == 0 for i in ids.tolist()], bool)


def _tokens(row: dict) -> tuple[Block, Sequence, np.ndarray, np.ndarray, np.ndarray]:
    """The block, its words, their distinct hashes, the place of each word in these, and each word's document."""
    block = Block(row["ids"], row["ends"], row["data"])
    block.data = _LOWER[block.data]
    seq = Sequence(block, True, second=False)
    order, new = group_order(seq.hash)
    u, at = seq.hash[order[new]], np.empty(seq.n, np.int64)
    at[order] = np.cumsum(new) - 1
    doc = np.repeat(np.arange(len(block.ids)), seq.ends - seq.starts)
    return block, seq, u, at, doc


def _count(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Corpus count of each entry's word, and 1 for one entry of each word."""
    key, n = cols
    order, new = group_order(key)
    total = np.add.reduceat(n[order].astype(np.int64), np.flatnonzero(new)) if len(key) else np.empty(0, np.int64)
    out, one = np.empty(len(key), np.int64), np.empty(len(key), np.uint8)
    out[order] = total[np.cumsum(new) - 1]
    one[order] = new
    return [out, one]


def count_words(docs: DataFrame) -> DataFrame:
    """Blocks as numbers: ``block, ids, sizes`` (words of each document), ``at`` (each word's place among the block's
    distinct words), ``words`` (their hashes), ``counts`` (their training counts) and ``one`` (the block speaks for it)."""
    blocks = pack(docs, "lm-blocks", block_bytes=BLOCK_BYTES)
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = buckets_for(total // 32)

    def ask(row):
        block, seq, u, at, doc = _tokens(row)
        train = ~held_out(block.ids)
        n = np.bincount(at[train[doc]], minlength=len(u)).astype(np.uint32)
        return question(row["block"], u, [u, n], buckets)

    asked = _ask(blocks, ask, 2)
    both = with_answers(blocks, answer(asked, buckets, [np.uint64, np.uint32], _count, 2), 2)

    def encode(row):
        block, seq, u, at, doc = _tokens(row)
        return _out(["block", "ids", "sizes", "at", "words", "counts", "one"], [pa.int64(), *[pa.binary()] * 6], [(
            row["block"], squeeze(block.ids), squeeze(seq.ends - seq.starts), squeeze(at.astype(np.uint32)), squeeze(u),
            squeeze(joined(row["a0"], np.int64)), squeeze(joined(row["a1"], np.uint8)))])

    return stage(per_block(both.select("block", "ids", "ends", "data", "a0", "a1"), encode, "block long, ids binary, sizes binary, at binary, words binary, counts binary, one binary"), "lm-encoded")


@dataclass
class Vocabulary:
    """``own``: hashes of the words with a class of their own, ascending; ``mass``/``kinds``: training tokens and
    distinct training words of every rare class; ``tokens``/``distinct``/``ends``: N, V and the training documents."""

    own: np.ndarray
    own_count: np.ndarray
    mass: np.ndarray
    kinds: np.ndarray
    tokens: int
    distinct: int
    ends: int

    def classes(self, words: np.ndarray) -> np.ndarray:
        rare = OWN + (mix(words ^ U(0x9E3779B97F4A7C15)) % U(RARE)).astype(np.int64)
        if not len(self.own):
            return rare
        at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        return np.where(self.own[at] == words, at, rare)

    def within(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of each word's share of its class."""
        k = np.clip(classes - OWN, 0, RARE - 1)
        p = (counts + SMOOTH) / (self.mass[k] + SMOOTH * (self.kinds[k] + 1))
        return np.where(classes < OWN, 0.0, np.log10(p))

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the smoothed unigram share."""
        return np.log10((counts + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))

    def frequencies(self) -> np.ndarray:
        """Training tokens of every class."""
        own = np.zeros(OWN)
        own[: len(self.own)] = self.own_count
        return np.concatenate([own, self.mass, [self.ends]])


def _spoken(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Training words that the block speaks for, and their counts."""
    w, c, one = unsqueeze(row["words"], np.uint64), unsqueeze(row["counts"], np.int64), unsqueeze(row["one"], np.uint8)
    pick = (one > 0) & (c > 0)
    return w[pick], c[pick]


def vocabulary(encoded: DataFrame) -> Vocabulary:
    def top(batches):
        for b in batches:
            for row in _rows(b):
                w, c = _spoken(row)
                best = np.lexsort((w, -c))[:OWN]
                yield pa.RecordBatch.from_arrays([pa.array(w[best].view(np.int64)), pa.array(c[best])], ["w", "c"])

    rows = encoded.select("words", "counts", "one").mapInArrow(top, "w long, c long").orderBy(F.desc("c"), "w").limit(OWN).collect()
    own = np.array([r["w"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(own)
    v = Vocabulary(own[order], np.array([r["c"] for r in rows], np.int64)[order], np.zeros(RARE), np.zeros(RARE), 0, 0, 0)

    def sums(batches):
        out = np.zeros((2, RARE), np.int64)
        all_ = np.zeros(3, np.int64)
        for b in batches:
            for row in _rows(b):
                w, c = _spoken(row)
                k = v.classes(w) - OWN
                rare = k >= 0
                out[0] += np.bincount(k[rare], c[rare], RARE).astype(np.int64)
                out[1] += np.bincount(k[rare], minlength=RARE)
                ends = int((~held_out(unsqueeze(row["ids"], np.int64))).sum())
                all_ += [c.sum() + ends, len(w), ends]
        x = np.concatenate([out.reshape(-1), all_])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x)], ["i", "x"])

    got = encoded.select("ids", "words", "counts", "one").mapInArrow(sums, "i long, x long").groupBy("i").agg(F.sum("x").alias("x")).collect()
    x = np.zeros(2 * RARE + 3)
    for r in got:
        x[r["i"]] = r["x"]
    v.mass, v.kinds = x[:RARE], x[RARE:2 * RARE]
    v.tokens, v.ends = int(x[-3]), int(x[-1])
    v.distinct = int(x[-2]) + (v.ends > 0)
    return v


# ---------------------------------------------------------------- the model
@dataclass
class Hmm:
    start: np.ndarray  # (S,)
    move: np.ndarray  # (S, S)
    emit: np.ndarray  # (classes, S): probability of the class in each state


def first_model(freq: np.ndarray) -> Hmm:
    """States that stay, and emissions that differ from the class frequencies by a hash."""
    share = (freq + SMOOTH) / (freq + SMOOTH).sum()
    h = mix(np.arange(1, CLASSES * STATES + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)).reshape(CLASSES, STATES)
    emit = share[:, None] * np.exp(2.0 * (h >> U(11)).astype(np.float64) * 2.0**-53)
    move = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    return Hmm(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


class Batch:
    """Sequences of classes, side by side: first tokens, then second ones, ...; longer sequences come first."""

    def __init__(self, sizes: np.ndarray, classes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[self.order] = np.arange(len(sizes))
        steps = int(sizes.max()) if len(sizes) else 0
        self.active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(steps), side="right")
        self.off = np.concatenate([[0], np.cumsum(self.active)])
        t = np.arange(len(classes)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        flat = self.off[t] + np.repeat(rank, sizes)
        self.x = np.empty(len(classes), np.int32)
        self.x[flat] = classes
        self.n, self.steps = len(sizes), steps

    def ranks(self) -> np.ndarray:
        return np.arange(len(self.x)) - np.repeat(self.off[:-1], self.active)

    def forward(self, m: Hmm, dtype, keep: bool):
        """Scales of all tokens; with ``keep`` also the scaled forward variables and emissions."""
        emit, move, start = m.emit.astype(dtype), m.move.astype(dtype), m.start.astype(dtype)
        scale = np.empty(len(self.x), dtype)
        alpha = np.empty((len(self.x), STATES), dtype) if keep else None
        off = self.off.tolist()
        a = None
        ones = np.ones(STATES, dtype)
        for t in range(self.steps):
            lo, hi = off[t], off[t + 1]
            e = emit[self.x[lo:hi]]
            a = start * e if a is None else (a[: hi - lo] @ move) * e
            c = a @ ones
            a /= c[:, None]
            scale[lo:hi] = c
            if keep:
                alpha[lo:hi] = a
        return scale, alpha

    def log10(self, m: Hmm) -> np.ndarray:
        """log10 of the probability of each sequence."""
        scale, _ = self.forward(m, np.float64, False)
        out = np.empty(self.n)
        out[self.order] = np.bincount(self.ranks(), np.log10(scale), self.n)
        return out

    def expected(self, m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions, and the log10 probability of all sequences."""
        f = np.float32
        scale, alpha = self.forward(m, f, True)
        emit, back = m.emit.astype(f), np.ascontiguousarray(m.move.T.astype(f))
        w = emit[self.x]
        w /= scale[:, None]  # times beta below
        beta = np.ones((len(self.x), STATES), f)
        off = self.off.tolist()
        for t in range(self.steps - 1, 0, -1):
            lo, hi = off[t], off[t + 1]
            w[lo:hi] *= beta[lo:hi]
            beta[off[t - 1]: off[t - 1] + hi - lo] = w[lo:hi] @ back
        before = np.arange(off[1], len(self.x)) - np.repeat(self.active[:-1], self.active[1:])
        move = (alpha[before].T @ w[off[1]:]).astype(np.float64) * m.move
        alpha *= beta
        alpha /= alpha.sum(axis=1, keepdims=True)
        counts = np.stack([np.bincount(self.x, alpha[:, s], CLASSES) for s in range(STATES)], axis=1)
        return alpha[: self.n].sum(axis=0, dtype=np.float64), move, counts, float(np.log10(scale.astype(np.float64)).sum())


def _sequences(row: dict, v: Vocabulary):
    """ids, sizes with the end, classes of all tokens, counts of the words and their places."""
    ids, sizes = unsqueeze(row["ids"], np.int64), unsqueeze(row["sizes"], np.int64)
    k = v.classes(unsqueeze(row["words"], np.uint64))
    at = unsqueeze(row["at"], np.uint32)
    ends = np.cumsum(sizes)
    return ids, sizes + 1, np.insert(k[at], ends, END), at


def train(encoded: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> tuple[Hmm, list[float]]:
    """The model, and the log10 probability of the training tokens' classes before each round."""
    m, logs = first_model(v.frequencies()), []
    for _ in range(rounds if v.ends else 0):
        def expect(batches, m=m):
            total = np.zeros(STATES + STATES * STATES + CLASSES * STATES + 1)
            for b in batches:
                for row in _rows(b):
                    ids, sizes, x, _ = _sequences(row, v)
                    learn = ~held_out(ids)
                    if not learn.any():
                        continue
                    got = Batch(sizes[learn], x[np.repeat(learn, sizes)]).expected(m)
                    total += np.concatenate([np.ravel(g) for g in got])
            fixed = np.round(total / UNIT).astype(np.int64)
            some = np.flatnonzero(fixed)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(fixed[some])], ["i", "x"])

        rows = encoded.select("ids", "sizes", "at", "words").mapInArrow(expect, "i long, x long").groupBy("i").agg(F.sum("x").alias("x")).collect()
        total = np.zeros(STATES + STATES * STATES + CLASSES * STATES + 1)
        for r in rows:
            total[r["i"]] = r["x"] * UNIT
        a, b = STATES, STATES + STATES * STATES
        start, move, emit = total[:a], total[a:b].reshape(STATES, STATES), total[b:-1].reshape(CLASSES, STATES)
        logs.append(float(total[-1]))
        share = (v.frequencies() + SMOOTH) / (v.frequencies() + SMOOTH).sum()
        emit = emit + share[:, None] + 1e-9
        m = Hmm((start + SMOOTH) / (start + SMOOTH).sum(), (move + SMOOTH) / (move + SMOOTH).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return m, logs


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    encoded = count_words(docs)
    v = vocabulary(encoded)
    m, _ = train(encoded, v, rounds)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches):
        for b in batches:
            for row in _rows(b):
                ids, sizes, x, at = _sequences(row, v)
                c = unsqueeze(row["counts"], np.int64)
                n = sizes - 1
                doc = np.repeat(np.arange(len(ids)), n)
                per = lambda w: np.bincount(doc, w[at], len(ids))
                k = v.classes(unsqueeze(row["words"], np.uint64))
                base = per(v.base(c)) + v.base(np.array([v.ends]))[0]
                hmm = Batch(sizes, x).log10(m) + per(v.within(k, c))
                known = per((c > 0).astype(np.float64)).astype(np.int64) + (v.ends > 0)
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(
                    [[None if i == NO_ID else i for i in ids.tolist()], held_out(ids), sizes, known, np.full(len(ids), v.tokens), base, hmm], kinds)], names)

    return encoded.select("ids", "sizes", "at", "words", "counts").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
