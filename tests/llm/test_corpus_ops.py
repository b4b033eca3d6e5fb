"""Mixing, passage and byte dedup, near duplicates, language model."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from starmetrics.llm import blocks, lm, minhash, mixing, repeats, substring_dedup, suffix_dedup
from tests.conftest import SF_SMALL
from tests.llm.brute import EDGE, LONG, edge_frame, near_components, repeated, shingles, words


def _docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]


# ---------------------------------------------------------------- mixing
def _targets(sizes: dict, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        share = sum(w[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and w[s] * left / share >= most * sizes[s]} if share else set()
        if not new:
            return {s: float(most * sizes[s]) if s in capped else w[s] * left / share for s in names}
        capped |= new


@pytest.mark.parametrize("rows", [EDGE, [(i, "w " * (1 + i % 40), "big" if i % 3 else f"s{i % 7}") for i in range(400)]])
def test_mixing(spark, rows):
    df = edge_frame(spark, rows)
    got = mixing.mix_plan(df).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    sizes = Counter({s: 0 for _, _, s in rows})
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want, taken = _targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix_plan(df.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_mixing_documents(spark):
    rows = [(i, "w " * (1 + i % 40), "big" if i % 3 else f"s{i % 7}") for i in range(400)]
    out = mixing.mix_documents(edge_frame(spark, rows))
    assert out.columns == edge_frame(spark).columns
    taken, plan = Counter(r["doc_id"] for r in out.collect()), mixing.mix_plan(edge_frame(spark, rows)).collect()
    words_of, want, most = Counter(), {}, Counter()
    for r in plan:
        words_of[r["source"]] += taken[r["doc_id"]] * r["size"]
        want[r["source"]], most[r["source"]] = r["target"], max(most[r["source"]], r["size"])
        assert r["epochs"] <= taken[r["doc_id"]] <= r["epochs"] + 1
    for s in want:
        assert abs(words_of[s] - want[s]) <= most[s]
    assert mixing.mix_documents(edge_frame(spark).limit(0)).count() == 0
    assert mixing.mix_plan(edge_frame(spark).limit(0)).count() == 0


# ---------------------------------------------------------------- repeats
def _check_bytes(rows, got):
    mask = repeated([(i, (t or "").encode()) for i, t in rows], 50)
    want = Counter()
    for r, (i, t) in enumerate(rows):
        raw = (t or "").encode()
        kept = bytes(b for b, m in zip(raw, mask[r]) if not m)
        runs = tuple((k, k + len(list(g))) for k, g in _runs(mask[r]))
        want[i, len(raw), kept, runs] += 1
    assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["spans"])) for r in got) == want


def _runs(mask):
    at = 0
    for v, g in itertools.groupby(mask):
        g = list(g)
        if v:
            yield at, g
        at += len(g)


def _check_words(rows, got):
    seqs = [(i, words(t)) for i, t in rows]
    mask = repeated(seqs, 50)
    want = Counter((i, len(w), b" ".join(x for x, m in zip(w, mask[r]) if not m).decode(), sum(mask[r])) for r, (i, w) in enumerate(seqs))
    assert Counter((r["doc_id"], r["n_words"], r["kept"], sum(s["end"] - s["start"] for s in r["spans"])) for r in got) == want


def _random_rows(seed, n):
    """Documents stitched from shared pieces, with edits."""
    rng = random.Random(seed)
    pieces = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 50)) for _ in range(rng.randint(20, 120))) for _ in range(12)]
    rows = []
    for i in range(n):
        w = " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))).split(" ")
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 999)}"
        rows.append((i // 2 if i % 11 == 0 else i, " ".join(w) + rng.choice(["", "\n", " ü"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_random(spark, seed, monkeypatch):
    monkeypatch.setattr(blocks, "BUCKET_KEYS", 500)  # several buckets
    rows = _random_rows(seed, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _check_bytes(rows, suffix_dedup.remove_repeats(df).collect())
    _check_words(rows, substring_dedup.remove_passages(df).collect())


def test_repeats_edges(spark):
    rows = [(i, t) for i, t, _ in EDGE if t != LONG and not (t or "").startswith(LONG)]
    df = edge_frame(spark, [(i, t, "s") for i, t in rows])
    _check_bytes(rows, suffix_dedup.remove_repeats(df).collect())
    _check_words(rows, substring_dedup.remove_passages(df).collect())
    long = edge_frame(spark, [(1, LONG, "s"), (2, LONG + " tail", "s"), (None, LONG, "s")])
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(long).collect()}
    assert got == {1: LONG.encode(), 2: b" tail", None: b""}
    got = {r["doc_id"]: r["kept"] for r in substring_dedup.remove_passages(long).collect()}
    assert got == {1: LONG, 2: "tail", None: ""}
    for f in (suffix_dedup.remove_repeats, substring_dedup.remove_passages, suffix_dedup.dedup):
        assert f(df.limit(0)).count() == 0


def test_repeats_on_documents(spark):
    rows = _docs(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _check_bytes(rows, suffix_dedup.remove_repeats(df).collect())
    by = {r["doc_id"]: r["kept_sha256"] for r in suffix_dedup.op6(spark, SF_SMALL).collect()}
    for r in suffix_dedup.remove_repeats(df).collect():
        assert by[r["doc_id"]] == hashlib.sha256(bytes(r["kept"])).hexdigest()


def test_byte_dedup_stage(spark):
    df = edge_frame(spark)
    out = suffix_dedup.dedup(df)
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append(r)
    assert got[6][0]["text"].startswith("intro shared0") and got[7][0]["text"].startswith("other start") and "shared30" not in got[7][0]["text"]
    assert 8 not in got and got[10][0]["text"] == " tail" and len(got[17]) == 2 and got[12][0]["text"] in ("x", "xé")
    assert got[6][0]["block"] == "clash"


def test_suffix_automaton():
    rng = random.Random(9)
    for _ in range(60):
        ref = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 3))]
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 60))]
        least = rng.randint(1, 6)
        have = {tuple(p[k:k + least]) for p in ref for k in range(len(p) - least + 1)}
        mask = [False] * len(text)
        for k in range(len(text) - least + 1):
            if tuple(text[k:k + least]) in have:
                mask[k:k + least] = [True] * least
        got = [False] * len(text)
        for a, b in substring_dedup.SuffixAutomaton(ref).spans(text, least):
            got[a:b] = [True] * (b - a)
        assert got == mask


def test_triggers_cover_every_window():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 103, 5000).astype(np.uint8).tobytes()
    block = blocks.Block.__new__(blocks.Block)
    block.data = np.frombuffer(data, np.uint8)
    block.starts, block.ends = np.array([0, 30, 2000]), np.array([30, 2000, 5000])
    seq = repeats.Sequence(block, False)
    at, _ = seq.triggers()
    for s in np.flatnonzero(seq.window_starts()):
        assert ((at >= s) & (at <= s + repeats.SPAN - 1)).any()


# ---------------------------------------------------------------- near duplicates
def test_near_duplicates(spark):
    rows = _docs(spark)
    got = {r["doc_id"]: r for r in minhash.op4(spark, SF_SMALL).collect()}
    sets = {i: shingles(t) for i, t in rows}
    comp = near_components(sets)
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), comp[i], comp[i] == i)


def test_near_duplicates_hub(spark, monkeypatch):
    """Copies that are each like the original but not like each other, and a chain."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(400)]
    rows = [(50, " ".join(base))]
    for k in range(25):
        w = list(base)
        for p in rng.sample(range(400), 12):
            w[p] = f"e{k}x{p}"
        rows.append((k, " ".join(w)))
    chain = [f"c{i}" for i in range(300)]
    rows += [(100 + k, " ".join(chain[k * 30:k * 30 + 210])) for k in range(4)]
    monkeypatch.setattr(minhash, "CHUNK_SETS", 4)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_components({i: shingles(t) for i, t in rows})


def test_near_duplicates_edges(spark):
    df = edge_frame(spark, [*EDGE, (None, "one two", "a")])
    got = defaultdict(set)
    for r in minhash.near_duplicates(df).collect():
        got[r["doc_id"]].add((r["component_id"], r["kept"]))
    comp = near_components({i: shingles(t) for i, t, _ in EDGE})
    for i in comp:
        assert got[i] == {(comp[i], comp[i] == i)}
    assert got[None] == {(None, True)}
    out = minhash.dedup(df)
    assert out.columns == df.columns
    ids = Counter(r["doc_id"] for r in out.collect())
    assert ids[17] == 1 and ids[4] == 1 and ids[5] == 0 and ids[None] == 1
    assert minhash.dedup(df.limit(0)).count() == 0


def test_signature_agreement_is_jaccard():
    """Over many random pairs, circulant coordinates agree as often as the sets are alike."""
    import pyarrow as pa
    rng, err = random.Random(1), []
    for _ in range(40):
        a = [f"v{i}" for i in range(200)]
        b = list(a)
        for p in rng.sample(range(200), rng.randint(0, 20)):
            b[p] = f"z{p}"
        h, border = minhash.shingle_sets(pa.array([" ".join(a), " ".join(b)]))
        s = minhash.signatures(h, border)
        x, y = set(h[border[0]:border[1]].tolist()), set(h[border[1]:border[2]].tolist())
        err.append((s[0] == s[1]).mean() - len(x & y) / len(x | y))
    assert abs(np.mean(err)) < 0.03


# ---------------------------------------------------------------- language model
def test_hmm_against_direct_sum():
    rng = np.random.default_rng(0)
    m = lm.Hmm(rng.dirichlet(np.ones(lm.STATES)), rng.dirichlet(np.ones(lm.STATES), lm.STATES), rng.dirichlet(np.ones(lm.CLASSES), lm.STATES).T.copy())
    seqs = [rng.integers(0, lm.CLASSES, n) for n in (4, 1, 7, 4, 2)]
    got = lm.Batch(np.array([len(s) for s in seqs]), np.concatenate(seqs)).log10(m)
    for s, g in zip(seqs, got):
        a = m.start * m.emit[s[0]]
        for x in s[1:]:
            a = (a @ m.move) * m.emit[x]
        assert g == pytest.approx(log10(a.sum()), rel=1e-9)
    s = seqs[0][:3]
    total = sum(m.start[p[0]] * m.emit[s[0], p[0]] * m.move[p[0], p[1]] * m.emit[s[1], p[1]] * m.move[p[1], p[2]] * m.emit[s[2], p[2]]
                for p in itertools.product(range(lm.STATES), repeat=3))
    assert lm.Batch(np.array([3]), s).log10(m)[0] == pytest.approx(log10(total), rel=1e-9)
    start, move, emit, log = lm.Batch(np.array([len(s) for s in seqs]), np.concatenate(seqs)).expected(m)
    assert start.sum() == pytest.approx(5, rel=1e-4) and emit.sum() == pytest.approx(18, rel=1e-4) and move.sum() == pytest.approx(13, rel=1e-4)
    assert log == pytest.approx(got.sum(), rel=1e-4)


def test_lm(spark):
    rows = _docs(spark)
    got = {r["doc_id"]: r for r in lm.op5(spark, SF_SMALL).collect()}
    toks = {i: [*words(t, True), None] for i, t in rows}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in toks}
    c: Counter = Counter()
    for i, w in toks.items():
        if not out[i]:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for i, w in toks.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_learns_and_handles_edges(spark):
    enc = lm.count_words(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    v = lm.vocabulary(enc)
    _, logs = lm.train(enc, v, 4)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(logs, logs[1:]))
    rows = lm.score(edge_frame(spark, [*EDGE, (None, "one two", "a")]), 2).collect()
    assert len(rows) == len(EDGE) + 1 and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm.score(edge_frame(spark).limit(0), 2).count() == 0
    alone = lm.score(edge_frame(spark, [(i, "x y", "s") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]), 2).collect()
    assert all(r["base_score"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in alone)
