"""Brute-force versions of the operators, and small fixtures."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw) if lower else raw)


def repeated(docs: list[tuple[int, object]], size: int) -> dict[int, bytearray]:
    """docs: (id, sequence).  Per row number a mask of the symbols inside a window that starts in a smaller id."""
    first: dict = {}
    for i, s in docs:
        for k in range(len(s) - size + 1):
            w = bytes(s[k:k + size]) if isinstance(s, bytes) else tuple(s[k:k + size])
            first[w] = min(first.get(w, i), i)
    out = {}
    for r, (i, s) in enumerate(docs):
        mask = bytearray(len(s))
        for k in range(len(s) - size + 1):
            w = bytes(s[k:k + size]) if isinstance(s, bytes) else tuple(s[k:k + size])
            if first[w] < i:
                mask[k:k + size] = b"\1" * size
        out[r] = mask
    return out


def shingles(text: str | None) -> set:
    w = words(text, True)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_components(sets: dict[int, set]) -> dict[int, int]:
    parent = {i: i for i in sets}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def jaccard(a: Counter, b: Counter) -> float:
    keys = set(a) | set(b)
    most = sum(max(a[k], b[k]) for k in keys)
    return sum(min(a[k], b[k]) for k in keys) / most if most else 1.0


PASSAGE = " ".join(f"shared{i}" for i in range(60))
LONG = " ".join(f"w{i % 9973}x{i // 7}" for i in range(30_000))

#: (doc_id, text, source): nulls, blanks, exact and near copies, a shared passage, a very long text.
EDGE = [
    (1, None, "b"), (2, "", "b"), (3, " \t\n", None), (4, "one two", "a"), (5, "one two", "a"),
    (6, "intro " + PASSAGE + " end six.", "a"), (7, "other start " + PASSAGE + " end seven.", "a"), (8, PASSAGE, "a"),
    (9, LONG, "c"), (10, LONG + " tail", "c"), (11, "é" * 200, "a"), (12, "x" + "é" * 200, "a"),
    (13, "naïve café " * 40, None), (14, "Hello\nHello\n\nmenu | one | two | three\nA proper sentence stands here, long enough to stay.", "a"),
    (15, " ".join(f"alpha{i}" for i in range(80)), "b"), (16, " ".join(f"alpha{i}" for i in range(78)) + " changed", "b"),
    (17, "a b a b a b a b a b a b a b a b", "b"), (17, "a b a b a b a b a b a b a b a b", "b"),
]


def edge_frame(spark, rows=EDGE):
    """With columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = ["block", "bucket", "size", "node", "host", "path", "n", "kept", "label", "key", "before", "taken", "fp1", "_t", "_w", "_id", "ids", "n_words", "lang"]
    return df.withColumns({c: F.lit("clash") for c in clash}).withColumn("n_chars", F.length("text").cast("long"))
