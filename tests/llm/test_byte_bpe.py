"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starmetrics.llm import byte_bpe
from tests.conftest import SF_SMALL
from tests.llm.brute import EDGE, edge_frame

PATH, PATTERN = byte_bpe.vocabulary()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = byte_bpe.load(PATH, PATTERN)


def check(text: str) -> None:
    ids = OWN.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@given(st.text(max_size=300))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    check(text)


@given(st.text(alphabet="aetn' s=\n\t0é", max_size=600))
@settings(max_examples=300, deadline=None)
def test_few_letters(text):
    check(text)


def test_long_matches():
    rng = random.Random(1)
    for n in (500, 5_000, 40_000):
        for unit in ("a", "ab", " ", "=", "\n ", "é", "the"):
            check(unit * n)
        check("".join(rng.choice("etaoinshrdlu") for _ in range(n)))
    tokens = list(RANKS)
    for _ in range(500):
        check(b"".join(rng.choice(tokens) for _ in range(12)).decode("utf-8", "ignore"))


def test_merges_of_many():
    rng = random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("aent hs=") for _ in range(rng.randrange(1, 250))).encode()
        assert OWN.merges(piece) == OWN.merges_of_many(piece) == OWN.tree(piece)


def test_joins_leave_the_rest_alone():
    """Any two codes join to the code of both."""
    rng = random.Random(3)
    for _ in range(500):
        a, b = ("".join(rng.choice("abnthe e=") for _ in range(rng.randrange(0, 60))).encode() for _ in range(2))
        assert OWN.join(OWN.merges(a), OWN.merges(b)) == OWN.merges(a + b)


@pytest.mark.parametrize("rows", [EDGE, None])
def test_query(spark, rows):
    df = edge_frame(spark) if rows else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    want = []
    for i, t in texts:
        ids = LIBRARY.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = byte_bpe.encode(df.select("doc_id", "text"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_frames(spark):
    df = edge_frame(spark).selectExpr("*", "'clash' n_tokens", "'clash' decoded")
    out = byte_bpe.encode(df)
    assert set(df.columns) - {"text"} <= set(out.columns) and out.count() == len(EDGE)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in out.collect()} == {i: t or "" for i, t, _ in EDGE}
    assert byte_bpe.encode(df.limit(0)).count() == 0
