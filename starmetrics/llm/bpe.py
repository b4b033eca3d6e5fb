"""Operator 9 — BPE encoding by backtracking over longest matches, decoding with an offset table.

The vocabulary is a tokenizer file with merges and an end-of-word mark.  A pre-token is a string of byte-level
characters plus one end mark, which belongs to the last character.  The encoder walks the pre-token with an
Aho-Corasick automaton over all tokens that a merge sequence can really produce: it takes the longest token at
the current position and keeps it if it is *compatible* with the token before it, i.e. if no merge would have
crossed their border earlier; otherwise it tries the next shorter token, and steps back when none is left.
Every (position) is left at most once, so a pre-token takes linear time, and the result equals the merges exactly.

Pre-tokens repeat a lot, so each task keeps the code of those it has met (a bounded table, emptied when full).
Decoding gathers the tokens' bytes from one blob through a table of offsets.

Edge cases: a null text counts as empty and gives no token; special tokens written in a text become their id, as
the file's added tokens say; very long texts are one row each; repeated rows are encoded each on its own; an
empty table gives an empty result; other columns are kept by ``encode``.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmetrics.llm.common import frugal, table

#: Pre-tokens whose codes a task keeps at once.
CACHE_WORDS = 600_000
CACHE_PAIRS = 500_000
_NONE = 1 << 30


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if printable and not a space, else the next one from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Bpe:
    """Tables of one tokenizer file.  Inside, a token is its *rank*: base symbols first, then merges in order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        base = [t for t in vocab if t not in made]
        self.rank: dict[str, int] = {t: i for i, t in enumerate(base)}
        self.n_base = len(base)
        self.left, self.right = list(range(self.n_base)), list(range(self.n_base))
        self.pair: dict[tuple[int, int], int] = {}
        tokens = list(base)
        for a, b in merges:
            t, r = a + b, len(tokens)
            self.pair.setdefault((self.rank[a], self.rank[b]), self.rank.setdefault(t, r))
            self.left.append(self.rank[a])
            self.right.append(self.rank[b])
            tokens.append(t)
        self.ids = np.array([vocab[t] for t in tokens], dtype="<u4")
        # tokens that merges really produce from their own characters
        ok = [True] * self.n_base
        for r in range(self.n_base, len(tokens)):
            a, b = self.left[r], self.right[r]
            ok.append(ok[a] and ok[b] and self.rank[tokens[r]] == r and self._compatible(a, b, r))
        self.symbols = [self._symbols(t) for t in tokens]
        self.size = [len(x) for x in self.symbols]
        self.known: dict[tuple[int, int], bool] = {}  # pairs already checked
        auto = ahocorasick.Automaton()
        for r, good in enumerate(ok):
            if good:
                auto.add_word(self.symbols[r], r)
        auto.make_automaton()
        self.auto = auto
        self.by_string = {self.symbols[r]: r for r, good in enumerate(ok) if good}
        self.shorter = [-1] * len(tokens)  # the longest proper prefix that is a token
        for s, r in self.by_string.items():
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in self.by_string:
                    self.shorter[r] = self.by_string[s[:n]]
                    break
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.byte_chars = byte_chars()
        # decoding: all tokens by id, each with the blank that joins tokens, and where they start
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        parts = [(" " + names.get(i, "")).encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])


    def _symbols(self, t: str) -> str:
        """The token as the automaton sees it: the end-of-word suffix is one character."""
        return t[: -len(self.suffix)] + "\0" if self.suffix and t.endswith(self.suffix) else t

    def _compatible(self, a: int, b: int, limit: int = _NONE) -> bool:
        """Whether merging the characters of a and b leaves exactly the tokens a, b (of merges below ``limit``).

        Undo the last merges on both sides of the border, latest first: a merge across the border that ranks
        before one undone would have come first."""
        pair, left, right = self.pair, self.left, self.right
        while True:
            if pair.get((a, b), _NONE) < limit:
                return False
            if a > b:  # a's last merge came later: undo it, its right part touches the border
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def encode_symbols(self, s: str) -> list[int]:
        """Ranks of one pre-token."""
        whole = self.by_string.get(s)
        if whole is not None:
            return [whole]
        n, size, known = len(s), self.size, self.known
        longest = [-1] * (n + 1)
        for end, r in self.auto.iter(s):  # all matches; a longer one at a start ends later and overwrites
            longest[end - size[r] + 1] = r
        out: list[int] = []
        at, r = 0, longest[0]
        dead = bytearray(n + 1)  # borders from which no way leads on
        while at < n:
            placed = False
            while r >= 0:
                end = at + size[r]
                if dead[end]:
                    r = self.shorter[r]
                    continue
                if out:
                    fits = known.get((out[-1], r))
                    if fits is None:
                        if len(known) > CACHE_PAIRS:
                            known.clear()
                        fits = known[out[-1], r] = self._compatible(out[-1], r)
                else:
                    fits = True
                if fits:
                    out.append(r)
                    at, r, placed = end, longest[end], True
                    break
                r = self.shorter[r]
            if not placed:
                dead[at] = 1
                if not out:
                    raise ValueError(f"no encoding for {s!r}")
                last = out.pop()
                at -= size[last]
                r = self.shorter[last]
        return out

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token, little-endian."""
        bc = self.byte_chars
        return self.ids[self.encode_symbols("".join([bc[b] for b in word.encode()]) + ("\0" if self.suffix else ""))].tobytes()

    def normalize(self, text: str) -> str:
        # per character: no final-sigma rule.  White space needs no collapsing: no pre-token contains any.
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str, cache: dict[str, bytes]) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.special_split.split(text) if self.special_split and "<|" in text else [text]
        out = []
        for p in parts:
            if p in self.special:
                out.append(np.array([self.special[p]], "<u4").tobytes())
                continue
            words = self.split.findall(self.normalize(p))
            for w in set(words).difference(cache):
                cache[w] = self.encode_word(w)
            out.append(b"".join([cache[w] for w in words]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The tokens joined by blanks, in UTF-8."""
        i = np.frombuffer(ids, "<u4")
        if not len(i):
            return b""
        start, size = self.offsets[i], self.offsets[i + 1] - self.offsets[i]
        end = np.cumsum(size)
        take = np.arange(end[-1]) + np.repeat(start - end + size, size)
        return self.blob[take].tobytes()[1:]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: What ``encode`` can add to a document.
OUTPUTS = {"n_tokens": (T.LongType(), lambda ids, back: len(ids) // 4),
           "ids": (T.BinaryType(), lambda ids, back: ids),
           "decoded": (T.StringType(), lambda ids, back: back.decode()),
           "ids_sha256": (T.StringType(), lambda ids, back: hashlib.sha256(ids).hexdigest()),
           "decoded_sha256": (T.StringType(), lambda ids, back: hashlib.sha256(back).hexdigest())}


def encode(docs: DataFrame, text: str = "text", path: str | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """``docs`` without its text, plus the ``outputs`` (names of ``OUTPUTS``; a column of that name is replaced): the
    ids as little-endian unsigned 32-bit integers, the text they decode to, the SHA-256 of both.

    ``path``: the tokenizer file, present on every node; read once by each worker."""
    path = path or vocabulary_path()
    keep = [c for c in docs.columns if c not in (*outputs, text)]
    schema = T.StructType([*docs.select(*keep).schema.fields, *[T.StructField(n, OUTPUTS[n][0]) for n in outputs]])
    kinds = {"n_tokens": pa.int64(), "ids": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = load(path), {}
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                cols: list[list] = [[] for _ in outputs]
                for t in part.column(text).to_pylist():
                    if len(cache) > CACHE_WORDS:
                        cache.clear()
                    ids = bpe.encode(t or "", cache)
                    back = bpe.decode(ids)
                    for c, n in zip(cols, outputs):
                        c.append(OUTPUTS[n][1](ids, back))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], *[pa.array(c, kinds.get(n, pa.string())) for c, n in zip(cols, outputs)]], [*keep, *outputs])

    return docs.select(*keep, text).mapInArrow(frugal(run), schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
