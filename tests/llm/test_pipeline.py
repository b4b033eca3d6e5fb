"""The pipeline, stage by stage, against plain Python on the smallest documents table."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from starmetrics.llm import bpe, mixing, quality
from starmetrics.llm.common import stage
from tests.conftest import SF_SMALL
from tests.llm.brute import near_components, repeated, shingles, words
from tests.llm.test_corpus_ops import _targets
from tests.llm.test_text_ops import _base


def _clean(text: str) -> str | None:
    n, chars, _, _, rep = _base(text)
    keep, lost, lines = [], 0, text.split("\n")
    final = max((k for k, line in enumerate(lines) if words(line)), default=0)
    for k, line in enumerate(lines):
        w = words(line)
        held = sum(len(p) for p in quality.BOILERPLATE if p in line.lower())
        sym = sum(bool(re.search(rb"[#*$%&|<>]", x)) for x in w)
        bars = line.count("|") + line.count("»")
        bad = w and (10 * sym >= 3 * len(w) or (len(w) < quality.MIN_LINE_WORDS and k >= final and not re.search(quality.TERMINAL, line))
                     or (bars >= quality.NAV_BARS and 100 * bars >= 15 * len(w)) or (held and 5 * held >= len(line.strip(" "))))
        if bad:
            lost += sum(len(x.decode()) for x in w)
        else:
            keep.append(line)
    return None if n < 10 or 100 * rep > 20 * n or 2 * lost > chars else "\n".join(keep)


def test_quality_rules_on_lines_that_mention_a_phrase(spark, tmp_path):
    """Long lines with a phrase and short lines before a sentence stay; Spark, SQL and plain Python agree."""
    import duckdb
    long = " ".join(f"word{k}" for k in range(40))
    texts = [f"{long} privacy policy {long.replace('word', 'other')}", f"Heading\n\nNames\n{long}", f"{long}\nPrivacy policy", f"{long}\nlast words\n \n",
             f"Privacy policy and terms of use of this very site\n" * 2 + " ".join(f"w{k}" for k in range(12)), "", None,
             f"  powered by {long[:30]}  \n{long[:60]}", "short\n" * 12, f"{long}\nall rights reserved. cookie policy terms of use: a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    by_sql = db.execute(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({quality.sql()}) ORDER BY 1").fetchall()
    got = quality.op7(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == by_sql
    assert [r["kept"] for r in got] == [_clean(t or "") is not None for t in texts]
    assert {r["doc_id"]: r["clean_text"] for r in quality.judge(docs).filter("kept").collect()} == {
        i: _clean(t or "") for i, t in enumerate(texts) if _clean(t or "") is not None}
    assert [r["kept"] for r in got][:4] == [True] * 4


def test_quality_rules_on_odd_lines(spark):
    """Symbols, bars, phrases, copies and white space in odd places: the counts and lines of plain Python."""
    tail = "\n" + " ".join(f"w{k}" for k in range(30))
    texts = ["a#b$c d e f" + tail, "#a# b c d e" + tail, "## a ## b ## c" + tail, "a | b | c | d" + tail, "a » b » c » d" + tail,
             "||| " + " ".join("abcdefghijklmnopqrstuv") + tail, "a | b » c" + tail, "one\n\n \t\none\r\n\x0bone\none" + tail, tail + "\n \x0c\n",
             tail + "\nEnd\n\n", tail + "\nEnd.\n\t", tail + "\n#\n", "ΟΔΟΣ\nPOWERED BY ΟΔΟΣ\nİ use cookies" + tail, "   \n\t\nUSE\nCOOKIES" + tail,
             "Powered by\nlorem ipsum lorem ipsum" + tail + " lorem ipsum", "all rights reserved\nnone reserved" + tail, "a b c d e " * 2 + tail,
             "a b c d " * 3 + tail, "a b c d e f a b c d e g b c d e f" + tail, "v w x y z", "v w x y z v w x y z", " a b c d e\n\x0ba b c d e f " + tail]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.judge(docs).orderBy("doc_id").collect()
    assert [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got] == [_base(t) for t in texts]
    assert [r["clean_text"] if r["kept"] else None for r in got] == [_clean(t) for t in texts]


def _rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_pipeline(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, source = docs.columns, {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    fns = [f for _, f in corpus_pipeline.STAGES]

    out = stage(fns[0](spark, docs, SF_SMALL), "test")
    rows = sorted((i, _clean(t)) for i, t in _rows(docs) if _clean(t) is not None)
    assert out.columns == columns and _rows(out) == rows and 100 < len(rows) < docs.count()
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())

    out = stage(fns[1](spark, out, SF_SMALL), "test")
    comp = near_components({i: shingles(t) for i, t in rows})
    rows = [(i, t) for i, t in rows if comp[i] == i]
    assert out.columns == columns and _rows(out) == rows

    out = stage(fns[2](spark, out, SF_SMALL), "test")
    mask = repeated([(i, t.encode()) for i, t in rows], 50)
    cut = [(i, bytes(b for b, m in zip(t.encode(), mask[k]) if not m).decode("utf-8", "ignore"), any(mask[k])) for k, (i, t) in enumerate(rows)]
    rows = [(i, t) for i, t, hit in cut if not hit or t.strip()]
    assert out.columns == columns and _rows(out) == rows

    out = stage(fns[3](spark, out, SF_SMALL), "test")
    sizes = Counter()
    for i, t in rows:
        sizes[source[i]] += len(words(t))
    want, text = [], dict(rows)
    for s, target in _targets(sizes).items():
        budget = int(target + 0.5)
        own = sorted((i for i in text if source[i] == s and words(text[i])), key=lambda i: (hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest(), i))
        before, rest = 0, budget % sizes[s]
        for i in own:
            n = len(words(text[i]))
            want += [(i, text[i])] * (budget // sizes[s] + (2 * (rest - before) >= n))
            before += n
    assert out.columns == columns and _rows(out) == sorted(want)

    final = fns[4](spark, out, SF_SMALL).collect()
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    code = {i: np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for i, x in set(want)}
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in final) == Counter((i, code[i]) for i, _ in want)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in final)
    assert Counter(r["ids_sha256"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == Counter(r["ids_sha256"] for r in final)


def test_pipeline_without_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF_SMALL)
    assert docs.count() == 0
