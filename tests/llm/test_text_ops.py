"""Quality rules, URL filters, HTML extraction, BPE, fingerprints."""

from __future__ import annotations

import hashlib
import html as entities
import random
import re
from collections import Counter

import numpy as np
import pytest

from starmetrics.llm import bpe, fingerprint, html, quality, urls
from tests.conftest import SF_SMALL
from tests.llm.brute import EDGE, edge_frame, jaccard, words


# ---------------------------------------------------------------- quality rules
def _base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    rep = set()
    for k in range(len(w) - 4):
        if grams[tuple(w[k:k + 5])] > 1:
            rep.update(range(k, k + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep)


def test_quality_counts(spark):
    rows = [(i, t) for i, (_, t, _) in enumerate(EDGE)]
    got = {r["doc_id"]: r for r in quality.judge(edge_frame(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, want = got[i], _base(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_quality_lines(spark):
    # 65 word characters are lost, and more than as many stay
    good = "A proper sentence stands here, and it is long enough to stay.\nAnother sentence follows it and is kept as well."
    text = good + "\nhome | news | sport | about\nPlease read our privacy policy today.\n### *** $$$ ###"
    bad = "x | y | z | w | q | r\n" * 20 + "One good line of text is not enough here."
    out = quality.clean(edge_frame(spark, [(1, text, "s"), (2, bad, "s"), (3, None, "s")]))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: good}
    assert out.columns == edge_frame(spark).columns


def test_quality_keeps_clean_documents(spark):
    """A phrase of page furniture in a long line, and short lines before others, cost a document nothing."""
    long = " ".join(f"Word{k} of tale{k}." for k in range(900)) + " The mill was powered by water; its privacy policy was a high wall."
    listed = "Fruit\n\nApples\nRed pears\nThese are the fruits that grow well in the old garden behind the house."
    tail = "These are the fruits that grow well in the old garden behind the house.\nHome"
    got = {r["doc_id"]: r["text"] for r in quality.clean(edge_frame(spark, [(1, long, "s"), (2, listed, "s"), (3, tail, "s")])).collect()}
    assert got == {1: long, 2: listed, 3: tail.removesuffix("\nHome")}


def test_quality_long_word(spark):
    """Counting the words with symbols takes time in proportion to a line, also for a word of 80,000 characters."""
    import time
    long = "x" * 80_000
    rows = [(1, long + " " + " ".join(f"w{k}" for k in range(20)), "s"), (2, long + "#", "s")]
    docs = edge_frame(spark, rows)
    start = time.monotonic()
    got = {r["doc_id"]: (r["word_chars"], r["lost_chars"], r["kept"]) for r in quality.judge(docs).collect()}
    assert got == {1: (80_050, 0, True), 2: (80_001, 80_001, False)}
    assert time.monotonic() - start < 20


def test_quality_empty(spark):
    assert quality.clean(edge_frame(spark).limit(0)).count() == 0
    assert "kept" in quality.judge(edge_frame(spark).limit(0)).columns


# ---------------------------------------------------------------- URL filters
def test_urls(spark):
    rows = [(1, "http://a.net/x"), (2, "https://EXAMPLE.net/en/1?q#f"), (3, "http://sub.example.com/de/1"), (4, "http://x.org/fr/"), (5, None),
            (6, "no-scheme.net/"), (7, "http://a.net"), (8, "http://notexample.com/de/"), (9, "http://www.cheap-pills.example.com/en/1"),
            (10, "http://x.org/xx?casino=1"), (11, "http://x.org/casino/1"), (12, "http://cheap-pillsx.com/"), (13, "http://x.org/FR/1"), (7, "http://a.net")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    from pyspark.sql import functions as F
    df = df.withColumns({"host": F.lit("clash"), "rule": F.lit("clash"), "verdict": F.lit("clash")})
    got = {r["page_id"]: r for r in urls.judge(df, urls.RULES).collect()}
    assert {i: (r["rule"], r["verdict"]) for i, r in got.items()} == {
        1: ("net/", "block"), 2: ("example.net/en/", "allow"), 3: ("example.com/de/", "block"), 4: ("org/fr/", "allow"), 5: (None, "allow"), 6: (None, "allow"),
        7: (None, "allow"), 8: (None, "allow"), 9: (None, "block"), 10: (None, "allow"), 11: (None, "block"), 12: (None, "allow"), 13: (None, "allow")}
    assert (got[2]["host"], got[2]["path"]) == ("example.net", "/en/1")
    assert urls.judge(df, urls.RULES).count() == len(rows)
    assert urls.judge(df.limit(0), urls.RULES).count() == 0


def test_url_index_changes_nothing(spark):
    """Candidates by token give the same verdicts as running every rule."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    plain = [urls.Rule(r.verdict, r.host, r.path, r.pattern) for r in urls.RULES]
    for r in urls.RULES:
        assert r.tokens(), r
    indexed = {r["page_id"]: (r["rule"], r["pattern"], r["verdict"]) for r in urls.judge(pages, plain).collect()}
    for r in urls.split_url(pages).collect():
        key = f"{r['host']}\0{r['path']}"
        site = [x for x in plain if not x.pattern and re.search(x.regex(), key, re.A)]
        pats = [x for x in plain if x.pattern and re.search(x.regex(), key.translate(urls.LOWER), re.A)]
        best = max(site, key=lambda x: len(x.name), default=None)
        assert indexed[r["page_id"]] == (best.name if best else None, pats[0].pattern if pats else None, best.verdict if best else "block" if pats else "allow")


def test_literal_tokens():
    assert urls.literal_tokens(r"\bfoo\-bar\b") == ["foo", "bar"]
    assert urls.literal_tokens(r"foo.*bar") == []
    assert urls.literal_tokens(r"/ads?/track/") == ["track"]


# ---------------------------------------------------------------- HTML
def test_html_blocks():
    page = ('<html><head><title>T &amp; T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><a>menu</a></nav>'
            '<div class="cookie-notice">We use cookies</div><article><h1>Head&nbsp;line</h1><p><b>One<br>two &lt;3<p>three\n  four</p><aside>side</aside>'
            '<form><p>mail</p></form><ul><li>x<li>y</ul><section id="comments"><p>first!</p></section></article><footer>&copy;</footer>')
    assert html.main_text(page, set()) == "Head line\n\nOne two <3\n\nthree four\n\nx\n\ny"
    assert html.main_text("", set()) == "" and html.main_text("plain <text", set()) == "plain <text"
    assert html.main_text("<div class=content>a</div><div class='sidebar'>b</div>", set()) == "a"
    assert html.main_text("<p>open <!-- never closed", set()) == "open"
    assert html.main_text("<script>x", set()) == ""


def test_html_pieces_by_their_own_element():
    """A line is not dropped for the furniture at its start, and furniture inside a line is not kept."""
    page = ('<body><article><p><a class="share">x</a> The whole paragraph <b>stays</b>.</p><p><button>Copy</button>Text.</p>'
            '<p>Words <span class="ad">Buy</span> go on</p><p><span class="ad">Only this</span></p></article><p>outside</p></body>')
    assert html.main_text(page, set()) == "The whole paragraph stays.\n\nText.\n\nWords go on"
    assert html.main_text('<span class="ad">Buy</span><a>this</a>', set()) == "this"


def test_html_template(spark):
    """Text that is the same on all pages of a host is template; elsewhere it stays."""
    def page(i, host):
        return (i, f"http://{host}/{i}", f"<html><body><article><p>Standing line.</p><p>Text number {i}.</p></article></body></html>")
    rows = [page(i, "big.example.org") for i in range(6)] + [page(i, "small.example.org") for i in range(6, 8)]
    rows += [(8, None, rows[0][2]), (9, "http://x.org/", None), (10, "http://x.org/", ""), (0, rows[0][1], rows[0][2])]
    rows += [(20 + i, "http://copies.example.org/", "<article><p>All the same.</p></article>") for i in range(5)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("c"), "tokens": F.lit("c"), "text": F.lit("c")})
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(df).collect()}
    assert got[0] == ("Text number 0.", 14)
    assert got[7][0] == "Standing line.\n\nText number 7." and got[8][0] == "Standing line.\n\nText number 0."
    assert got[9] == ("", 0) and got[10] == ("", 0)
    assert got[20][0] == "All the same."
    assert html.extract(df).count() == len(rows)
    assert html.extract(df.limit(0)).count() == 0


def _extract(spark, pages):
    df = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, (h, p) in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html.extract(df).collect()}


def test_html_template_of_uneven_hosts(spark):
    """Null, empty, broken and odd pages, a second menu and a second page type leave a host's template as it is."""
    menu = "<div class='top'><p>Standing menu.</p></div>"
    def page(i, top=menu):
        return f"<html><body>{top}<div class='text'><p>Text number {i}.</p></div></body></html>"
    odd = [None, "", "<p>error</p>", page(3, menu + menu)]
    pages = [("one.example.org", p) for p in [page(0), page(1), page(2), *odd, *map(page, range(7, 12))]]
    kinds = ["<div class='b'><p>Standing kind b.</p></div>", "<p>Standing kind a.</p><ul></ul>"]
    pages += [("two.example.org", page(i, kinds[i % 2])) for i in range(12, 24)]
    got = _extract(spark, pages)
    assert [got[3], got[4], got[5]] == ["", "", "error"]
    assert all(got[i] == f"Text number {3 if i == 6 else i}." for i in range(24) if i not in (3, 4, 5))


def test_html_near_copies(spark):
    """Near copies of an article keep the paragraphs they share; text around other articles is template."""
    shared = [f"Shared paragraph number {k} of the article." for k in range(4)]
    copies = [["Copied under licence.", *shared, f"Only here: {i}."] for i in range(6)]
    others = [["Standing line.", f"Article number {i} has a text of its own."] for i in range(6)]
    pages = [(h, "<article>" + "".join(f"<p>{x}</p>" for x in p) + "</article>")
             for h, ps in (("copies.example.org", copies), ("others.example.org", others)) for p in ps]
    got = _extract(spark, pages)
    assert [got[i] for i in range(6)] == ["\n\n".join(p) for p in copies]
    assert [got[i] for i in range(6, 12)] == [p[1] for p in others]


def test_html_slots_without_names(spark):
    """Without article or main, slots of the template that are mostly links are left out, whatever their names."""
    def page(i):
        links = "".join(f"<li><a href='/{k}'>Teaser {k} of page {i}</a></li>" for k in range(5))
        return (f"<html><body><div class='x1'><ul>{links}</ul></div><div class='x2'><h1><a href='/{i}'>Head {i}</a></h1>"
                f"<p>Text number {i} with <a href='/t'>a link</a> in it.</p><p>More of {i}.</p></div></body></html>")
    got = _extract(spark, [("plain.example.org", page(i)) for i in range(6)])
    assert all(got[i] == f"Head {i}\n\nText number {i} with a link in it.\n\nMore of {i}." for i in range(6))


LONG = "A sentence of the article that goes on for quite some words. " * 8


@pytest.mark.parametrize("page", [
    f"<body><div class='site no-sidebar'><p>{LONG}</p></div></body>",
    f"<body><div class='content-with-sidebar'><article><p>{LONG}</p></article></div></body>",
    f"<body><div class='ad-free'><p>{LONG}</p></div></body>",
    f"<body><div class='post share-enabled'><p>{LONG}</p></div></body>",
    f"<body><main><div class='privacy-notice-study'><p>{LONG}</p></div></main></body>",
    f"<body><div class='sidebar'><main><p>{LONG}</p></main></div></body>",
    f"<body><div class='sidebar'><p>{LONG}</p></div></body>",  # nothing else on the page
    f"<body><div class='a'><article><p>teaser</p></article></div><div class='b'><p>{LONG}</p></div></body>"])
def test_html_names_are_hints(page):
    assert html.main_text(page, set()) == LONG.strip()


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "comments-list", "comment-12", "adSlot", "main-nav", "cookie-notice", "left-sidebar-inner"])
def test_html_furniture_by_whole_names(name):
    assert html.main_text(f"<div><p>{LONG}</p></div><div class='x {name}'><p>{LONG} again</p></div>", set()) == LONG.strip()


def test_html_template_without_names(spark):
    """With every element of the pages a div without a class, the template and the slots leave out the menu and the head
    and hold the whole article; the advert and the footer stay, whose texts differ by page and hold no link."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    bare = [("one.example.org", re.sub(r"<(/?)(?:article|nav|footer|div)\b[^>]*>", r"<\1div>", r["html"])) for r in pages]
    got, want = _extract(spark, bare), {r["page_id"]: r["text"] for r in html.op10(spark, SF_SMALL).collect()}
    for i, r in enumerate(pages):
        advert = " ".join(entities.unescape(re.search(r'<div class="ad">(.*?)</div>', r["html"], re.S)[1]).split())
        footer = " ".join(entities.unescape((re.findall(r"<footer>(.*?)(?:</footer>|</body>|\Z)", r["html"], re.S) or [""])[0]).split())
        assert got[i] == "\n\n".join(x for x in (advert, want[r["page_id"]], footer) if x)


def test_html_on_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.op10(spark, SF_SMALL).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        body = re.sub(r"</?[a-zA-Z][^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:h1|p)>", "\0", body)))
        want = "\n\n".join(x for x in (" ".join(entities.unescape(y).split()) for y in body.split("\0")) if x)
        assert got[r["page_id"]] == want


# ---------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def _texts():
    rng = random.Random(5)
    odd = ["", "  ", "ΑΣ ΟΔΟΣ İ ǅ ﬁ x\x1cy\x85z q 中文 🙂👍🏽 don't", "<|endoftext|>a<|startoftext|>", "<|endoftext", "a" * 300, "é" * 99, "\0a", "ẞ K Å ²½Ⅷ٣", "éa"]
    return odd + ["".join(rng.choice("abetinghors ÀéßΣσ'1½.,!🙂中\t\n\x1c <|>_-İǅ") for _ in range(rng.randint(1, 50))) for _ in range(800)]


def test_bpe_exact(reference):
    b, cache = bpe.load(bpe.vocabulary_path()), {}
    for t in _texts():
        want = reference.encode(t, add_special_tokens=False).ids
        ids = b.encode(t, cache)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert b.decode(ids).decode() == reference.decode(want, skip_special_tokens=False)


def test_bpe_query(spark, reference):
    rows = {r["doc_id"]: r for r in bpe.op9(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edges(spark):
    out = bpe.encode(edge_frame(spark))
    got = out.collect()
    assert len(got) == len(EDGE) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert bpe.encode(edge_frame(spark).limit(0)).count() == 0


# ---------------------------------------------------------------- fingerprints
def test_fingerprint_estimates():
    rng, s, errors = random.Random(3), fingerprint.Sampler(), []
    for _ in range(150):
        a = [f"t{rng.randint(0, 60)}" for _ in range(rng.randint(1, 120))]
        b = a[: rng.randint(0, len(a))] + [f"t{rng.randint(0, 60)}" for _ in range(rng.randint(1, 60))]
        near = fingerprint.likeness(s.fingerprint(" ".join(a)), s.fingerprint(" ".join(b)))
        errors.append(near - jaccard(Counter(a), Counter(b)))
    assert abs(np.mean(errors)) < 0.015 and np.sqrt(np.mean(np.square(errors))) < 0.06


def test_fingerprint_query(spark):
    got = {r["doc_id"]: r for r in fingerprint.op8(spark, SF_SMALL).collect()}
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]
    assert len(got) == len(docs)
    s = fingerprint.Sampler()
    for k, (i, t) in enumerate(docs):
        nxt, m = docs[(k + 1) % len(docs)][1], len(t) // 2
        edited = t[: len(t) - m] + nxt[:m]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == s.fingerprint(t).hex() and r["edited_fingerprint"] == s.fingerprint(edited).hex()
        assert r["near_edited"] == fingerprint.likeness(s.fingerprint(t), s.fingerprint(edited))
        assert r["near_next"] == fingerprint.likeness(s.fingerprint(t), s.fingerprint(nxt))


def test_fingerprint_edges(spark):
    rows = fingerprint.edit_likeness(edge_frame(spark, [*EDGE, (None, "first of all", "a")])).collect()
    assert len(rows) == len(EDGE) + 1
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[4][0]["fingerprint"] == by[5][0]["fingerprint"] and by[4][0]["near_next"] == 1.0
    assert by[1][0]["near_next"] == 1.0 and by[3][0]["near_next"] == 0.0
    assert len(by[17]) == 2 and {r["near_next"] for r in by[17]} >= {1.0}
    one = fingerprint.edit_likeness(edge_frame(spark, EDGE[3:4])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprint.edit_likeness(edge_frame(spark).limit(0)).count() == 0
    assert words("a") == [b"a"]
