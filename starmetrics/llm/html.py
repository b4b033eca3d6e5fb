"""Operator 10 — main text of web pages by equivalence-class template deduction.

A page is read into tokens: element starts (keyed by their path of element names, classes and ids) and text blocks
(keyed by path and text).  For every host, tokens that stand on the same pages form an equivalence class.  A class is
valid when it holds an element and stands on ``TYPE_SHARE`` of the host's pages, a page type; so is a text that stands
on ``SUPPORT`` of the pages that hold its root, where the root is the main element for text inside it, else the block
element of the text, and makes up a page type.  Odd pages, pages without a token (empty or broken ones), other page
types and second copies of a menu therefore leave the template as it is.

The block elements of the classes that stand on ``SUPPORT`` of a host's pages nest by their paths into its template.  The
regions between them are its slots: a block is in the slot of the nearest template element around its own element; an
``article`` or ``main`` is a slot of its own.  The slots are judged by their content on the page first: those with more
than ``LINKED`` of their varying text in links are menus and teasers, unless the page names them main.  Of what is left
the named slots are kept, unless another slot holds ``OUTWEIGH`` times their unlinked varying text (a teaser, not the
article).  Blocks whose text is itself part of the template are left out.  The template may surround the text of a page
but not make up most of it: a page whose main text is for the greater part the same as elsewhere is a near copy of an
article and stays whole.

Names of furniture (navigation, sidebars, notices, adverts, comments) are a hint: a class or id counts as a whole, with
words of place or part around the name (``site-footer``, ``comments-list``; not ``no-sidebar`` or ``ad-free``), never for
``main`` and what surrounds it, and if the hints leave nothing of a page, they are not followed there.  Elements that
are no text or furniture by kind (scripts, styles, forms, ``nav``, ``footer``, hidden ones) are always left out.

Occurrence vectors are never collected: a vector is the wrapped sum of the hashes of the pages that hold the token, with
their number, so a host with a third of all pages is aggregated like any other.  A task first adds up the tokens of the
pages that it holds; a token on fewer than ``MIN_PAGES`` pages of its host goes no further than the first shuffle.

A host needs ``MIN_PAGES`` pages before text counts as template; if nothing else is left on a page, its blocks stay.

Edge cases: null or empty html gives an empty text; unclosed elements end with their parent; a null url or one
without a host has no template; repeated rows are extracted each on its own; an empty table gives an empty result;
very long pages are one row each; other columns are kept by ``extract``.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.common import stage, table
from starmetrics.llm.urls import split_url

MIN_PAGES = 4
#: Share of the pages of its root that a text of the template stands on, and share of a host's pages that is a page type.
SUPPORT, TYPE_SHARE = 0.8, 0.1
#: Share of linked text above which a slot is a list of links.
LINKED = 0.6
#: A slot with so many times the unlinked varying text of the named main slots takes their place.
OUTWEIGH = 3
#: Parts into which the pages of each host are dealt to meet its template.
SALTS = 32
#: Tokens that a task holds for its hosts before it passes them on.
HELD_TOKENS = 500_000

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot
th thead title tr ul""".split())
CLOSES_P = BLOCK - frozenset("caption html head body tbody td tfoot th thead title tr legend summary li dd dt".split())
#: An element start ends open elements of the second set, down to one of the third.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
MAIN = frozenset(["article", "main"])
FURNITURE = frozenset("head nav aside footer form script style noscript template iframe select button textarea dialog menu svg object".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promotion related respond share sharing sidebar
skip social sponsor sponsored subscribe toolbar widget widgets""".split())
#: Words of place before such a name, and of part after it.
PLACE = frozenset("bottom global header left main mobile page post primary right secondary site sticky top".split())
PART = frozenset("""area bar block body bottom box button buttons col column container content group header inner item items left link links list outer panel
right section slot text title top unit wrap wrapper""".split())
ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"])

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_END = {t: re.compile(rf"</{t}\s*/?>?", re.I) for t in RAW}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@lru_cache(maxsize=50_000)
def _names_furniture(name: str) -> bool:
    """Whether a class or id as a whole is a name of furniture: listed words, perhaps with words of place before and of
    part after them."""
    words = [x.lower() for x in _NAME.findall(name)]
    while words and words[-1] not in NAMES and words[-1] in PART:
        words.pop()
    while words and words[0] not in NAMES and words[0] in PLACE:
        words.pop(0)
    return bool(words) and NAMES.issuperset(words)


class Element:
    """An element of a page, by its path: pages share these objects, so a path is described once for each worker."""

    __slots__ = ("tag", "path", "out", "hint", "main", "root", "parent", "link", "block", "kids")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        found = {m[0].lower(): m[1].strip("\"'") for m in _ATTR.findall(attrs)} if attrs.strip() else {}
        label = tag + "".join(f"|{k}={found[k]}" for k in ("class", "id", "role") if k in found)
        self.tag, self.block, self.kids = tag, tag in BLOCK, {}
        self.path = f"{parent.path}>{label}" if parent else label
        self.main = bool(parent and parent.main) or tag in MAIN or found.get("role") == "main"
        self.root = parent.root if parent and parent.main else self.path
        self.parent, self.link = parent, tag == "a" or bool(parent and parent.link)
        furniture = (tag in FURNITURE or (tag == "header" and not self.main) or found.get("role") in ROLES
                     or "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", ""))))
        stays = tag in ("html", "body", "article", "main")
        self.out = bool(parent and parent.out) or (furniture and not stays)
        # by name only; the main element overrules what is around it
        named = any(map(_names_furniture, (found.get("class", "") + " " + found.get("id", "")).split()))
        self.hint = tag != "main" and found.get("role") != "main" and (bool(parent and parent.hint) or (named and not stays))


_ROOT: dict[str, Element] = {}
_SEEN = [0]
MAX_PATHS = 100_000


def _child(parent: Element | None, tag: str, attrs: str) -> Element:
    label = tag + attrs if attrs and _ATTR.search(attrs) else tag
    kids = parent.kids if parent else _ROOT
    e = kids.get(label)
    if e is None:
        e = kids[label] = Element(tag, attrs, parent)
        _SEEN[0] += 1
    return e


def read_page(page: str) -> tuple[list[Element], list[tuple[Element | None, str, int]]]:
    """The elements in order of their starts, and the text blocks as (block-level element, text, linked characters)."""
    starts: list[Element] = []
    blocks: list[tuple[Element | None, str, int]] = []
    stack: list[Element] = []
    run: list[str] = []
    linked = 0
    holder: Element | None = None  # block-level element of the current block
    at, n = 0, len(page)
    if _SEEN[0] > MAX_PATHS:
        _ROOT.clear()
        _SEEN[0] = 0

    def flush():
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                blocks.append((holder, text, min(linked, len(text))))
            linked = 0

    def add(text: str):
        nonlocal holder, linked
        if text:
            if not run:
                holder = next((e for e in reversed(stack) if e.block), None)
            # furniture inside the line (a button, an advert) is skipped, the line around it stays
            if not (stack and (stack[-1].out or stack[-1].hint)) or (holder and (holder.out or holder.hint)):
                run.append(entities.unescape(text) if "&" in text else text)
                if stack and stack[-1].link:
                    linked += len(run[-1])

    def pop_to(k: int):
        if any(e.block for e in stack[k:]):
            flush()
        del stack[k:]

    while at < n:
        m = _MARK.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag, attrs = tag.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in ("button", "td", "th", "li", "article", "section", "div", "body"):
                    break
        if tag in IMPLIED:
            ends, scope = IMPLIED[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in scope:
                    break
                if stack[k].tag in ends:
                    pop_to(k)
        if tag in BLOCK:
            flush()
        e = _child(stack[-1] if stack else None, tag, attrs)
        starts.append(e)
        if tag in RAW:
            end = _END[tag].search(page, at)
            if tag == "title":  # a text block of the head
                flush()
                blocks.append((e, " ".join(entities.unescape(page[at:end.start() if end else n]).split()), 0))
            at = end.end() if end else n
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(e)
    flush()
    return starts, [b for b in blocks if b[1]]


def _key(kind: str, path: str, text: str = "") -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{path}\0{text}") - (1 << 63)


#: Kinds of tokens.
ELEMENT, BLOCK_ELEMENT, TEXT, MAIN_TEXT = 0, 1, 2, 3


def page_tokens(page: str) -> dict[int, tuple[int, int]]:
    """token → (kind, token of the root); the page itself is the element without a path.  Nothing for an empty page."""
    starts, blocks = read_page(page)
    if not starts and not blocks:
        return {}
    tokens = {_key("e", ""): (ELEMENT, 0)}
    for e in set(starts):
        tokens[_key("e", e.path)] = (BLOCK_ELEMENT if e.block else ELEMENT, 0)
    for e, text, _ in blocks:
        tokens[_key("t", e.path if e else "", text)] = (MAIN_TEXT if e and e.main else TEXT, _key("e", e.root if e else ""))
    return tokens


_WRAP = (1 << 64) - 1


def templates(pages: DataFrame) -> DataFrame:
    """``host, tokens``: the tokens of the host's template, texts and block elements.  ``pages`` has ``host`` and ``html``."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: dict[str, dict[int, list[int]]] = {}  # host → {token: [kind, root, pages, vector]}
        names = ["host", "token", "kind", "root", "pages", "vector"]
        kinds = [pa.string(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64()]

        def flush():
            rows = [(h, t, k, r, n, ((v + (1 << 63)) & _WRAP) - (1 << 63)) for h, toks in hosts.items() for t, (k, r, n, v) in toks.items()]
            hosts.clear()
            for lo in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo:lo + 50_000]), kinds)], names)

        held = 0
        for b in batches:
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                if not host or not page:
                    continue
                h = xxhash.xxh3_64_intdigest(page)
                toks = hosts.setdefault(host, {})
                held -= len(toks)
                for t, (kind, root) in page_tokens(page).items():
                    x = toks.get(t)
                    if x is None:
                        toks[t] = [kind, root, 1, h]
                    else:
                        x[2] += 1
                        x[3] = (x[3] + h) & _WRAP
                held += len(toks)
                if held > HELD_TOKENS:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = pages.select("host", "html").mapInArrow(vectors, "host string, token long, kind byte, root long, pages long, vector long")
    # wrapped sums of vectors: the two halves are added apart, so no sum overflows
    per = rows.groupBy("host", "token").agg(
        F.min("kind").alias("kind"), F.min("root").alias("root"), F.sum("pages").alias("pages"),
        F.sum(F.col("vector").bitwiseAND(0xFFFFFFFF)).alias("_lo"), F.sum(F.shiftrightunsigned("vector", 32)).alias("_hi")).filter(F.col("pages") >= MIN_PAGES)
    per = per.withColumn("vector", F.struct((F.col("_lo") % (1 << 32)).alias("lo"), ((F.col("_hi") + F.floor(F.col("_lo") / (1 << 32))) % (1 << 32)).alias("hi")))
    per = stage(per.drop("_lo", "_hi"), "html-vectors")
    elements = per.filter(F.col("kind") <= BLOCK_ELEMENT)
    total = elements.filter(F.col("token") == _key("e", "")).select("host", F.col("pages").alias("n"))
    texts = per.filter(F.col("kind") > BLOCK_ELEMENT).join(total, "host")
    frame = elements.filter(F.col("kind") == BLOCK_ELEMENT).join(total, "host").filter(F.col("pages") >= SUPPORT * F.col("n"))
    of_root = elements.select("host", F.col("token").alias("root"), F.col("pages").alias("of"))
    standing = texts.join(of_root, ["host", "root"]).filter((F.col("pages") >= SUPPORT * F.col("of")) & (F.col("of") >= TYPE_SHARE * F.col("n")))
    # classes: equal vectors; valid: with an element
    classes = texts.filter((F.col("kind") == TEXT) & (F.col("pages") >= TYPE_SHARE * F.col("n"))).join(elements.select("host", "pages", "vector"), ["host", "pages", "vector"], "left_semi")
    return standing.select("host", "token").union(classes.select("host", "token")).union(frame.select("host", "token")).groupBy("host").agg(F.collect_set("token").alias("tokens"))


def _slot(e: Element | None, template: set[int]) -> Element | None:
    """The nearest template element around a block's element (without a template: the element around it)."""
    e = e.parent if e else None
    while e and template and _key("e", e.path) not in template:
        e = e.parent
    return e


def _weights(slots: list, blocks: list[tuple[Element | None, str, int]], varying: list[bool]) -> dict:
    """slot → varying text, and how much of it is linked."""
    size: dict = {}
    for slot, (_, text, linked), new in zip(slots, blocks, varying):
        if new:
            x = size.setdefault(slot, [0, 0])
            x[0] += len(text)
            x[1] += linked
    return size


def main_text(page: str, template: set[int]) -> str:
    _, blocks = read_page(page)
    body = [b for b in blocks if not (b[0] and b[0].out)]
    body = [b for b in body if not (b[0] and b[0].hint)] or body
    varying = [_key("t", e.path if e else "", text) not in template for e, text, _ in body]
    slots = [("main", e.root) if e and e.main else ("slot", _slot(e, template)) for e, _, _ in body]
    size = _weights(slots, body, varying)
    named = {s for s in slots if s[0] == "main"}
    plain = {s: n for s, (n, linked) in size.items() if s not in named and (linked <= LINKED * n or not template)}
    if named:
        own = sum(size[s][0] - size[s][1] for s in named if s in size)
        better = {s for s in plain if own and size[s][0] - size[s][1] >= OUTWEIGH * own}
        main = better or named
    else:
        main = set(plain) or set(size) or set(slots)
    keep = [s in main for s in slots]
    body, varying = [b for b, k in zip(body, keep) if k], [v for v, k in zip(varying, keep) if k]
    kept = [text for (_, text, _), new in zip(body, varying) if new]
    if 2 * sum(map(len, kept)) < sum(len(text) for _, text, _ in body):
        # a near copy: the standing text is the article
        kept = [text for _, text, _ in body]
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (with ``url`` and ``html``) without its html, plus ``text`` and ``n_chars``; columns of these names
    are replaced."""
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    salt = F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int").alias("_salt")
    hosted = split_url(pages.select(F.struct(*keep).alias("_row"), "url", "html", salt)).select("_row", "html", "host", "_salt")
    # a host may hold a third of all pages: they meet copies of its template
    t = templates(hosted).select(F.col("host").alias("_host"), "tokens", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_copy"))
    joined = hosted.join(t, (F.col("host") == F.col("_host")) & (F.col("_salt") == F.col("_copy")), "left").select("_row", "html", "tokens")
    schema = joined.select("_row").schema.simpleString()[7:-1] + ",text:string,n_chars:bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                s = b.slice(lo, 500)
                text = [main_text(p or "", set(k or ())) for p, k in zip(s.column("html").to_pylist(), s.column("tokens").to_pylist())]
                yield pa.RecordBatch.from_arrays([s.column("_row"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["_row", "text", "n_chars"])

    return joined.mapInArrow(run, schema).select("_row.*", "text", "n_chars")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
