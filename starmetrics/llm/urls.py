"""Operator 3 — URL filters with a rarest-token rule index.

A rule is either a *site* rule (host suffix on label boundaries and a path prefix) or a *pattern* rule (a
regular expression over the lower-cased host followed by the path).  Every rule is indexed under one literal
token that any URL it matches must contain: of its literal tokens the one that is rarest in the URLs at hand.
A URL is split into tokens once; its tokens fetch the candidate rules, and only those run their regular
expression.  Rules without a literal token are candidates for every URL.

Site rules come first: the longest that fits decides.  Otherwise a URL that any blocking pattern matches is
blocked, and every other URL is allowed.

Edge cases: a null url or one without ``://`` has empty host and path, fits no rule and is allowed; repeated
rows are judged each on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmetrics.llm.common import table

#: The rules travel to the executors inside the task; a larger list is refused.
MAX_RULES = 200_000

TOKEN = re.compile(r"[0-9a-z]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``host``/``path``: a site rule, named ``host + path``.  ``pattern``: a regular expression."""

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    def regex(self) -> str:
        """Over host, NUL and path of the URL."""
        return self.pattern or rf"^(?:[^\x00]*\.)?{re.escape(self.host)}\x00{re.escape(self.path)}"

    def tokens(self) -> list[str]:
        return literal_tokens(self.regex())


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every match contains as whole tokens: literal runs of ``[0-9a-z]`` of the top-level sequence,
    bounded on both sides by another literal character or a word boundary."""
    marks: list[str] = []  # one character each; "\0": unknown; "\n": a boundary
    for op, arg in sre_parser.parse(pattern):
        if op is sre.LITERAL:
            c = chr(arg)
            marks.append(c if TOKEN.match(c) else "\n")
        elif op is sre.AT and arg in (sre.AT_BOUNDARY, sre.AT_BEGINNING, sre.AT_END, sre.AT_BEGINNING_STRING, sre.AT_END_STRING):
            marks.append("\n")
        elif op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and _ends_with_dot(arg[2]):
            marks.append("\n")  # an optional "….": the run after it starts at a dot or at the start
        else:
            marks.append("\0")
    return re.findall(r"(?<=\n)[0-9a-z]+(?=\n)", "\n".join(["".join(marks)]))


def _ends_with_dot(sub) -> bool:
    last = list(sub)[-1:] or [(None, None)]
    op, arg = last[0]
    if op is sre.SUBPATTERN:
        return _ends_with_dot(arg[3])
    return op is sre.LITERAL and chr(arg) == "."


#: The site rules of the contract.
SITE_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
              Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]

#: Blocking patterns for spam, gambling, drugs, adult and trap URLs.
BLOCK_WORDS = ("cheap-pills", "spam-farm", "casino", "viagra", "porn", "xxx", "payday-loan", "torrent", "warez", "phishing")
PATTERN_RULES = [Rule("block", pattern=rf"\b{re.escape(w)}\b") for w in BLOCK_WORDS]
RULES = SITE_RULES + PATTERN_RULES


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``, empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.expr("substring(coalesce(%s, ''), instr(coalesce(%s, ''), '://') + 3)" % (f"`{url}`", f"`{url}`"))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    return df.withColumns({
        "host": F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)})


def url_tokens(host: str, path: str) -> set[str]:
    return set(TOKEN.findall(f"{host}\0{path}".translate(LOWER)))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs contain each literal token of the rules (at most one row per rule token)."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    if not wanted:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, n = set(wanted), {}
        for b in batches:
            for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in url_tokens(h, p) & have:
                    n[t] = n.get(t, 0) + 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

    got = urls.select("host", "path").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in got.collect()}


def build_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """token → numbers of the rules under it; the rules without a token."""
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for i, r in enumerate(rules):
        toks = r.tokens()
        if toks:
            index.setdefault(min(toks, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def judge(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` (site rule that decided, else null), ``pattern`` (blocking pattern
    that matched, else null) and ``verdict``.  Columns of ``urls`` with these names are replaced."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are sent to each task")
    parts = split_url(urls, url)
    index, always = build_index(rules, token_counts(parts, rules))
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "pattern", "verdict")]
    schema = parts.select(*keep, "host", "path").schema
    out = schema.simpleString()[7:-1] + ",rule:string,pattern:string,verdict:string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[int, re.Pattern] = {}
        for b in batches:
            named, matched, verdicts = [], [], []
            for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist()):
                cand = set(always)
                for t in url_tokens(h, p):
                    cand.update(index.get(t, ()))
                best, pat = None, None
                for i in sorted(cand):
                    r = rules[i]
                    rx = compiled.get(i) or compiled.setdefault(i, re.compile(r.regex(), re.ASCII))
                    if r.pattern:
                        if pat is None and r.verdict == "block" and rx.search(f"{h}\0{p}".translate(LOWER)):
                            pat = r.pattern
                    elif (best is None or len(r.name) > len(best.name)) and rx.search(f"{h}\0{p}"):
                        best = r
                named.append(best.name if best else None)
                matched.append(pat)
                verdicts.append(best.verdict if best else "block" if pat else "allow")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(named, pa.string()), pa.array(matched, pa.string()), pa.array(verdicts, pa.string())],
                                             [*b.schema.names, "rule", "pattern", "verdict"])

    return parts.select(*keep, "host", "path").mapInArrow(run, out)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def sql() -> str:
    words = "|".join(w.replace("-", r"\-") for w in BLOCK_WORDS)
    site = "\n".join(
        f"    WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.name}'"
        for r in sorted(SITE_RULES, key=lambda r: -len(r.name)))
    blocked = ", ".join(f"'{r.name}'" for r in SITE_RULES if r.verdict == "block")
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT page_id, host, path, CASE
{site}
    ELSE NULL END AS rule FROM hp
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(translate(host || ' ' || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\\b({words})\\b') THEN 'block' ELSE 'allow' END AS verdict
FROM r"""
