"""URL filters.

A rule is a regular expression with the literal tokens that every url it fits
must contain.  Each rule is filed under its rarest token, by how often the
tokens occur in the urls to be judged; a url's own tokens fetch the few rules
that could fit, and only their regular expressions run.  Rules without a usable
token are tried on every url.  Judging is one pass without a shuffle; the index
is a bounded number of rules (SHARD), longer lists are judged shard by shard
and the best rule of all shards wins.

Null urls have an empty host and path and fit no rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ship

SHARD = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile("[a-z0-9]+")
_FOLD = str.maketrans(_UPPER, _LOWER)


@dataclass(frozen=True)
class Rule:
    """``regex`` runs on host + path if ``by_host``, else on the whole url in
    lower case.  Of the rules that fit, the greatest ``rank`` wins, of equal
    ones the first."""
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    rank: int
    by_host: bool


def host_rule(name: str, verdict: str) -> Rule:
    """``host/path``: fits the host and its subdomains, if the path starts with
    the rule's.  The longest rule wins, and wins over patterns."""
    host, slash, path = name.partition("/")
    tokens = _TOKEN.findall(host)
    path_tokens = _TOKEN.findall((slash + path).translate(_FOLD))
    if path_tokens and name[-1:].isalnum():
        path_tokens.pop()  # it may go on in the url
    return Rule(name, verdict, rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}",
                tuple(tokens + path_tokens), 1000 + len(name), True)


def pattern_rule(text: str) -> Rule:
    """Filter-list syntax: ``@@`` allows; ``||`` start of a host label, ``|``
    start or end, ``*`` anything, ``^`` a separator or the end."""
    verdict, body = ("allow", text[2:]) if text.startswith("@@") else ("block", text)
    parts = re.findall(r"\|\||\||\*|\^|[^|*^]+", body.lower())
    special = {"||": r"^[^:/?#]+://(?:[^/?#]*\.)?", "*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}
    regex, tokens = "(?s)", []
    for k, part in enumerate(parts):
        regex += ("^" if k == 0 else "$") if part == "|" else special.get(part, re.escape(part))
        if part not in special and part != "|":
            before = parts[k - 1] if k else "*"
            after = parts[k + 1] if k + 1 < len(parts) else "*"
            for m in _TOKEN.finditer(part):  # a token must be whole wherever the rule fits
                if (m.start() or before != "*") and (m.end() < len(part) or after != "*"):
                    tokens.append(m.group())
    return Rule(text, verdict, regex, tuple(tokens), 2 if verdict == "allow" else 1, False)


# fixed values: the four contract rules
HOST_RULES = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"),
              host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
PATTERNS = tuple(map(pattern_rule, (
    "||ads.", "||track.", "/cgi-bin/", "/login^", "/cart/", "/print.html|", "?sessionid=", "&sessionid=",
    "?utm_medium=ad^", "&utm_medium=ad^", "/tag/*/feed^", "@@/login/help^", "@@||docs.*/cart/",
)))
RULES = HOST_RULES + PATTERNS


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def token_counts(df: DataFrame, url_col: str, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many urls hold each token of the rules (at most so many rows)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    words = F.array_distinct(F.split(F.translate(F.col(url_col), _UPPER, _LOWER), "[^a-z0-9]+"))
    rows = (df.select(F.explode(F.array_intersect(words, F.lit(wanted))).alias("token"))
            .groupBy("token").count().collect())
    return {r["token"]: r["count"] for r in rows}


class Index:
    """Rules of one shard by their rarest token."""

    def __init__(self, rules: tuple[Rule, ...], counts: dict[str, int]):
        self.rules = rules
        self.regex = [re.compile(r.regex) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for k, r in enumerate(rules):
            if r.tokens:
                token = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(token, []).append(k)
            else:
                self.always.append(k)

    def best(self, url: str, host_path: str) -> int | None:
        low = url.translate(_FOLD)
        fit = None
        for token in {None, *_TOKEN.findall(low)}:
            for k in self.always if token is None else self.by_token.get(token, ()):
                r = self.rules[k]
                if (fit is None or (r.rank, -k) > (self.rules[fit].rank, -fit)) and \
                        self.regex[k].search(host_path if r.by_host else low):
                    fit = k
        return fit


@lru_cache(maxsize=8)
def _index(rules: tuple[Rule, ...], counts: tuple) -> Index:
    return Index(rules, dict(counts))


def _shard_udf(shard: tuple[Rule, ...], at: int, counts: tuple):
    """The best rule of one shard; among shards the greatest struct wins."""

    def best(urls: pa.Array, host_paths: pa.Array) -> pa.Array:
        index = _index(shard, counts)
        fits = [index.best(u or "", h) for u, h in zip(urls.to_pylist(), host_paths.to_pylist())]
        some = [None if k is None else shard[k] for k in fits]
        return pa.StructArray.from_arrays(
            [pa.array([-1 if r is None else r.rank for r in some], pa.int32()),
             pa.array([0 if k is None else -(at + k) for k in fits], pa.int32()),
             pa.array([r and r.name for r in some], pa.string()),
             pa.array([r and r.by_host for r in some], pa.bool_()),
             pa.array([r and r.verdict for r in some], pa.string())],
            ["rank", "first", "rule", "by_host", "verdict"])

    kind = "struct<rank:int,first:int,rule:string,by_host:boolean,verdict:string>"
    return F.arrow_udf(best, kind).asNondeterministic()


def judge(df: DataFrame, url_col: str = "url", out_col: str = "judged", rules: tuple[Rule, ...] = RULES,
          default: str = "allow") -> DataFrame:
    """``df`` with ``struct<host,path,rule,by_host,verdict>`` of every url; rule
    is null and the verdict ``default`` where none fits."""
    ship(df.sparkSession)
    counts = token_counts(df, url_col, rules)
    host, path = F.coalesce(host_of(F.col(url_col)), F.lit("")), F.coalesce(path_of(F.col(url_col)), F.lit(""))
    shards = [rules[at:at + SHARD] for at in range(0, max(len(rules), 1), SHARD)]
    found = [_shard_udf(shard, k * SHARD, tuple(sorted(counts.items())))(F.col(url_col), F.concat(host, path))
             for k, shard in enumerate(shards)]
    top = found[0] if len(found) == 1 else F.greatest(*found)
    with_top = df.withColumn(out_col, top)
    t = F.col(out_col)
    return with_top.withColumn(out_col, F.struct(
        host.alias("host"), path.alias("path"), t["rule"].alias("rule"), t["by_host"].alias("by_host"),
        F.coalesce(t["verdict"], F.lit(default)).alias("verdict")))


def op1_url_filter(pages: DataFrame) -> DataFrame:
    j = F.col("judged")
    return judge(pages.select("page_id", "url")).select(
        "page_id", j["host"].alias("host"), j["path"].alias("path"),
        F.when(j["by_host"], j["rule"]).alias("rule"), j["verdict"].alias("verdict"))


def op1_sql() -> str:
    """The four contract rules as comparisons of host and path, the longest first;
    then every pattern tried on every url."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    fits = lambda host, path: (f"(host = '{host}' OR ends_with(host, '.{host}')) "  # noqa: E731
                               f"AND starts_with(path, '{path}')")
    # fixed values: the contract's rules
    contract = [("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
                ("net", "/", "block")]
    patterns = sorted((r for r in RULES if not r.by_host), key=lambda r: -r.rank)
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in contract)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in contract)
    verdict += " " + " ".join(f"WHEN regexp_matches(low, {quoted(r.regex)}) THEN '{r.verdict}'" for r in patterns)
    return f"""
      WITH cut AS (SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
                          CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
      parts AS (SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
      SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule, CASE {verdict} ELSE 'allow' END AS verdict
      FROM parts"""
