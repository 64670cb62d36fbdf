"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host rule (`example.net/en/`: the host and its subdomains, a path
prefix) or a pattern rule (a regular expression with the literal tokens that
any match must contain). Token counts over the url table decide which literal
of a rule is rarest; the rule is filed under it. A url's own tokens fetch the
candidate rules, and only those run their regular expression.

Defined cases: a null url or one without `://` has empty host and path and
gets no host rule; its verdict is the default. Repeated rows and ids are
judged row by row. A line feed is a character like any other. An empty table gives an empty result. Extra columns are
ignored. Rules without any literal token are tried on every url.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

TOKEN = re.compile(r"[a-z0-9]+")
_SPLIT = re.compile(r"://([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class Rule:
    text: str  # what is reported
    action: str  # allow or block
    regex: str  # searched in host + path + rest
    tokens: tuple[str, ...]  # literal tokens that stand whole in any matching url
    host_rule: bool = True


def host_rule(action: str, text: str) -> Rule:
    """`host/path`: fits the host and all its subdomains where the url's path starts with `/path`."""
    host, slash, path = text.partition("/")
    path = slash + path
    whole = TOKEN.findall(host.lower())
    # the last token of a path prefix is whole only where a delimiter follows it
    whole += TOKEN.findall(re.sub(r"[A-Za-z0-9]+$", "", path).lower())
    return Rule(text, action, r"\A(?:[^/?#]*\.)?" + re.escape(host) + r"(?=[/?#]|\Z)" + re.escape(path), tuple(dict.fromkeys(whole)))


def pattern_rule(action: str, name: str, regex: str, tokens: Iterable[str]) -> Rule:
    """A general pattern; tokens must stand whole (between non-alphanumerics) in each matching url."""
    return Rule(name, action, regex, tuple(tokens), False)


#: The rules of the registered query (fixed values of its contract).
HOST_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The method's own patterns, for urls no host rule fits: advertising, session and sign-in pages.
PATTERNS = (
    ("block", "ads", r"/ads/", ("ads",)),
    ("block", "banner", r"/banner[./_-]", ("banner",)),
    ("block", "login", r"/login(?:[/.?#]|\Z)", ("login",)),
    ("block", "signup", r"/signup(?:[/.?#]|\Z)", ("signup",)),
    ("block", "session", r"[?&]sessionid=", ("sessionid",)),
)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*p) for p in PATTERNS]


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host with A-Z lower-cased, path, rest from ? or #)."""
    m = _SPLIT.search(url or "")
    if not m:
        return "", "", ""
    host = re.sub("[A-Z]+", lambda x: x[0].lower(), m[1])
    return host, m[2], url[m.end() :]


def _tokens(column):
    return F.filter(F.array_distinct(F.split(F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+")), lambda x: x != "")


def token_counts(pages: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, int]:
    """How many urls hold each literal token of the rules. At most one row per rule token reaches the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    hits = pages.select(F.explode(F.array_intersect(_tokens(F.col(url)), F.array(*map(F.lit, wanted)))).alias("t"))
    return {r["t"]: r["n"] for r in hits.groupBy("t").agg(F.count("*").alias("n")).collect()}


def build_index(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Token -> positions of rules filed under it; and the rules without a token."""
    index, rest = defaultdict(list), []
    for k, r in enumerate(rules):
        if r.tokens:
            index[min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(k)
        else:
            rest.append(k)
    return dict(index), rest


class Matcher:
    def __init__(self, rules: list[Rule], index: dict[str, list[int]], rest: list[int], default: str = "allow"):
        self.rules, self.index, self.rest, self.default = rules, index, rest, default
        self.compiled = [re.compile(r.regex) for r in rules]

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None]:
        """host, path, host rule or None, verdict, pattern or None."""
        host, path, tail = split_url(url)
        if not _SPLIT.search(url or ""):
            return "", "", None, self.default, None
        text = host + path + tail
        asked = set(self.rest)
        for t in set(TOKEN.findall(text.lower())):
            asked.update(self.index.get(t, ()))
        hits = [self.rules[k] for k in asked if self.compiled[k].search(text)]
        best = max((r for r in hits if r.host_rule), key=lambda r: (len(r.text), r.text), default=None)
        other = max((r for r in hits if not r.host_rule), key=lambda r: (len(r.text), r.text), default=None)
        verdict = best.action if best else other.action if other else self.default
        return host, path, best.text if best else None, verdict, other.text if other else None


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict, pattern) for every row of pages."""
    rules = default_rules() if rules is None else rules
    index, rest = build_index(rules, token_counts(pages, rules, url))
    kind = pages.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(rules, index, rest, default)
        for b in batches:
            got = list(zip(*map(m.judge, b.column(1).to_pylist()), strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.string()) for x in got)], ["_id", "host", "path", "rule", "verdict", "pattern"])

    out = pages.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"))
    out = C.arrow(out, judge, f"_id {kind}, host string, path string, rule string, verdict string, pattern string")
    return out.withColumnRenamed("_id", id_col)
