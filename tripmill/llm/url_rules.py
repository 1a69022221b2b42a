"""URL filters: host rules, and pattern rules indexed by their rarest literal token.

A pattern rule is a filter in the usual notation: ``||`` begins at a label of the host, ``|`` at an
end of the address, ``^`` is a separator or the end, ``*`` anything; ``@@`` in front makes it an
exception. The literal tokens of a rule are the runs of letters and digits that must stand alone in
every address it matches. Each rule is filed under the one of its tokens that is rarest in the
addresses at hand, as counted over the whole table. An address is cut into its own tokens, these
fetch the few candidate rules, and only those run their regular expression. A rule without such a
token is a candidate for every address.

Rules are arguments that the caller holds, so the index is as large as those and does not grow with
the table; rows are judged where they are read, without a shuffle. The only thing that comes to the
driver is one count per token that occurs in a rule.

Defined cases: a null address, or one without ``://``, has empty host and path, so no host rule fits;
patterns see it as empty text and allow it. Repeated rows are judged alike; other columns are not
read. An empty rule list allows everything. Among pattern rules an exception wins over a block; the
first in the list is the one named.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.llm.common import for_python

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the path starts with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# --- parameters of the registered query -------------------------------------------------------------
HOST_RULES = (
    HostRule("com", "/", ALLOW), HostRule("example.com", "/en/", BLOCK),
    HostRule("www.example.com", "/en/", ALLOW), HostRule("net", "/es/", BLOCK),
    HostRule("net", "/fr/", BLOCK),
)
PATTERN_RULES = (
    "||casino-win.", "||cheap-pills.", "||free-bets.", "||adult-x.", "||ads-track.", "||spam-farm.",
    ".casino-win.", ".cheap-pills.", ".free-bets.", ".adult-x.", ".ads-track.", ".spam-farm.",
    "/ads/", "/banner/", "/casino/", "/porn/", "/viagra/", "^utm_source=spam^", "*/tracker/*.gif|",
    "@@||example.org/ads/about^",
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end; A-Z lowered."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def lowered(url: Column) -> Column:
    return F.coalesce(F.translate(url, UPPER, LOWER), F.lit(""))


def regex_of(rule: str) -> str:
    """The regular expression of a pattern rule without its ``@@``; the same in Python, Java and
    RE2."""
    start = end = ""
    if rule.startswith("||"):
        start, rule = r"^[a-z][a-z0-9+.-]*://([^/?#]*[.])?", rule[2:]
    elif rule.startswith("|"):
        start, rule = "^", rule[1:]
    if rule.endswith("|"):
        end, rule = "$", rule[:-1]
    parts = {"*": ".*", "^": r"([^a-z0-9_.%-]|$)"}
    return start + "".join(parts.get(c) or (c if re.match("[a-z0-9]", c) else f"[{c}]")
                           for c in rule.lower()) + end


def literal_tokens(rule: str) -> list[str]:
    """Tokens that stand alone in every address that the rule matches: runs with a literal, an anchor
    or a separator on both sides, none of which may be a letter or digit."""
    body = rule.lower()
    padded = re.sub(r"^\|{1,2}", " ", body)
    padded = re.sub(r"\|$", " ", padded)
    return [m.group() for m in re.finditer(TOKEN, padded)
            if 0 < m.start() and m.end() < len(padded)
            and padded[m.start() - 1] != "*" and padded[m.end()] != "*"]


def token_counts(urls: DataFrame, rules: Sequence[str]) -> dict[str, int]:
    """How often the rules' tokens occur in all addresses (column ``url``)."""
    wanted = sorted({t for rule in rules for t in literal_tokens(rule.removeprefix("@@"))})
    if not wanted:
        return {}
    tokens = urls.select(F.explode(F.regexp_extract_all(lowered(F.col("url")),
                                                        F.lit(f"({TOKEN})"))).alias("token"))
    return {r["token"]: r["count"] for r in
            tokens.where(F.col("token").isin(wanted)).groupBy("token").count().collect()}


class RuleIndex:
    """Host rules by host, pattern rules by their rarest token."""

    def __init__(self, hosts: Sequence[HostRule], patterns: Sequence[str],
                 counts: dict[str, int]) -> None:
        self.by_host = defaultdict(list)
        for rule in sorted(hosts, key=lambda r: (-len(r.name), -len(r.host))):
            self.by_host[rule.host].append((rule.path, rule.name, rule.verdict))
        self.rules = []
        self.by_token, self.anywhere = defaultdict(list), []
        for place, text in enumerate(patterns):
            plain = text.removeprefix("@@")
            self.rules.append((re.compile(regex_of(plain), re.DOTALL),
                               ALLOW if text != plain else BLOCK, text))
            tokens = literal_tokens(plain)
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token[rarest].append(place)
            else:
                self.anywhere.append(place)

    def host_rule(self, host: str, path: str) -> tuple[str, str] | None:
        """Name and verdict of the longest host rule that fits."""
        best, at = None, 0
        while True:
            for begin, name, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(begin) and (best is None or len(name) > len(best[0])):
                    best = (name, verdict)
                    break
            dot = host.find(".", at)
            if dot < 0:
                return best
            at = dot + 1

    def candidates(self, url: str) -> list[int]:
        found = set(self.anywhere)
        for token in set(re.findall(TOKEN, url)):
            found.update(self.by_token.get(token, ()))
        return sorted(found)

    def pattern_verdict(self, url: str) -> tuple[str, str | None]:
        """Verdict and rule of the patterns: an exception, else a block, else allowed."""
        blocked = None
        for place in self.candidates(url):
            expression, verdict, text = self.rules[place]
            if (verdict == ALLOW or blocked is None) and expression.search(url):
                if verdict == ALLOW:
                    return ALLOW, text
                blocked = text
        return (BLOCK, blocked) if blocked else (ALLOW, None)


JUDGED = StructType([StructField(c, StringType()) for c in ("rule", "verdict", "pattern")])


def _judge(index: RuleIndex):
    @F.pandas_udf(JUDGED)
    def judge(urls: pd.Series, hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        rows = []
        for url, host, path in zip(urls, hosts, paths):
            fits = index.host_rule(host, path)
            verdict, pattern = index.pattern_verdict(url)
            rows.append((*(fits or (None, verdict)), pattern))
        return pd.DataFrame(rows, columns=JUDGED.names)
    return judge


def url_filter(pages: DataFrame, hosts: Sequence[HostRule] = HOST_RULES,
               patterns: Sequence[str] = PATTERN_RULES) -> DataFrame:
    """Judge every address: the longest host rule that fits decides, else the patterns.

    Returns page_id, host, path, rule (of a host rule, else null), verdict, and the pattern that
    matched.
    """
    for_python(pages.sparkSession)
    index = RuleIndex(hosts, patterns, token_counts(pages.select("url"), patterns))
    parts = pages.select("page_id", lowered(F.col("url")).alias("_url"),
                         host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumn("_judged", _judge(index)("_url", "host", "path"))
    return judged.select("page_id", "host", "path", "_judged.rule", "_judged.verdict",
                         "_judged.pattern")
