"""URL verdicts from rules indexed by their rarest literal token.

Site rules give a host and a path: they fit the host and its subdomains where the path
starts with theirs, and the longest rule that fits decides (of equal length, the last by name).
All other URLs are judged by pattern rules, regular expressions that come with the literal
tokens any match must contain. Both kinds are regular expressions in one index. Tokens are runs
of letters and digits in the lower-cased URL. A rule is filed under the one of its tokens that
the fewest URLs hold, so a URL's tokens fetch the few rules that can match it, and only those
run. A URL is blocked if a pattern rule matches. Rules without a token run on every URL.

The counts that choose the tokens cover all rows and have one row per literal token of
the rule list, however many URLs there are. No URL is shuffled.

Nulls: a URL that is null or has no ``://`` has an empty host and path; it has no
tokens, fits no rule and is allowed. A null id stays null; repeated rows get equal
results, an empty table gives none, and very long URLs are taken whole. Columns other than id
and URL are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class SiteRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Over host and path in one: a host has no slash, and a path starts with one."""
        return rf"(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    @property
    def tokens(self) -> tuple[str, ...]:
        """Runs that stand whole in every URL that fits: what follows the path may lengthen its last one."""
        whole = self.path[: self.path.rfind("/") + 1]
        return tuple(dict.fromkeys(re.findall(TOKEN, f"{self.host}{whole}".lower())))


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` can only match URLs with all of ``tokens`` (one at least)."""

    pattern: str
    tokens: tuple[str, ...]


Rule = SiteRule | PatternRule
# The site rules of the query.
SITE_RULES = (
    SiteRule("org", "/", ALLOW),
    SiteRule("example.org", "/es/", BLOCK),
    SiteRule("example.org", "/en/1", BLOCK),
    SiteRule("com", "/fr/", ALLOW),
    SiteRule("com", "/de/", BLOCK),
)
#: Words of hosts that sell, cheat or spread. A pair has both words, in order, in one host label.
SINGLE_WORDS = ("adult", "casino", "porn", "xxx", "viagra", "spam", "malware", "phishing", "torrent", "warez")
WORD_PAIRS = (
    ("ads", "track"), ("ad", "server"), ("cheap", "pills"), ("cheap", "meds"), ("free", "bets"), ("free", "spins"),
    ("link", "farm"), ("payday", "loans"), ("click", "bait"), ("fake", "watches"),
)
HOST = r"://(?:[^/?#]*[.@])?"
PATTERN_RULES = (
    *(PatternRule(rf"{HOST}(?:[a-z0-9]+-)*{word}(?:-[a-z0-9]+)*\.", (word,)) for word in SINGLE_WORDS),
    *(PatternRule(rf"{HOST}(?:[a-z0-9]+-)*{a}-{b}(?:-[a-z0-9]+)*\.", (a, b)) for a, b in WORD_PAIRS),
    PatternRule(r"[?&](?:aff|affiliate)_?id=[^&#]+&(?:.*&)?subid=", ("subid",)),
    PatternRule(r"/wp-content/.*\.(?:exe|scr|apk)(?:[?#]|$)", ("wp", "content")),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def token_counts(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> dict[str, int]:
    """How many URLs hold each literal token of the rules: a row per token at most."""
    wanted = sorted({token for rule in rules for token in rule.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url_col)), F.lit(f"({TOKEN})"), 1))
    held = F.array_intersect(tokens, F.array(*map(F.lit, wanted)))
    counted = pages.select(F.explode(held).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counted.collect()}


def index_of(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules under the rarest literal token of each; those without one under none."""
    index: dict[str | None, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token), default=None)
        index.setdefault(rarest, []).append(rule)
    return index


def judge(
    pages: DataFrame, site_rules: Sequence[SiteRule] = SITE_RULES, pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (site rule, or null) and ``verdict`` of every row."""
    url = F.col(url_col).cast("string")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), url.alias("url"))
    rules = [*site_rules, *pattern_rules]
    index = index_of(rules, token_counts(source, rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = re.compile(TOKEN)
        compiled = {
            key: [(re.compile(rule.pattern, re.DOTALL), rule if isinstance(rule, SiteRule) else None) for rule in found]
            for key, found in index.items()
        }
        always = compiled.pop(None, [])

        def verdict(url: str | None, place: str) -> tuple[str | None, str]:
            if url is None or "://" not in url:
                return None, ALLOW
            lowered, longest, blocked = url.lower(), None, False
            for fetched in (always, *(compiled[key] for key in compiled.keys() & set(token.findall(lowered)))):
                for pattern, site in fetched:
                    if site is None:
                        blocked = blocked or bool(pattern.search(lowered))
                    elif pattern.match(place) and (longest is None or (len(longest.name), longest.name) < (len(site.name), site.name)):
                        longest = site
            if longest is not None:
                return longest.name, longest.verdict
            return None, BLOCK if blocked else ALLOW

        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            found = [verdict(url, host + path) for url, host, path in zip(batch.column("url").to_pylist(), hosts, paths, strict=True)]
            made = [pa.array([one[k] for one in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("path"), *made], ["page_id", "host", "path", "rule", "verdict"])

    return source.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def judge_sql() -> str:
    """DuckDB SQL for ``judge`` over ``pages`` with the fixed rules."""
    host = r"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = r"regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    names = verdicts = ""
    for rule in sorted(SITE_RULES, key=lambda rule: (-len(rule.name), rule.name)):
        fits = f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"
        names += f" WHEN {fits} THEN '{rule.name}'"
        verdicts += f" WHEN rule = '{rule.name}' THEN '{rule.verdict}'"
    patterns = " OR ".join(f"regexp_matches(lowered, '(?s){rule.pattern}')" for rule in PATTERN_RULES)
    return f"""
        WITH parts AS (
            SELECT page_id, coalesce({host}, '') AS host, coalesce({path}, '') AS path, lower(url) AS lowered
            FROM pages
        ), ruled AS (
            SELECT *, CASE{names} ELSE NULL END AS rule FROM parts
        )
        SELECT page_id, host, path, rule,
            CASE{verdicts} WHEN contains(lowered, '://') AND ({patterns}) THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """
