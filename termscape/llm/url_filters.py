"""URL filters: pattern rules indexed by their rarest literal token.

A rule has literal tokens, alphanumeric runs that every matching URL must hold whole. Each rule is filed
under the one of them that is rarest in the URLs at hand. A URL's tokens fetch the rules filed under
them, and only these run their regular expression. Rules without a literal token are tried on all URLs.

Two kinds of rules: site rules (host, path prefix; the longest that fits decides) and pattern rules
(glob-like, decide where no site rule fits; block before allow). URLs that no rule fits are allowed.

Everything is DataFrame functions. URLs are aggregated by (id, url) once, a key that no value can
dominate, as repeated rows collapse before the shuffle; tokens and candidates stay within that
partitioning. The rules are a parameter of the job, at most ``MAX_RULES`` of them, and broadcast.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no site rule, and
is judged by the patterns alone (null as the empty string). Repeated rows give repeated results. A URL of any
length is judged whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import ascii_lower

#: The index of so many rules takes a few tens of MB; larger sets are refused, not cut.
MAX_RULES = 200_000
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class SiteRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        """Over ``host + path``; the host rule fits all subdomains."""
        return rf"^(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    def literals(self) -> set[str]:
        """Tokens that are delimited on both sides in each URL that fits."""
        host = re.findall(TOKEN, self.host)
        return set(host) | closed_tokens(self.path, open_end=True)


@dataclass(frozen=True)
class PatternRule:
    """``*`` stands for any run of characters; the pattern may match anywhere in the lower-cased URL."""

    verdict: str
    pattern: str

    @property
    def name(self) -> str:
        return self.pattern

    @property
    def regex(self) -> str:
        return "(?s)" + ".*".join(re.escape(piece) for piece in self.pattern.split("*"))

    def literals(self) -> set[str]:
        found: set[str] = set()
        for piece in self.pattern.split("*"):
            found |= closed_tokens(piece, open_end=True)
        return found


def closed_tokens(text: str, open_end: bool) -> set[str]:
    """Tokens of ``text`` with a delimiter on both sides inside it (only before, if the end is closed)."""
    lowered = text.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    return {
        m.group()
        for m in re.finditer(TOKEN, lowered)
        if m.start() > 0 and (m.end() < len(text) or not open_end)
    }


SITE_RULES = (
    SiteRule("allow", "org", "/"),
    SiteRule("block", "example.org", "/es/"),
    SiteRule("block", "example.org", "/en/1"),
    SiteRule("allow", "com", "/fr/"),
    SiteRule("block", "com", "/de/"),
)
#: Patterns for what a training corpus leaves out whatever the site.
PATTERN_RULES = (
    PatternRule("block", "/wp-login."),
    PatternRule("block", "/wp-admin/"),
    PatternRule("block", "/cgi-bin/"),
    PatternRule("block", ".casino."),
    PatternRule("block", ".porn."),
    PatternRule("block", ".xxx/"),
    PatternRule("block", "/login/*?redirect="),
    PatternRule("block", "/cart/add/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many distinct (id, url) hold each of the rules' tokens; one row per such token comes back."""
    if not tokens:
        return {}
    wanted = F.array(*[F.lit(t) for t in sorted(tokens)])
    held = urls.select(F.explode(F.array_intersect("_tokens", wanted)).alias("token"))
    return {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}


def judge_urls(
    pages: DataFrame,
    site_rules: tuple[SiteRule, ...] = SITE_RULES,
    pattern_rules: tuple[PatternRule, ...] = PATTERN_RULES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Host, path, deciding site rule (else null), deciding pattern (else null) and verdict of each row."""
    rules = [*site_rules, *pattern_rules]
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    spark = pages.sparkSession
    url = pages[url_column]
    # repeated rows become a count, so a repeated URL costs its work once
    rows = pages.select(pages[id_column].alias("_id"), url.alias("_url")).groupBy("_id", "_url").agg(F.count(F.lit(1)).alias("_rows"))
    lowered = ascii_lower(F.coalesce(F.col("_url"), F.lit("")))
    urls = rows.select("*", F.array_distinct(F.regexp_extract_all(lowered, F.lit(TOKEN), 0)).alias("_tokens"))

    counts = _token_counts(urls, set().union(*[r.literals() for r in rules])) if rules else {}
    index = [
        (i, min(r.literals(), key=lambda t: (counts.get(t, 0), t), default=""), r.regex, isinstance(r, SiteRule), len(r.name), len(getattr(r, "host", "")), r.verdict, r.name)
        for i, r in enumerate(rules)
    ]
    schema = "number int, token string, regex string, site boolean, length int, host_length int, verdict string, name string"
    filed = F.broadcast(spark.createDataFrame(index, schema))

    # the empty token fetches the rules that have no literal
    tokens = urls.select("_id", "_url", "_rows", F.explode(F.array_append("_tokens", F.lit(""))).alias("token"))
    subject = F.when(F.col("site"), F.concat(host_of(F.col("_url")), path_of(F.col("_url")))).otherwise(lowered)
    fits = tokens.join(filed, "token", "left")
    fits = fits.withColumn("fits", F.when(F.col("number").isNotNull(), F.regexp_like(subject, F.col("regex"))))
    # longest name, then longest host, then block, then the first rule
    blocks = F.col("verdict") == "block"
    site_rank = F.struct("length", "host_length", blocks, -F.col("number"))
    pattern_rank = F.struct(blocks, -F.col("number"))
    site = F.col("fits") & F.col("site")
    pattern = F.col("fits") & ~F.col("site")
    decided = F.struct("name", "verdict")
    best = fits.groupBy("_id", "_url").agg(
        F.first("_rows").alias("_rows"),
        F.max_by(decided, F.when(site, site_rank)).alias("_site"),
        F.max_by(decided, F.when(pattern, pattern_rank)).alias("_pattern"),
    )
    return best.select(
        F.col("_id").alias(id_column),
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        F.col("_site.name").alias("rule"),
        F.when(F.col("_site.name").isNull(), F.col("_pattern.name")).alias("pattern"),
        F.coalesce("_site.verdict", "_pattern.verdict", F.lit("allow")).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))).alias("_copy"),
    ).drop("_copy")
