"""URL filters: pattern rules that are looked up by their rarest literal token.

A pattern is literal text with ``*`` (anything), ``^`` (a character that is no letter or digit, or the end),
``|`` at an end (start or end of the url) and ``||`` at the start (start of the host or of one of its labels). It
is compiled to a regular expression. A token is a run of ASCII letters and digits of the lower-cased url; the
tokens that a pattern surely needs whole are the runs that are fenced on both sides by a literal other
character, a ``^`` or an anchor. Of these the one that fewest urls contain is the pattern's index key.

Plan: the distinct urls are cut into tokens, the tokens meet the index in a join, and only the patterns that are
fetched this way run, each as a column of its row. Patterns without a safe token are tried on every url.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import lowered

TOKEN = "[a-z0-9]+"
#: Blocked and (with a leading ``@@``) allowed patterns of the registered query. An allowed pattern wins.
PATTERNS = (
    "||spam-farm.", "||ads.", "^casino^", "/wp-login.", "^phpsessid^", "^sessionid^", "|ftp://", "/trackback|",
    "/cgi-bin/*.exe|", "&affiliate=*&campaign=", "@@/robots.txt|",
)


@dataclass(frozen=True)
class Site:
    """A rule on a host with all its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


SITES = (
    Site("allow", "org", "/"), Site("block", "example.org", "/es/"), Site("block", "example.org", "/en/1"),
    Site("allow", "com", "/fr/"), Site("block", "com", "/de/"),
)


def compiled(pattern: str) -> str:
    """The regular expression of a pattern, for lower-cased urls; it is the same in Java, Python and RE2."""
    body, start, end = pattern.lower(), "", ""
    if body.startswith("||"):
        body, start = body[2:], r"^[a-z][a-z0-9+.\-]*://([^/?#]*\.)?"
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], "$"
    middle = "".join(
        ".*" if c == "*" else "([^a-z0-9]|$)" if c == "^" else c if re.fullmatch("[a-z0-9]", c) else "\\" + c if c.isascii() else c
        for c in body
    )
    return f"(?s){start}{middle}{end}"


def safe_tokens(pattern: str) -> list[str]:
    """Tokens that every matching url contains whole."""
    body = pattern.lower()
    fenced_start, fenced_end = body.startswith("|"), body.endswith("|")
    body = body.strip("|")
    found = []
    for run in re.finditer(TOKEN, body):
        left = body[run.start() - 1] != "*" if run.start() else fenced_start
        right = body[run.end()] != "*" if run.end() < len(body) else fenced_end
        if left and right and run.group() not in found:
            found.append(run.group())
    return found


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_rule(host_name: Column, url_path: Column, sites: tuple[Site, ...] = SITES) -> Column:
    """The longest site rule that fits, as a struct of name and verdict; null if none fits."""
    best = F.lit(None).cast("struct<rule: string, verdict: string>")
    for site in sorted(sites, key=lambda s: len(s.name)):
        fits = ((host_name == site.host) | host_name.endswith("." + site.host)) & url_path.startswith(site.path)
        best = F.when(fits, F.struct(F.lit(site.name).alias("rule"), F.lit(site.verdict).alias("verdict"))).otherwise(best)
    return best


def pattern_table(spark, patterns: tuple[str, ...]) -> DataFrame:
    """(pattern, expression, verdict, safe): the rules as rows, with the tokens they may be indexed by."""
    rows = []
    for text in dict.fromkeys(patterns):
        allowed = text.startswith("@@")
        bare = text[2:] if allowed else text
        rows.append((text, compiled(bare), "allow" if allowed else "block", safe_tokens(bare)))
    return spark.createDataFrame(rows, "pattern string, expression string, verdict string, safe array<string>")


def token_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rules with ``token``, the safe token that fewest urls contain; null where a rule has none.

    Only tokens that rules ask for are counted, so the counts are no larger than the rules.
    """
    wanted = rules.select("pattern", F.explode("safe").alias("token"))
    seen = tokens.join(wanted.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = (
        wanted.join(seen, "token", "left").groupBy("pattern")
        .agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), -F.length("token"), "token")).alias("token"))
    )
    return rules.drop("safe").join(rarest, "pattern", "left")


def pattern_verdicts(urls: DataFrame, patterns: tuple[str, ...] = PATTERNS) -> DataFrame:
    """(url, pattern, verdict) of the distinct non-null urls that some pattern fits; an allowed one wins, then
    the smaller pattern."""
    distinct = urls.select("url").filter("url IS NOT NULL").distinct()
    small = lowered(F.col("url"))
    tokens = distinct.select("url", F.explode(F.array_distinct(F.regexp_extract_all(small, F.lit(TOKEN), F.lit(0)))).alias("token"))
    rules = token_index(pattern_table(urls.sparkSession, patterns), tokens)
    fetched = tokens.join(rules.filter("token IS NOT NULL"), "token").drop("token")
    loose = [
        (p, compiled(p.removeprefix("@@")), "allow" if p.startswith("@@") else "block")
        for p in dict.fromkeys(patterns) if not safe_tokens(p.removeprefix("@@"))
    ]
    if loose:
        known = F.array(*[
            F.struct(F.lit(p).alias("pattern"), F.lit(e).alias("expression"), F.lit(v).alias("verdict")) for p, e, v in loose
        ])
        fetched = fetched.unionByName(distinct.select("url", F.inline(known)))
    fits = fetched.filter(F.expr("translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') RLIKE expression"))
    first = F.min(F.struct("verdict", "pattern"))  # 'allow' is before 'block'
    return fits.groupBy("url").agg(first.alias("m")).select("url", "m.pattern", "m.verdict")


def judge(pages: DataFrame, sites: tuple[Site, ...] = SITES, patterns: tuple[str, ...] = PATTERNS) -> DataFrame:
    """Every row of (page_id, url) with host, path, rule, pattern and verdict.

    A site rule that fits decides; else a pattern that fits; else the url is allowed. A null url, or one without
    ``://``, has empty host and path, so no site rule fits; a null url fits no pattern. Repeated rows are judged
    alike and all kept, other columns are ignored, no rows give no rows.
    """
    found = pattern_verdicts(pages, patterns).select(
        F.col("url").alias("_url"), "pattern", F.col("verdict").alias("by_pattern")
    )
    judged = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).join(
        found, F.col("url") == F.col("_url"), "left"
    )
    site = site_rule(F.col("host"), F.col("path"), sites)
    return judged.withColumn("site", site).select(
        "page_id", "host", "path", F.col("site.rule").alias("rule"), "pattern",
        F.coalesce("site.verdict", "by_pattern", F.lit("allow")).alias("verdict"),
    )
