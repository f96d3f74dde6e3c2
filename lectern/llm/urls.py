"""Verdicts on URLs by host rules and by pattern rules that are indexed by their rarest literal token.

A host rule (host, path) fits a host and all its subdomains when the URL's path begins with the rule's; the
longest rule that fits decides. URLs that no host rule fits are judged by pattern rules. In a pattern, ``||``
is the start of the host or of one of its labels, ``^`` a character that is no letter, digit, ``_``, ``-``,
``.`` or ``%``, or the end, ``*`` any text, and ``|`` at either end the URL's start or end; all else is literal.

A word of letters and digits that stands whole in a pattern is one of its literal tokens: every URL that the
pattern matches holds it as a token. Counting those tokens in the URLs tells the rarest of each pattern. Each
distinct URL fetches, by an equality join on its tokens, the patterns filed under them, and only those run
their regular expressions. Patterns without a token are run on every URL, all in one pass. A list of patterns may
come from a table (``read_patterns``).

Null URLs and URLs without ``://`` have empty host and path and no rule; pattern rules still see their text.
Repeated rows get the same verdict each; an empty table gives no rows. URLs of any length are read whole. Columns
beside page_id and url are not read, whatever their names.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"


#: Bytes of pattern text up to which the index goes to every task; a larger one meets the tokens in a shuffle.
INDEX_BYTES = 8 << 20
#: Bytes of a table of patterns, at most; it passes through the driver.
RULE_BYTES = 64 << 20


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str


class Pattern(NamedTuple):
    verdict: str
    text: str


#: What the method blocks when no host rule fits; exceptions win over blocks.
PATTERNS = (
    Pattern(BLOCK, "||cheap-pills."),
    Pattern(BLOCK, "||spam-farm."),
    Pattern(BLOCK, "||casino."),
    Pattern(BLOCK, "||casino-*.com^"),
    Pattern(BLOCK, "||ads."),
    Pattern(BLOCK, "||adserver."),
    Pattern(BLOCK, "||tracker."),
    Pattern(BLOCK, "||malware."),
    Pattern(BLOCK, "||phishing."),
    Pattern(BLOCK, "||warez."),
    Pattern(BLOCK, "||xxx."),
    Pattern(BLOCK, ".onion^"),
    Pattern(BLOCK, "/wp-login.php"),
    Pattern(BLOCK, "/phpmyadmin/"),
    Pattern(BLOCK, "/adserver/"),
    Pattern(BLOCK, "/banner/ads/"),
    Pattern(BLOCK, ".exe|"),
    Pattern(BLOCK, ".apk|"),
    Pattern(BLOCK, "/download-*-crack^"),
    Pattern(BLOCK, "^affiliate_id="),
    Pattern(ALLOW, "||docs.*/malware."),
)

_ANCHOR = r"(^[a-z][a-z0-9+.-]*://([^/?#]*\.)?|^([^/?#:]*\.)?)"
_SEPARATOR = r"([^a-z0-9_.%-]|$)"
_WORD = re.compile(r"[a-z0-9]+")


def regex(pattern: str) -> str:
    """The pattern as a regular expression on a lower-cased URL, in the syntax common to Java, RE2 and Python."""
    body, front, back = pattern.lower(), "", ""
    if body.startswith("||"):
        body, front = body[2:], _ANCHOR
    elif body.startswith("|"):
        body, front = body[1:], "^"
    if body.endswith("|"):
        body, back = body[:-1], "$"
    special = {"*": ".*", "^": _SEPARATOR}
    return front + "".join(special.get(c) or (c if c.isalnum() or c in "-_/=%&" else "\\" + c) for c in body) + back


def tokens_of(pattern: str) -> list[str]:
    """Words that every URL the pattern matches holds as whole tokens."""
    body = pattern.lower()
    edge = lambda c, outer: c in "|^" if c else outer
    out = []
    for m in _WORD.finditer(body):
        before, after = body[: m.start()][-1:], body[m.end() :][:1]
        whole_left = edge(before, False) or bool(before) and before not in "*" and not before.isalnum()
        whole_right = edge(after, False) or bool(after) and after not in "*" and not after.isalnum()
        if whole_left and whole_right:
            out.append(m.group())
    return sorted(set(out))


def read_patterns(rules: DataFrame) -> tuple[Pattern, ...]:
    """Patterns from a table of (verdict, pattern), sorted. Verdicts are ``block`` or ``allow``, in any case.

    Null and blank patterns and comments, which begin with ``!``, are left out; repeated ones count once. Raises
    ValueError for another verdict and for a table of more than ``RULE_BYTES``.
    """
    text = F.trim("pattern")
    listed = rules.select(F.lower(F.trim("verdict")).alias("verdict"), text.alias("pattern")).where((F.length(text) > 0) & ~text.startswith("!"))
    wrong = ~F.coalesce(F.col("verdict").isin(BLOCK, ALLOW), F.lit(False))
    size, unknown = listed.agg(F.sum(F.octet_length("pattern")), F.count_if(wrong)).first()
    if unknown:
        raise ValueError(f"{unknown} patterns with a verdict other than {BLOCK} and {ALLOW}")
    if (size or 0) > RULE_BYTES:
        raise ValueError(f"{size} bytes of patterns, more than {RULE_BYTES}")
    return tuple(sorted(Pattern(r.verdict, r.pattern) for r in listed.distinct().collect()))


def host_and_path(url: Column) -> tuple[Column, Column]:
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, shape, 1), upper, lower), F.regexp_extract(text, shape, 2)


def host_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host) + len(r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(url), F.lit("([a-z0-9]+)"), F.lit(1)))


def index_patterns(urls: DataFrame, patterns: tuple[Pattern, ...]) -> DataFrame:
    """Patterns with the token they are filed under: token, verdict, text, regex. ``urls`` has the column url."""
    spark = urls.sparkSession
    of = {p.text: tokens_of(p.text) for p in patterns}
    words = sorted({w for ws in of.values() for w in ws})
    listed = spark.createDataFrame([(w,) for w in words], "token string")
    tokens = urls.select(F.explode(_tokens(F.col("url"))).alias("token"))
    # Either way a token that most URLs hold leaves each task as one count.
    if sum(map(len, words)) <= INDEX_BYTES:
        seen = tokens.join(F.broadcast(listed), "token", "left_semi").groupBy("token").count()
    else:
        seen = tokens.groupBy("token").count().join(listed, "token", "left_semi")
    often = {r[0]: r[1] for r in seen.collect()}  # at most one row per token of the rules
    rows = [(min(of[p.text], key=lambda w: (often.get(w, 0), w)) if of[p.text] else None, p.verdict, p.text, regex(p.text)) for p in patterns]
    return spark.createDataFrame(rows, "token string, pattern_verdict string, pattern string, regex string")


def match_patterns(urls: DataFrame, patterns: tuple[Pattern, ...]) -> DataFrame:
    """url, pattern and pattern_verdict of each distinct URL that a pattern matches.

    Exceptions win; among patterns of the same verdict the first in the alphabet is named.
    """
    distinct = urls.where(F.col("url").isNotNull()).select("url").distinct()
    index = index_patterns(distinct, patterns)
    filed = index.where(F.col("token").isNotNull())
    if sum(len(p.text) for p in patterns) <= INDEX_BYTES:
        filed = F.broadcast(filed)
    by_token = distinct.withColumn("token", F.explode(_tokens(F.col("url")))).join(filed, "token").drop("token")
    found = by_token.where(F.rlike(F.lower("url"), F.col("regex"))).select("url", "pattern_verdict", "pattern")
    if bare := [p for p in patterns if not tokens_of(p.text)]:
        named = lambda p: F.struct(F.lit(p.verdict).alias("pattern_verdict"), F.lit(p.text).alias("pattern"))
        hits = F.array(*[F.when(F.lower("url").rlike(regex(p.text)), named(p)) for p in bare])
        hit = distinct.select("url", F.explode(F.array_compact(hits)).alias("hit"))
        found = found.unionByName(hit.select("url", "hit.pattern_verdict", "hit.pattern"))
    best = F.min(F.struct("pattern_verdict", "pattern")).alias("best")  # "allow" comes before "block"
    return found.groupBy("url").agg(best).select("url", "best.pattern_verdict", "best.pattern")


def judge(pages: DataFrame, rules: tuple[HostRule, ...], patterns: tuple[Pattern, ...] = PATTERNS, default: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every page."""
    rows = pages.select("page_id", "url")
    matched = match_patterns(rows, patterns)
    host, path = host_and_path(F.col("url"))
    name, verdict = host_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(matched, "url", "left").withColumn("host", host).withColumn("path", path)
    ruled = judged.withColumn("rule", name).withColumn("ruled", verdict)
    return ruled.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "pattern_verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("pattern")).alias("pattern"),
    )


def judge_sql(rules: tuple[HostRule, ...], patterns: tuple[Pattern, ...] = PATTERNS, default: str = ALLOW) -> str:
    """The same by SQL that runs every pattern on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    longest = sorted(rules, key=lambda r: -len(r.host) - len(r.path))
    fit = lambda r: f"(host = {quote(r.host)} OR ends_with(host, {quote('.' + r.host)})) AND starts_with(path, {quote(r.path)})"
    names = " ".join(f"WHEN {fit(r)} THEN {quote(r.host + r.path)}" for r in longest)
    verdicts = " ".join(f"WHEN {fit(r)} THEN {quote(r.verdict)}" for r in longest)
    listed = ", ".join(f"({quote(p.verdict)}, {quote(p.text)}, {quote(regex(p.text))})" for p in patterns)
    return f"""
WITH parts AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(v, p, r) AS (VALUES {listed}),
found AS (
  SELECT url, min(struct_pack(v := v, p := p)) AS best
  FROM (SELECT DISTINCT url FROM pages) u JOIN rules ON regexp_matches(lower(url), r) GROUP BY url),
ruled AS (
  SELECT parts.*, CASE {names} END AS rule, CASE {verdicts} END AS ruled, best
  FROM parts LEFT JOIN found ON parts.url = found.url)
SELECT page_id, host, path, rule, coalesce(ruled, best.v, {quote(default)}) AS verdict,
  CASE WHEN ruled IS NULL THEN best.p END AS pattern
FROM ruled"""
