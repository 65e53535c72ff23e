"""URL filters: pattern rules behind an index of their rarest literal token.

A url is judged by its address: the host (after the first ``://`` up to ``/``,
``?``, ``#`` or the end, A-Z lower-cased) and the path (from there up to ``?``,
``#`` or the end).  A null url, or one without ``://``, has an empty address.

Two kinds of rules, all compiled to regular expressions over the address:
host rules ``host/path`` fit a host, all its subdomains and every path that
starts with theirs; the longest that fits wins.  Pattern rules, for urls that no
host rule fits, are globs over the address: ``*`` any text, ``^`` a character
other than a letter, digit, ``-``, ``.`` or ``%`` or the end, ``||`` in front the
start of a host label, ``|`` the start; the longest that fits blocks.

Literal tokens are runs of [a-z0-9] whose neighbours in the rule are literal
other characters, so an address that fits holds them as whole tokens.  Token
counts over all addresses give each rule its rarest one.  The tokens of an
address fetch the rules filed under them, and only these are run.  Rules without
a literal token are filed under a token that every address holds (none of the
rules below needs it).

Addresses are judged once each and joined back, so a url that fills a third of
the table is one row to judge.  The joins are equi-joins of sizes Spark sees.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.llm.common import fresh

# fixed values: the host rules
HOST_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]
# fixed values: the pattern rules, which all block
PATTERN_RULES = [
    "||ads-track.", "||spam-farm.", "||casino-win.", "||adult-x.", "||cheap-pills.", "||free-bets.",
    "/wp-admin^", "/cgi-bin/*.exe^", "-torrent-",
]
EVERY = ""
RULES = "kind string, rule string, action string, regex string, tokens array<string>"


def host_rule(action: str, rule: str) -> tuple:
    host, slash, path = rule.partition("/")
    fit = r"^([^/]*\.)?" + re.escape(host) + re.escape(slash + path)
    # the last token of a path may go on in the address
    tokens = re.findall(r"[a-z0-9]+", host) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", (slash + path).lower())
    return ("host", rule, action, fit, tokens)


def pattern_rule(rule: str) -> tuple:
    body = rule.lstrip("|")
    start = {"||": r"^([^/]*\.)?", "|": "^"}.get(rule[: len(rule) - len(body)], "")
    one = {"*": ".*", "^": r"([^a-zA-Z0-9.%-]|$)"}
    fit = "(?s)" + start + "".join(one.get(c, re.escape(c)) for c in body)
    framed = (" " if start else "*") + body + "*"
    tokens = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", framed.lower())
    return ("pattern", rule, "block", fit, tokens)


def compiled(spark, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    rows = [host_rule(*r) for r in host_rules] + [pattern_rule(r) for r in pattern_rules]
    return spark.createDataFrame(rows, RULES)


def host_of(url: Column) -> Column:
    whole = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(address: Column) -> Column:
    found = F.regexp_extract_all(F.lower(address), F.lit("([a-z0-9]+)"))
    return F.concat(F.array_distinct(found), F.array(F.lit(EVERY)))


def indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with its rarest token, by counts over ``tokens`` (token)."""
    wanted = rules.select("rule", "kind", F.explode("tokens").alias("token"))
    asked = wanted.select("token").distinct()
    counts = tokens.join(asked, "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule", "kind")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return rules.join(rarest, ["rule", "kind"], "left").withColumn("token", F.coalesce("token", F.lit(EVERY)))


def verdicts(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and pattern (of the pattern rule
    that blocks).  Columns with these names are replaced; rows repeat as given."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "pattern")]
    rows = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    address = F.concat("host", "path")
    each = rows.select(address.alias("a")).distinct()
    tokens = each.select("a", F.explode(tokens_of(F.col("a"))).alias("token"))
    index = indexed(rules, tokens.select("token"))
    fits = tokens.join(index, "token").filter(F.expr("a rlike regex"))
    picked = fits.groupBy("a").agg(
        F.max(F.when(F.col("kind") == "host", F.struct(F.length("rule").alias("n"), "rule", "action"))).alias("h"),
        F.max(F.when(F.col("kind") == "pattern", F.struct(F.length("rule").alias("n"), "rule", "action"))).alias("p"),
    )
    a = fresh("a", rows.columns)
    found = picked.select(F.col("a").alias(a), F.struct("h", "p").alias(fresh("found", rows.columns)))
    f = F.col(found.columns[1])
    joined = rows.withColumn(a, address).join(found, a, "left")
    return joined.select(
        *kept, "host", "path", f["h"]["rule"].alias("rule"),
        F.coalesce(f["h"]["action"], f["p"]["action"], F.lit("allow")).alias("verdict"),
        F.when(f["h"].isNull(), f["p"]["rule"]).alias("pattern"),
    )


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = [host_rule(*r) for r in HOST_RULES] + [pattern_rule(r) for r in PATTERN_RULES]
    values = ", ".join(f"({quote(k)}, {quote(r)}, {quote(a)}, {quote(x)})" for k, r, a, x, _ in rows)
    return f"""
with u as (select row_number() over () n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from pages),
r(kind, rule, action, fit) as (values {values}),
f as (select n, kind, max({{'n': length(rule), 'rule': rule, 'action': action}}) b
      from u join r on regexp_matches(host || path, fit) group by n, kind)
select page_id, host, path, h.b.rule as rule, coalesce(h.b.action, p.b.action, 'allow') verdict,
       case when h.n is null then p.b.rule end as pattern
from u left join (select * from f where kind = 'host') h using (n)
left join (select * from f where kind = 'pattern') p using (n)
"""


SQL = _sql()
