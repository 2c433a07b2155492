"""URL filters: host and path rules, and pattern rules indexed by their rarest literal token; DataFrame operations only.

A host rule fits its host and all subdomains, on paths that start with its own; the longest fitting rule decides. Where none
fits, the pattern rules do: each is a regular expression with the literal tokens that any match must contain.
Of these the one that the fewest URLs hold is the rule's key. A URL's tokens fetch the rules of their keys, and
only those are tried. A matching allow pattern goes before a block pattern; without any match the verdict is allow.

Defined cases: a null URL, or one without `://`, has empty host and path, fits no host rule and is judged by
patterns on the empty text (so: allowed); equal URLs are judged once and rows repeat as they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The given rules: (host, path, verdict).
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# Pattern rules: (regular expression on the lower-cased URL, literal tokens that every match has, verdict).
PATTERN_RULES = (
    (r"^[a-z]+://([^/?#]*\.)?spam-farm\.", ("spam", "farm"), "block"),
    (r"^[a-z]+://([^/?#]*\.)?free-bets\.", ("free", "bets"), "block"),
    (r"^[a-z]+://([^/?#]*\.)?free-spins\.", ("free", "spins"), "block"),
    (r"^[a-z]+://([^/?#]*\.)?ads-track\.", ("ads", "track"), "block"),
    (r"^[a-z]+://([^/?#]*\.)?casino\.", ("casino",), "block"),
    (r"^[a-z]+://([^/?#]*\.)?adult\.", ("adult",), "block"),
    (r"[?&]utm_medium=(cpc|banner|popup)(&|#|$)", ("utm", "medium"), "block"),
    (r"\.exe([?#]|$)", ("exe",), "block"),
    (r"/(wp-login|xmlrpc)\.php", (), "block"),  # also fits .php5, so no token is in every match
)
# Key of rules without a literal token of their own: such rules are tried on every URL.
ANY = ""
TOKEN = "[a-z0-9]+"


def parts(url):
    """(host, path) as the contract cuts them; both empty without `://`."""
    found = F.locate("://", url) > 0
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(""), F.when(found, path).otherwise("")


def host_rule(host, path, rules=HOST_RULES):
    """The longest fitting rule as (name, verdict), or null; ties go to the rule named first."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in reversed(longest):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def rule_index(urls: DataFrame, rules=PATTERN_RULES) -> DataFrame:
    """(token, pattern, verdict): each rule under that of its literal tokens that the fewest URLs hold."""
    spark = urls.sparkSession
    # The rules are a parameter: as many rows as it names.
    given = spark.createDataFrame(
        [(i, p, list(tokens) or [ANY], v) for i, (p, tokens, v) in enumerate(rules)],
        "number int, pattern string, tokens array<string>, verdict string",
    )
    wanted = given.select("number", "pattern", "verdict", F.explode("tokens").alias("token"))
    asked = F.broadcast(wanted.select("token").distinct())
    seen = urls.select(F.explode("__tokens").alias("token")).join(asked, "token").groupBy("token").count()
    ranked = wanted.join(F.broadcast(seen), "token", "left").fillna(0, ["count"])
    return ranked.groupBy("number", "pattern", "verdict").agg(F.min(F.struct("count", "token")).alias("rarest")).select(
        "number", "pattern", "verdict", F.col("rarest.token").alias("token")
    )


def judge(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """page_id, url, host, path, rule, verdict and pattern (the deciding one) of every row."""
    rows = pages.select(F.col("page_id").alias("__page"), F.col("url").alias("__url"))
    host, path = parts(F.col("__url"))
    urls = rows.select("__url").distinct().withColumns({"__host": host, "__path": path})
    name, verdict = host_rule(F.col("__host"), F.col("__path"), host_rules)
    low = F.lower(F.coalesce("__url", F.lit("")))
    tokens = F.array_union(F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0)), F.array(F.lit(ANY)))
    urls = urls.withColumns({"__rule": name, "__ruled": verdict, "__low": low, "__tokens": tokens})
    index = F.broadcast(rule_index(urls, pattern_rules))  # as many rows as rules
    open_urls = urls.filter("__ruled is null").select("__url", "__low", F.explode("__tokens").alias("token"))
    matches = open_urls.join(index, "token").filter("__low rlike pattern")
    # One decision a URL: allow before block, then the rule named first.
    decided = matches.groupBy("__url").agg(
        F.min(F.struct("verdict", "number", "pattern")).alias("__first")
    ).select(F.col("__url").alias("__decided"), "__first")
    judged = urls.join(decided, F.col("__url").eqNullSafe(F.col("__decided")), "left").select(
        F.col("__url").alias("__of"), "__host", "__path", "__rule",
        F.coalesce("__ruled", "__first.verdict", F.lit("allow")).alias("__verdict"), F.col("__first.pattern").alias("__pattern"),
    )
    return rows.join(judged, F.col("__url").eqNullSafe(F.col("__of"))).select(
        F.col("__page").alias("page_id"), F.col("__url").alias("url"), F.col("__host").alias("host"),
        F.col("__path").alias("path"), F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict"),
        F.col("__pattern").alias("pattern"),
    )
