"""URL rules, each indexed by its rarest literal token.

A rule fits a host and all its subdomains, and paths that start with the rule's path, where
``*`` stands for any characters. Its literal tokens are its host labels and its whole path
segments: every URL it fits has them all. A rule is filed under the one that fewest URLs have.
URL tokens fetch candidate rules through an equi-join, and only these run the regular
expression. The longest fitting rule decides; ties go to ``block``, then to the smaller text.

Defined results: a URL that is null or has no ``://`` has an empty host and path, no rule and the
default verdict. A rule without a literal token is a candidate for every URL. Rules that are null or
have no host are left out, copies of a rule count once. Rows with the same id or URL each keep
their row. Further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import ascii_lower, picked
from rankflow.session import cut

ANY_TOKEN = "*"
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """Lower-cased text between the first ``://`` and the next ``/``, ``?`` or ``#``; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(host: Column, segments: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.transform(segments, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, parts), lambda x: F.length(x) > 2))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct host labels and path segments, and the token that all URLs share."""
    return F.concat(_tokens(host, F.split(path, "/")), F.array(F.lit(ANY_TOKEN)))


def compile_rules(rules: DataFrame) -> DataFrame:
    """``(rule, verdict, pattern, tokens)`` of ``(verdict, rule)``; a rule is its host and path."""
    named = picked(rules, verdict="verdict", rule="rule").filter("rule IS NOT NULL").distinct()
    host = ascii_lower(F.regexp_extract("rule", r"(?s)^([^/]*)", 1))
    path = F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1)
    split = named.select("rule", "verdict", host.alias("host"), path.alias("path"))
    # A path segment is whole where a slash closes it; parts with a wildcard are no literals.
    whole = F.slice(F.split("path", "/"), F.lit(1), F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0)))
    literals = F.filter(_tokens(F.col("host"), whole), lambda x: ~x.contains("*"))
    escaped = [
        F.regexp_replace(F.regexp_replace(c, r"([^A-Za-z0-9*])", r"\\$1"), r"\*", "[^\\\n]*")
        for c in ("host", "path")
    ]
    pattern = F.concat(F.lit(r"(?s)^([^\n]*\.)?"), escaped[0], F.lit("\n"), escaped[1])
    return split.filter("host != ''").select("rule", "verdict", pattern.alias("pattern"), literals.alias("tokens"))


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Compiled rules with the ``token`` they are filed under; ``tokens`` holds a row per URL and token."""
    uses = rules.select("rule", "verdict", F.explode("tokens").alias("token"))
    wanted = uses.select("token").distinct()
    counts = tokens.join(wanted, "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = (
        uses.join(counts, "token", "left")
        .groupBy("rule", "verdict")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("least"))
    )
    filed = F.coalesce("least.token", F.lit(ANY_TOKEN)).alias("token")
    return rules.join(rarest, ["rule", "verdict"], "left").select("rule", "verdict", "pattern", filed)


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` per row of ``pages``.

    Rules run over distinct URLs, so a URL that a third of all rows share is matched once.
    """
    url = F.col("url")
    parsed = picked(pages, id=id_col, url=url_col).select(
        "id", url_host(url).alias("host"), url_path(url).alias("path")
    )
    urls = cut(parsed.select("host", "path").filter("host != ''").distinct(), "urls")
    tokens = urls.select("host", "path", F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
    index = cut(index_rules(compile_rules(rules), tokens), "rules")
    # Host and path meet the pattern as two lines; a line break inside them counts as a space.
    lines = F.concat(F.translate("host", "\n", " "), F.lit("\n"), F.translate("path", "\n", " "))
    hits = tokens.join(index, "token").filter(F.rlike(lines, F.col("pattern")))
    order = F.struct(
        F.length("rule").alias("size"), (F.col("verdict") == "block").alias("block"),
        F.col("rule"), F.col("verdict"),
    )
    # The larger of two texts of equal length must lose, which max() over the text cannot say.
    longest = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("size"), (F.col("verdict") == "block").alias("block"))).alias("top"),
        F.collect_set(order).alias("all"),
    )
    fitting = F.filter("all", lambda x: (x["size"] == F.col("top.size")) & (x["block"] == F.col("top.block")))
    best = longest.select("host", "path", F.array_min(fitting).alias("best"))
    judged = cut(best.select("host", "path", "best.rule", "best.verdict"), "judged")
    return parsed.join(judged, ["host", "path"], "left").select(
        "id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
