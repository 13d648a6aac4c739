r"""URL filters by hashed host-suffix / path-prefix expressions (DataFrame operations only).

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A null url or one
without ``://`` has an empty host and path. A rule (host, path, verdict) fits its
host and all subdomains when the url's path starts with the rule's path; of the
rules that fit the longest (host and path together, then host, then block before
allow) decides, and without one the default verdict holds.

Method. The distinct (host, path) of the urls are expanded into expressions
``host suffix + path prefix``: every suffix at a label boundary, and the path
prefixes whose lengths occur among the rules (a few numbers), so rules need not
end at a slash. Expressions and rules meet in an equi-join on one number, the first 4 bytes
of their SHA-256. These candidates are written out; over that table the full digest
confirms the match (the optimiser can't move it into the join), and ``max`` over the
precedence picks the rule. Only expressions go through the join, never html. The rules are a
literal table of known size.

Defined results: every input row gives one row, repeated rows too; empty rule
tables give the default; duplicate rules count once; rules with a null host or
path are ignored. Extra columns stay unless named like an output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard.llm.common import ascii_lower, stage

DEFAULT = "allow"
#: The contract's rules: host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
PREFIX_HEX = 8


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as a literal table, made in the JVM."""
    # Named markers: positional ones are not bound in the order they are written in.
    rows = ", ".join(f"(:host{i}, :path{i}, :verdict{i})" for i in range(len(rules)))
    args = {f"{name}{i}": x for i, rule in enumerate(rules) for name, x in zip(("host", "path", "verdict"), rule, strict=True)}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(host, path, verdict)", args=args)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path, expr): every host suffix with every path prefix of a rule's length."""
    suffixes = F.expr(
        "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))"
    )
    n = F.char_length("path")
    out = urls.where("host <> ''").withColumn("labels", F.split("host", "[.]", -1))
    out = out.withColumn("suffix", F.explode(suffixes))
    allowed = F.array(*[F.lit(x) for x in lengths]).cast("array<int>")
    out = out.withColumn("n", F.explode(F.filter(allowed, lambda x: x <= n)))
    return out.select("host", "path", F.concat("suffix", F.expr("substring(path, 1, n)")).alias("expr"))


def candidates(found: DataFrame, rules: DataFrame) -> DataFrame:
    """Expressions with the rules that share their prefix, not confirmed yet."""
    return found.join(rules, "prefix").drop("expr")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) that a rule decides."""
    rules = rules.where("host is not null and path is not null").select(
        ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("says")
    ).distinct()
    # The different lengths of rule paths: at most as many as a path has characters.
    lengths = sorted(r[0] for r in rules.select(F.char_length("rule_path")).distinct().collect())
    digest = lambda c: F.sha2(c, 256)
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("rule_digest", digest(F.col("rule")))
    prefix = lambda c: F.conv(F.substring(c, 1, PREFIX_HEX), 16, 10).cast("long")
    rules = rules.withColumn("prefix", prefix("rule_digest"))
    found = expressions(urls, lengths).withColumn("digest", digest(F.col("expr")))
    found = stage(candidates(found.withColumn("prefix", prefix("digest")), rules), "url-candidates")
    # "a.b" + "c/" and "a.bc" + "/" are one string: the split is confirmed too.
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", F.col("rule_path")) & (
        (F.col("host") == F.col("rule_host")) | F.endswith("host", F.concat(F.lit("."), "rule_host"))
    )
    rank = F.struct(
        F.char_length("rule"), F.char_length("rule_host"), (F.col("says") == "block").alias("blocks"), "rule", "says"
    )
    best = found.where(fits).groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.says").alias("verdict"))


def url_filter(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages`` (url and any other columns) with host, path, rule, verdict."""
    own = ("host", "path", "rule", "verdict")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(*[c for c in pages.columns if c not in own], host.alias("host"), path.alias("path"))
    # Written out, the decided (host, path) are a plain scan of known size: broadcast only if
    # that is small, else both sides are shuffled and a hot url is split at run time.
    hits = stage(matches(rows.select("host", "path").distinct(), rules), "url-hits")
    out = rows.join(hits, ["host", "path"], "left")
    return out.select(*[c for c in pages.columns if c not in own], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op3_url_filters(pages: DataFrame) -> DataFrame:
    out = url_filter(pages.select("page_id", "url"), rules_table(pages.sparkSession))
    return out.select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rhost, rpath, says) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.says,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost) + length(r.rpath) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM best WHERE n = 1
"""
