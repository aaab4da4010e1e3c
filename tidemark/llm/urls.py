"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule (host, path, verdict) fits its host and all its subdomains, for urls whose
path starts with the rule's path; the longest rule wins.

Canonical keys: host labels reversed and joined by a dot, then ``#``, then the path
(``com.example#/en/``).  ``#`` can't stand in a host or a path, so all urls that a
rule fits on one host are exactly those whose key starts with the rule's key: an
interval of the key order.  A url stands once for each of its host's suffixes that
some rule names, so subdomains need no second dimension.

Rule intervals on one host nest or are disjoint.  Rules and urls are sorted
together by key; at each point the rules that are open form a stack, and the
stack after the last rule before a url holds every rule that can fit it.  The
stack of a rule (itself and the rules whose keys begin its key) is built once, on
the rules alone, by looking up the rule's own path prefixes.  The sweep carries
the latest stack over the urls that follow; a url takes the deepest open rule that
is a prefix of its key.

The sort is a range partitioning on (key, url), so a host with a third of all rows
is cut like any other, and each partition starts with the last stack of those
before it (one row a partition).  Equal urls are judged once: distinct (host, path)
pairs are swept, and joined back.

Defined results: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; rules with a null or an empty host are ignored; of
equal rules ``block`` wins; without rules every url gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

DEFAULT = "allow"
#: The contract's rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    rest = F.substring_index(_rest(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(rev, path, stack): for each rule key its open rules, shortest path first, as (path, verdict)."""
    one = (
        rules.where(F.col("host").isNotNull() & (F.col("host") != ""))
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(reversed_host(F.col("host")).alias("rev"), "host", "path", "verdict")
    )
    prefixes = one.select("rev", F.col("path").alias("of"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("k")).select("rev", "of", F.expr("substring(of, 1, k)").alias("path"))
    # at most one open rule for each length of the path
    return (
        prefixes.join(one, ["rev", "path"])
        .groupBy("rev", "of")
        .agg(F.array_sort(F.collect_list(F.struct(F.length("path").alias("n"), "path", "host", "verdict"))).alias("stack"))
        .withColumnRenamed("of", "path")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url", carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``carry`` columns of every row, ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict``."""
    seen = pages.select(*carry, F.col(url).cast("string").alias("url_")).select(*carry, host_of(F.col("url_")).alias("host"), path_of(F.col("url_")).alias("path"))
    stacks = stage(rule_stacks(rules), "stacks")
    urls = seen.select("host", "path").distinct().where("host != ''")
    labels = F.split("host", r"\.", -1)
    # one row for each suffix of the host that has rules
    suffixes = urls.withColumn("rev", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(F.reverse(labels), 1, k), "."))))
    points = suffixes.join(stacks.select("rev").distinct(), "rev", "left_semi")
    nothing = F.lit(None).cast(stacks.schema["stack"].dataType)
    swept = points.select("rev", "path", "host", nothing.alias("stack")).unionByName(stacks.select("rev", "path", F.lit("").alias("host"), "stack"))
    key = F.concat("rev", F.lit("#"), "path")
    # rules have an empty host, so a rule comes before the urls with its very key
    sorted_ = swept.withColumn("key", key).repartitionByRange("key", "host").withColumn("piece", F.spark_partition_id())
    sorted_ = stage(sorted_, "swept")
    w = Window.partitionBy("piece").orderBy("key", "host")
    open_ = F.last(F.when(F.col("stack").isNotNull(), F.struct("rev", "stack")), ignorenulls=True)
    # the last stack of each piece, carried to the pieces after it
    ends = sorted_.groupBy("piece").agg(F.max(F.when(F.col("stack").isNotNull(), F.struct("key", "rev", "stack"))).alias("end"))
    before = F.last("end", ignorenulls=True).over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = ends.select("piece", before.alias("start"))
    at = (
        sorted_.withColumn("open", open_.over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(starts), "piece")
        .where(F.col("stack").isNull())
        .select("host", "path", "rev", F.coalesce("open", F.struct(F.col("start.rev").alias("rev"), F.col("start.stack").alias("stack"))).alias("open"))
        .where(F.col("open.rev") == F.col("rev"))
    )
    fit = F.filter("open.stack", lambda r: F.col("path").startswith(r["path"]))
    best = at.select("host", "path", fit.alias("fit")).where(F.size("fit") > 0).select("host", "path", F.element_at("fit", -1).alias("r"))
    rule = F.concat("r.host", "r.path")
    won = best.groupBy("host", "path").agg(F.max(F.struct((F.length("r.host") + F.col("r.n")).alias("n"), F.length("r.host").alias("h"), rule.alias("rule"), F.col("r.verdict").alias("verdict"))).alias("won"))
    return seen.join(won, ["host", "path"], "left").select(*carry, "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


ORACLE = """
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u
), r(rh, rp, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT DISTINCT host, path, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY host, path ORDER BY length(rh || rp) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM h) JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM h LEFT JOIN m ON m.host = h.host AND m.path = h.path AND m.k = 1
"""
