"""URL filter: rules first, then trust and distrust propagated over links between hosts.

Rules (action, host, path) fit their host, its subdomains and paths which start with theirs; the longest rule wins. Hosts most of
whose pages are blocked by rules are blocked seeds; other hosts with pages allowed by rules are trusted seeds. Trust flows from trusted
seeds along links (personalised PageRank), distrust from blocked seeds against links: who links to a blocked host is distrusted.
A host is blocked when its distrust exceeds its trust by more than ``threshold`` times the mean rank of a host.

An edge counts the pages of a host which link to another host (absolute or scheme-relative ``href`` of ``a``), so a page counts once per target.
Every step is a join or aggregation on the host graph; nothing of it reaches the driver but sums. A url which is null or has no ``://`` has empty
host and path, fits no rule and is allowed, as are hosts without any score. Null html has no links. Repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.session import write_stage

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 0.01
"""How far off a rank may be, as a share of the margin of a verdict."""
ROUNDING = 1e-13
BROADCAST_HOSTS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column) -> Column:
    """A host and all its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def _rules_of_hosts(hosts: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """For each host the rules which can fit it, longest first."""
    spark = hosts.sparkSession
    given = spark.createDataFrame([(h, p, a, h + p, len(h + p)) for a, h, p in rules], "of string, rule_path string, action string, rule string, size int")
    fitting = hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("of")).join(given, "of")
    rows = F.sort_array(F.collect_list(F.struct("size", "rule", "rule_path", "action")), asc=False)
    return fitting.groupBy("host").agg(rows.alias("rules"))


def pagerank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = 1e-8) -> DataFrame:
    """Personalised PageRank: node, rank. ``edges`` (src, dst, n), ``seeds`` (node); ranks add up to 1, dead ends return to the seeds.

    A round shrinks the change by ``damping`` at least, so it ends without ``rounds``: once the changes left add up to less than ``tolerance``."""
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    flow = write_stage(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "flow")
    start = write_stage(seeds.select("node").distinct(), "seeds")
    number = start.count()
    ranks = start.withColumn("rank", F.lit(1.0 / max(number, 1)))
    if not number or flow.isEmpty():
        return ranks
    for _ in count() if rounds is None else range(rounds):
        sent = ranks.join(flow, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        moved = sent.agg(F.sum("rank")).first()[0] or 0.0
        back = start.select("node", F.lit((1.0 - moved) / number).alias("rank"))
        new = write_stage(sent.unionAll(back).groupBy("node").agg(F.sum("rank").alias("rank")), "ranks")
        change = new.join(ranks.withColumnRenamed("rank", "was"), "node", "full").agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))).first()[0]
        ranks = new
        if change * damping < max(tolerance * (1 - damping), ROUNDING):
            break
    return ranks


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Every page with host, path, rule, verdict, and the trust and distrust of its host."""
    host, path = split_url("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = split.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    rows = _rules_of_hosts(hosts, rules)
    hosts = write_stage(hosts.join(rows, "host", "left"), "hosts")
    few = hosts.count() <= BROADCAST_HOSTS
    known = hosts.select("host", "rules")
    fit = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    ruled = split.join(F.broadcast(known) if few else known, "host", "left").withColumn("first", F.when(F.size(fit) > 0, fit[0]))
    shares = ruled.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("first.action") == "block").alias("blocked"), F.count_if(F.col("first.action") == "allow").alias("allowed")
    )
    shares = write_stage(shares, "shares")
    bad = shares.where(F.col("blocked") * 2 > F.col("pages")).select(F.col("host").alias("node"))
    good = shares.where((F.col("blocked") * 2 <= F.col("pages")) & (F.col("allowed") > 0)).select(F.col("host").alias("node"))

    targets = F.array_distinct(F.transform(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)), lambda t: F.translate(t, _UPPER, _LOWER)))
    linked = pages.where(F.col("html").contains("//")).select(host.alias("src"), F.explode(targets).alias("dst"))
    edges = linked.where((F.col("src") != F.col("dst")) & (F.col("src") != "")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    edges = write_stage(edges, "edges")
    nodes = shares.select(F.col("host").alias("node")).unionAll(edges.select("src")).unionAll(edges.select("dst")).distinct().count()
    near = TOLERANCE * threshold / max(nodes, 1)
    trust = pagerank(edges, good, tolerance=near)
    distrust = pagerank(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"), bad, tolerance=near)

    zero = F.lit(0.0)
    scored = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "node", "full").select(
        F.col("node").alias("host"), F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust")
    )
    table = write_stage(known.join(scored, "host", "left"), "judged")
    distrusted = (F.coalesce("distrust", zero) - F.coalesce("trust", zero)) * nodes > threshold
    by_method = F.when(distrusted & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow"))
    found = split.join(F.broadcast(table) if few else table, "host", "left").withColumn("first", F.when(F.size(fit) > 0, fit[0]))
    return found.select(
        "page_id", "host", "path", F.col("first.rule").alias("rule"), F.coalesce("first.action", by_method).alias("verdict"),
        F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"),
    )
