"""URL filters by rules and link-graph propagation (operator 5, DataFrame functions only).

Rules ``host/path`` fit a host and all its subdomains if the url's path starts with the
rule's path; the longest that fits decides. Pages without a rule are judged by their
host: trust flows forward over host links from hosts with allowed pages, distrust flows
backward from hosts with blocked pages (whoever links to a blocked host is distrusted),
both as personalised PageRank, iterated until the ranks of all hosts together change by
less than ``TOLERANCE`` seed pages. A host is linked both ways with the domain above it,
that one with the next, and so on down to two labels, whether or not these have pages: so
hosts of one domain share trust and distrust. A host is blocked if its distrust per page is
at least ``MIN_DISTRUST`` and more than ``RATIO`` times its trust.

``pages`` is read once: ids, hosts, paths and the hosts linked to are written to the shared
folder, and everything else is made from that table.

Null urls and urls without ``://`` have an empty host and path; no rule and no link
fits them, and they are allowed. An empty table gives an empty result; repeated rows
are judged alike; extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.session import MAX_BROADCAST_BYTES, broadcast_if_small, cut_lineage, table_bytes

DAMPING = 0.85
#: Steps between two written rank tables.
WRITE_EVERY = 4
RATIO = 2.0
MIN_DISTRUST = 0.05
#: Change of all ranks between two written tables, in seed pages, at which they are final.
#: What is still to come is at most 1.1 times that (0.85**4 / (1 - 0.85**4)), and the final
#: scaling multiplies by 1 / 0.15 at most.
TOLERANCE = MIN_DISTRUST / 1000
#: Bytes of links a task of a step takes where the rank table is small enough to travel.
TASK_BYTES = 4 << 20
#: A change that falls to this share or more of the one before is rounding: exact ranks
#: change by at most 0.85**4 = 0.53 of it.
STALLED = 0.75


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


# The rules of the registered query.
RULES = (rule("allow", "org/"), rule("block", "example.org/es/"), rule("block", "example.org/en/1"),
         rule("allow", "com/fr/"), rule("block", "com/de/"))

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_REST = r"(?s)^.*?://(.*)$"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, _REST, 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(url, _REST, 1)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null. Ties of length
    go to the first rule of the list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path, targets)``: what the filter needs of a page. ``targets`` are the
    other hosts it links to, each once."""
    targets = F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:https?:)?//[^\s"'<>]+)"""), F.lit(1)),
        lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u))))
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), targets.alias("targets"))
    return at.withColumn("targets", F.filter("targets", lambda t: (t != "") & (t != F.col("host"))))


def judged_pages(parsed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, rule_verdict)``."""
    return parsed.select("page_id", "host", "path", matching_rule(F.col("host"), F.col("path"), rules).alias("m")).select(
        "page_id", "host", "path", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("rule_verdict"))


def parent_domains(hosts: DataFrame) -> DataFrame:
    """``(src, dst)``: every host with the domain one label above it, that domain with the
    next, down to two labels, each pair once. Domains need no pages of their own; addresses
    of numbers alone and empty labels have none."""
    labels = F.split("host", r"\.")
    named = hosts.filter(F.col("host").rlike(r"^[^.]+(\.[^.]+){2,}$") & ~F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$"))
    tails = F.transform(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.array_join(F.slice("l", i, F.size("l")), "."))
    pairs = named.select(labels.alias("l")).select(tails.alias("t")).select(
        F.explode(F.arrays_zip(F.slice("t", 1, F.size("t") - 1).alias("src"), F.slice("t", 2, F.size("t") - 1).alias("dst"))).alias("p"))
    return pairs.select("p.src", "p.dst").distinct()


def host_links(parsed: DataFrame) -> DataFrame:
    """``(src, dst, n)``: links between different hosts found in the pages, those of one page
    to one host counted once, and between every host of the table and its parent domains."""
    found = parsed.filter("host <> ''").select(F.col("host").alias("src"), F.explode("targets").alias("dst"))
    linked = found.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))
    up = parent_domains(parsed.select("host").distinct()).withColumn("n", F.lit(1.0))
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    return linked.unionByName(up).unionByName(down).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def page_rank(links: DataFrame, seeds: DataFrame, tolerance: float, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank ``(host, rank)``: seeds ``(host, weight)`` with weights that
    add up to 1, links ``(src, dst, n)``. The links are written once, weighted by their
    share of the source. Rank tables of a proven size up to ``MAX_BROADCAST_BYTES`` travel to
    the links, in tasks that follow the bytes of the links; larger ones are joined by a
    shuffle. The steps end when the changes of all ranks between two written
    tables add up to at most ``tolerance``. Each step leaves at most ``damping`` of the change;
    once it falls by less than that allows, what is left is the rounding of sums taken in
    another order, and the steps end too: so they do end, whatever the tolerance. Ranks are
    scaled to add up to 1 at the end, which is the same as letting hosts without links hand
    their rank back to the seeds."""
    total = links.groupBy("src").agg(F.sum("n").alias("total"))
    share = cut_lineage(links.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")))
    rank = seeds.select("host", F.col("weight").alias("rank"))
    base = seeds.select("host", (F.col("weight") * (1.0 - damping)).alias("rank"))
    # ranked hosts are seeds or ends of links, so this bounds the bytes of every rank table
    size = table_bytes(share) + table_bytes(rank)
    travels, tasks = size <= MAX_BROADCAST_BYTES, max(links.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    if travels:
        share, base = share.coalesce(tasks), base.coalesce(tasks)
    written, before, linked = rank, math.inf, not share.isEmpty()
    while linked:
        for _ in range(WRITE_EVERY):
            flow = ((F.broadcast(rank) if travels else rank).join(share, F.col("host") == F.col("src"))
                    .select(F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")))
            rank = base.unionByName(flow).groupBy("host").agg(F.sum("rank").alias("rank"))
            rank = rank.coalesce(tasks) if travels else rank
        rank = cut_lineage(rank)
        change = (rank.unionByName(written.select("host", (-F.col("rank")).alias("rank"))).groupBy("host")
                  .agg(F.sum("rank").alias("rank")).agg(F.sum(F.abs("rank"))).first()[0] or 0.0)
        if change <= tolerance or change >= STALLED * before:
            break
        written, before = rank, change
    rank = cut_lineage(rank)
    scale = rank.agg(F.sum("rank")).first()[0]
    return rank.withColumn("rank", F.col("rank") / F.lit(scale)) if scale else rank


def host_scores(parsed: DataFrame, judged: DataFrame) -> DataFrame:
    """``(host, trust, distrust)`` per page of the host: seeds weigh by their number of
    allowed or blocked pages, and a host's rank, counted in seed pages, is divided by its
    own number of pages."""
    links = cut_lineage(host_links(parsed))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    counts = cut_lineage(judged.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count(F.when(F.col("rule_verdict") == "allow", 1)).cast("double").alias("allow"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).cast("double").alias("block")))
    sums = counts.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    out = counts.select("host", "pages")
    sides = [(side, graph, name) for side, graph, name in (("allow", links, "trust"), ("block", back, "distrust")) if sums[side]]
    if sides:
        # both sides are iterated together, as the two parts of one graph without links between them
        def part(side, c):
            return F.concat(F.lit(f"{side}:"), F.col(c)).alias(c)

        graph = reduce(DataFrame.unionByName, [g.select(part(side, "src"), part(side, "dst"), "n") for side, g, _ in sides])
        seeds = reduce(DataFrame.unionByName, [
            counts.filter(F.col(side) > 0).select(part(side, "host"), (F.col(side) / (sums[side] * len(sides))).alias("weight"))
            for side, _, _ in sides])
        ranked = page_rank(graph, seeds, TOLERANCE / (len(sides) * max(sums[side] for side, _, _ in sides)))
    for side, name in (("allow", "trust"), ("block", "distrust")):
        if sums[side]:
            own = ranked.filter(F.col("host").startswith(f"{side}:")).select(
                F.expr(f"substring(host, {len(side) + 2})").alias("host"), "rank")
            scale = own.agg(F.sum("rank")).first()[0]
            out = out.join(own.select("host", (F.col("rank") * (sums[side] / scale)).alias(name)), "host", "left")
        else:
            out = out.withColumn(name, F.lit(0.0))
    return out.select("host", *[(F.coalesce(F.col(c), F.lit(0.0)) / F.col("pages")).alias(c) for c in ("trust", "distrust")])


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` for every page."""
    parsed = cut_lineage(parsed_pages(pages))
    judged = judged_pages(parsed, rules)
    scores = host_scores(parsed, judged)
    bad = (F.col("distrust") >= MIN_DISTRUST) & (F.col("distrust") > F.col("trust") * RATIO)
    return judged.join(broadcast_if_small(cut_lineage(scores)), "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op5_url_filters(spark, sf_dir: str) -> DataFrame:
    """All of ``pages``."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
