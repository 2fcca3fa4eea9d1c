"""URL rules, and verdicts for other hosts from trust and distrust that spread over links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.columns import ascii_lower
from martlight.session import materialize, remove, store

# Masses are whole numbers, so sums don't depend on their order.
TOTAL_MASS = 10**15
FOLLOW_PERCENT = 85
# Rounds between two stored rank tables.
STORE_ROUNDS = 4
# Masses have settled when so many rounds add no more than this to all of them, and reach no further host.
TOLERANCE = 10**6
# A host is blocked from this share of distrust in its trust and distrust on.
BLOCK_PERCENT = 50

# Link targets with a host: absolute, or relative to the scheme alone.
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``host`` and all hosts below it, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    host, slash, path = name.partition("/")
    return Rule(verdict, host.lower(), slash + path)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rules(hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, rules): for each host with any, the rules of it and the domains above, longest first."""
    spark = hosts.sparkSession
    rows = [(r.host, len(r.name), r.path, r.name, r.verdict) for r in rules]
    table = spark.createDataFrame(rows, "suffix string, size int, path string, name string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    met = hosts.select("host", F.explode(suffixes).alias("suffix")).join(table, "suffix")
    entry = F.struct("size", "path", "name", "verdict")
    return met.groupBy("host").agg(F.sort_array(F.collect_set(entry), asc=False).alias("rules"))


def link_edges(pages: DataFrame) -> DataFrame:
    """(source, target): distinct links between two different hosts; ``pages`` has host and links."""
    edges = pages.select(F.col("host").alias("source"), F.explode("links").alias("target"))
    return edges.where("source <> '' and target <> '' and source <> target").distinct()


def propagate(
    seeds: DataFrame, edges: DataFrame, rounds: int | None = None, follow: int = FOLLOW_PERCENT
) -> DataFrame:
    """(host, trust, distrust) of the hosts that seeds reach.

    ``seeds`` has host, allowed and blocked: counts of pages that a rule decides. Personalised
    PageRank runs from the allowed ones along links, and from the blocked ones against them: who
    links to a blocked host is suspect. A host keeps (100 - follow) percent of what its own seed is
    worth and hands ``follow`` percent of its mass on in equal parts; what it can't
    hand on is lost. Both totals are TOTAL_MASS, and what falls below one unit on its way ends there.

    Without ``rounds`` masses grow from what the seeds keep until they settle: no round takes
    any away, so the sum and the number of hosts show the change. ``rounds`` runs just
    so many from the seeds' whole mass.
    """
    kinds = [("trust", "allowed", "source", "target"), ("distrust", "blocked", "target", "source")]
    starts = ways = None
    for kind, count, start, end in kinds:
        named = seeds.withColumn("total", seeds.agg(F.sum(count)).scalar()).where(F.col(count) > 0)
        mass = F.expr(f"cast({count} as decimal(20,0)) * {TOTAL_MASS} div total")
        own = named.select(F.lit(kind).alias("kind"), "host", mass.alias("mass"))
        # Hosts that only spread are kept out of the degrees.
        degree = edges.groupBy(start).agg(F.count(F.lit(1)).alias("degree"))
        way = edges.join(degree, start).select(
            F.lit(kind).alias("kind"), F.col(start).alias("host"), F.col(end).alias("next"), "degree"
        )
        starts = own if starts is None else starts.union(own)
        ways = way if ways is None else ways.union(way)
    starts, ways = materialize(starts, "seeds"), materialize(ways, "links")
    kept = starts.withColumn("mass", F.expr(f"mass * {100 - follow} div 100"))

    def following(ranks: DataFrame) -> DataFrame:
        handed = ranks.join(ways, ["kind", "host"]).select(
            "kind", F.col("next").alias("host"), F.expr(f"mass * {follow} div 100 div degree").alias("mass")
        )
        return handed.where("mass > 0").union(kept).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))

    ranks = kept if rounds is None else starts
    if rounds is None:
        path, last = None, ranks.agg(F.sum("mass"), F.count(F.lit(1))).first()
        settled = not last[1]
        while not settled:
            before = path
            for _ in range(STORE_ROUNDS):
                ranks = following(ranks)
            ranks, path = store(ranks, "ranks")
            if before:
                remove(seeds.sparkSession, before)
            now = ranks.agg(F.sum("mass"), F.count(F.lit(1))).first()
            settled, last = now[0] - last[0] <= TOLERANCE and now[1] == last[1], now
    else:
        for n in range(1, rounds + 1):
            ranks = following(ranks)
            if n % STORE_ROUNDS == 0:
                ranks = materialize(ranks, "ranks")
    return ranks.groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0)).alias(k) for k, *_ in kinds]
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    block_percent: int = BLOCK_PERCENT,
    rounds: int | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, trust, distrust), a row for every page.

    The longest rule that fits decides, else the host: blocked if distrust makes up
    ``block_percent`` of its trust and distrust, allowed otherwise, also without either.
    A null url, or one without "://", has an empty host and path, which no rule fits and no
    link reaches. A null html has no links. Repeated rows are judged alike.
    """
    address = F.col(url)
    rows = pages.select(
        F.col(key).alias("key"),
        host_of(address).alias("host"),
        path_of(address).alias("path"),
        F.array_distinct(
            F.transform(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_LINK), 1), ascii_lower)
        ).alias("links"),
    )
    rows = materialize(rows, "urls")
    own = host_rules(rows.select("host").distinct(), rules)
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), 0)
    ruled = rows.drop("links").join(own, "host", "left").withColumn("fit", fits).drop("rules")
    decided = F.col("fit")["verdict"]
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.count_if(decided == "allow").alias("allowed"), F.count_if(decided == "block").alias("blocked")
    )
    scores = propagate(materialize(seeds, "host-rules"), materialize(link_edges(rows), "host-links"), rounds)
    trust, distrust = (F.coalesce(c, F.lit(0)).alias(c) for c in ("trust", "distrust"))
    bad = (distrust > 0) & (distrust * 100 >= (trust + distrust) * block_percent)
    return ruled.join(scores, "host", "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("fit")["name"].alias("rule"),
        F.coalesce(decided, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        trust,
        distrust,
    )


