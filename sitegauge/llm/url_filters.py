"""Rules for urls, and trust spread over the links between hosts where no rule speaks.

Urls that a rule allows or blocks are seeds. Trust is a personalised PageRank that starts at
the hosts of allowed urls and follows links; distrust starts at the hosts of blocked urls and
follows links backwards, to those that point at them. The steps go on until no score changes.
A host is blocked if its distrust is larger than its trust; the two are compared by their ratio,
as both are shares of all seeds and shrink as the table grows. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import lower_ascii
from sitegauge.sources.workdir import stored

DAMPING = 0.6
#: The largest relative change of a score that counts as none.
TOLERANCE = 1e-9
#: Distrust counts as larger if it is so by this part, so that the order of a sum decides nothing.
MARGIN = 1e-6
STORE_EVERY = 4
# Steps of the SQL, whose text cannot go on until scores settle: DAMPING ** 64 is below 1e-14.
SQL_STEPS = 64

LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        on_host = (host == self.host) | host.endswith("." + self.host)
        return on_host & path.startswith(self.path)


#: The rules of the registered query, fixed values.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path; both empty without ``://`` or for NULL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    whole = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(whole, r"(?s)^([^/]*)", 1)
    return lower_ascii(host), F.substring(whole, F.length(host) + 1, F.length(whole))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...], value: str) -> Column:
    """``text`` or ``verdict`` of the longest fitting rule, else NULL. The rules are a short list."""
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fitting = [F.when(r.fits(host, path), F.lit(getattr(r, value))) for r in by_length]
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def links(pages: DataFrame) -> DataFrame:
    """Links between hosts with their number: ``source``, ``target``, ``n``.

    Counted per page first and in the map tasks next, so a host with very many links reaches
    the shuffle as a row per task and target.
    """
    target = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))))
    return (
        pages.where(F.col("html").isNotNull() & (F.col("host") != ""))
        .select(F.col("host").alias("source"), target.alias("target"))
        .withColumn("target", lower_ascii(F.col("target")))
        .where((F.col("target") != "") & (F.col("target") != F.col("source")))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def flows(edges: DataFrame) -> DataFrame:
    """Shares that pass from a host to another: trust along links, distrust against them."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("at"), F.col("target").alias("to"), "n")
    both = both.unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("at"), F.col("source").alias("to"), "n")
    )
    out = both.groupBy("kind", "at").agg(F.sum("n").alias("_all"))
    return both.join(out, ["kind", "at"]).select("kind", "at", "to", (F.col("n") / F.col("_all")).alias("share"))


def seeds(hosts: DataFrame) -> DataFrame:
    """Where trust and distrust start: a host's part of all allowed, or all blocked, urls."""
    long = hosts.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("n_allow").alias("n")),
                F.struct(F.lit("distrust").alias("kind"), F.col("n_block").alias("n")),
            )
        ).alias("s"),
    ).select("host", "s.kind", "s.n").where(F.col("n") > 0)
    total = long.groupBy("kind").agg(F.sum("n").alias("_all"))  # two rows
    return long.join(F.broadcast(total), "kind").select(
        "kind", F.col("host").alias("at"), (F.col("n") / F.col("_all")).alias("seed")
    )


def propagate(
    edges: DataFrame, starts: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``kind``, ``at``, ``score`` where they no longer change; what reaches a host without links ends there.

    Each step is one join on the giving host and one sum over the receiving one, which the map
    tasks begin. Every few steps the scores are written, so a lost executor repeats those alone,
    and compared with those written before. A score that is new, or changed by more than
    ``tolerance`` of itself, asks for more steps; as only ``damping`` of a score is passed on, what
    they change shrinks from step to step, and a host is reached over any number of links.
    """
    shares = stored(flows(edges), "flows")
    start = stored(starts, "seeds")
    base = start.select("kind", "at", ((1 - F.lit(damping)) * F.col("seed")).alias("score"))
    if shares.isEmpty():
        # No link: the fixed point of the same steps.
        return base
    before = base
    while True:
        scores = before
        for _ in range(STORE_EVERY):
            moved = shares.join(scores, ["kind", "at"]).select(
                "kind", F.col("to").alias("at"), (F.lit(damping) * F.col("share") * F.col("score")).alias("score")
            )
            scores = moved.unionByName(base).groupBy("kind", "at").agg(F.sum("score").alias("score")).where("score > 0")
        scores = stored(scores, "scores")
        old = before.withColumnRenamed("score", "_old")
        both = scores.join(old, ["kind", "at"], "left")
        settled = F.coalesce(F.abs(F.col("score") - F.col("_old")) <= tolerance * F.col("score"), F.lit(False))
        if both.where(~settled).isEmpty():
            return scores
        before = scores


def host_verdicts(pages: DataFrame, rules: tuple[Rule, ...], damping: float = DAMPING) -> DataFrame:
    """``host``, ``trust``, ``distrust``, ``blocked`` of every host with a score."""
    verdict = longest_rule(F.col("host"), F.col("path"), rules, "verdict")
    hosts = (
        pages.where(F.col("host") != "")
        .withColumn("_v", verdict)
        .groupBy("host")
        .agg(F.count_if(F.col("_v") == "allow").alias("n_allow"), F.count_if(F.col("_v") == "block").alias("n_block"))
    )
    edges = stored(links(pages), "links")
    scores = propagate(edges, seeds(stored(hosts, "hosts")), damping)
    return (
        scores.groupBy(F.col("at").alias("host"))
        .agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
        )
        .withColumn("blocked", F.col("distrust") > F.col("trust") * (1 + MARGIN))
    )


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    damping: float = DAMPING,
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``.

    ``verdict`` is the longest fitting rule's, else ``block`` for hosts with more distrust than
    trust and ``allow`` for all others: scores that are equal up to MARGIN, hosts without any, and urls without a
    host (NULL, or no ``://``). Repeated pages count as often as they stand there. NULL html
    has no links. An empty table gives none. Other columns of ``pages`` are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    verdicts = host_verdicts(split, rules, damping)
    # The judged side keeps its hot host: an equi-join that AQE may split.
    joined = split.drop("html").join(verdicts, "host", "left")
    own = longest_rule(F.col("host"), F.col("path"), rules, "verdict")
    by_host = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        longest_rule(F.col("host"), F.col("path"), rules, "text").alias("rule"),
        F.coalesce(own, by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def oracle(rules: tuple[Rule, ...] = RULES, damping: float = DAMPING, steps_taken: int = SQL_STEPS) -> str:
    """The same as SQL, with the steps written out."""
    by_length = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def chain(value: str) -> str:
        whens = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
            f"THEN '{getattr(r, value)}'"
            for r in by_length
        )
        return f"CASE {whens} END"

    steps = ["s0 AS (SELECT kind, node, seed AS score FROM seed)"]
    for i in range(1, steps_taken + 1):
        steps.append(
            f"s{i} AS MATERIALIZED (SELECT kind, node, sum(score) AS score FROM ("
            f"SELECT f.kind, f.target AS node, {damping} * f.share * s.score AS score "
            f"FROM flow f JOIN s{i - 1} s ON s.kind = f.kind AND s.node = f.node "
            f"UNION ALL SELECT kind, node, (1 - {damping}) * seed FROM seed) GROUP BY kind, node)"
        )
    pattern = LINK.replace("'", "''")
    return f"""
WITH rests AS (
  SELECT page_id, html, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
         ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, html, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host,
         regexp_extract(rest, '^([^?#]*)', 1) AS whole FROM rests),
parts AS MATERIALIZED (
  SELECT page_id, html, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(whole, length(raw_host) + 1) AS path FROM split),
ruled AS MATERIALIZED (
  SELECT page_id, host, path, {chain("text")} AS rule, {chain("verdict")} AS own FROM parts),
edge AS MATERIALIZED (
  SELECT source, target, count(*) AS n FROM (
    SELECT host AS source, translate(unnest(list_distinct(regexp_extract_all(html, '{pattern}', 1))),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
    FROM parts WHERE host <> '') WHERE target <> '' AND target <> source GROUP BY source, target),
both_ways AS (
  SELECT 'trust' AS kind, source AS node, target, n FROM edge
  UNION ALL SELECT 'distrust', target, source, n FROM edge),
flow AS MATERIALIZED (
  SELECT kind, node, target, n / sum(n) OVER (PARTITION BY kind, node) AS share FROM both_ways),
counted AS (
  SELECT CASE own WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host AS node, count(*) AS n
  FROM ruled WHERE own IS NOT NULL AND host <> '' GROUP BY 1, 2),
seed AS MATERIALIZED (
  SELECT kind, node, n / sum(n) OVER (PARTITION BY kind) AS seed FROM counted),
{", ".join(steps)},
judged AS (
  SELECT node AS host, sum(CASE kind WHEN 'trust' THEN score ELSE 0 END) AS trust,
         sum(CASE kind WHEN 'distrust' THEN score ELSE 0 END) AS distrust
  FROM s{steps_taken} GROUP BY node)
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.own, CASE WHEN j.distrust > j.trust * (1 + {MARGIN}) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN judged j ON j.host = r.host"""
