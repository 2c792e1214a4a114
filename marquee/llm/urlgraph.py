"""URL filters: rules, and trust spread over the graph of hosts.

Rules decide where they fit.  Elsewhere the host decides: links between hosts
are read from the pages, personalised PageRank spreads trust from hosts whose
pages the rules allow along the links, and spreads distrust from hosts whose
pages the rules block against them (who links to a blocked host shares in its
distrust).  A host with more distrust than trust is blocked.

Everything is DataFrame expressions.  Links are reduced to distinct pairs of
hosts and written before the first round; each round is one join and one sum by host.  As
a verdict compares two scores of one host, however small, rounds go on until
every host's scores stand still relative to themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, discard, materialize

#: Up to so many rules become one expression; longer lists are joined as a table.  The outcome is the same.
MAX_RULES = 1000
#: Rounds of the propagation that one job makes.
ROUNDS = 4


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path after the first ``://``; both empty without one, or for a null."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls; of equally long ones the longer host."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def judge(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rows`` (host, path, ...) with ``rule`` and ``_own``, text and verdict of the longest rule that fits."""
    if len(rules) <= MAX_RULES:
        rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
        return rows.withColumn("rule", rule).withColumn("_own", verdict)
    # A host's own name and those of its parent domains meet the rules of that host.
    table = rows.sparkSession.createDataFrame([(r.host, r.path, r.verdict, i) for i, r in enumerate(rules)],
                                              "r_host string, r_path string, r_verdict string, r_place int")
    places = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = (places.select("host", "path", F.explode(names).alias("r_host")).join(table, "r_host")
                 .filter(F.col("path").startswith(F.col("r_path"))))
    length = F.length(F.concat("r_host", "r_path"))
    best = met.groupBy("host", "path").agg(F.max(F.struct(
        length.alias("n"), F.length("r_host").alias("h"), F.col("r_place").alias("i"), "r_host", "r_path", "r_verdict")).alias("b"))
    best = materialize(best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.concat("b.r_host", "b.r_path").alias("rule"),
                                   F.col("b.r_verdict").alias("_own")), "rules-met")
    return rows.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left").drop("_h", "_p")


def host_links(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """Distinct links (src, dst) between two hosts, from absolute addresses in href attributes."""
    refs = F.regexp_extract_all(F.col(html_col), F.lit(r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^"'\s>/?#]+)"""), 1)
    return (pages.select(host.alias("src"), F.explode(F.array_distinct(refs)).alias("dst"))
                 .select("src", ascii_lower(F.col("dst")).alias("dst"))
                 .filter("src <> dst AND src <> ''").distinct())


def spread(links: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """(host, trust, distrust): personalised PageRank along and against ``links``.

    ``seeds`` (host, trust, distrust) are the teleport weights.  Stops once no
    score has moved by more than ``tolerance`` times itself over the last
    ``ROUNDS`` rounds, which one job makes.  After k rounds what is still to come
    to a host that all its paths have reached is at most ``damping`` ** k of the
    whole weight (0.85 ** 130 is below 1e-9).  A host that a score
    reaches for the first time has moved by all of it, so every chain of links
    is followed to its end (as far as doubles are above 0), and neither the
    number of hosts nor the scale of the weights matters.
    """
    links = materialize(links, "link-pairs")
    # Written before they are joined: a join of two plain tables may split a hub.
    out_n = materialize(links.groupBy("src").agg(F.count(F.lit(1)).alias("_out")), "out-degrees")
    in_n = materialize(links.groupBy("dst").agg(F.count(F.lit(1)).alias("_in")), "in-degrees")
    edges = links.join(out_n, "src").join(in_n, "dst")
    flows = materialize(edges.select(F.col("src").alias("host"), F.col("dst").alias("to"),
                                     (damping / F.col("_out")).alias("_t"), F.lit(0.0).alias("_d"))
                             .union(edges.select("dst", "src", F.lit(0.0), damping / F.col("_in"))), "flows")
    base = materialize(seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"),
                                    ((1 - damping) * F.col("distrust")).alias("distrust")), "teleport")

    def once(state: DataFrame) -> DataFrame:
        sent = flows.join(state, "host").select(F.col("to").alias("host"), (F.col("_t") * F.col("trust")).alias("trust"),
                                                (F.col("_d") * F.col("distrust")).alias("distrust")).filter(
                                                    "trust > 0 OR distrust > 0")
        return (base.union(sent).groupBy("host")
                    .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")))

    state = base
    while True:
        after = state
        for _ in range(ROUNDS):
            after = once(after)
        before = state.select("host", F.col("trust").alias("_t0"), F.col("distrust").alias("_d0"))
        moved = F.greatest(*[F.when(F.col(c) > 0, F.abs(F.col(c) - F.coalesce(c0, F.lit(0.0))) / F.col(c)).otherwise(0.0)
                             for c, c0 in (("trust", "_t0"), ("distrust", "_d0"))])
        after = materialize(after.join(before, "host", "left").select(
            "host", "trust", "distrust", moved.alias("moved")), "host-scores")
        most = after.agg(F.max("moved")).first()[0]
        if state is not base:
            discard(state)
        state = after.drop("moved")
        if most is None or most <= tolerance:
            break
    return state


def filter_urls(pages: DataFrame, rules: list[Rule], ratio: float = 1.0, id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    A page without a fitting rule is blocked if its host has more than
    ``ratio`` times as much distrust as trust, else allowed.

    Defined cases: a url that is null or has no ``://`` has an empty host and
    path, fits no rule unless one is for them, and is allowed; a null html has
    no links; repeated rows and null ids are judged like others; an empty
    table gives no rows; further columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = judge(rows, rules)
    per_host = judged.groupBy("host").agg(F.count_if(F.col("_own") == "allow").alias("_a"),
                                          F.count_if(F.col("_own") == "block").alias("_b"))
    per_host = materialize(per_host, "hosts")
    total = per_host.agg(F.sum("_a"), F.sum("_b")).first()
    seeds = per_host.select("host", (F.col("_a") / F.lit(float(total[0] or 1))).alias("trust"),
                            (F.col("_b") / F.lit(float(total[1] or 1))).alias("distrust"))
    links = host_links(pages, host, html_col)
    scores = spread(links, seeds).select("host", (F.col("distrust") > ratio * F.col("trust")).alias("_bad"))
    return (judged.join(scores, "host", "left")
                  .select("page_id", "host", "path", "rule",
                          F.coalesce("_own", F.when(F.col("_bad"), "block"), F.lit("allow")).alias("verdict")))
