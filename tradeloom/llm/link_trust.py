"""URL verdicts from rules and from the links between hosts, in SQL only.

Rules judge the urls they fit. Hosts with an allowed url are trusted seeds,
hosts with a blocked one blocked seeds. Trust walks along the links: a host
passes a share of its trust to every host it links to (personalised PageRank
from the trusted seeds). Distrust walks against them: a host that links to
distrusted hosts receives a share of their distrust. A url that no rule fits
is blocked if its host has more distrust than trust.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
ROUNDS = 12  # of the check SQL
LOOK_EVERY = 4  # rounds between looks for convergence
TOLERANCE = 1e-6  # largest change of a host's mass, as a share of its mass
MAX_DISTRUST = 0.5  # share of distrust in trust and distrust
# The host of an absolute or protocol-relative link of an anchor or area.
LINK = r"""(?i)<a(?:rea)?\s(?:[^>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'<>\s]+)"""


@dataclass(frozen=True)
class Rule:
    text: str  # host and path, as in "example.net/en/"
    verdict: str  # allow or block

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(self.path)


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return _lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULL if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest comes last, outermost
        fits = rule.fits(host, path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Different ``(src, dst)`` links between hosts, taken from the pages' anchors."""
    host, _ = host_and_path(pages[url_col].cast("string"))
    html = pages[html_col].cast("string")
    linked = F.explode(F.regexp_extract_all(html, F.lit(LINK), 1))
    links = pages.where(html.contains("//")).select(host.alias("src"), linked.alias("to"))
    links = links.select("src", _lower(F.col("to")).alias("dst"))
    return links.where("src <> '' and dst <> src").distinct()


def _shares(links: DataFrame) -> DataFrame:
    """``(kind, at, to, share)``: where a host's mass goes, and how much of it."""
    ways = links.select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to")).union(
        links.select(F.lit("distrust"), "dst", "src")
    )
    ways = stage(ways, "ways")
    degrees = stage(ways.groupBy("kind", "at").agg((1 / F.count("*")).alias("share")), "degrees")
    return ways.join(degrees, ["kind", "at"])


def _changed(before: DataFrame, after: DataFrame, tolerance: float) -> bool:
    """Whether a host is new or gone, or its mass changed by more than a share of it."""
    old = before.select("kind", "at", F.col("mass").alias("old"))
    both = old.join(after, ["kind", "at"], "full")
    moved = F.abs(F.col("mass") - F.col("old")) > tolerance * F.col("mass")
    return bool(both.agg(F.max(F.coalesce(moved, F.lit(True)))).first()[0])


def host_scores(
    seeds: DataFrame,
    links: DataFrame,
    rounds: int | None = None,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(host, trust, distrust)`` of all hosts that either kind of mass reaches.

    ``seeds``: different ``(kind, host)``, kind ``trust`` or ``distrust``. The
    mass of a kind is 1 in all. Each round is one join and one sum over both
    kinds, written as a table, so a lost executor costs one round. Rounds go
    on until no host is new or gone and none changes by more than
    ``tolerance`` of its own mass; one row a look reaches the driver. The
    changes shrink by ``damping`` a round at least, so this ends. ``rounds``
    asks for a fixed number instead.
    """
    shares = stage(_shares(links), "shares")
    counts = seeds.groupBy("kind").agg((1 / F.count("*")).alias("mass"))
    start = stage(seeds.join(F.broadcast(counts), "kind").select("kind", F.col("host").alias("at"), "mass"), "seeds")
    mass = start
    done = 0
    while rounds is None or done < rounds:
        moved = mass.join(shares, ["kind", "at"]).select(
            "kind", F.col("to").alias("at"), (F.col("mass") * F.col("share") * damping).alias("mass")
        )
        back = start.select("kind", "at", (F.col("mass") * (1 - damping)).alias("mass"))
        before = mass
        mass = stage(moved.union(back).groupBy("kind", "at").agg(F.sum("mass").alias("mass")), "mass")
        done += 1
        if rounds is None and done % LOOK_EVERY == 0 and not _changed(before, mass, tolerance):
            break

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)

    return mass.groupBy(F.col("at").alias("host")).agg(of("trust"), of("distrust"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rounds: int | None = None,
    max_distrust: float = MAX_DISTRUST,
) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` per row of ``pages``.

    Rules decide first. Otherwise a host with a larger share of distrust than
    ``max_distrust`` is blocked; hosts that nothing reaches, and urls without
    a host, are allowed. NULL html has no links. Repeated rows stay; links and
    seeds count once. Other columns are not read; an empty table gives no rows.
    """
    host, path = host_and_path(pages[url_col].cast("string"))
    judged = pages.select(pages[id_col].cast("long").alias("id"), host.alias("host"), path.alias("path"))
    rule, ruled = best_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "ruled": ruled})
    kind = F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind")
    seeds = stage(judged.where("ruled is not null and host <> ''").select(kind, "host").distinct(), "ruled")
    links = stage(host_links(pages, url_col, html_col), "links")
    scores = stage(host_scores(seeds, links, rounds).withColumnRenamed("host", "of"), "scores")
    joined = judged.join(scores, judged["host"] == scores["of"], "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    verdict = F.when(distrust > F.lit(max_distrust) * (trust + distrust), "block").otherwise("allow")
    return joined.select(
        "id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", verdict).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
