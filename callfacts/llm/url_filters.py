"""URL filters: host and path rules, then trust over the host link graph (DataFrame expressions only).

A page is judged by the longest rule that fits its URL.  Where none fits, its
host decides: personalised PageRank from trusted hosts follows links forwards,
distrust from blocked hosts follows them backwards (who links to a blocked host
is suspect), and a host with more distrust than trust is blocked.

Defined results: a null URL or one without ``://`` has an empty host and path;
an empty host is in no link and has no trust, so no rule fits and the verdict is
``allow``.  Null HTML holds no links.  Repeated rows are judged alike and count
in link weights as often as they occur.  With no pages at all the result is empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import delete_folder, staged
from callfacts.scratch import fresh_folder

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = 4
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule], pick) -> Column:
    """``pick(rule)`` of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text, r.verdict)):  # the last when() is the outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(pick(r))).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst, w)``: links between different hosts, counted before any shuffle."""
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.filter(F.regexp_extract_all(F.col(html), F.lit(HREF), 1), lambda x: x.rlike(r"^(?:[A-Za-z][\w+.-]*:)?//"))).alias("to"),
    ).select("src", host_of(F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))).alias("dst"))
    return links.where("src != dst and src != '' and dst != ''").groupBy("src", "dst").agg(F.count("*").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """``(host, trust, distrust)`` for every host with a seed or a link.

    ``seeds``: ``(host, good, bad)``, the weights of trusted and blocked pages.
    Every link stands in one table in both directions, with the share of trust that it hands on
    and the share of distrust that it hands back, so a round is one join and one partially
    aggregated sum.  ``STEP`` rounds make one staged table; the one before is deleted then, as
    nothing reads it any more.  Rounds end when no host's values change by more than the share
    ``tolerance`` in the last of them: a host that is reached for the first time counts as
    changed, however small its value.
    """
    totals = seeds.agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    start = (
        seeds.crossJoin(F.broadcast(totals))  # one row of totals
        .select(
            "host",
            (F.coalesce(F.col("good") / F.nullif("g", F.lit(0)), F.lit(0.0)) * (1 - damping)).alias("t"),
            (F.coalesce(F.col("bad") / F.nullif("b", F.lit(0)), F.lit(0.0)) * (1 - damping)).alias("d"),
        )
    )
    out_w = edges.groupBy("src").agg(F.sum("w").alias("ow"))
    in_w = edges.groupBy("dst").agg(F.sum("w").alias("iw"))
    zero = F.lit(0.0)
    both_ways = F.array(
        F.struct(F.col("src").alias("at"), F.col("dst").alias("to"), (F.col("w") / F.col("ow") * damping).alias("wt"), zero.alias("wd")),
        F.struct(F.col("dst").alias("at"), F.col("src").alias("to"), zero.alias("wt"), (F.col("w") / F.col("iw") * damping).alias("wd")),
    )
    hands = staged(edges.join(out_w, "src").join(in_w, "dst").select(F.explode(both_ways).alias("e")).select("e.*"), "host_edges")
    start = staged(start, "host_seeds")
    state = start.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"))
    if hands.isEmpty():
        return state
    moved = lambda new, old: F.when(F.col(new) > 0, F.abs(F.col(new) - F.col(old)) / F.col(new)).otherwise(0.0)
    change, folder = 1.0, None
    while change > tolerance:
        before = None
        for step in range(STEP):
            given = hands.join(state, hands["at"] == state["host"]).select(
                F.col("to").alias("host"), (F.col("wt") * F.col("trust")).alias("t"), (F.col("wd") * F.col("distrust")).alias("d")
            )
            if step == STEP - 1:  # beside the last round's values those that it started from
                before = state.select("host", zero.alias("t"), zero.alias("d"), F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
            rows = given.unionByName(start)
            if before is not None:
                rows = rows.select("*", zero.alias("t0"), zero.alias("d0")).unionByName(before)
            sums = [F.sum(a).alias(b) for a, b in (("t", "trust"), ("d", "distrust"), ("t0", "t0"), ("d0", "d0")) if a in rows.columns]
            state = rows.groupBy("host").agg(*sums)
        last, folder = folder, fresh_folder(state.sparkSession, "llm", "host_trust")
        state.write.parquet(folder)
        state = state.sparkSession.read.schema(state.schema).parquet(folder)
        change = state.agg(F.max(F.greatest(moved("trust", "t0"), moved("distrust", "d0")))).first()[0] or 0.0
        state = state.select("host", "trust", "distrust")
        if last:
            delete_folder(state.sparkSession, last)
    return state


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = 1.0,
    digits: int = 12,
) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` of every page.

    A host without a rule's verdict is blocked when its distrust is over ``threshold``
    times its trust by more than ``10 ** (3 - digits)`` of it (sums differ by rounding),
    so verdicts do not depend on the size of the corpus.  A host's seed weight is the
    number of its pages that rules allow or block.
    """
    at = pages.select(F.col(id_col), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = at.select(
        id_col,
        "host",
        "path",
        rule_of(F.col("host"), F.col("path"), rules, lambda r: r.text).alias("rule"),
        rule_of(F.col("host"), F.col("path"), rules, lambda r: r.verdict).alias("said"),
    )
    seeds = (
        ruled.where("said is not null and host != ''")
        .groupBy("host")
        .agg(F.count_if(F.col("said") == "allow").alias("good"), F.count_if(F.col("said") == "block").alias("bad"))
    )
    trust = propagate(host_links(pages, url, html), seeds)
    verdicts = trust.select(
        "host",
        (F.col("distrust") > threshold * F.col("trust") * (1 + 10.0 ** (3 - digits))).alias("bad"),
        "trust",
        "distrust",
    )
    return ruled.join(verdicts, "host", "left").select(
        id_col,
        "host",
        "path",
        "rule",
        F.coalesce("said", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
