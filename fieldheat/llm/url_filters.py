"""URL filters: rules for hosts and paths; trust and distrust spread over the links between hosts.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import stage

TOLERANCE = 1e-6
LEAST = 1e-300
STAGED_ROUNDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]*)"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def matching_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule for each distinct `host` and `path`: `host`, `path`, `rule`, `verdict`; no row without a rule.

    `rules` has `host`, `path` (both not null) and `verdict` ('allow' or 'block'). A rule fits its host and all
    subdomains if the path starts with its own. Length counts host and path together; of equally long rules, the one
    with the longer host, then 'block', wins. Hosts meet rules by an equi-join on each domain they lie in.
    """
    listed = rules.select(F.col("host").alias("domain"), F.col("path").alias("start"), "verdict").distinct()
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), ".")
    )
    inside = urls.select("host", "path").distinct().select("host", "path", F.explode(domains).alias("domain"))
    fits = inside.join(listed, "domain").where(F.startswith("path", "start"))
    size, own = F.length("domain") + F.length("start"), F.length("domain")
    order = F.struct(size.alias("size"), own.alias("own"), "verdict", "domain", "start")
    best = fits.groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", F.concat("best.domain", "best.start").alias("rule"), "best.verdict")


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Links between different hosts: `src`, `dst`, `weight` (pages of `src` that link to `dst`)."""
    source = host_of(F.col(url_col)).alias("src")
    targets = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1)))
    # //host/path takes the page's scheme.
    hosts = F.array_distinct(F.transform(targets, lambda t: host_of(F.when(t.startswith("//"), F.concat(F.lit("x:"), t)).otherwise(t))))
    found = pages.select(source, F.explode(hosts).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def spread(
    edges: DataFrame, seeds: DataFrame, damping: float, rounds: int | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """Personalised PageRank: `host`, `score`. `edges`: `src`, `dst`, `share` (adding up to 1 per `src`).

    `seeds`: `host`, `start` (adding up to 1). Every round passes on `damping` of each score along the links and gives
    the rest back to the seeds; what reaches hosts without links goes no further. Rounds go on until one reaches no new
    host and changes no score by more than `tolerance` of itself, or as many are made as `rounds` says. A host once
    reached keeps a score above zero, however far it is. Scores are written every few rounds, which keeps the plan small
    and survives lost executors. Sums are combined before the shuffle.
    """
    if damping >= 1 and rounds is None:
        raise ValueError("damping must be below 1 for scores to settle")
    score = seeds.select("host", F.col("start").alias("score"))
    done = 0
    while rounds is None or done < rounds:
        done += 1
        passed = edges.join(score, F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"), F.greatest(F.col("score") * F.col("share") * damping, F.lit(LEAST)).alias("score")
        )
        back = seeds.select("host", (F.col("start") * (1 - damping)).alias("score"))
        if done % STAGED_ROUNDS or done == rounds:
            score = passed.unionByName(back).groupBy("host").agg(F.sum("score").alias("score"))
            continue
        before = score.select("host", F.lit(0.0).alias("score"), F.col("score").alias("before"))
        both = passed.unionByName(back).withColumn("before", F.lit(0.0)).unionByName(before)
        score = stage(both.groupBy("host").agg(F.sum("score").alias("score"), F.sum("before").alias("before")), "host_scores")
        if rounds is None:
            # 1 where a host is new; never more in a later round than in an earlier one.
            change = score.agg(F.max(F.abs(F.col("score") - F.col("before")) / F.greatest("score", "before"))).first()[0]
            if (change or 0) <= tolerance:
                break
    return score.select("host", "score")


def seed_hosts(judged: DataFrame, verdict: str) -> DataFrame:
    """Hosts by their share of the pages that rules give this verdict: `host`, `start`."""
    own = judged.where(F.col("verdict") == verdict).groupBy("host").agg(F.count("*").alias("pages"))
    total = own.agg(F.sum("pages")).first()[0] or 1
    return own.select("host", (F.col("pages") / F.lit(total)).alias("start"))


def shares(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """`src`, `dst` and the part of all weight leaving `src`; either direction of the links."""
    weight = edges.groupBy(F.col(src).alias("src")).agg(F.sum("weight").alias("total"))
    picked = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), "weight")
    return picked.join(weight, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    damping: float = 0.85,
    rounds: int | None = None,
    threshold: float = 0.5,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """A verdict for every page: `id`, `host`, `path`, `rule` (null without one), `verdict`, `trust`, `distrust`.

    A page that a rule fits has the rule's verdict. Others have their host's: trust starts at hosts of allowed pages
    and follows links, distrust starts at hosts of blocked pages and follows links backwards; a host is blocked if
    distrust is more than `threshold` of both together, and allowed otherwise, also where neither reaches it. Both are
    spread until they settle (`spread`), through chains of any length; with `rounds`, so many links far only.

    Null urls and urls without `://` have an empty host and path, which no rule fits and no link reaches, so they are
    allowed. Null pages have no links. Links within a host do not count. Repeated rows are judged each. An empty table
    gives no rows. `rules` is joined like any table; Spark broadcasts it where its size is known to be small.
    """
    address = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    address = stage(address, "addresses")
    ruled = stage(matching_rules(address, rules), "ruled")
    judged = stage(address.join(ruled, ["host", "path"], "left"), "judged")
    links = stage(host_links(pages, url_col, html_col), "host_links")
    forward, backward = stage(shares(links, "src", "dst"), "forward_links"), stage(shares(links, "dst", "src"), "backward_links")
    trust = spread(forward, stage(seed_hosts(judged, "allow"), "trusted"), damping, rounds)
    distrust = spread(backward, stage(seed_hosts(judged, "block"), "distrusted"), damping, rounds)
    scores = trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(
        distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust"))
    )
    hosts = scores.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    known = judged.join(hosts, "host", "left").withColumns(
        {"trust": F.coalesce("trust", F.lit(0.0)), "distrust": F.coalesce("distrust", F.lit(0.0))}
    )
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict")
    return known.select("id", "host", "path", "rule", verdict, "trust", "distrust")
