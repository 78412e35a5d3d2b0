"""Verdicts on pages by rules for their urls and by their hosts' place in the link graph.

Pages that a rule allows make their host a trusted seed, pages that a rule blocks a
blocked one, by their share. Trust follows links forward (personalised PageRank from
the trusted seeds), distrust follows them backward from the blocked ones: a host that
links to blocked hosts is suspect. A page without a rule gets its host's verdict.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import chosen, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.75  # share of a host's rank that its links pass on
EQUAL = 1e-9  # ranks that differ by a smaller part are equal
ROUNDS = 8  # links that ranks move over between looks at whether all is settled
MARGIN = 1.0  # distrust above this many times the trust blocks a host

RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    without one."""
    rest = _after(url)
    return F.translate(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def fitting(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule for the host or a domain above it whose path
    the path begins with, or null; of equally long ones the first in the alphabet, and a
    rule given twice blocks if one of them does."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0], r[1] != "block"))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(ordered):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): how many links a host's pages have to a host. Links without a host
    of their own stay on the page's. Pages and links without a host count nothing."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    found = chosen(pages, url="string", html="string").select(
        host_of(F.col("url")).alias("src"), F.explode(hrefs).alias("href")
    )
    target = F.when(F.startswith("href", F.lit("//")), host_of(F.concat(F.lit("x:"), "href"))).when(
        F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(F.col("href"))
    ).when(F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit("")).otherwise(F.col("src"))
    hosts = found.select("src", target.alias("dst")).where("src <> '' AND dst <> ''")
    return hosts.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, margin: float = MARGIN) -> DataFrame:
    """(kind, host, rank) from edges (kind, a, b, share), the share of a's rank that goes
    to b, and seeds (kind, host, seed).

    rank = (1 - damping) * sum over k of damping**k * (seed pushed over k links). What
    isn't passed on by a host without links is gone. Ranks move until no verdict can
    change: until no host is reached for the first time, and every host's distrust is
    so far from ``margin`` times its trust, or both so near, that all that is still on its
    way changes nothing. Kinds are propagated together; what a host gets is summed before
    it is shuffled.
    """
    moving = stored(seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank")), "seeds")
    total = moving
    while True:
        parts, last = [total], moving
        for _ in range(ROUNDS):
            sent = (
                moving.withColumnRenamed("kind", "of")
                .join(edges, (F.col("of") == F.col("kind")) & (F.col("host") == F.col("a")))
                .groupBy("kind", F.col("b").alias("host"))
                .agg((F.sum(F.col("rank") * F.col("share")) * damping).alias("rank"))
            )
            last, moving = moving, stored(sent, "ranks")
            parts.append(moving)
        before = parts[0]
        for more in parts[1:-1]:
            before = before.unionByName(more)
        before = before.select(F.col("kind").alias("of"), F.col("host").alias("known")).distinct()
        first = moving.join(before, (F.col("kind") == F.col("of")) & (F.col("host") == F.col("known")), "left_anti")
        # All that a host can still get of a kind.
        waiting = dict(moving.groupBy("kind").agg(F.sum("rank") * damping / (1 - damping)).collect())
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        total = stored(every.groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "totals")
        if not waiting:
            return total
        if first.isEmpty() and _unsettled(total, waiting, margin).isEmpty():
            return total


def _unsettled(total: DataFrame, waiting: dict[str, float], margin: float) -> DataFrame:
    """Hosts with both ranks whose verdict what is on its way may change. A host that a
    kind doesn't reach by now has none of it."""
    by_host = _by_host(total).where("trust > 0 AND distrust > 0")
    trust, distrust = F.col("trust") * margin, F.col("distrust")
    up, down = F.lit(waiting.get("distrust", 0.0)), F.lit(waiting.get("trust", 0.0) * margin)
    blocked, allowed = distrust - trust > down, trust - distrust >= up
    equal = F.abs(distrust - trust) + up + down <= EQUAL * F.greatest(trust, distrust)
    return by_host.where(~(blocked | allowed | equal))


def _by_host(found: DataFrame) -> DataFrame:
    """(host, trust, distrust)."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return found.groupBy("host").agg(of("trust"), of("distrust"))


def ranks(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """(host, trust, distrust), for hosts that have either."""
    found = chosen(pages, url="string").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    judged = stored(
        found.where("host <> ''")
        .select("host", fitting(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("verdict") == "allow").alias("trust"),
            F.count_if(F.col("verdict") == "block").alias("distrust"),
        ),
        "hosts",
    )
    by_kind = judged.unpivot(["host", "pages"], ["trust", "distrust"], "kind", "n").where("n > 0")
    seeds = by_kind.select("kind", "host", (F.col("n") / F.col("pages")).alias("seed"))
    graph = stored(links(pages), "links")
    both = graph.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n").union(
        graph.select(F.lit("distrust"), "dst", "src", "n")
    )
    out = both.groupBy("kind", "a").agg(F.sum("n").alias("all")).withColumnsRenamed({"kind": "k", "a": "from"})
    edges = stored(
        both.join(out, (F.col("k") == F.col("kind")) & (F.col("from") == F.col("a"))).select(
            "kind", "a", "b", (F.col("n") / F.col("all")).alias("share")
        ),
        "shares",
    )
    return _by_host(propagated(edges, seeds))


def verdicts(pages: DataFrame, rules: list[tuple[str, str]] = RULES, margin: float = MARGIN) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per row of ``pages``.

    The longest fitting rule decides; without one a host is blocked if its distrust is
    above ``margin`` times its trust by more than a part EQUAL of it, else allowed, so a
    host nothing is known about is allowed. A null url, or one without ``://``, has an empty host and path, and no rank.
    """
    scores = stored(ranks(pages, rules), "host-ranks").withColumnRenamed("host", "ranked")
    found = chosen(pages, page_id="long", url="string").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    found = found.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    joined = found.join(scores, F.col("host") == F.col("ranked"), "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    by_host = F.when(distrust - margin * trust > EQUAL * distrust, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_host).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
