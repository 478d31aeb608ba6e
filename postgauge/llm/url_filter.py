"""URL filters: rules, and for the rest the reputation that hosts earned by labelled pages.

A host's outcomes are shrunk towards its registered domain, the domain's towards its public
suffix, the suffix's towards all labelled pages. Each level is a beta-binomial model: children
of a parent have rates that follow a beta distribution around the parent's rate, whose
strength is estimated from the spread of the children (empirical Bayes, method of moments). A
host is blocked if the upper bound of its posterior rate of good pages is below `floor`:
there is evidence against it, not just a lack of evidence for it. For a host without outcomes
that is the rate that its registered domain's outcomes predict for a further host, or else the
rate that its suffix predicts for a further domain. All of it is joins and sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.llm.tables import materialise, small

TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")


@dataclass(frozen=True)
class Rule:
    """`text` is a host with all its subdomains, a slash, and how the path goes on."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def host(url: str) -> Column:
    """What follows the first `://`, ASCII letters in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits columns `host` and `path`, else null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        under = (F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))
        fits = under & F.startswith("path", F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _labels_of(name: Column) -> Column:
    return F.split(name, r"\.")


def public_suffix(name: str) -> Column:
    parts = _labels_of(F.col(name))
    two = F.array_join(F.slice(parts, -2, 2), ".")
    is_two = (F.size(parts) >= 2) & two.isin(*TWO_PART_SUFFIXES)
    return F.when(is_two, two).otherwise(F.element_at(parts, -1))


def registered_domain(name: str, suffix: str) -> Column:
    """The suffix and one label before it; a name that is no longer is its own domain."""
    parts = _labels_of(F.col(name))
    n = F.least(F.size(_labels_of(F.col(suffix))) + 1, F.size(parts))
    return F.array_join(F.slice(parts, -n, n), ".")


def _rates(children: DataFrame, parent: str) -> DataFrame:
    """Strength of the beta prior over the children of each parent: (parent, strength, unseen).

    With child rates p, sizes n and the pooled rate m, the spread beyond what sampling explains
    is sum(n (p - m)^2) - m (1 - m) (k - 1), over N - sum(n^2) / N; the strength is
    m (1 - m) / spread - 1, held between 1 and 1000 pages. One child shows no spread: `unseen`,
    the strength for children without outcomes, is the least one then.
    """
    sums = children.groupBy(parent).agg(
        F.sum("good").alias("g"), F.sum("n").alias("t"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("gg"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    )
    m = F.col("g") / F.col("t")
    width = F.col("t") - F.col("nn") / F.col("t")
    between = F.col("gg") - F.col("t") * m * m - m * (1 - m) * (F.col("k") - 1)
    spread = F.when(width > 0, between / width)
    strength = F.when(spread > 0, F.least(F.greatest(m * (1 - m) / spread - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(1000.0)
    return sums.select(parent, strength.alias("strength"), F.when(F.col("k") > 1, strength).otherwise(1.0).alias("unseen"))


def _shrunk(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Children with a (alpha) and b (beta) of their posteriors; `parents` has its rate as `prior`."""
    joined = children.join(parents, parent).join(_rates(children, parent), parent)
    a = F.col("good") + F.col("strength") * F.col("prior")
    return joined.withColumn("a", a).withColumn("b", F.col("n") + F.col("strength") - a)


def _predicted(parents: DataFrame, children: DataFrame, parent: str) -> DataFrame:
    """(parent, a, b): the rate of a child without outcomes, from the posteriors of `parents`.

    Its variance is the parent's own and, around that, the children's; a and b have it and the mean.
    """
    joined = parents.select(parent, "a", "b").join(_rates(children, parent).select(parent, "unseen"), parent)
    size, strength = F.col("a") + F.col("b"), F.col("unseen")
    part = strength / (size + strength + 1)  # a + b becomes size * strength / (size + strength + 1)
    return joined.select(parent, (F.col("a") * part).alias("a"), (F.col("b") * part).alias("b"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, page_id: str, good: str, floor: float, z: float = 1.96) -> DataFrame:
    """Per host: n, good, a, b, upper (posterior bound by normal approximation), bad.

    `pages` has `page_id` and `host`; `outcomes` has `page_id` and `good`, 1 or 0. Rows without
    host or outcome don't count; a page that is labelled twice counts twice. Hosts without
    outcomes have an n of 0, and null for a, b and upper where neither their domain nor their
    suffix has any, or where they are addresses of digits, which have no domain.
    """
    known = outcomes.select(F.col(page_id).alias("_id"), F.col(good).cast("double").alias("_good")).where("_good is not null")
    named = pages.where("host <> ''").select(F.col(page_id).alias("_id"), "host")
    # Summed before names are taken apart: a hot host is one row from here on.
    counted = named.join(known, "_id").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good"))
    hosts = materialise(
        counted.withColumn("suffix", public_suffix("host")).withColumn("domain", registered_domain("host", "suffix"))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("root", F.lit(""))
    whole = suffixes.groupBy("root").agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("prior"))
    rate = (F.col("a") / (F.col("a") + F.col("b"))).alias("prior")
    of_suffix = _shrunk(suffixes, whole, "root")
    of_domain = _shrunk(domains, of_suffix.select("suffix", rate), "suffix")
    judged = _shrunk(hosts, of_domain.select("domain", rate), "domain").select("host", "n", "good", "a", "b")
    rest = named.select("host").distinct().join(hosts.select("host"), "host", "left_anti")
    rest = rest.withColumn("suffix", public_suffix("host")).withColumn("domain", registered_domain("host", "suffix"))
    near = small(materialise(_predicted(of_domain, hosts, "domain").withColumnsRenamed({"a": "a1", "b": "b1"})), 100_000)
    far = small(materialise(_predicted(of_suffix, domains, "suffix").withColumnsRenamed({"a": "a2", "b": "b2"})), 100_000)
    named_so = ~F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$")
    a, b = (F.when(named_so, F.coalesce(f"{x}1", f"{x}2")).alias(x) for x in "ab")
    zero = F.lit(0)
    unseen = rest.join(near, "domain", "left").join(far, "suffix", "left").select(
        "host", zero.cast("bigint").alias("n"), zero.cast("double").alias("good"), a, b
    )
    total, mean = F.col("a") + F.col("b"), F.col("a") / (F.col("a") + F.col("b"))
    upper = mean + z * F.sqrt(mean * (1 - mean) / (total + 1))
    return judged.unionByName(unseen).withColumn("upper", upper).withColumn("bad", F.coalesce(F.col("upper") < floor, F.lit(False)))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", page_id: str = "page_id",
    good: str = "quality", floor: float = 0.8,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (`block` or `allow`).

    A url that is null or has no `://` has an empty host and path, which no rule fits, and is
    allowed, like every host whose labelled pages, or without any those of its domain or else
    its suffix, don't fall short. Rows that repeat are judged each; other columns of `pages` are not looked at. Empty tables give no rows.
    """
    placed = pages.select(F.col(page_id).alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    outcomes = outcomes.select(F.col(page_id).alias("page_id"), F.col(good).alias("good"))
    bad = materialise(host_reputation(placed, outcomes, "page_id", "good", floor).where("bad").select("host", "bad"))
    text, verdict = best_rule(rules)
    judged = placed.withColumn("rule", text).withColumn("by_rule", verdict).join(small(bad, 10_000), "host", "left")
    earned = F.when(F.col("bad"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", earned).alias("verdict"))
