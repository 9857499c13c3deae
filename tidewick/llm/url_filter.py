"""URL filters: rules first, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted by host. Rates are shrunk down a hierarchy: the corpus to the suffix, the
suffix to the registered domain, the domain to the host. At each level a unit's outcomes are beta-binomial: its prior has
the parent's posterior mean and a strength fitted by moments, from how much rates spread around their parents beyond
chance; where they don't, the strength is infinite and all units have their parent's rate. A host without labels gets its
domain's posterior, and so on up. A page is blocked when the lower bound of its host's bad rate (posterior mean less ``Z``
standard deviations) passes the corpus's rate by the factor ``LIFT``: how common bad pages are differs between corpora, and
a fixed limit would block all or none.

The suffixes under which names are registered are given as public-suffix rules (``co.uk``, ``*.ck``, ``!www.ck``), or else
told by a short rule; user names and ports don't count, and an address of numbers is its own domain.

Counting is a partial aggregation by host, and pages meet their host's verdict by a broadcast of checked size or salted, so
that a host with a third of all pages is no hot spot; only a few sums for each level reach the driver.

Rules are (action, host, path): a rule fits its host and all subdomains if the url's path starts with the rule's, the
longest fitting one wins (of equally long ones the first in order of action, host and path) and overrides the reputation.

Defined cases: a null url, or one without ``://``, has an empty host and path, which are judged like any other; long urls
are read whole; pages without labels only use the priors; without any label all are allowed; repeated rows each get their
verdict, and each counts; columns named like a result (host, path, rule, verdict, bad_rate, bound) are replaced, others pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST, checkpointed, meet, scratch

LIFT = 1.25
Z = 1.645
POOLED = 1e15  # stands for an infinite strength
LEAST = 1e-3  # so that a host without labels has its parent's rate, however much rates spread
# Without rules, suffixes are one label, or two for these.
LONG_SUFFIX = r"(?:co|com|net|org|gov|ac|edu)\.[a-z]{2}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def bare(host: Column) -> Column:
    """The host without user name and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def registered(hosts: DataFrame, rules: Sequence[str] | None = None) -> DataFrame:
    """Rows (host, ...) with domain and suffix; the domain is the suffix and one label before it. rules: public-suffix rules."""
    labels, numeric = F.split(bare(F.col("host")), r"\."), bare(F.col("host")).rlike(r"^([0-9]+\.){3}[0-9]+$|^\[")
    if rules is None:
        size = F.when(bare(F.col("host")).rlike(rf"(^|\.){LONG_SUFFIX}$"), 2).otherwise(1)
        found = hosts.withColumn("size_", size)
    else:
        table = hosts.sparkSession.createDataFrame([(r.removeprefix("!"), r.startswith("!")) for r in rules], "rule_ string, except_ boolean")
        last = lambda n: F.array_join(F.slice(F.col("labels_"), F.size("labels_") - n + 1, n), ".")
        names = hosts.select("host", labels.alias("labels_")).select("host", "labels_", F.explode(F.sequence(F.lit(1), F.size("labels_"))).alias("n_"))
        # The last n labels, and with a star for the first of them, may be rules.
        names = names.select("host", "n_", F.explode(F.array(last(F.col("n_")), F.concat(F.lit("*."), F.when(F.col("n_") > 1, last(F.col("n_") - 1))))).alias("rule_"))
        best = names.join(F.broadcast(table), "rule_").groupBy("host").agg(F.max(F.struct("except_", "n_")).alias("best_"))
        sizes = best.select("host", (F.col("best_.n_") - F.col("best_.except_").cast("int")).alias("size_"))
        found = hosts.join(sizes, "host", "left").withColumn("size_", F.coalesce("size_", F.lit(1)))
    tail = lambda n: F.when(numeric, bare(F.col("host"))).otherwise(F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), n), "."))
    return found.withColumns({"domain": tail(F.col("size_") + 1), "suffix": F.when(numeric, "").otherwise(tail(F.col("size_")))}).drop("size_")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its action, or nulls. Rules are a parameter, so that there are few."""
    rule = action = None
    for verb, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == at) | F.endswith(host, F.lit(f".{at}"))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        action = F.when(fits, verb) if action is None else action.when(fits, verb)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, action)


def _strength(units: DataFrame) -> float:
    """The prior's strength by moments, from units with their number n, bad ones k and their parent's mean m.

    The squared deviations of k from n m are n m (1 - m) by chance alone and n (n - 1) m (1 - m) / (1 + strength) beyond it.
    """
    chance = F.col("m") * (1 - F.col("m"))
    sums = units.where("n > 0").agg(
        F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) - F.col("n") * chance).alias("beyond"),
        F.sum(F.col("n") * (F.col("n") - 1) * chance).alias("room"),
    ).head()
    share = sums["beyond"] / sums["room"] if sums["room"] else 0.0
    return max(LEAST, 1 / share - 1) if share > 0 else POOLED


def corpus_rate(n: int | None, k: int | None) -> float:
    """The share of bad outcomes, one of each sort added, so that it is never 0 or 1."""
    return ((k or 0) + 1) / ((n or 0) + 2)


def reputations(outcomes: DataFrame, z: float = Z, suffixes: Sequence[str] | None = None) -> DataFrame:
    """From rows (host, bad: 1, 0 or null where unlabelled, and times, where there is such a column), a row for each host.

    Its labelled outcomes, the posterior mean and deviation of its bad rate and their lower bound; corpus is the rate of all.
    """
    times = F.col("times") if "times" in outcomes.columns else F.lit(1)
    counts = {"n": F.sum(F.when(F.col("bad").isNotNull(), times).otherwise(0)), "k": F.sum(F.when(F.col("bad") == 1, times).otherwise(0))}
    hosts = checkpointed(registered(outcomes.groupBy("host").agg(*[x.alias(c) for c, x in counts.items()]), suffixes))
    summed = [F.sum(c).alias(c) for c in counts]
    domains = hosts.groupBy("suffix", "domain").agg(*summed)
    suffixed = domains.groupBy("suffix").agg(*summed)
    overall = corpus_rate(*suffixed.agg(*summed).head())

    def shrunk(units: DataFrame) -> DataFrame:
        strength = _strength(units)
        return units.withColumns({"a": F.col("k") + strength * F.col("m"), "b": F.col("n") - F.col("k") + strength * (1 - F.col("m"))})

    mean = F.col("a") / (F.col("a") + F.col("b"))
    tops = shrunk(suffixed.withColumn("m", F.lit(overall))).select("suffix", mean.alias("m"))
    domains = shrunk(domains.join(tops, "suffix")).select("suffix", "domain", mean.alias("m"))
    hosts = shrunk(hosts.join(domains, ["suffix", "domain"]))
    spread = F.sqrt(mean * (1 - mean) / (F.col("a") + F.col("b") + 1))
    return hosts.select(
        "host", "domain", "suffix", F.col("n").alias("labelled"), mean.alias("bad_rate"), spread.alias("deviation"), F.greatest(F.lit(0.0), mean - z * spread).alias("bound"), F.lit(overall).alias("corpus")
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = (), url_col: str = "url", lift: float = LIFT, suffixes: Sequence[str] | None = None, broadcast: int = BROADCAST
) -> DataFrame:
    """pages with host, path, rule, verdict, bad_rate and bound. outcomes: as for ``reputations``."""
    made = ("host", "path", "rule", "verdict", "bad_rate", "bound")
    host, path, rate, bound, corpus = scratch(pages, "host", "path", "bad_rate", "bound", "corpus")
    found = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    known = reputations(outcomes, suffixes=suffixes).select(F.col("host").alias(host), F.col("bad_rate").alias(rate), F.col("bound").alias(bound), F.col("corpus").alias(corpus))
    rule, action = rule_for(F.col(host), F.col(path), rules)
    learned = F.when(F.col(bound) > lift * F.col(corpus), "block").otherwise("allow")
    results = zip((F.col(host), F.col(path), rule, F.coalesce(action, learned), F.col(rate), F.col(bound)), made)
    return meet(found, known, host, broadcast).select(*[c for c in pages.columns if c not in made], *[x.alias(c) for x, c in results])
