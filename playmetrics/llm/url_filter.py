"""URL filter: written rules first, then the reputation of the host by empirical Bayes.

Pages that are labelled count as good or bad outcomes of their host. A host's share of bad pages is
shrunk towards its registered domain, the domain's towards its suffix, and the suffix's towards
all pages: each level is a beta prior for the next, and its strength is fitted by moments from how
much the units below differ. A host is blocked if its share of bad pages lies above ``threshold``
even at the lower bound of the posterior. Hosts without outcomes inherit from the level above.

The suffix of a host is the longest of the given public suffixes that it ends with, or else its last
label; the registered domain has one label more. User, port and a dot at the end do not count for
the given suffixes. A host that is a suffix or a single label is its own domain and suffix, and so is
an IP address; an empty host is a unit like any other. Suffixes are plain names, without the
wildcards and exceptions of the public list; they are sent with the plan.

Nulls and edge cases: a null url, or one without ``://``, has an empty host and path. Null and
repeated labels: nulls do not count, repeated ones count as often as they occur. Repeated pages
get repeated rows. Without any outcome everything without a rule is allowed. An empty table gives
no rows. Only the named columns are read. A url may be of any length; it is held by one task, in
time that grows with its length.

Pages meet outcomes by id and hosts by name. Outcomes are summed on the map side; the join by
host is left to Spark, which splits hot hosts at run time. The sums of hosts, domains and suffixes
are stored, a row per unit, and so are the shares that a level hands down, so pages are read once
for the sums and once for the verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.exact_dedup import lower_ascii
from playmetrics.storage import store

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# A host is blocked if more than this share of its pages is bad, at the lower bound.
THRESHOLD = 0.5
# Standard deviations between the posterior mean and its lower bound.
BOUND = 2.0
# The least and the largest strength of a prior, in pages.
STRENGTH = (2.0, 1000.0)
# What surrounds a host's name, and IP addresses.
_AROUND = r"^.*@|\.?(:\d*)?$"
_ADDRESS = r"^(.*@)?(\d{1,3}(\.\d{1,3}){3}|\[.*\])\.?(:\d*)?$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(
        F.substring(after, F.length(host) + 1, F.length(after)), r"^[^?#]*", 0
    )
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, both null if none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _levels(host: Column, suffixes: Sequence[str] = ()) -> dict[str, Column]:
    by_labels: dict[int, list[str]] = {}
    for suffix in suffixes:
        by_labels.setdefault(suffix.count(".") + 1, []).append(suffix)
    name = F.regexp_replace(host, _AROUND, "")
    suffix, domain = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    for labels in sorted(by_labels):
        fits = F.substring_index(name, ".", -labels).isin(by_labels[labels])
        suffix = F.when(fits, F.substring_index(name, ".", -labels)).otherwise(suffix)
        domain = F.when(fits, F.substring_index(name, ".", -labels - 1)).otherwise(domain)
    address = host.rlike(_ADDRESS)
    return {
        "suffix": F.when(address, host).otherwise(suffix),
        "domain": F.when(address, host).otherwise(domain),
        "host": host,
    }


def _shrunk(units: DataFrame, above: DataFrame, parent: str | None) -> DataFrame:
    """Posterior share ``p`` of each unit, with the prior taken from its ``parent``.

    ``units`` has ``bad`` and ``n`` per unit. The strength s of the prior solves, by moments over
    all units of the level, E[n (x - m)^2] = m (1 - m) (1 + (n - 1) / (s + 1)), x being a unit's
    share and m its parent's.
    """
    joined = units.join(above, parent) if parent else units.crossJoin(F.broadcast(above))
    n, m = F.col("n").cast("double"), F.col("m")
    off = F.try_divide(F.col("bad"), n) - m
    within = m * (1 - m)
    known = joined.where((F.col("n") > 0) & (m > 0) & (m < 1))
    # the intra-unit correlation 1 / (s + 1)
    correlation = known.agg(
        F.try_divide(F.sum(n * off * off - within), F.sum(within * (n - 1))).alias("c")
    )
    low, high = (F.lit(x) for x in STRENGTH)
    c = F.greatest(F.coalesce("c", F.lit(0.0)), F.lit(1e-9))
    strength = F.greatest(low, F.least(high, 1 / c - 1)).alias("s")
    alpha, beta = m * F.col("s") + F.col("bad"), (1 - m) * F.col("s") + n - F.col("bad")
    return (
        joined.crossJoin(F.broadcast(correlation.select(strength)))
        .select("*", alpha.alias("alpha"), beta.alias("beta"))
        .withColumn("p", F.col("alpha") / (F.col("alpha") + F.col("beta")))
    )


def reputation(
    hosts: DataFrame,
    threshold: float = THRESHOLD,
    bound: float = BOUND,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """Per host ``p``, its lower bound ``low`` and ``host_verdict``.

    ``hosts`` has ``host``, ``bad`` and ``n``, one row per host, also for hosts without outcomes.
    Runs a job per level and stores what it finds.
    """
    sums = F.sum("bad").alias("bad"), F.sum("n").alias("n")
    units = store(hosts.select(
        *[c.alias(k) for k, c in _levels(F.col("host"), suffixes).items()], "bad", "n"
    ))
    per_domain = store(units.groupBy("suffix", "domain").agg(*sums))
    per_suffix = store(per_domain.groupBy("suffix").agg(*sums))
    # one page of each kind on top, so that the mean is never exactly 0 or 1
    everything = per_suffix.agg(
        ((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0))
        .alias("m")
    )
    shares = F.col("p").alias("m")
    of_suffixes = store(_shrunk(per_suffix, everything, None).select("suffix", shares))
    of_domains = store(_shrunk(per_domain, of_suffixes, "suffix").select("domain", shares))
    found = _shrunk(units.select("domain", "host", "bad", "n"), of_domains, "domain")
    a, b = F.col("alpha"), F.col("beta")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    low = F.col("p") - F.lit(bound) * deviation
    verdict = F.when(F.round(low, 9) > threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return found.select("host", "bad", "n", "p", low.alias("low"), verdict.alias("host_verdict"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    bad_col: str = "bad",
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``outcomes`` has the page id and ``bad_col``, true or false, of labelled pages.
    ``suffixes`` are public suffixes of more than one label, such as ``co.uk``, in lower case.
    Runs the jobs of ``reputation``.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", text.alias("rule"), verdict.alias("rule_verdict"))
    labelled = (
        outcomes.where(F.col(bad_col).isNotNull())
        .groupBy(F.col(id_col).alias("page_id"))
        .agg(F.sum(F.col(bad_col).cast("long")).alias("bad"), F.count(F.lit(1)).alias("n"))
    )
    per_host = ruled.join(labelled, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )
    verdicts = reputation(per_host, suffixes=suffixes).select("host", "host_verdict")
    return ruled.join(verdicts, "host").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "host_verdict").alias("verdict"),
    )
