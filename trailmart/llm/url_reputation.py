"""URL filters: rules first, then empirical-Bayes reputation of the host.

Every page is an outcome of its host: bad if a rule blocks it, else not, so that a host's clean
pages lower its bound. The counts per host are shrunk through beta-binomial priors: a suffix
towards all outcomes, a registered domain towards its suffix, a host towards its domain. How
strongly is estimated at each level from how far the children scatter around their parents. A
host is blocked if the lower bound of its posterior share of bad pages reaches ``LEAST_BLOCKED``.
Only DataFrame functions are used.

Domain and suffix come from the host without user information, port and trailing dots. A suffix
is the last label, or two of them under a country's code where the second is one of
``SECOND_LABELS``, which is an argument. Addresses are their own domains, with one suffix.

A null url or one without ``://`` has an empty host and path; the empty host is a host like
any other. Repeated pages count and are judged each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import stored

#: Standard deviations of the one-sided bound, and the bound from which a host is blocked:
#: with 95 % confidence, at least a tenth of its pages are bad.
DEVIATIONS, LEAST_BLOCKED = 1.645, 0.1
#: Bounds of the estimated correlation of outcomes within a group.
LEAST_CORRELATION, MOST_CORRELATION = 0.01, 0.99
# Labels that, before a country's code, make a suffix of two labels.
SECOND_LABELS = (
    "ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "id", "ltd", "mil", "ne", "net", "nom",
    "or", "org", "plc", "sch",
)
#: What precedes, follows and makes up a name, alike in both engines' patterns.
USER, PORT, DOTS = r"^[\s\S]*@", r":[0-9]*\z", r"\.+\z"
ADDRESS, ADDRESSES = r"^([0-9]+(\.[0-9]+){3}|\[[\s\S]*)\z", "[address]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return host & F.col("path").startswith(self.path)


def located(pages: DataFrame) -> DataFrame:
    """(page_id, host, path) of each page."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rows = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    rows = rows.select("page_id", "rest", host.alias("raw"))
    after = F.expr("substring(rest, length(raw) + 1)")
    return rows.select(
        "page_id",
        F.translate("raw", UPPER, LOWER).alias("host"),
        F.regexp_extract(after, r"^[^?#]*", 0).alias("path"),
    )


def ruled(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """With ``rule`` and ``rule_verdict``: the longest rule that fits, null if none does."""
    longest_first = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    named = [F.when(rule.fits(), rule.name) for rule in longest_first]
    verdicts = [F.when(F.col("rule") == rule.name, rule.verdict) for rule in longest_first]
    nothing = F.lit(None).cast("string")
    rows = rows.withColumn("rule", F.coalesce(*named, nothing))
    return rows.withColumn("rule_verdict", F.coalesce(*verdicts, nothing))


def _two_labels(second_labels: tuple[str, ...]) -> str:
    return rf"^({'|'.join(second_labels)})\.[a-z]{{2}}\z"


def with_domains(hosts: DataFrame, second_labels: tuple[str, ...] = SECOND_LABELS) -> DataFrame:
    """With ``suffix`` and ``domain``, the name registered under it."""
    name = F.col("host")
    for pattern in (USER, PORT, DOTS):
        name = F.regexp_replace(name, pattern, "")
    last = F.substring_index("bare_name", ".", -2)
    address = F.col("bare_name").rlike(ADDRESS)
    parted = hosts.withColumn("bare_name", name)
    parted = parted.withColumn("deep", F.when(last.rlike(_two_labels(second_labels)), 2).otherwise(1))
    return parted.withColumns(
        {
            "suffix": F.when(address, ADDRESSES).otherwise(
                F.expr("substring_index(bare_name, '.', -deep)")
            ),
            "domain": F.when(address, F.col("bare_name")).otherwise(
                F.expr("substring_index(bare_name, '.', -deep - 1)")
            ),
        }
    ).drop("bare_name", "deep")


def _strength(children: DataFrame, parent: str) -> float:
    """Prior outcomes that a parent is worth to its children, by the method of moments.

    ``children`` has ``n`` and ``k`` of each child and its parent's ``n_parent``,
    ``k_parent``. The correlation within children is the scatter around the parents beyond
    what chance gives, over the most it could be.
    """
    children = children.filter("n > 0")
    share = F.col("k_parent") / F.col("n_parent")
    each = children.groupBy(parent, "n_parent", "k_parent").agg(
        F.count("*").alias("groups"),
        F.sum(F.col("n") * (F.col("k") / F.col("n") - share) ** 2).alias("scatter"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    )
    chance = share * (1 - share)
    free = F.col("groups") - 1
    found = each.agg(
        F.sum(F.col("scatter") - free * chance).alias("beyond"),
        F.sum(chance * (F.col("n_parent") - F.col("squares") / F.col("n_parent") - free)).alias(
            "most"
        ),
    ).head()
    most, beyond = found["most"] or 0.0, found["beyond"] or 0.0
    correlation = beyond / most if most > 0 else MOST_CORRELATION
    correlation = min(max(correlation, LEAST_CORRELATION), MOST_CORRELATION)
    return (1 - correlation) / correlation


def _with_parents(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    known = parents.select(
        parent,
        F.col("n").alias("n_parent"),
        F.col("k").alias("k_parent"),
        F.col("mean").alias("prior"),
    )
    return children.join(known, parent)


def _shrunk(joined: DataFrame, parent: str) -> DataFrame:
    """Children with ``strength`` and ``mean``, that of their posterior."""
    strength = _strength(joined, parent)
    mean = (F.col("k") + strength * F.col("prior")) / (F.col("n") + strength)
    return joined.withColumn("strength", F.lit(strength)).withColumn("mean", mean)


def reputations(
    outcomes: DataFrame, second_labels: tuple[str, ...] = SECOND_LABELS
) -> DataFrame:
    """(host, mean, bound) from (host, bad) rows; bad is null where nothing is known."""
    counted = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k")
    )
    hosts = stored(with_domains(counted, second_labels), "hosts")

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    domains = stored(summed(hosts, "domain", "suffix"), "domains")
    whole = domains.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).head()
    n, k = whole["n"] or 0, whole["k"] or 0
    parent = {"everything": 1, "n_parent": max(n, 1), "k_parent": k, "prior": k / max(n, 1)}
    suffixes = summed(domains, "suffix")
    suffixes = suffixes.withColumns({name: F.lit(value) for name, value in parent.items()})
    suffixes = _shrunk(suffixes, "everything")
    domains = _shrunk(_with_parents(domains, suffixes, "suffix"), "suffix")
    hosts = _shrunk(_with_parents(hosts, domains, "domain"), "domain")
    a = F.col("k") + F.col("strength") * F.col("prior")
    b = F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("prior"))
    deviation = F.sqrt(a * b / (a + b + 1)) / (a + b)
    return hosts.select("host", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound"))


def judged(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    least_blocked: float = LEAST_BLOCKED,
    second_labels: tuple[str, ...] = SECOND_LABELS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page."""
    rows = ruled(located(pages), rules)
    bad = F.coalesce(F.col("rule_verdict") == "block", F.lit(False))
    known = stored(reputations(rows.select("host", bad.alias("bad")), second_labels), "reputations")
    blocked = known.select("host", (F.col("bound") >= least_blocked).alias("blocked"))
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return rows.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict")
    )


def oracle(rules: tuple[Rule, ...]) -> str:
    """The same as one DuckDB statement over ``pages``."""
    longest_first = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}'))"
        f" AND starts_with(path, '{r.path}') THEN '{r.name}'"
        for r in longest_first
    )
    blocks = ", ".join(f"'{r.name}'" for r in rules if r.verdict == "block")
    def level(name: str, children: str, parent: str, parents: str) -> str:
        return f"""
        {name}_joined AS (
            SELECT c.*, p.n AS n_parent, p.k AS k_parent, p.mean AS prior
            FROM {children} c JOIN {parents} p USING ({parent})
        ), {name}_each AS (
            SELECT {parent}, n_parent, k_parent / n_parent AS share, count(*) - 1 AS free,
                   sum(n * (k / n - k_parent / n_parent) ** 2) AS scatter, sum(n * n) AS squares
            FROM {name}_joined WHERE n > 0 GROUP BY {parent}, n_parent, k_parent
        ), {name}_moments AS (
            SELECT coalesce(sum(scatter - free * share * (1 - share)), 0) AS beyond,
                   coalesce(sum(share * (1 - share) * (n_parent - squares / n_parent - free)), 0)
                       AS most
            FROM {name}_each
        ), {name}_strength AS (
            SELECT (1 - c) / c AS strength FROM (
                SELECT least(greatest(CASE WHEN most > 0 THEN beyond / most
                    ELSE {MOST_CORRELATION}::DOUBLE END, {LEAST_CORRELATION}::DOUBLE),
                    {MOST_CORRELATION}::DOUBLE) AS c
                FROM {name}_moments)
        ), {name} AS (
            SELECT j.*, strength, (k + strength * prior) / (n + strength) AS mean
            FROM {name}_joined j, {name}_strength
        )"""

    return f"""
    WITH rest AS (
        SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), cut AS (
        SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest
    ), located AS (
        SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
               regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM cut
    ), ruled AS (
        SELECT *, CASE {fits} END AS rule FROM located
    ), counted AS (
        SELECT host, count(*)::DOUBLE AS n,
               count(*) FILTER (WHERE rule IN ({blocks}))::DOUBLE AS k
        FROM ruled GROUP BY host
    ), bare AS (
        SELECT *, regexp_replace(regexp_replace(regexp_replace(host,
            '{USER}', ''), '{PORT}', ''), '{DOTS}', '') AS name FROM counted
    ), parted AS (
        SELECT *, string_split(name, '.') AS labels, regexp_matches(name, '{ADDRESS}') AS address,
               CASE WHEN regexp_matches(array_to_string(string_split(name, '.')[-2:], '.'),
                    '{_two_labels(SECOND_LABELS)}') THEN 2 ELSE 1 END AS deep
        FROM bare
    ), hosts0 AS (
        SELECT host, n, k,
               CASE WHEN address THEN '{ADDRESSES}'
                    ELSE array_to_string(labels[-deep:], '.') END AS suffix,
               CASE WHEN address THEN name
                    ELSE array_to_string(labels[-deep - 1:], '.') END AS domain FROM parted
    ), domains0 AS (
        SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts0 GROUP BY ALL
    ), suffixes0 AS (
        SELECT suffix, 1 AS everything, sum(n) AS n, sum(k) AS k FROM domains0 GROUP BY ALL
    ), whole AS (
        SELECT 1 AS everything, sum(n) AS n, sum(k) AS k,
               CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0 END AS mean FROM suffixes0
    ), {level("suffixes", "suffixes0", "everything", "whole")}
    , {level("domains", "domains0", "suffix", "suffixes")}
    , {level("hosts", "hosts0", "domain", "domains")}
    , shaped AS (
        SELECT host, mean, k + strength * prior AS a, n - k + strength * (1 - prior) AS b
        FROM hosts
    ), bounds AS (
        SELECT host, mean - {DEVIATIONS} * (sqrt(a * b / (a + b + 1)) / (a + b)) AS bound
        FROM shaped
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ({blocks}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                WHEN bound >= {LEAST_BLOCKED} THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled LEFT JOIN bounds USING (host)
    """
