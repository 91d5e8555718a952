"""Host reputation by empirical Bayes: from host to registered domain to suffix.

Outcomes of labelled pages are counted by host. Rates shrink level by level: the rate of
all pages is the prior of a suffix, the posterior mean of the suffix is the prior of its
registered domains, and theirs of its hosts; the strength of each prior comes from the
moments of the rates at its level. A host is blocked if the lower bound of its posterior
rate of bad pages is above the limit. Rules, a short list of the caller, come first.

Defined results: a null url, or one without ``://``, has an empty host and path, and no
rule fits it; a null page id stays null; a page without a label is no outcome; repeated
rows are judged each, and counted each; without any labels every host is allowed; a host
without labelled pages has its domain's rate; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: (verdict, host, path): a rule fits its host and all subdomains.
Rule = tuple[str, str, str]
BAD_LIMIT = 0.5
Z = 1.645
MAX_STRENGTH = 1000.0
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> list[Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.when(url.contains("://"), F.expr(f"substring({{0}}, position('://', {{0}}) + 3)".format("__url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return [host.alias("host"), path.alias("path")]


def _fitting_rule(rules: list[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as (size, rule, verdict)."""
    listed = F.array(
        *[
            F.struct(
                F.lit(len(host + path)).alias("size"),
                F.lit(host + path).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit(host).alias("host"),
                F.lit(path).alias("path"),
            )
            for verdict, host, path in rules
        ]
    )
    host, path = F.col("host"), F.col("path")
    fits = F.filter(
        listed,
        lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]),
    )
    return F.array_max(fits)


def _labels(n: int) -> Column:
    """The last ``n`` labels of the host."""
    return F.substring_index("host", ".", -n)


def _strength(counts: DataFrame, prior: str) -> DataFrame:
    """One row: how strongly rates of ``counts (n, bad, prior)`` keep to their priors."""
    rate = F.col("bad") / F.col("n")
    off = (rate - F.col(prior)) * (rate - F.col(prior))
    noise = F.col(prior) * (1 - F.col(prior))
    sums = counts.where("n > 0").agg(
        F.coalesce(F.avg(off), F.lit(0.0)).alias("v"),
        F.coalesce(F.avg(noise), F.lit(0.0)).alias("s"),
        F.coalesce(F.avg(noise / F.col("n")), F.lit(0.0)).alias("c"),
    )
    between = F.col("v") - F.col("c")
    return sums.select(
        F.when(between > F.col("s") / (MAX_STRENGTH + 1), F.greatest(F.col("s") / between - 1, F.lit(1.0)))
        .otherwise(F.lit(MAX_STRENGTH))
        .alias("k")
    )


def host_posteriors(outcomes: DataFrame) -> DataFrame:
    """``(host, n, bad, mean, lower)`` from ``(host, n, bad)``, each host once."""
    hosts = outcomes.withColumns({"domain": _labels(2), "suffix": _labels(1)})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.coalesce(F.sum("bad") / F.sum("n"), F.lit(0.0)).alias("p"))
    suffixes = suffixes.withColumn("p", whole.scalar())
    suffixes = suffixes.withColumn("k", _strength(suffixes, "p").scalar())
    mean = (F.col("bad") + F.col("k") * F.col("p")) / (F.col("n") + F.col("k"))
    domains = domains.join(suffixes.select("suffix", mean.alias("p")), "suffix")
    domains = domains.withColumn("k", _strength(domains, "p").scalar())
    hosts = hosts.join(domains.select("domain", mean.alias("p")), "domain")
    hosts = hosts.withColumn("k", _strength(hosts, "p").scalar())
    a = F.col("bad") + F.col("k") * F.col("p")
    b = F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("p"))
    m = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select(
        "host", "n", "bad", F.round(m, 9).alias("mean"), F.round(m - Z * deviation, 9).alias("lower")
    )


def judge_pages(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    label_id: str = "doc_id",
    bad: Column | None = None,
) -> DataFrame:
    """Host, path, fitting rule and verdict of every row of ``pages``.

    ``labels`` says by ``label_id`` which pages are bad: ``bad``, an expression over its
    columns, is by default quality 0 or toxic 1.
    """
    is_bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    parsed = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("__url"))
    parsed = parsed.select("page_id", *host_and_path(F.col("__url")))
    parsed = written(parsed.withColumn("fit", _fitting_rule(rules)), "urls")
    marked = labels.select(F.col(label_id).alias("page_id"), is_bad.alias("is_bad")).where(
        F.col("page_id").isNotNull() & F.col("is_bad").isNotNull()
    )
    marked = marked.groupBy("page_id").agg(F.max("is_bad").alias("is_bad"))
    outcomes = parsed.join(marked, "page_id", "left").groupBy("host").agg(
        F.count("is_bad").alias("n"), F.coalesce(F.sum(F.col("is_bad").cast("long")), F.lit(0)).alias("bad")
    )
    posteriors = host_posteriors(outcomes).select("host", "mean", "lower")
    judged = parsed.join(posteriors, "host", "left")
    by_host = F.when(F.col("lower") > BAD_LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", by_host).alias("verdict"),
    )
