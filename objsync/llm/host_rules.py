"""Quality rules by host: failures of documents, shrunk by an empirical beta prior.

Counts of each text are array expressions inside its row. Failures are aggregated by
host, the prior's mean and strength come from the moments of all hosts' rates, and a
host whose posterior failure rate is certain enough to exceed the limit loses all its
documents. Only counts are shuffled, never texts; the join back by host can be split.

Defined results: a null or empty text has no words and fails; a null host is one host
of its own; repeated rows count each; with fewer than two hosts, or rates that do not
differ more than chance makes them, the prior is as strong as ``MAX_STRENGTH``; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20
#: A host is dropped if its failure rate is above this by Z standard deviations.
HOST_LIMIT = 0.5
Z = 1.645
MAX_STRENGTH = 1000.0

_WHITE = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words in windows that a text has twice or more, the first time included."""

    def in_order(held: Column) -> Column:
        # places of windows by their hash: equal ones stand side by side
        def twice(x: Column, i: Column) -> Column:
            return (F.get(held, i - 1)["h"] == x["h"]) | (F.get(held, i + 1)["h"] == x["h"])

        places = F.filter(held, lambda x, i: F.coalesce(twice(x, i), F.lit(False)))
        return _let(F.sort_array(F.transform(places, lambda x: x["i"])), covered)

    def covered(places: Column) -> Column:
        # each window adds the words up to the next one's start
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda held, i: F.struct(
                (held["n"] + F.least(F.lit(WINDOW), i - held["last"])).alias("n"), i.alias("last")
            ),
            lambda held: held["n"],
        )

    def count(hashes: Column) -> Column:
        either = F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0))
        return either.otherwise(
            _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), in_order)
        )

    def windows(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(held) - (WINDOW - 1))
        return _let(F.transform(starts, lambda i: F.xxhash64(F.slice(held, i, WINDOW))), count)

    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(windows(words))


def text_counts(documents: DataFrame, text_column: str = "text") -> list[Column]:
    """Counts of a text: words, their characters, symbols, repeated lines and words."""
    text = text_or_empty(text_column)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = _let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeated(w).cast("long").alias("n_repeat_words")
        ),
    )
    return [
        counted.alias("counted"),
        F.length(F.translate(text, _WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``(host, n_docs, n_failed, failure_rate, host_kept)`` from ``(host, failed)`` rows."""
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    # moments of the rates, each host alike; chance alone gives them m (1 - m) / n
    moments = hosts.agg(
        F.avg(rate).alias("m"),
        F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"),
        F.avg(1 / F.col("n_docs")).alias("per"),
    )
    noise = F.col("m") * (1 - F.col("m"))
    between = F.col("v") - noise * F.col("per")
    strength = F.when(
        between > noise / (MAX_STRENGTH + 1), F.greatest(noise / between - 1, F.lit(1.0))
    ).otherwise(F.lit(MAX_STRENGTH))
    m = F.coalesce("m", F.lit(0.0))
    prior = moments.select(F.struct((m * strength).alias("alpha"), ((1 - m) * strength).alias("beta"))).scalar()
    both = hosts.withColumn("prior", prior)
    a = F.col("n_failed") + F.col("prior.alpha")
    b = F.col("n_docs") - F.col("n_failed") + F.col("prior.beta")
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return both.select(
        "host",
        "n_docs",
        "n_failed",
        F.round(mean, 9).alias("failure_rate"),
        (F.round(mean - Z * deviation, 9) <= HOST_LIMIT).alias("host_kept"),
    )


def judge_documents(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
) -> DataFrame:
    """Counts, the base verdict and the final one for every row of ``documents``."""
    counted = documents.select(
        F.col(id_column).alias("doc_id"), F.col(host_column).alias("host"), *text_counts(documents, text_column)
    )
    counted = counted.select("doc_id", "host", "counted.*", "word_chars", "n_symbols", "n_dup_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    counted = written(counted.withColumn("base_failed", failed), "counted")
    # a document fails its host by any rule
    rules = failed | (2 * F.col("n_symbols") > F.col("word_chars")) | (2 * F.col("n_dup_lines") > F.col("n_words"))
    hosts = host_verdicts(counted.select("host", rules.alias("failed")))
    hosts = hosts.select(F.col("host").alias("of"), "failure_rate", "host_kept")
    judged = counted.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
    )
