"""Quality rules with host verdicts [native].

Every document is measured by column expressions alone. Rule failures are summed
by host (partial aggregation, so a hot host collapses before the shuffle), each
host's failure rate is shrunk towards the corpus by a beta prior fitted to the
hosts' own rates, and the verdict goes back to the documents by a join on host.

The measured rows are written once to the shared folder and read by both passes.
The join is Spark's choice by the written size of the host table: a broadcast
below its threshold, else a sort-merge join whose hot hosts AQE splits.

Defined results: a null text has no words (and so fails ``n_words < 50``); null
hosts form one host; repeated rows count and come back as often as they occur;
an empty table gives an empty result. Only the named columns are read; a kept
column whose name is one of the result's is replaced by the result's.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, text_of, words_of, written

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*MEASURES, "base_failed", "any_failed", "host_rate", "kept")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_m`` of the five measures (all long).

    Repeated 3-word windows are found by sorting each text's own windows, which
    takes n log n steps and no shuffle however long the text is."""
    df = docs.withColumn("_t", text_of(text))
    df = df.withColumn("_w", words_of(F.col("_t")))
    windows = F.when(F.size("_w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.struct(F.concat_ws(" ", F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("k"),
                           i.alias("p"))))
    df = df.withColumn("_s", F.sort_array(windows))

    def same(x, other):
        return F.coalesce(x["k"] == other["k"], F.lit(False))
    twice = F.filter("_s", lambda x, j: same(x, F.get("_s", j + 1)) | same(x, F.get("_s", j - 1)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    df = df.withColumn("_l", F.when(F.instr("_t", "\n") > 0, lines))
    return df.withColumn("_m", F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.coalesce(F.size("_l") - F.size(F.array_distinct("_l")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.greatest(F.coalesce(covered, F.lit(0)), F.lit(0)).cast("long").alias("n_repeat_words"),
    )).drop("_t", "_w", "_s", "_l")


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", keep: Sequence[str] = ("doc_id",),
                  min_words: int = 50, max_repeat_pct: int = 50, least_limit: float = 0.5, deviations: float = 3.0) -> DataFrame:
    """The ``keep`` columns, the five measures, ``base_failed`` (too few words, or
    too many in repeated windows), ``any_failed`` (that, or over 10 symbols per 100
    words, or over 30 repeated lines per 100 words, or a mean word length outside
    2 to 15), ``host_rate`` (the host's shrunk rate of ``any_failed``) and ``kept``:
    false if ``base_failed`` or the host's rate is over the limit. The limit lies
    ``deviations`` standard deviations of the prior above its mean, and at
    ``least_limit`` or more: most documents of a rejected host fail a rule."""
    clash = {c.lower() for c in RESULT}
    carried = [c for c in keep if c.lower() not in clash]
    m = measured(docs.select(F.col(host).alias("_host"), F.col(text).alias("_text"),
                             F.struct(F.lit(0).alias("_"), *[F.col(c) for c in carried]).alias("_in")), "_text")
    n = F.col("n_words")
    rows = written(
        m.select("_host", "_in", "_m.*")
        .withColumn("base_failed", (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * n))
        .withColumn("any_failed", F.col("base_failed") | (10 * F.col("n_symbols") > n)
                    | (10 * F.col("n_dup_lines") > 3 * n)
                    | (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)), "quality-measures")
    hosts = written(rows.groupBy("_host").agg(
        F.count("*").alias("_n"), F.sum(F.col("any_failed").cast("long")).alias("_f")), "quality-hosts")
    alpha, beta = beta_prior(hosts)
    mean = alpha / (alpha + beta)
    limit = max(least_limit, mean + deviations * math.sqrt(mean * (1 - mean) / (alpha + beta + 1)))
    rates = hosts.select(F.col("_host").alias("_h"), ((F.col("_f") + alpha) / (F.col("_n") + alpha + beta)).alias("host_rate"))
    out = rows.join(rates, F.col("_host").eqNullSafe(F.col("_h")), "left")
    return out.select(*[F.col("_in")[c].alias(c) for c in carried], *MEASURES, "base_failed", "any_failed", "host_rate",
                      (~F.col("base_failed") & (F.col("host_rate") <= limit)).alias("kept"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Method of moments over the hosts' raw rates: one row from Spark. The prior
    weighs at least one and at most a million documents, which also settles the
    cases of no host, one host and equal rates."""
    rate = F.col("_f") / F.col("_n")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, var = mean or 0.0, var or 0.0
    weight = mean * (1 - mean) / var - 1 if var > 0 else 1e6
    weight = min(max(weight, 1.0), 1e6)
    return mean * weight, (1 - mean) * weight
