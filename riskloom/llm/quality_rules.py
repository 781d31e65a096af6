"""Quality rules with host verdicts, in DataFrame functions only.

Documents fail by their own text; then failures are summed per host (the ``source`` of a
document), each host's failure rates are shrunk by a beta prior fitted to all hosts, and hosts
whose shrunk rate is too high lose their remaining documents as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import SPACE, let, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: A host loses all its documents where the shrunk rate of base failures or of symbol-heavy documents exceeds these.
HOST_LIMITS = {"base": 0.5, "symbols": 0.5}
SYMBOL_PERCENT = 10


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """How many words stand in three-word windows that the text holds twice or more."""
    def covered(w):
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i")))
        def twice(s):
            again = F.filter(s, lambda x, k: (F.get(s, k - 1)["t"] == x["t"]) | (F.get(s, k + 1)["t"] == x["t"]))
            return F.when(F.size(again) == 0, 0).otherwise(
                F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))
        return let(F.sort_array(windows), twice)
    return F.when(F.size(words) < 3, 0).otherwise(covered(words))


def measures(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, host`` and the five counts of its text; a null text counts as empty, a null source is a host of its own."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spaces = "\x20\x09\x0a\x0b\x0c\x0d"
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, spaces, "") != "")
    counts = let(_words(text), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    return docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("host"),
        F.explode(F.array(counts)).alias("w"),
        F.length(F.translate(text, spaces, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "host", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
             F.col("w.r").cast("long").alias("n_repeat_words"))


def _shrunk(hosts: DataFrame, rule: str) -> DataFrame:
    """Adds ``<rule>_rate``: the host's failures over its documents, shrunk by a beta prior.

    The prior's mean is the pooled rate; its strength comes from the variance of the hosts' rates
    beyond what chance gives (moments), between 1 and 1000 documents.
    """
    fails, n = F.col(f"{rule}_fails").cast("double"), F.col("n_docs").cast("double")
    pooled = hosts.agg(F.struct((F.sum(fails) / F.sum(n)).alias("mean"), (F.sum(n) / F.count("*")).alias("per_host"))).scalar()
    apart = hosts.select(fails.alias("f"), n.alias("n"), pooled["mean"].alias("mean"), pooled["per_host"].alias("per_host"))
    spread = apart.groupBy("mean", "per_host").agg(F.avg((F.col("f") / F.col("n") - F.col("mean")) ** 2).alias("var"))
    chance = F.col("mean") * (1 - F.col("mean"))
    beyond = F.col("var") - chance / F.col("per_host")
    strength = F.when(beyond > 0, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), chance / beyond - 1))).otherwise(1000.0)
    prior = spread.select(F.struct(F.col("mean").alias("mean"), strength.alias("strength"))).scalar()
    return hosts.withColumn(f"{rule}_rate", (fails + prior["mean"] * prior["strength"]) / (n + prior["strength"]))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """``host, n_docs, host_fails, <rule>_rate..., host_kept``; ``measured`` as from `judged`.

    Only one row per host is shuffled (partial sums); the prior is one row, a scalar subquery.
    """
    hosts = stored(measured.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.count_if("base_failed").alias("base_fails"),
        F.count_if(F.col("n_symbols") * 100 > F.col("word_chars") * SYMBOL_PERCENT).alias("symbols_fails")), "quality-hosts")
    for rule in HOST_LIMITS:
        hosts = _shrunk(hosts, rule)
    kept = F.lit(True)
    for rule, limit in HOST_LIMITS.items():
        kept = kept & (F.col(f"{rule}_rate") <= limit)
    return hosts.withColumn("host_kept", kept)


def judged(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its measures, ``base_failed``, its host's figures and ``kept``.

    Null and empty texts have no words and fail; rows without source share one host; repeated rows
    count each; no documents give no rows. Texts are read once, whole; hosts join null-safe, and
    a host that holds a third of all rows is left to skew splitting or a measured broadcast.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    measured = stored(measures(docs).withColumn("base_failed", failed), "quality-measures")
    hosts = host_verdicts(measured)
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))  # noqa: E731  null is a host too
    joined = measured.withColumn("k", key(F.col("host"))).join(hosts.withColumn("k", key(F.col("host"))).drop("host"), "k", "left").drop("k")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
