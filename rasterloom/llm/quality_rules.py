"""Quality rules at host level, in DataFrame functions only.

Each document gets the base rule (too few words, too much repetition). Failures are
aggregated by host, the failure rates are shrunk with a beta prior fitted to all hosts by
the method of moments, and each host's verdict is joined back to its documents.

Defined cases: null or blank text has no words and fails the base rule; a null host has
no host verdict (the base rule alone decides) and doesn't enter the prior; repeated rows
are counted and returned as they come; an empty table gives an empty result. Only the
named columns are read, so other columns can have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import has_word, materialise, words_of

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Parameters. A host is rejected when its shrunk failure rate is over ``max_host_rate``.

    ``min_strength`` and ``max_strength`` bound the prior's weight in documents; the upper
    bound is taken when hosts differ by no more than chance.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_host_rate: float = 0.5
    min_strength: float = 1.0
    max_strength: float = 10_000.0


def _windows(words: Column, n: int) -> Column:
    """64-bit hashes of all windows of n words; none for shorter texts."""
    here = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), here)).otherwise(
        F.array().cast("array<bigint>")
    )


def _repeat_places(ordered: Column) -> Column:
    """Ascending places of windows that occur at least twice.

    ``ordered`` holds the windows sorted by hash with their places, so that repeats are
    neighbours of equal hash.
    """
    mark = lambda p, i: F.when(
        (p["h"] == F.get(ordered, i - 1)["h"]) | (p["h"] == F.get(ordered, i + 1)["h"]), p["i"]
    )
    return F.sort_array(F.filter(F.transform(ordered, mark), lambda x: x.isNotNull()))


def document_metrics(docs: DataFrame, rules: QualityRules, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Two windows count as equal when their 64-bit hashes are; within one text of 20,000
    words two different windows collide with a probability near 1e-11.
    """
    n = rules.window
    text = F.coalesce(F.col("__text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), has_word)
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    step = docs.select(*keep, "__text", words_of(F.col("__text")).alias("__words"))
    step = step.select(
        *[c for c in step.columns if c not in ("__text", "__words")],
        F.size("__words").cast("long").alias("n_words"),
        F.array_join("__words", "").alias("__joined"),
        F.when(F.instr(text, "\n") > 0, lines).otherwise(F.array().cast("array<string>")).alias("__lines"),
        _windows(F.col("__words"), n).alias("__hashes"),
    )
    inner = ("__joined", "__lines", "__hashes")
    own = [c for c in step.columns if c not in inner]
    step = step.select(
        *own,
        F.char_length("__joined").cast("long").alias("word_chars"),
        (F.char_length("__joined") - F.char_length(F.translate("__joined", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
            F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(empty).alias("__sorted"),
    )
    own = [c for c in step.columns if c != "__sorted"]
    step = step.select(*own, _repeat_places(F.col("__sorted")).alias("__places"))
    gaps = F.transform("__places", lambda p, i: F.least(F.lit(n), F.coalesce(F.get("__places", i + 1) - p, F.lit(n))))
    step = step.select(*own, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return step.withColumn("base_failed", failed)


def beta_prior(hosts: DataFrame, rules: QualityRules) -> tuple[float, float]:
    """(alpha, beta) by the method of moments over hosts (n documents, f failures).

    The variance between hosts is what is left of the weighted variance of rates after the
    binomial part; one row reaches the driver. No hosts: the flat prior (1, 1).
    """
    total = hosts.agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
                      F.count("*").alias("hosts"), F.sum(F.col("f") * (F.col("f") / F.col("n"))).alias("fp")).first()
    if not total["n"]:
        return 1.0, 1.0
    n, mean = float(total["n"]), total["f"] / total["n"]
    spread = float(total["fp"]) - n * mean * mean  # sum of n_i (p_i - mean)^2
    room = n - float(total["nn"]) / n
    between = (spread - mean * (1 - mean) * (total["hosts"] - 1)) / room if room > 0 else 0.0
    strength = mean * (1 - mean) / between - 1 if between > 0 else rules.max_strength
    strength = min(max(strength, rules.min_strength), rules.max_strength)
    return mean * strength, (1 - mean) * strength


def host_verdicts(metrics: DataFrame, rules: QualityRules) -> DataFrame:
    """__host, host_docs, host_failed, host_rate, host_rejected; a row for each non-null host."""
    hosts = materialise(
        metrics.where(F.col("__host").isNotNull()).groupBy("__host").agg(
            F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f")),
        "hosts",
    )
    alpha, beta = beta_prior(hosts, rules)
    rate = (F.col("f") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.select("__host", F.col("n").alias("host_docs"), F.col("f").alias("host_failed"),
                        rate.alias("host_rate"), (rate > rules.max_host_rate).alias("host_rejected"))


def assess(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: id, metrics, base_failed, host verdict and kept.

    The metrics are written once (a thin table without texts), so that hosts and documents
    share them. The join back is by host: Spark broadcasts the verdicts where they are
    small, and otherwise splits a hot host's partition, as nothing above needs it whole.
    """
    source = docs.select(F.col(id_col).alias("__id"), F.col(host_col).cast("string").alias("__host"), F.col(text_col).alias("__text"))
    metrics = materialise(document_metrics(source, rules, [F.col("__id"), F.col("__host")]), "quality")
    joined = metrics.join(host_verdicts(metrics, rules), "__host", "left")
    return joined.select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"),
        "host_docs", "host_failed", F.round("host_rate", 6).alias("host_rate"),
    )


def filter_documents(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Each row's own rule is evaluated once, where the row is: the rows that pass it are written
    whole, and of the others only host and verdict. Hosts are counted on these two thin
    columns; texts are not shuffled, as only the rejected hosts (an anti join) come from elsewhere.
    """
    row = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text"), F.col(host_col).cast("string").alias("__host"))
    own = document_metrics(row, rules, [F.col("__row"), F.col("__host")])
    own = materialise(own.select("__host", "base_failed", F.when(~F.col("base_failed"), F.col("__row")).alias("__row")), "quality")
    rejected = host_verdicts(own, rules).where("host_rejected").select("__host")
    return own.where(~F.col("base_failed")).join(rejected, "__host", "left_anti").select("__row.*")
