"""Quality rules by document and by host, with DataFrame functions only.

Failures are counted by host, each host's failure rate is shrunk by a beta prior fitted
to all hosts, and the hosts' verdicts are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bannerloom.llm.common import WHITE, WORD_GAP, stage

#: A host is rejected when its failure rate is above this even at the low end of its likely range.
HOST_RATE = 0.7
#: Standard deviations between the shrunk rate and that low end.
HOST_MARGIN = 2.0
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and the measures of each whole text (long), 0 for null and empty texts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    first = docs.drop(*MEASURES).withColumns(
        {
            "__words": split_words(whole),
            "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
            "__lines": lines,
        }
    )
    w = F.col("__words")
    # a number for each window of three words, equal for equal ones. Only where one occurs
    # twice are they sorted with their places, so that equal ones are neighbours: n log n
    # steps for any text.
    windows = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    second = first.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.concat_ws("", w)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__windows": windows,
        }
    ).drop("__words", "__lines")
    h = F.col("__windows")
    placed = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.zip_with(h, F.sequence(F.lit(0), F.size(h) - 1), lambda a, p: F.struct(a.alias("h"), p.alias("p")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    third = second.withColumn("__placed", placed).drop("__windows")
    s = F.col("__placed")
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    fourth = third.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("__placed")
    return fourth.select(*[c for c in docs.columns if c not in MEASURES], *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def failures() -> Column:
    """Whether a document fails any rule; all count against its host."""
    return (
        base_failed()
        | (5 * F.col("n_symbols") > F.col("n_words"))
        | (F.col("word_chars") > 12 * F.col("n_words"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
    )


def host_verdicts(measured: DataFrame, host: str, rate: float = HOST_RATE, margin: float = HOST_MARGIN) -> DataFrame:
    """One row for each host: documents, failures, shrunk rate, and whether it is rejected.

    The beta prior comes from all hosts by moments: its mean is the share of failures,
    its weight what the spread of the hosts' rates leaves after their sampling noise.
    Hosts without documents to judge, and a null host, have no verdict.
    """
    hosts = (
        measured.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("__host"))
        .agg(F.count("*").alias("docs"), F.sum(failures().cast("long")).alias("failed"))
    )
    r = F.col("failed") / F.col("docs")
    totals = hosts.agg(
        (F.sum("failed") / F.sum("docs")).alias("m"), F.var_pop(r).alias("v"), F.avg(1 / F.col("docs")).alias("noise")
    )
    spread = F.greatest(F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("noise"), F.lit(1e-4))
    m, weight = totals.select("m", F.greatest(F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(1.0))).first()
    if m is None:  # no host at all
        m = weight = 0.0
    shrunk = hosts.withColumn("rate", (F.col("failed") + m * weight) / (F.col("docs") + weight))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("docs") + weight + 1))
    return shrunk.select("__host", "docs", "failed", "rate", (F.col("rate") - margin * deviation > rate).alias("rejected"))


def judge(docs: DataFrame, host: str = "source", text: str = "text", carry: list[str] | None = None, own: bool = False) -> DataFrame:
    """The columns of ``docs`` named in ``carry`` (all if None), the measures, ``base_failed`` and ``kept``.

    Kept are documents that pass the base rules and whose host is not rejected; with
    ``own`` they must pass the rules for symbols and length of words too. Null and
    empty texts fail the base rules (no words); documents without a host are judged alone;
    repeated rows count each; columns named like a result are replaced; an empty table
    stays empty. Measures are taken once and written, as hosts and documents both read
    them. The hosts' verdicts are a written table too: a few are broadcast by their size,
    many are joined with large hosts split.
    """
    named = docs.drop(*MEASURES, "base_failed", "kept")
    carry = named.columns if carry is None else carry
    measured = measure(named.withColumn("__host", F.col(host)), text).withColumn("base_failed", base_failed())
    measured = stage(measured.select(*carry, "__host", *MEASURES, "base_failed"), "measures")
    bad = stage(host_verdicts(measured, "__host").where("rejected").select("__host", F.lit(True).alias("__bad")), "hosts")
    joined = measured.join(bad, "__host", "left")
    failed = failures() if own else F.col("base_failed")
    return joined.select(*carry, *MEASURES, "base_failed", (~failed & F.col("__bad").isNull()).alias("kept"))
