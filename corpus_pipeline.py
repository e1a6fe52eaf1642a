"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before has
kept and returns a DataFrame; all but the last return the columns of the documents.
``run`` applies them to the table ``documents``; what a stage returns is written to the
shared scratch folder and read again, so a lost executor costs one stage at most. What
earlier stages wrote for themselves is deleted when the next one starts, unless its input
still reads it.

Null and empty texts are rejected by the quality rules; empty tables pass through all
stages; columns beyond ``doc_id``, ``text`` and ``source`` are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.llm import line_dedup, ngram_join, packing, quality_classifier, quality_rules
from bannerloom.llm.common import release, scope, small_batches, stage

#: A document stays if label 1 is at least as likely as label 0.
LEAST_SCORE = 0.5
#: A line found in so many documents goes.
LINE_DOCUMENTS = 10
#: Near duplicates: words in a shingle, least similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80
WINDOW, END = 2048, 1
TOKENIZER = "word_bpe_49k.json"

#: No SQL: compression, tokenizer and solver have none. Tested against a brute-force version.
ORACLE_SQL = None


#: Tables that the stages have written for themselves and that are still there.
_written: list[tuple[SparkSession, str]] = []


def tidy(apply: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, which first deletes the tables of earlier ones of this run that ``docs`` does not read.

    Its texts go to Python in small batches, as executors keep the memory that a stage took.
    """

    @wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if apply.__name__ == STAGES[0][1].__name__:
            _written.clear()  # another run, whose result may not have been read yet
        release(_written, docs)
        small_batches(spark)
        with scope() as made:
            result = apply(spark, docs, sf_dir)
        _written.extend(made)
        return result

    return run_stage


@tidy
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good, learnt from the labels of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, F.lit(True))
    return quality_classifier.score(docs, model, "__score").where(F.col("__score") >= LEAST_SCORE).select(*docs.columns)


@tidy
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules and whose host is not rejected."""
    return quality_rules.judge(docs, carry=docs.columns, own=True).where("kept").select(*docs.columns)


@tidy
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that many share; ``n_chars`` follows the text."""
    done = line_dedup.dedup_lines(docs, LINE_DOCUMENTS)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


@tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of ``WINDOW`` ids."""
    pieces = packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), WINDOW, END)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "ids", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
