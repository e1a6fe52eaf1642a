"""The processing history: what was done, what comes next, what is a duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.schemas import HISTORY


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def append_history(history_rows: DataFrame, path: str) -> None:
    history_rows.select(*HISTORY.fieldNames()).write.mode("append").parquet(path)


def history_row(fingerprints: DataFrame, seq: int, dataset_id: int, state: str, start_time: str, end_time: str | None = None) -> DataFrame:
    """One row from (kind, fingerprint); the times are ISO-8601 text, without an end it is now."""
    kinds = F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "fingerprint"))))
    return fingerprints.agg(kinds.alias("fingerprints")).select(
        F.lit(seq).cast("long").alias("seq"),
        F.lit(dataset_id).alias("order"),
        F.lit(state).alias("state"),
        F.lit(start_time).cast("timestamp").alias("start_time"),
        (F.current_timestamp() if end_time is None else F.lit(end_time).cast("timestamp")).alias("end_time"),
        "fingerprints",
    )


def latest_dataset(history: DataFrame, any_state: bool = False) -> DataFrame:
    """Dataset of the last inserted row, NULL without history.

    Only processed datasets count unless ``any_state`` is set: a skipped
    duplicate has no table to serve from.
    """
    rows = history if any_state else history.where(F.col("state") == "processed")
    return rows.agg(F.max_by("order", "seq").alias("latest"))


def next_dataset(folders: DataFrame, history: DataFrame) -> DataFrame:
    """Smallest dataset number above the last one handled; NULL when there is none."""
    last = history.agg(F.max_by("order", "seq")).scalar()
    above = folders.withColumn("_last", last).where(F.col("_last").isNull() | (F.col("dataset_id") > F.col("_last")))
    return above.agg(F.min("dataset_id").alias("next"))


def known_fingerprints(history: DataFrame) -> DataFrame:
    return history.select(F.explode("fingerprints").alias("kind", "fingerprint")).distinct()


def duplicate_datasets(candidates: DataFrame, history: DataFrame, mode: str = "any") -> DataFrame:
    """(dataset_id, is_duplicate) for candidates(dataset_id, kind, fingerprint).

    A fingerprint counts only against the same kind of file. ``any``: one known
    file makes the dataset a duplicate. ``first``: only the first file, in name
    order, is looked at.
    """
    if mode not in ("any", "first"):
        raise ValueError(mode)
    known = known_fingerprints(history).withColumn("_known", F.lit(True))
    marked = candidates.join(known, ["kind", "fingerprint"], "left").withColumn(
        "_known", F.coalesce("_known", F.lit(False))
    )
    verdict = F.bool_or("_known") if mode == "any" else F.min_by("_known", "kind")
    return marked.groupBy("dataset_id").agg(verdict.alias("is_duplicate"))
