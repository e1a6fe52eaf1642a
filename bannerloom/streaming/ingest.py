"""Incremental ingestion of dataset folders."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bannerloom import schemas
from bannerloom.operators.performance import banner_performance
from bannerloom.sources import datasets, history, tables

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def create_history(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], schemas.HISTORY).write.mode("ignore").parquet(path)


def ingest_dataset(spark: SparkSession, root: str, dataset_id: int, perf_path: str, history_path: str) -> str:
    """Process one dataset folder; returns what was done.

    Safe to repeat: a dataset in the history is left alone, and the table
    partition is replaced as a whole before its history row is written.
    """
    start = datetime.now(timezone.utc).isoformat()
    seen = history.read_history(spark, history_path)
    known = seen.agg(
        F.max("seq").alias("seq"), F.coalesce(F.bool_or(F.col("order") == dataset_id), F.lit(False)).alias("handled")
    ).first()
    if known["handled"]:
        return "handled before"
    if not datasets.complete(spark, root, dataset_id):
        return "incomplete"
    # one short row per file kind
    prints = spark.createDataFrame(
        datasets.file_fingerprints(spark, root, dataset_id).collect(), "dataset_id int, kind string, fingerprint string"
    )
    duplicate = history.duplicate_datasets(prints, seen).first()["is_duplicate"]
    if not duplicate:
        inputs = {kind: datasets.read_csv(spark, root, dataset_id, kind) for kind in schemas.INPUTS}
        perf = banner_performance(inputs["clicks"], inputs["impressions"], inputs["conversions"])
        tables.overwrite_dataset(tables.clustered(perf), perf_path, dataset_id)
    state = "duplicate" if duplicate else "processed"
    row = history.history_row(prints, (known["seq"] or 0) + 1, dataset_id, state, start)
    history.append_history(row, history_path)
    return state


def ingest_next(spark: SparkSession, root: str, perf_path: str, history_path: str) -> tuple[int | None, str]:
    """One scheduled batch run: the next dataset after the last one handled."""
    folders = datasets.discover(spark, root)
    following = history.next_dataset(folders, history.read_history(spark, history_path)).first()["next"]
    if following is None:
        return None, "nothing new"
    return following, ingest_dataset(spark, root, following, perf_path, history_path)


def ingest_stream(
    spark: SparkSession, root: str, perf_path: str, history_path: str, checkpoint: str
) -> StreamingQuery:
    """Every new dataset folder once, in numeric order, then stop.

    The stream carries file paths only; contents are read by the batch job of
    the folder.
    """
    create_history(spark, history_path)
    arrived = (
        spark.readStream.schema(FILES)
        .format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(datasets.dataset_of(F.col("path")).alias("dataset_id"))
        .where(F.col("dataset_id").isNotNull())
    )

    def each(batch: DataFrame, _: int) -> None:
        # folder numbers are control values: one per new dataset
        for row in batch.distinct().orderBy("dataset_id").collect():
            ingest_dataset(spark, root, row["dataset_id"], perf_path, history_path)

    return (
        arrived.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
