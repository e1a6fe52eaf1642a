"""Performance tables and result tables on Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.operators import skew
from bannerloom.schemas import PERFORMANCE


def overwrite_dataset(perf: DataFrame, path: str, dataset_id: int) -> None:
    """Replace one dataset's rows, leaving the other datasets in place."""
    (
        perf.withColumn("dataset_id", F.lit(dataset_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset_id")
        .parquet(path)
    )


def scan_performance(spark: SparkSession, path: str) -> DataFrame:
    """All datasets; a filter on dataset_id prunes partitions."""
    with_id = T.StructType([*PERFORMANCE.fields, T.StructField("dataset_id", T.IntegerType())])
    return spark.read.schema(with_id).parquet(path)


def scan_dataset(spark: SparkSession, path: str, dataset_id: int) -> DataFrame:
    return scan_performance(spark, path).where(F.col("dataset_id") == dataset_id)


def clustered(perf: DataFrame) -> DataFrame:
    """Layout for reads by campaign: files hold narrow campaign ranges, best banners first.

    The range includes the banner, so a very large campaign spreads over several files.
    """
    order = [F.col("campaign_id"), F.desc_nulls_last("revenue_total"), F.col("banner_id")]
    return perf.repartitionByRange(*order).sortWithinPartitions(*order)


def write_out(df: DataFrame, path: str) -> DataFrame:
    """Write a pipeline's result and return the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_unique(existing: DataFrame, batch: DataFrame, key: Sequence[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of an insert under a unique key.

    A row is rejected when its key exists already or appeared earlier in the
    batch. Rejection does not stop the rest, as an ordered insert would: the
    rejected rows come back as a second DataFrame. ``seq`` is unique in the
    batch; rows are told apart by it, so a key repeated very often is reduced
    before the shuffle and never gathered. NULL is a key value like any other.
    """
    first = batch.groupBy(*key).agg(F.min(seq).alias(seq))
    there = existing.select(*[F.col(k).alias(f"_there_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_there_{k}")) for k in key])
    new = first.join(there, same, "left_anti").select(seq)
    return batch.join(new, seq, "left_semi"), batch.join(new, seq, "left_anti")


def unique_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def nth_revision(files: DataFrame, revision: int, name: str = "filename") -> DataFrame:
    """For every name, revision n: 0 the original, 1 the next, -1 the newest, -2 the one before."""
    newest_first = revision < 0
    n = -revision if newest_first else revision + 1
    order: skew.Order = [("upload_date", not newest_first), ("file_id", not newest_first)]
    return skew.top_rows(files, [name], order, n, "_rev").where(F.col("_rev") == n).drop("_rev")


def list_names(files: DataFrame, name: str = "filename") -> DataFrame:
    return files.where(F.col(name).isNotNull()).select(name).distinct()
