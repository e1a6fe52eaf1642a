"""Answers to request tables, in batch or for one micro-batch of a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bannerloom.functions import requests as R
from bannerloom.operators import serving
from bannerloom.sources import history
from bannerloom.sources.tables import scan_dataset, write_out


def validate(requests: DataFrame, has_data: bool = True) -> DataFrame:
    """Adds status, message and the typed campaign number."""
    status = R.request_status(F.col("method"), F.col("campaign_id"), has_data)
    return requests.withColumns(
        {
            "status": status,
            "campaign": F.when(status == 200, R.campaign_number(F.col("campaign_id"))),
            "message": R.error_message(status),
        }
    )


def visits_of(requests: DataFrame, has_data: bool = True) -> DataFrame:
    """The valid requests as (request_id, ts, user_key, campaign_id, seen)."""
    return (
        validate(requests, has_data)
        .where(F.col("status") == 200)
        .select(
            "request_id", "ts", "user_key", F.col("campaign").alias("campaign_id"), R.seen_banners(F.col("cookie")).alias("seen")
        )
    )


@dataclass(frozen=True)
class Serving:
    """What requests are answered from.

    ``lists`` has one row per campaign, ``around`` one per ring position. Both
    are made once per dataset and written as tables (see ``publish``), which
    every batch of requests reads.
    """

    perf: DataFrame
    lists: DataFrame
    around: DataFrame
    ring_size: int
    seed: str


def prepare(perf: DataFrame, seed: str) -> Serving:
    ring = serving.banner_ring(perf, seed)
    return Serving(perf, serving.serving_lists(perf, seed, ring), serving.ring_lists(ring), ring.count(), seed)


def publish(perf: DataFrame, seed: str, path: str) -> Serving:
    """Write ring and lists under ``path`` and serve from the written tables."""
    ring = write_out(serving.banner_ring(perf, seed), f"{path}/ring")
    around = write_out(serving.ring_lists(ring), f"{path}/around")
    lists = write_out(serving.serving_lists(perf, seed, ring), f"{path}/lists")
    return Serving(perf, lists, around, ring.count(), seed)


def publish_latest(spark: SparkSession, perf_path: str, history_path: str, seed: str, path: str) -> Serving | None:
    """``publish`` of the newest processed dataset in the history; None where there is none yet."""
    try:
        done = history.read_history(spark, history_path)
        newest = history.latest_dataset(done).first()["latest"]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return None if newest is None else publish(scan_dataset(spark, perf_path, newest), seed, path)


def serve_latest(requests: DataFrame, perf_path: str, history_path: str, seed: str, path: str, **pages: str) -> DataFrame:
    """Responses to all requests from the newest processed dataset: history, its table, lists under ``path``, answers."""
    return respond(requests, publish_latest(requests.sparkSession, perf_path, history_path, seed, path), **pages)


def pick_banners(visits: DataFrame, ready: Serving) -> DataFrame:
    """Visits with ``picks``.

    The longest seen list decides the plan (one number read by the driver):
    usually every list fits the campaign's pool and one join answers all; else
    the visits with longer lists take the exact join.
    """

    def usual(some: DataFrame) -> DataFrame:
        return serving.answer(some, ready.lists, ready.around, ready.ring_size, ready.seed)

    longest = visits.agg(F.max(serving.seen_size(F.col("seen"))).alias("n")).first()["n"] or 0
    if longest <= serving.SEEN_IN_POOL:
        return usual(visits)
    is_long = serving.seen_size(F.col("seen")) > serving.SEEN_IN_POOL
    # the same list in the same campaign has one answer: it is found once, whatever ids the requests have
    listed = F.concat_ws(",", F.col("campaign_id").cast("string"), F.sort_array(F.array_distinct("seen")).cast("array<string>"))
    long = visits.where(is_long).withColumn("_list", F.md5(listed))
    different = long.groupBy("_list").agg(F.first("campaign_id").alias("campaign_id"), F.first("seen").alias("seen"))
    exact = (
        usual(long)
        .join(serving.answer_long(different, ready.perf, "_list"), "_list", "left")
        .withColumn("picks", F.coalesce("long_picks", "picks"))
        .drop("long_picks", "_list")
    )
    return usual(visits.where(~is_long)).unionByName(exact)


def respond(
    requests: DataFrame,
    ready: Serving | None,
    domain: str = R.DEFAULT_DOMAIN,
    image_base: str = R.DEFAULT_IMAGE_BASE,
) -> DataFrame:
    """responses(request_id, status, banner_ids, body, set_cookie) for every request.

    ``ready`` is None when no dataset has been processed: valid requests get 500.
    """
    rejected = (
        validate(requests, ready is not None)
        .where(F.col("status") != 200)
        .select(
            "request_id",
            "status",
            F.lit(None).cast("array<int>").alias("banner_ids"),
            R.error_page(F.col("message")).alias("body"),
            F.lit(None).cast("string").alias("set_cookie"),
        )
    )
    if ready is None:
        return rejected
    picked = pick_banners(visits_of(requests), ready)
    ids = serving.shuffled_array(F.col("picks"), ready.seed, F.col("campaign_id"))
    answered = picked.withColumn("banner_ids", ids).select(
        "request_id",
        F.lit(200).alias("status"),
        "banner_ids",
        R.page(F.col("banner_ids"), image_base).alias("body"),
        R.set_cookie(F.col("banner_ids"), F.col("ts"), domain).alias("set_cookie"),
    )
    return answered.unionByName(rejected)
