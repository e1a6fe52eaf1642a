"""Clicks, impressions and conversions to one row per (campaign, banner)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bannerloom.operators import skew

KEYS = ["campaign_id", "banner_id"]


def to_double(c: str) -> Column:
    """Text to double, NULL when it is not a number."""
    return F.col(c).try_cast("double")


def to_int(c: str) -> Column:
    return F.col(c).try_cast("int")


def null_fill(df: DataFrame) -> DataFrame:
    """Unmatched conversions: revenue and conversion id become zero (text or number)."""
    zero = {f.name: "0" if f.dataType.simpleString() == "string" else 0 for f in df.schema.fields}
    return df.na.fill({c: zero[c] for c in ("revenue", "conversion_id") if c in zero})


def impressions_per_banner(impressions: DataFrame) -> DataFrame:
    return impressions.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("impression_count"))


def attach_impressions(clicks: DataFrame, impressions: DataFrame) -> DataFrame:
    """Every click with the impression count of its banner, NULL when there is none.

    The right side has one row per banner; a very large (campaign, banner) on
    the click side is joined by broadcast.
    """
    return skew.join_unique(clicks, impressions_per_banner(impressions), KEYS)


def attach_conversions(clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """Every click with its conversions; a click with several is repeated.

    Both sides are plain inputs, so adaptive skew splitting applies.
    """
    return clicks.join(conversions.where(F.col("click_id").isNotNull()), "click_id", "left")


def typed(df: DataFrame) -> DataFrame:
    """Performance columns in their declared types and order."""
    return df.select(
        "revenue_total",
        "impression_count",
        to_int("campaign_id").alias("campaign_id"),
        to_int("banner_id").alias("banner_id"),
        F.col("click_count").cast("int").alias("click_count"),  # a count beyond it is an error
    )


def banner_performance(
    clicks: DataFrame, impressions: DataFrame, conversions: DataFrame, exact_impressions: bool = False
) -> DataFrame:
    """Revenue, impressions and clicks of every clicked banner in every campaign.

    Defined as clicks left join grouped impressions left join conversions, then
    sums over the joined rows. So a banner without clicks does not appear,
    ``click_count`` counts (click, conversion) rows, and ``impression_count`` is
    the banner's impressions times its joined rows. ``exact_impressions`` counts
    each click and each impression once instead.

    The joins are not executed in that order. Conversions are summed per click
    first and clicks per banner second, so the click table crosses the network
    once, on click id, and both inputs of the last join are already aggregated
    on its key and need no further exchange. An id shared by very many clicks (a
    placeholder, a missing id) is joined by broadcast, see skew.join_unique.
    """
    per_click = (
        conversions.where(F.col("click_id").isNotNull())
        .select("click_id", F.expr("try_cast(coalesce(revenue, 0) AS double)").alias("_r"))
        if dict(conversions.dtypes)["revenue"] != "string"
        else conversions.where(F.col("click_id").isNotNull()).select(
            "click_id", F.coalesce("revenue", F.lit("0")).try_cast("double").alias("_r")
        )
    ).groupBy("click_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("_r").alias("_revenue"))

    # a matched click whose revenue texts are all bad stays NULL; an unmatched one counts as zero
    joined = skew.join_unique(clicks, per_click, ["click_id"]).select(
        *KEYS,
        "click_id",
        F.coalesce("_n", F.lit(1)).alias("_rows"),
        F.when(F.col("_n").isNull(), F.lit(0.0)).otherwise(F.col("_revenue")).alias("_revenue"),
    )
    clicked = (
        F.count_distinct("click_id")
        if exact_impressions
        else F.sum(F.when(F.col("click_id").isNotNull(), F.col("_rows")).otherwise(0))
    )
    per_banner = joined.groupBy(*KEYS).agg(
        F.sum("_revenue").alias("revenue_total"),
        clicked.alias("click_count"),
        F.sum("_rows").alias("_rows"),
    )
    shown = impressions_per_banner(impressions)
    times = F.lit(1) if exact_impressions else F.col("_rows")
    return typed(
        per_banner.join(shown, KEYS, "left").withColumn("impression_count", F.col("impression_count") * times)
    )
