"""Joins, aggregates and casts behind the performance table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bannerloom.operators import performance as P
from bannerloom.plans.registry import query
from bannerloom.plans.views import Views, with_views


@query("banner_performance", with_views("SELECT * FROM perf", "perf"))
def _(v: Views) -> DataFrame:
    return v.perf


@query(
    "banner_performance_exact",
    with_views(
        """SELECT ROUND(SUM(COALESCE(v.revenue, 0)), 2) AS revenue_total, MAX(i.impression_count) AS impression_count,
  CAST(c.campaign_id AS INTEGER) AS campaign_id, CAST(c.banner_id AS INTEGER) AS banner_id,
  CAST(COUNT(DISTINCT c.click_id) AS INTEGER) AS click_count
FROM clk c
LEFT JOIN (SELECT campaign_id, banner_id, COUNT(*) AS impression_count FROM imp GROUP BY 1, 2) i
  ON c.campaign_id = i.campaign_id AND c.banner_id = i.banner_id
LEFT JOIN conv v ON c.click_id = v.click_id
GROUP BY c.campaign_id, c.banner_id""",
        "imp",
        "clk",
        "conv",
    ),
)
def _(v: Views) -> DataFrame:
    exact = P.banner_performance(v.clicks, v.impressions, v.conversions, exact_impressions=True)
    return exact.withColumn("revenue_total", F.round("revenue_total", 2))


@query(
    "impressions_per_banner",
    with_views("SELECT campaign_id, banner_id, COUNT(*) AS impression_count FROM imp GROUP BY 1, 2", "imp"),
)
def _(v: Views) -> DataFrame:
    return P.impressions_per_banner(v.impressions)


@query(
    "join_clicks_impressions",
    with_views(
        """SELECT c.campaign_id, c.banner_id, c.click_id, i.impression_count FROM clk c
LEFT JOIN (SELECT campaign_id, banner_id, COUNT(*) AS impression_count FROM imp GROUP BY 1, 2) i
  ON c.campaign_id = i.campaign_id AND c.banner_id = i.banner_id""",
        "clk",
        "imp",
    ),
)
def _(v: Views) -> DataFrame:
    return P.attach_impressions(v.clicks.select("click_id", "banner_id", "campaign_id"), v.impressions)


@query(
    "join_clicks_conversions",
    with_views(
        """SELECT c.click_id, c.banner_id, c.campaign_id, v.conversion_id, v.revenue FROM clk c
LEFT JOIN conv v ON c.click_id = v.click_id""",
        "clk",
        "conv",
    ),
)
def _(v: Views) -> DataFrame:
    return P.attach_conversions(
        v.clicks.select("click_id", "banner_id", "campaign_id"), v.conversions.select("conversion_id", "click_id", "revenue")
    )


@query(
    "null_fill",
    with_views(
        """SELECT c.click_id, c.banner_id, c.campaign_id, COALESCE(CAST(v.conversion_id AS VARCHAR), '0') AS conversion_id,
  COALESCE(v.revenue, 0) AS revenue FROM clk c LEFT JOIN conv v ON c.click_id = v.click_id""",
        "clk",
        "conv",
    ),
)
def _(v: Views) -> DataFrame:
    conversions = v.conversions.select(F.col("conversion_id").cast("string").alias("conversion_id"), "click_id", "revenue")
    return P.null_fill(P.attach_conversions(v.clicks.select("click_id", "banner_id", "campaign_id"), conversions))


@query(
    "typed_cast",
    with_views(
        """SELECT request_id, TRY_CAST(campaign_id AS INTEGER) AS campaign_id,
  TRY_CAST(cookie AS DOUBLE) AS cookie_number, TRY_CAST(CAST(request_id AS VARCHAR) AS DOUBLE) AS request_number
FROM requests""",
        "requests",
    ),
)
def _(v: Views) -> DataFrame:
    text = v.requests.withColumn("request_text", F.col("request_id").cast("string"))
    return text.select(
        "request_id",
        P.to_int("campaign_id").alias("campaign_id"),
        P.to_double("cookie").alias("cookie_number"),
        P.to_double("request_text").alias("request_number"),
    )
