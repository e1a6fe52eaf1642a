"""The performance table on small hand-computed inputs."""

import pytest
from pyspark.sql import functions as F

from bannerloom import schemas
from bannerloom.operators import performance as P
from bannerloom.operators import skew

CLICKS = "click_id string, banner_id string, campaign_id string"
IMPRESSIONS = "banner_id string, campaign_id string"
CONVERSIONS = "conversion_id string, click_id string, revenue string"


def table(spark, clicks, impressions, conversions, **options):
    perf = P.banner_performance(
        spark.createDataFrame(clicks, CLICKS),
        spark.createDataFrame(impressions, IMPRESSIONS),
        spark.createDataFrame(conversions, CONVERSIONS),
        **options,
    )
    assert [(f.name, f.dataType) for f in perf.schema] == [(f.name, f.dataType) for f in schemas.PERFORMANCE]
    return {
        (r.campaign_id, r.banner_id): (r.revenue_total, r.click_count, r.impression_count) for r in perf.collect()
    }


FAN_OUT = (
    [("c1", "1", "7"), ("c2", "1", "7"), ("c3", "9", "7")],
    [("1", "7")] * 3 + [("5", "7")],
    [("v1", "c1", "2.5"), ("v2", "c1", "1.5"), ("v3", "nobody", "100"), ("v4", None, "100")],
)


def test_fan_out(spark):
    # three joined rows times three impressions; no impressions stays NULL; no clicks, no row
    assert table(spark, *FAN_OUT) == {(7, 1): (4.0, 3, 9), (7, 9): (0.0, 1, None)}


def test_exact_counts(spark):
    assert table(spark, *FAN_OUT, exact_impressions=True) == {(7, 1): (4.0, 2, 3), (7, 9): (0.0, 1, None)}


def test_bad_text(spark):
    got = table(
        spark,
        [("c1", "1", "7"), ("c2", "2", "7"), ("c3", "3", "7"), ("c4", "x", "hi")],
        [],
        [("v1", "c1", "oops"), ("v2", "c2", None), ("v3", "c3", "oops"), ("v4", "c3", "2")],
    )
    # bad revenue alone gives NULL, missing revenue counts as zero, bad ids become NULL
    assert got == {
        (7, 1): (None, 1, None),
        (7, 2): (0.0, 1, None),
        (7, 3): (2.0, 2, None),
        (None, None): (0.0, 1, None),
    }


def test_click_without_id(spark):
    got = table(spark, [(None, "1", "7"), ("c1", "1", "7")], [("1", "7"), ("1", "7")], [("v1", None, "5")])
    assert got == {(7, 1): (0.0, 1, 4)}


@pytest.mark.parametrize("hot_rows", [30, 1000])
def test_equals_the_literal_definition(spark, hot_rows, monkeypatch):
    """Against joins in the written order; a third of the clicks share a banner, many an id or none."""
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    clicks = [(f"c{i}", "1" if i % 3 == 0 else str(i % 7), str(i % 2)) for i in range(300)]
    clicks += [("c6", str(i % 4), "1") for i in range(90)] + [(None, str(i % 4), "0") for i in range(60)]
    impressions = [(str(i % 5), str(i % 2)) for i in range(200)]
    conversions = [(f"v{i}", f"c{(i * 7) % 400 if i % 3 else 6}", str(i % 9)) for i in range(150)]
    c, m, v = (
        spark.createDataFrame(clicks, CLICKS),
        spark.createDataFrame(impressions, IMPRESSIONS),
        spark.createDataFrame(conversions, CONVERSIONS),
    )
    joined = P.null_fill(P.attach_conversions(P.attach_impressions(c, m), v))
    literal = P.typed(
        joined.groupBy("campaign_id", "banner_id").agg(
            F.sum(F.col("revenue").cast("double")).alias("revenue_total"),
            F.count("click_id").alias("click_count"),
            F.sum("impression_count").alias("impression_count"),
        )
    )
    want = {(r.campaign_id, r.banner_id): (r.revenue_total, r.click_count, r.impression_count) for r in literal.collect()}
    assert table(spark, clicks, impressions, conversions) == want


def test_null_fill_fills_text(spark):
    df = spark.createDataFrame([("c", None, None)], "click_id string, conversion_id string, revenue string")
    assert P.null_fill(df).first().asDict() == {"click_id": "c", "conversion_id": "0", "revenue": "0"}


def test_clicks_cross_the_network_once(spark, folder):
    """Four exchanges: clicks and conversions by click, both aggregates by banner."""
    for name, rows, schema in (("c", FAN_OUT[0], CLICKS), ("m", FAN_OUT[1], IMPRESSIONS), ("v", FAN_OUT[2], CONVERSIONS)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c, m, v = (spark.read.parquet(f"{folder}/{n}") for n in "cmv")
        plan = P.banner_performance(c, m, v)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4
    assert "IsNotNull(click_id)" in plan
