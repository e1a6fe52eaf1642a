"""Stats, ranking, tiers, back-fill, seen lists and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bannerloom.functions import requests as R
from bannerloom.operators import requests as requests_op
from bannerloom.operators import serving as S
from bannerloom.plans.registry import query
from bannerloom.plans.source_queries import write_periods
from bannerloom.plans.views import SEED, SQL, Views, with_views
from bannerloom.session import scratch_dir
from bannerloom.sources import history

ONE_CAMPAIGN = 100000
BANNERS_OUT = [1, 3, 5, 7, 11]


@query("filter_campaign", with_views(f"SELECT * FROM perf WHERE campaign_id = {ONE_CAMPAIGN}", "perf"))
def _(v: Views) -> DataFrame:
    return v.perf.where(F.col("campaign_id") == ONE_CAMPAIGN)


@query("filter_not_in", with_views("SELECT * FROM perf WHERE banner_id NOT IN (1, 3, 5, 7, 11)", "perf"))
def _(v: Views) -> DataFrame:
    return v.perf.where(~F.col("banner_id").isin(BANNERS_OUT))


@query("campaign_stats", with_views("SELECT * FROM stats", "stats"))
def _(v: Views) -> DataFrame:
    return S.campaign_stats(v.perf)


@query(
    "campaign_stats_one",
    with_views(
        f"""SELECT COUNT(*) AS banner_rows,
  CAST(COALESCE(SUM(CASE WHEN revenue_total > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS revenue_count,
  CAST(COALESCE(SUM(CASE WHEN click_count > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS click_count
FROM perf WHERE campaign_id = {ONE_CAMPAIGN}""",
        "perf",
    ),
)
def _(v: Views) -> DataFrame:
    return S.campaign_stats(v.perf, ONE_CAMPAIGN)


@query("rank_banners", with_views("SELECT campaign_id, banner_id, banner_rank FROM ranked", "ranked"))
def _(v: Views) -> DataFrame:
    return S.rank_banners(v.perf_table).select("campaign_id", "banner_id", F.col("banner_rank").cast("long").alias("banner_rank"))


@query(
    "topk_campaign",
    with_views(
        f"SELECT * EXCLUDE (banner_rank) FROM ranked WHERE campaign_id = {ONE_CAMPAIGN} AND banner_rank <= 12", "ranked"
    ),
)
def _(v: Views) -> DataFrame:
    return S.topk_campaign(v.perf, ONE_CAMPAIGN, 12)


@query("serve_campaigns", with_views("SELECT * FROM served", "served"))
def _(v: Views) -> DataFrame:
    return S.serve_campaigns(v.perf_table).withColumn("banner_rank", F.col("banner_rank").cast("long"))


@query("distinct_banners", with_views("SELECT DISTINCT banner_id FROM perf WHERE banner_id NOT IN (1, 3, 5, 7, 11)", "perf"))
def _(v: Views) -> DataFrame:
    return S.distinct_banners(v.perf, BANNERS_OUT)


# requested campaigns are included, so campaigns without any row are filled too
@query(
    "backfill_candidates",
    with_views("SELECT campaign_id, have, banner_id, step FROM backfill", "backfill", campaigns="known_or_asked"),
)
def _(v: Views) -> DataFrame:
    return S.backfill_candidates(v.perf_table, SEED, requests_op.visits_of(v.requests))


@query("serve_with_backfill", with_views("SELECT campaign_id, banner_id, pos, is_backfill FROM filled", "filled"))
def _(v: Views) -> DataFrame:
    return S.serve_with_backfill(v.perf_table, SEED)


@query(
    "shuffled_serving_order",
    with_views(
        f"""SELECT campaign_id, banner_id, ROW_NUMBER() OVER (PARTITION BY campaign_id
  ORDER BY md5('{SEED}|' || campaign_id || '|' || banner_id), banner_id) AS show_pos FROM served""",
        "served",
    ),
)
def _(v: Views) -> DataFrame:
    shuffled = S.shuffled_order(S.serve_campaigns(v.perf_table), SEED)
    return shuffled.select("campaign_id", "banner_id", F.col("show_pos").cast("long").alias("show_pos"))


@query(
    "served_arrays",
    with_views(
        "SELECT campaign_id, string_agg(CAST(banner_id AS VARCHAR), ',' ORDER BY pos) AS banner_ids FROM filled GROUP BY 1",
        "filled",
    ),
)
def _(v: Views) -> DataFrame:
    arrays = S.served_arrays(S.serve_with_backfill(v.perf_table, SEED))
    return arrays.withColumn("banner_ids", F.array_join(F.col("banner_ids").cast("array<string>"), ","))


@query(
    "request_validation",
    with_views(
        """SELECT request_id, status, campaign,
  CASE WHEN status = 400 THEN 'The request method is unsupported!' END AS message FROM (
  SELECT request_id, CASE WHEN method = 'GET' AND TRY_CAST(campaign_id AS INTEGER) IS NOT NULL THEN 200 ELSE 400 END AS status,
    CASE WHEN method = 'GET' THEN TRY_CAST(campaign_id AS INTEGER) END AS campaign FROM requests)""",
        "requests",
    ),
)
def _(v: Views) -> DataFrame:
    return requests_op.validate(v.requests).select("request_id", "status", "campaign", "message")


@query(
    "request_validation_no_data",
    with_views(
        """SELECT request_id, CASE WHEN method = 'GET' AND TRY_CAST(campaign_id AS INTEGER) IS NOT NULL THEN 500 ELSE 400 END
  AS status FROM requests""",
        "requests",
    ),
)
def _(v: Views) -> DataFrame:
    return requests_op.validate(v.requests, has_data=False).select("request_id", "status")


@query(
    "parse_seen_cookie",
    with_views(
        """SELECT request_id, CASE WHEN request_id % 3 = 0
  THEN regexp_extract(cookie, 'seen_banners_cookie=\\[([^\\]]*)\\]', 1) ELSE '' END AS seen FROM requests""",
        "requests",
    ),
)
def _(v: Views) -> DataFrame:
    seen = R.seen_banners(F.col("cookie"))
    return v.requests.select("request_id", F.array_join(seen.cast("array<string>"), ", ").alias("seen"))


PICKED_TEXT = """SELECT request_id, string_agg(CAST(banner_id AS VARCHAR), ',' ORDER BY pos) AS banner_ids
FROM picks GROUP BY request_id"""


@query("serve_requests_picks", with_views(PICKED_TEXT, "picks", campaigns="known_or_asked"))
def _(v: Views) -> DataFrame:
    picked = requests_op.pick_banners(requests_op.visits_of(v.requests), v.ready)
    return picked.select("request_id", F.array_join(F.col("picks").cast("array<string>"), ",").alias("banner_ids"))


# a visit with a remembered list, in campaigns of the top tier
@query(
    "serve_excluding_seen",
    with_views(
        """SELECT request_id, string_agg(CAST(banner_id AS VARCHAR), ',' ORDER BY pos) AS banner_ids
FROM picks JOIN stats USING (campaign_id) JOIN (SELECT request_id, seen FROM visits) s USING (request_id)
WHERE revenue_count >= 10 AND len(seen) > 0 GROUP BY request_id""",
        "picks",
        campaigns="known_or_asked",
    ),
)
def _(v: Views) -> DataFrame:
    visits = requests_op.visits_of(v.requests).where(F.size("seen") > 0)
    top_tier = v.ready.lists.where(F.col("pool").isNotNull())
    picked = requests_op.pick_banners(visits.join(top_tier, "campaign_id", "left_semi"), v.ready)
    return picked.select("request_id", F.array_join(F.col("picks").cast("array<string>"), ",").alias("banner_ids"))


# the same visits through the exact path for long seen lists
@query(
    "serve_excluding_seen_long",
    with_views(
        """SELECT request_id, string_agg(CAST(banner_id AS VARCHAR), ',' ORDER BY pos) AS banner_ids
FROM picks JOIN stats USING (campaign_id) WHERE revenue_count >= 10 GROUP BY request_id""",
        "picks",
        campaigns="known_or_asked",
    ),
)
def _(v: Views) -> DataFrame:
    picked = S.answer_long(requests_op.visits_of(v.requests), v.perf_table, "request_id")
    return picked.select("request_id", F.array_join(F.col("long_picks").cast("array<string>"), ",").alias("banner_ids"))


RESPONSES = f"""SELECT request_id, 200 AS status, banner_ids,
  '<html><body>' || array_to_string(list_transform(string_split(banner_ids, ', '),
     lambda b: '<img src=''{R.DEFAULT_IMAGE_BASE}/image_' || b || '.png''>'), '') || '</body></html>' AS body,
  'seen_banners_cookie=[' || banner_ids || ']; domain={R.DEFAULT_DOMAIN}; expires='
     || strftime(ts + INTERVAL 30 DAY, '%a, %d-%b-%Y %H:%M:%S PST') || ';"' AS set_cookie
FROM (SELECT request_id, ts, string_agg(CAST(banner_id AS VARCHAR), ', '
        ORDER BY md5('{SEED}|' || campaign_id || '|' || banner_id), banner_id) AS banner_ids
      FROM picks GROUP BY request_id, ts)
UNION ALL
SELECT request_id, 400, NULL, '<html><head><title>400 Bad Request</title></head><body><h1>Bad Request</h1>'
  || '<p>Your browser sent a request that this server could not understand.</p><p>The request method is unsupported!</p></body></html>',
  NULL FROM requests WHERE method <> 'GET' OR TRY_CAST(campaign_id AS INTEGER) IS NULL"""


@query("serve_requests", with_views(RESPONSES, "picks", campaigns="known_or_asked"))
def _(v: Views) -> DataFrame:
    return as_text(requests_op.respond(v.requests, v.ready))


# datasets 1 and 2 are processed, 3 was skipped as a duplicate: 2 is served
LATEST = with_views(RESPONSES, "period_perf", "picks", campaigns="known_or_asked").replace(
    f"\nperf AS ({SQL['perf'][1]})",
    "\nperf AS (SELECT revenue_total, impression_count, campaign_id, banner_id, click_count FROM period_perf WHERE dataset_id = 2)",
)


@query("serve_latest", LATEST)
def _(v: Views) -> DataFrame:
    perf, done, lists = (scratch_dir(v.spark, n) for n in ("perf", "history", "latest"))
    write_periods(v, perf)
    for n, state in ((1, "processed"), (2, "processed"), (3, "duplicate")):
        prints = v.spark.createDataFrame([("clicks", f"print {n}")], "kind string, fingerprint string")
        history.append_history(history.history_row(prints, n, n, state, f"2024-01-0{n}T00:00:00", f"2024-01-0{n}T01:00:00"), done)
    return as_text(requests_op.serve_latest(v.requests, perf, done, SEED, lists))


def as_text(responses: DataFrame) -> DataFrame:
    return responses.withColumn("banner_ids", F.array_join(F.col("banner_ids").cast("array<string>"), ", "))


@query(
    "build_cookie",
    with_views(
        f"""SELECT request_id, 'seen_banners_cookie=[' || array_to_string(seen, ', ') || ']; domain={R.DEFAULT_DOMAIN}; expires='
  || strftime(ts + INTERVAL 30 DAY, '%a, %d-%b-%Y %H:%M:%S PST') || ';"' AS set_cookie FROM visits""",
        "visits",
    ),
)
def _(v: Views) -> DataFrame:
    return requests_op.visits_of(v.requests).select("request_id", R.set_cookie(F.col("seen"), F.col("ts")).alias("set_cookie"))


@query(
    "render_html",
    with_views(
        f"""SELECT campaign_id, '<html><body>' || string_agg('<img src=''{R.DEFAULT_IMAGE_BASE}/image_' || banner_id || '.png''>', ''
  ORDER BY pos) || '</body></html>' AS body FROM filled GROUP BY campaign_id""",
        "filled",
    ),
)
def _(v: Views) -> DataFrame:
    arrays = S.served_arrays(S.serve_with_backfill(v.perf_table, SEED))
    return arrays.select("campaign_id", R.page(F.col("banner_ids")).alias("body"))
