"""Streams over the given tables; each one runs until its input is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bannerloom.operators import requests as requests_op
from bannerloom.plans.registry import query
from bannerloom.plans.serving_queries import RESPONSES, as_text
from bannerloom.plans.source_queries import staged_csv
from bannerloom.plans.table_queries import FEED_SQL, feed, feed_text
from bannerloom.plans.views import Views, with_views
from bannerloom.session import scratch_dir
from bannerloom.sources import tables
from bannerloom.streaming import ingest, serve, tail

WAIT = 3600


def finish(q: StreamingQuery) -> None:
    if not q.awaitTermination(WAIT):
        q.stop()
        raise TimeoutError("the stream did not finish")


@query("stream_ingest", with_views("SELECT * FROM period_perf", "period_perf"))
def _(v: Views) -> DataFrame:
    perf, done, checkpoint = (scratch_dir(v.spark, n) for n in ("perf", "history", "checkpoint"))
    finish(ingest.ingest_stream(v.spark, staged_csv(v), perf, done, checkpoint))
    return tables.scan_performance(v.spark, perf).withColumn("revenue_total", F.round("revenue_total", 2))


def written_requests(v: Views) -> DataFrame:
    """The requests as a stream over files."""
    path = scratch_dir(v.spark, "requests")
    v.requests.write.parquet(path)
    return tail.tail(v.spark, path, v.requests.schema)


@query("stream_serve", with_views(RESPONSES, "picks", campaigns="known_or_asked"))
def _(v: Views) -> DataFrame:
    out, checkpoint = (scratch_dir(v.spark, n) for n in ("responses", "checkpoint"))
    finish(serve.serve_stream(written_requests(v), v.ready, out, checkpoint))
    return as_text(serve.read_responses(v.spark, out))


@query(
    "seen_state",
    with_views(
        """, lists AS (SELECT request_id, ts, user_key, string_agg(CAST(banner_id AS VARCHAR), ',' ORDER BY pos) AS ids
  FROM picks GROUP BY ALL)
SELECT request_id, CASE WHEN before_ts >= ts - INTERVAL 30 DAY THEN before ELSE '' END AS seen FROM (
  SELECT *, LAG(ids) OVER w AS before, LAG(ts) OVER w AS before_ts FROM lists WINDOW w AS (PARTITION BY user_key ORDER BY ts, request_id))""",
        "picks",
        campaigns="known_or_asked",
    ).replace("\n, lists", ",\nlists"),
)
def _(v: Views) -> DataFrame:
    picked = requests_op.pick_banners(requests_op.visits_of(v.requests), v.ready)
    log = tables.write_out(picked.select("request_id", "user_key", "ts", "picks"), scratch_dir(v.spark, "log"))
    return serve.remembered(log).select("request_id", F.array_join(F.col("seen").cast("array<string>"), ",").alias("seen"))


MEMORY_SQL = with_views(
    "@", "visits", "ranked", "stats", "filled", campaigns="known_or_asked", recursive=True
).replace(
    "\n@",
    """,
pools AS (SELECT campaign_id, list(banner_id ORDER BY banner_rank) AS pool FROM ranked JOIN stats USING (campaign_id)
  WHERE revenue_count >= 10 GROUP BY campaign_id),
fixed AS (SELECT campaign_id, list(banner_id ORDER BY pos) AS fixed FROM filled GROUP BY campaign_id),
queue AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_key ORDER BY ts, request_id) AS i
  FROM visits LEFT JOIN pools USING (campaign_id) LEFT JOIN fixed USING (campaign_id)),
run AS (
  SELECT DISTINCT user_key, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS request_id, CAST([] AS INTEGER[]) AS picks FROM visits
  UNION ALL
  SELECT q.user_key, q.i, q.request_id, CASE WHEN q.pool IS NULL THEN q.fixed ELSE list_slice(list_concat(
      list_filter(q.pool, lambda b: NOT list_contains(r.picks, b)), list_filter(q.pool, lambda b: list_contains(r.picks, b))), 1, 10) END
  FROM run r JOIN queue q ON q.user_key = r.user_key AND q.i = r.i + 1
)
SELECT request_id, array_to_string(picks, ',') AS banner_ids FROM run WHERE request_id IS NOT NULL""",
)


@query("seen_state_stream", MEMORY_SQL)
def _(v: Views) -> DataFrame:
    out, checkpoint = (scratch_dir(v.spark, n) for n in ("served", "checkpoint"))
    visits = requests_op.visits_of(written_requests(v)).drop("seen")
    answered = serve.serve_with_memory(visits, v.ready)
    finish(tail.drain(answered, out, checkpoint))
    picks = F.array_join(F.col("picks").cast("array<string>"), ",")
    return v.spark.read.parquet(out).select("request_id", picks.alias("banner_ids"))


@query("change_feed_resume", FEED_SQL)
def _(v: Views) -> DataFrame:
    path, out, checkpoint = (scratch_dir(v.spark, n) for n in ("feed", "delivered", "checkpoint"))
    changes = tail.with_tokens(feed_text(feed(v)), F.col("o_orderkey"))
    # two versions of the feed; the reader stops in between and resumes from its checkpoint
    for rest in (0, 1):
        changes.where(F.col("token") % 2 == rest).write.mode("append").parquet(path)
        finish(tail.drain(tail.tail(v.spark, path, changes.schema), out, checkpoint))
    return v.spark.read.parquet(out).drop("token")


@query("tail_append", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'")
def _(v: Views) -> DataFrame:
    path, out, checkpoint = (scratch_dir(v.spark, n) for n in ("log", "tailed", "checkpoint"))
    log = v.table("events").select("event_id", "user_id", "event_type", "value")
    for rest in (0, 1):
        log.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(path)
        clicks = tail.tail(v.spark, path, log.schema).where(F.col("event_type") == "click").drop("event_type")
        finish(tail.drain(clicks, out, checkpoint))
    return v.spark.read.parquet(out)
