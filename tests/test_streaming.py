"""Streams give the batch result and add nothing twice after a restart."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from bannerloom.operators import requests as requests_op
from bannerloom.operators import serving
from bannerloom.streaming import serve, tail

PERF = "campaign_id int, banner_id int, revenue_total double, click_count int, impression_count long"
START = datetime(2024, 1, 1)


def perf_of(spark):
    rows = [(1, b, 50.0 - b, 1, 1) for b in range(25)] + [(2, b, 1.0, 1, 1) for b in range(3)]
    return spark.createDataFrame(rows, PERF)


def finish(q):
    assert q.awaitTermination(120)


def test_memory(spark, folder):
    """Alternating top lists for one user, a forgotten list after 30 days, no memory without a user."""
    days = [0, 1, 2, 40]
    rows = [(10 + i, START + timedelta(days=d), 7, 1) for i, d in enumerate(days)]
    rows += [(20 + i, START + timedelta(days=d), None, 1) for i, d in enumerate(days)]
    rows += [(30, START, 8, 2), (31, START, 8, 999)]  # a short and an unknown campaign
    visits = spark.createDataFrame(rows, "request_id long, ts timestamp_ntz, user_key long, campaign_id int")
    ready = requests_op.publish(perf_of(spark), "s", f"{folder}/ready")
    source, out, check = f"{folder}/visits", f"{folder}/out", f"{folder}/check"
    # two runs: the state survives the restart
    for part in ("request_id % 10 < 1", "request_id % 10 >= 1"):
        visits.where(part).write.mode("append").parquet(source)
        stream = tail.tail(spark, source, visits.schema)
        finish(tail.drain(serve.serve_with_memory(stream, ready), out, check))
    got = {r.request_id: (r.seen, r.picks) for r in spark.read.parquet(out).collect()}
    first, second = list(range(10)), list(range(10, 20))
    assert got[10] == ([], first)
    assert got[11] == (first, second)
    # the list before is remembered, not all lists
    assert got[12] == (second, first)
    assert got[13] == ([], first)
    assert all(got[20 + i] == ([], first) for i in range(4))
    assert len(got[30][1]) == len(set(got[31][1])) == 5


def test_memory_of_a_hot_user_in_several_batches(spark, folder, monkeypatch):
    """One user with most visits, out of order, in chunks and micro-batches: the answers of a plain loop."""
    r = random.Random(2)
    rows = [(i, START + timedelta(minutes=r.randrange(4000), days=20 * (i >= 300)), 7 if r.random() < 0.6 else r.randrange(5), r.choice([1, 1, 2, None])) for i in range(600)]
    visits = spark.createDataFrame(rows, "request_id long, ts timestamp_ntz, user_key long, campaign_id int")
    ready = requests_op.publish(perf_of(spark), "s", f"{folder}/ready")
    source, out, check = f"{folder}/visits", f"{folder}/out", f"{folder}/check"
    for part in ("request_id < 300", "request_id >= 300"):
        visits.where(part).repartition(3).write.mode("append").parquet(source)
        finish(tail.drain(serve.serve_with_memory(tail.tail(spark, source, visits.schema), ready), out, check))
    lists = {r.campaign_id: r for r in serving.with_lists(visits, ready.lists, ready.around, ready.ring_size, ready.seed).collect()}
    want, last = {}, {}
    for i, ts, user, campaign in sorted(rows, key=lambda x: (x[0] >= 300, x[1], x[0])):
        ids, since = last.get(user, ([], None))
        seen = ids if since is not None and ts - since <= timedelta(days=30) else []
        pool, fixed = lists[campaign].pool, lists[campaign].fixed
        picks = list(fixed or []) if pool is None else sorted(pool, key=lambda b: b in seen)[:10]
        want[i], last[user] = (seen, picks), (picks, ts)
    got = {r.request_id: (r.seen, r.picks) for r in spark.read.parquet(out).collect()}
    assert got == want and len(got) == 600


def test_remembered_log(spark):
    rows = [(1, 7, START, [1]), (2, 7, START + timedelta(days=3), [2]), (3, 7, START + timedelta(days=50), [3])]
    rows += [(4, None, START, [4]), (5, None, START + timedelta(days=1), [5])]
    log = spark.createDataFrame(rows, "request_id long, user_key long, ts timestamp_ntz, picks array<int>")
    for min_rows in (1, 1000):
        got = {r.request_id: r.seen for r in serve.remembered(log, min_rows).collect()}
        assert got == {1: [], 2: [1], 3: [], 4: [], 5: []}


REQUEST = "request_id long, ts timestamp_ntz, user_key long, method string, campaign_id string, cookie string"


def test_stream_serves_like_batch(spark, folder):
    rows = [(i, START, 1, "GET" if i % 5 else "POST", str(1 + i % 3), f"seen_banners_cookie=[{i}]") for i in range(40)]
    requests = spark.createDataFrame(rows, REQUEST)
    ready = requests_op.publish(perf_of(spark), "s", f"{folder}/ready")
    source, out, check = f"{folder}/in", f"{folder}/out", f"{folder}/check"
    for part in ("request_id < 25", "request_id >= 25"):
        requests.where(part).write.mode("append").parquet(source)
        finish(serve.serve_stream(tail.tail(spark, source, requests.schema), ready, out, check))
    got = serve.read_responses(spark, out)
    want = requests_op.respond(requests, ready)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    # nothing new, nothing added
    finish(serve.serve_stream(tail.tail(spark, source, requests.schema), ready, out, check))
    assert serve.read_responses(spark, out).count() == 40


def test_resume(spark, folder):
    source, out, check = f"{folder}/in", f"{folder}/out", f"{folder}/check"
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.mode("append").parquet(source)
        evens = tail.tail(spark, source, spark.range(1).schema).where(F.col("id") % 2 == 0)
        finish(tail.drain(evens, out, check))
        finish(tail.drain(evens, out, check))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(0, 30, 2))


def test_tokens(spark):
    feed = tail.with_tokens(spark.range(10), F.col("id"))
    assert [r.id for r in tail.resume_after(feed, 7).orderBy("id").collect()] == [8, 9]
    broken = tail.with_tokens(spark.range(10), F.when(F.col("id") != 3, F.col("id")))
    try:
        broken.collect()
        raise AssertionError("expected an error")
    except Exception as e:
        assert "no resume token" in str(e)
