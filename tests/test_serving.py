"""Tiers, ranking, back-fill, seen lists and answers."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bannerloom.functions import requests as R
from bannerloom.operators import requests as requests_op
from bannerloom.operators import serving as S

PERF = "campaign_id int, banner_id int, revenue_total double, click_count int, impression_count long"
REQUEST = "request_id long, ts timestamp_ntz, user_key long, method string, campaign_id string, cookie string"


def perf_of(spark, rows):
    return spark.createDataFrame([(c, b, r, k, 1) for c, b, r, k in rows], PERF)


def lists(served):
    return {r.campaign_id: list(r.banner_ids) for r in S.served_arrays(served).collect()}


def test_top_five_by_revenue(spark):
    perf = perf_of(spark, [(40, b, 10.0, 1) for b in range(1, 6)] + [(40, 6, 0.0, 1)])
    assert set(lists(S.serve_with_backfill(perf, "s"))[40]) == {1, 2, 3, 4, 5}


def test_backfill_from_other_campaigns(spark):
    perf = perf_of(spark, [(40, 1, 10.0, 1), (30, 2, 10.0, 1), (430, 3, 10.0, 1), (420, 4, 10.0, 1), (450, 5, 10.0, 1), (460, 6, 0.0, 1)])
    for seed in ("a", "b", "c"):
        got = lists(S.serve_with_backfill(perf, seed))
        assert all(len(ids) == 5 and len(set(ids)) == 5 for ids in got.values())
        assert got[40][0] == 1


def test_backfill_with_fewer_banners_than_the_limit(spark):
    perf = perf_of(spark, [(1, 1, 5.0, 1), (2, 2, 5.0, 1), (2, 3, 5.0, 1)])
    got = lists(S.serve_with_backfill(perf, "s"))
    assert {c: sorted(ids) for c, ids in got.items()} == {1: [1, 2, 3], 2: [1, 2, 3]}


def test_ring_is_a_permutation(spark):
    perf = perf_of(spark, [(b % 7, b, 1.0, 1) for b in range(500)])
    ring = S.banner_ring(perf, "s").collect()
    assert sorted(r.ring_pos for r in ring) == list(range(500))
    assert sorted(r.banner_id for r in ring) == list(range(500))


def test_tiers(spark):
    rows = []
    for campaign, with_revenue in ((1, 12), (2, 7), (3, 3), (4, 0)):
        # later banners earn more and are clicked less
        rows += [(campaign, b, float(b) if b > 15 - with_revenue else 0.0, 20 - b) for b in range(1, 16)]
    got = lists(S.serve_with_backfill(perf_of(spark, rows), "s"))
    assert got[1] == [15, 14, 13, 12, 11, 10, 9, 8, 7, 6]
    assert got[2] == [15, 14, 13, 12, 11, 10, 9]
    assert got[3] == [15, 14, 13, 1, 2]  # top revenue, then top clicks
    assert got[4] == [1, 2, 3, 4, 5]


def test_null_revenue_sorts_last_and_does_not_count(spark):
    perf = perf_of(spark, [(1, 1, None, 9), (1, 2, 0.0, 1), (1, 3, 1.0, 1)])
    assert [r.banner_id for r in S.topk_campaign(perf, 1, 3).collect()] == [3, 2, 1]
    assert S.campaign_stats(perf, 1).first().revenue_count == 1
    assert tuple(S.campaign_stats(perf, 99).first()) == (0, 0, 0)


def test_unseen_first(spark):
    df = spark.createDataFrame([([6, 5, 4, 3, 2, 1], [1]), ([3, 2, 1], [3, 9])], "pool array<int>, seen array<int>")
    got = [list(r[0]) for r in df.select(S.prefer_unseen(F.col("pool"), F.col("seen"), 5)).collect()]
    assert got == [[6, 5, 4, 3, 2], [2, 1, 3]]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_same_seed_same_lists(spark, partitions):
    rnd = random.Random(1)
    rows = [(c, b, round(rnd.random() * 5, 2), rnd.randrange(9)) for c in range(30) for b in range(rnd.randrange(1, 9))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        first = lists(S.serve_with_backfill(perf_of(spark, rows), "s"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == lists(S.serve_with_backfill(perf_of(spark, rows).repartition(5), "s"))


def test_large_campaign_is_ranked_in_pieces(spark):
    rnd = random.Random(3)
    rows = [(1 if b % 3 else 2, b, float(rnd.randrange(4)), rnd.randrange(3)) for b in range(2000)]
    perf = perf_of(spark, rows)
    plain = {tuple(r) for r in S.rank_banners(perf).select("campaign_id", "banner_id", "banner_rank").collect()}
    split = {tuple(r) for r in S.rank_banners(perf, 700).select("campaign_id", "banner_id", "banner_rank").collect()}
    assert plain == split


# --- requests


def test_cookies(spark):
    texts = [
        "bla bla bla",
        "mycookiee=[373, 124, 114, 472, 322]; seen_banners_cookie=[446, 121, 334, 500, 182]",
        None,
        "seen_banners_cookie=[1, x]",
        "seen_banners_cookie=__import__('os')",
        "not_seen_banners_cookie=[1]",
        "seen_banners_cookie=[]",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, cookie string")
    got = [list(r[1]) for r in df.select("i", R.seen_banners(F.col("cookie"))).orderBy("i").collect()]
    assert got == [[], [446, 121, 334, 500, 182], [], [], [], [], []]


def test_page_and_cookie_text(spark):
    df = spark.createDataFrame([([3, 1], datetime(2018, 3, 20, 20, 41, 27))], "ids array<int>, ts timestamp_ntz")
    body, cookie = df.select(R.page(F.col("ids"), "http://x"), R.set_cookie(F.col("ids"), F.col("ts"), "d.org")).first()
    assert body == "<html><body><img src='http://x/image_3.png'><img src='http://x/image_1.png'></body></html>"
    assert cookie == 'seen_banners_cookie=[3, 1]; domain=d.org; expires=Thu, 19-Apr-2018 20:41:27 PST;"'


def requests_of(spark, rows):
    return spark.createDataFrame([(i, datetime(2024, 1, 1), 1, *r) for i, r in enumerate(rows)], REQUEST)


def test_validation(spark):
    rows = [("GET", "5", ""), ("GET", "hi", ""), ("GET", None, ""), ("POST", "5", ""), (None, "5", "")]
    requests = requests_of(spark, rows)
    got = [r.status for r in requests_op.validate(requests).orderBy("request_id").collect()]
    assert got == [200, 400, 400, 400, 400]
    got = [r.status for r in requests_op.respond(requests, None).orderBy("request_id").collect()]
    assert got == [500, 400, 400, 400, 400]


def by_hand(perf_rows, campaign, seen):
    """Unshuffled list of a top-tier campaign, straight from the rule."""
    ranked = [b for _, b, _, _ in sorted((r for r in perf_rows if r[0] == campaign), key=lambda r: (-r[2], -r[3], r[1]))]
    pool = ranked[: 10 + len(seen)]
    unseen = [b for b in pool if b not in seen][:10]
    return unseen + [b for b in pool if b not in unseen][: 10 - len(unseen)]


@pytest.mark.parametrize("lengths", [[0, 3, 12], [0, 3, 60, 150]])
def test_answers(spark, lengths):
    """Usual and very long seen lists, known and unknown campaigns."""
    rnd = random.Random(5)
    perf_rows = [(c, b, float(rnd.randrange(1, 50)), rnd.randrange(5)) for c, n in ((1, 120), (2, 40), (3, 12)) for b in range(n)]
    perf_rows += [(4, 1, 3.0, 1)]
    perf = perf_of(spark, perf_rows)
    asked = []
    for campaign in (1, 2, 3, 4, 77):
        for n in lengths:
            asked.append((campaign, rnd.sample(range(160), n)))
    requests = requests_of(spark, [("GET", str(c), f"seen_banners_cookie={s}") for c, s in asked])
    ready = requests_op.prepare(perf, "s")
    picked = requests_op.pick_banners(requests_op.visits_of(requests), ready)
    got = {r.request_id: list(r.picks) for r in picked.collect()}
    assert len(got) == len(asked)
    for i, (campaign, seen) in enumerate(asked):
        if campaign <= 3:
            assert got[i] == by_hand(perf_rows, campaign, seen)
        else:
            assert len(got[i]) == len(set(got[i])) == 5
            assert campaign != 4 or got[i][0] == 1
    answers = {r.request_id: r for r in requests_op.respond(requests, ready).collect()}
    assert all(a.status == 200 and set(a.banner_ids) == set(got[i]) for i, a in answers.items())


def test_requests_that_share_an_id(spark):
    perf = perf_of(spark, [(7, b, float(100 - b), 1) for b in range(1, 91)])
    ready = requests_op.prepare(perf, "s")
    cookie = "seen_banners_cookie=[" + ", ".join(map(str, range(1, 71))) + "]"
    asked = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, "GET", "7", cookie)] * 2, REQUEST)
    got = requests_op.respond(asked, ready).collect()
    assert len(got) == 2 and all(sorted(r.banner_ids) == list(range(71, 81)) for r in got)


def test_empty_table_gives_an_empty_page(spark):
    ready = requests_op.prepare(perf_of(spark, []), "s")
    asked = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, "GET", "7", None)], REQUEST)
    got = requests_op.respond(asked, ready).first()
    assert got.status == 200 and got.banner_ids == [] and "<body></body>" in got.body and "=[];" in got.set_cookie
