"""The split paths give what the plain windows give, also when one key has most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bannerloom.operators import skew


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        user = None if i % 50 == 0 else (1 if rnd.random() < 0.4 else rnd.randrange(2, 40))
        value = None if rnd.random() < 0.2 else rnd.randrange(100)
        data.append((i, user, rnd.randrange(500), value))
    return spark.createDataFrame(data, "id long, user long, t long, value long").cache()


ORDER = [("t", True), ("id", True)]


def same(a, b):
    assert a.columns == b.columns
    left, right = sorted(map(tuple, a.collect()), key=str), sorted(map(tuple, b.collect()), key=str)
    assert left == right


def test_hot_keys(rows):
    hot = skew.hot_keys(rows, ["user"], 500)
    assert [r["user"] for r in hot.collect()] == [1]
    assert skew.hot_keys(rows, ["user"], 5000) is None


def test_hot_keys_of_a_sample(rows, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 600)
    found = {r["user"]: r["_n"] for r in skew.hot_keys(rows, ["user"], 500).collect()}
    assert 900 < found[1] < 1500


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("min_rows", [1, 500, 5000])
def test_join_unique(rows, how, min_rows):
    right = rows.where("user % 2 = 1").groupBy("user").agg(F.sum("value").alias("total"))
    same(skew.join_unique(rows, right, ["user"], how, min_rows), rows.join(right, ["user"], how))


def test_large_keys_do_not_reach_the_shuffled_join(rows):
    right = rows.groupBy("user").agg(F.sum("value").alias("total"))
    plan = skew.join_unique(rows, right, ["user"], "left", 500)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 3


@pytest.mark.parametrize("min_rows", [1, 60, 500])
def test_running_max(rows, min_rows):
    w = Window.partitionBy("user").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("m", F.max("value").over(w))
    got = skew.running_max(rows, ["user"], ORDER, F.col("value"), "m", min_rows)
    same(got.select(want.columns), want)


@pytest.mark.parametrize("min_rows", [1, 60, 500])
def test_previous_row(rows, min_rows):
    w = Window.partitionBy("user").orderBy("t", "id")
    want = rows.withColumn("pv", F.lag("value").over(w)).withColumn("pt", F.lag("t").over(w))
    got = skew.previous_row(rows, ["user"], ORDER, {"value": "pv", "t": "pt"}, min_rows)
    same(got.select(want.columns), want)


@pytest.mark.parametrize("min_rows", [1, 500, 5000])
def test_previous_row_in_descending_order(rows, min_rows):
    w = Window.partitionBy("user").orderBy(F.col("t").desc(), "id")
    got = skew.previous_row(rows, ["user"], [("t", False), ("id", True)], {"value": "pv"}, min_rows)
    same(got, rows.withColumn("pv", F.lag("value").over(w)))


@pytest.fixture
def small_pieces(spark):
    """Pieces are not put together, though these tables are small."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_a_third_of_the_rows_in_one_second(spark, small_pieces):
    """One user with a third of all rows, all at one time: many tasks share them, and the results are those of plain windows."""
    rows = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user"), F.lit(5).alias("t"), F.xxhash64("id").alias("value")
    )
    w = Window.partitionBy("user").orderBy("t", "id")
    got = skew.running_max(rows, ["user"], ORDER, F.col("value"), "m", 1000)
    same(got, rows.withColumn("m", F.max("value").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    got = skew.previous_row(rows, ["user"], ORDER, {"value": "pv"}, 1000)
    same(got, rows.withColumn("pv", F.lag("value").over(w)))
    pieces = skew._in_pieces(rows.where("user = 0"), ["user"], ORDER).groupBy("_piece").count().collect()
    assert len(pieces) > 1 and max(r["count"] for r in pieces) < 10_000


@pytest.mark.parametrize("min_rows", [1, 500])
@pytest.mark.parametrize("order", [[("value", False), ("t", True), ("id", True)], [("value", True), ("id", False)]])
def test_row_numbers(rows, min_rows, order):
    w = Window.partitionBy("user").orderBy(*skew.sort_columns(order))
    want = rows.withColumn("n", F.row_number().over(w).cast("long"))
    got = skew.row_numbers(rows, ["user"], order, "n", min_rows)
    same(got.select(want.columns), want)


def test_row_numbers_of_the_whole_table(rows):
    order = [("value", False), ("t", True), ("id", True)]
    want = rows.withColumn("n", F.row_number().over(Window.orderBy(*skew.sort_columns(order))).cast("long"))
    got = skew.row_numbers(rows, [], order, "n", min_rows=1)
    same(got.select(want.columns), want)


def test_split_path_really_splits(rows):
    got = skew.row_numbers(rows, ["user"], [("id", True)], "n", 500)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "_piece" in plan


@pytest.mark.parametrize("depth", [3, 1500])
def test_top_rows(rows, depth):
    order = [("value", False), ("id", True)]
    w = Window.partitionBy("user").orderBy(*skew.sort_columns(order))
    want = rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= depth)
    got = skew.top_rows(rows, ["user"], order, depth, "n")
    same(got.select(want.columns), want)


def test_top_rows_are_bounded_before_the_shuffle(rows):
    plan = skew.top_rows(rows, ["user"], [("value", False)], 3, "n")._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange


@pytest.mark.parametrize("chunk", [None, 1, 7, 10_000])
def test_ordered_fold(rows, chunk):
    # concatenation is associative and depends on the order
    got = skew.ordered_fold(
        rows, ["user"], "id", F.col("id").cast("string"), lambda a, b: F.concat(a, F.lit(","), b), "s", chunk
    )
    want = rows.groupBy("user").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("s")
    )
    same(got, want)


def test_fold_arrays_are_bounded_by_rows_and_not_by_the_span(spark, monkeypatch):
    """One key, its numbers close together and one far away."""
    monkeypatch.setattr(skew, "FOLD_ROWS", 10)
    df = spark.createDataFrame([(1, i) for i in range(100)] + [(1, 10**12)], "k long, q long")
    longest = F.struct(F.lit(1).alias("n"), F.lit(1).alias("steps"))

    def merge(a, b):
        return F.struct((a["n"] + b["n"]).alias("n"), (a["steps"] + 1).alias("steps"))

    got = skew.ordered_fold(df, ["k"], "q", longest, merge, "f").first().f
    assert got.n == 101 and got.steps <= 20


def test_many_large_keys_are_all_listed(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLE_ROWS", 100_000)
    df = spark.range(300_000).select((F.col("id") % 2000).alias("k"))
    assert skew.hot_keys(df, ["k"], 100).count() == 2000
