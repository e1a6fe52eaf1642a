"""Dataset selection, duplicates, fingerprints and ingestion runs."""

import pytest
from pyspark.sql import functions as F

from bannerloom import schemas
from bannerloom.sources import datasets, history, tables
from bannerloom.streaming import ingest


def history_of(spark, rows):
    full = [(i, order, state, None, None, prints) for i, (order, state, prints) in enumerate(rows)]
    return spark.createDataFrame(full, schemas.HISTORY)


def folders(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "dataset_id int")


@pytest.mark.parametrize("done, want", [([1, 2], 3), ([1, 2, 4], None), ([], 1), ([9], None)])
def test_next_dataset(spark, done, want):
    past = history_of(spark, [(n, "processed", {}) for n in done])
    assert history.next_dataset(folders(spark, 4, 2, 1, 3), past).first().next == want


def test_folder_numbers_are_compared_as_numbers(spark):
    past = history_of(spark, [(9, "processed", {})])
    assert history.next_dataset(folders(spark, 1, 10, 2, 9), past).first().next == 10


def test_latest_dataset(spark):
    past = history_of(spark, [(1, "processed", {}), (2, "processed", {}), (3, "duplicate", {})])
    assert history.latest_dataset(past).first().latest == 2
    assert history.latest_dataset(past, any_state=True).first().latest == 3
    assert history.latest_dataset(past.where("false")).first().latest is None


PAST = [
    (1, "processed", {"clicks": "10", "impressions": "20", "conversions": "30"}),
    (2, "processed", {"clicks": "40", "impressions": "50", "conversions": "60"}),
]


@pytest.mark.parametrize("mode", ["any", "first"])
@pytest.mark.parametrize(
    "files, want",
    [([("clicks", "10")], True), ([("conversions", "10")], False), ([("clicks", "200"), ("conversions", "10")], False)],
)
def test_duplicates(spark, mode, files, want):
    given = spark.createDataFrame([(5, k, f) for k, f in files], "dataset_id int, kind string, fingerprint string")
    assert history.duplicate_datasets(given, history_of(spark, PAST), mode).first().is_duplicate is want


def test_duplicate_modes_differ_on_the_second_file(spark):
    given = spark.createDataFrame(
        [(5, "clicks", "200"), (5, "conversions", "30")], "dataset_id int, kind string, fingerprint string"
    )
    past = history_of(spark, PAST)
    assert history.duplicate_datasets(given, past, "any").first().is_duplicate is True
    assert history.duplicate_datasets(given, past, "first").first().is_duplicate is False
    with pytest.raises(ValueError):
        history.duplicate_datasets(given, past, "last")


def write_dataset(spark, root, n, shift=0, parts=1):
    clicks = spark.createDataFrame([(f"c{i + shift}", str(i % 3), "1") for i in range(9)], schemas.CLICKS)
    impressions = spark.createDataFrame([(str(i % 3), "1") for i in range(6 + shift // 5)], schemas.IMPRESSIONS)
    conversions = spark.createDataFrame([(f"v{i}", f"c{i + shift}", "1.5") for i in range(4)], schemas.CONVERSIONS)
    for kind, df in (("clicks", clicks), ("impressions", impressions), ("conversions", conversions)):
        datasets.write_csv(df.repartition(parts), root, n, kind)


def test_fingerprints_do_not_depend_on_files(spark, folder):
    write_dataset(spark, folder, 1, parts=1)
    write_dataset(spark, folder, 2, parts=3)
    write_dataset(spark, folder, 3, shift=1)
    prints = [
        {r.kind: r.fingerprint for r in datasets.file_fingerprints(spark, folder, n).collect()} for n in (1, 2, 3)
    ]
    assert prints[0] == prints[1]
    assert prints[0]["clicks"] != prints[2]["clicks"] and prints[0]["impressions"] == prints[2]["impressions"]


def test_discovery_skips_other_folders(spark, folder):
    write_dataset(spark, folder, 10)
    write_dataset(spark, folder, 9)
    spark.createDataFrame([("x",)], "a string").write.csv(f"{folder}/old/clicks_1.csv")
    assert [r.dataset_id for r in datasets.discover(spark, folder).collect()] == [9, 10]


def test_header_is_checked(spark, folder):
    spark.createDataFrame([("1", "2", "3")], "a string, b string, c string").write.csv(
        datasets.csv_path(folder, 1, "clicks"), header=True
    )
    with pytest.raises(Exception, match="header|Header|name"):
        datasets.read_csv(spark, folder, 1, "clicks").collect()


def test_overwrite_replaces_one_dataset(spark, folder):
    perf = spark.createDataFrame([(1.0, 1, 1, 1, 1)], schemas.PERFORMANCE)
    tables.overwrite_dataset(perf, folder + "/p", 1)
    tables.overwrite_dataset(perf.withColumn("banner_id", F.lit(5)), folder + "/p", 2)
    tables.overwrite_dataset(perf.withColumn("banner_id", F.lit(7)), folder + "/p", 1)
    got = {(r.dataset_id, r.banner_id) for r in tables.scan_performance(spark, folder + "/p").collect()}
    assert got == {(1, 7), (2, 5)}
    plan = tables.scan_dataset(spark, folder + "/p", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_id" in plan


def states(spark, path):
    return [(r.order, r.state) for r in history.read_history(spark, path).orderBy("seq").collect()]


def test_batch_runs(spark, folder):
    root, perf, past = f"{folder}/csv", f"{folder}/perf", f"{folder}/history"
    ingest.create_history(spark, past)
    write_dataset(spark, root, 1)
    write_dataset(spark, root, 2, parts=2)  # the same rows
    assert ingest.ingest_next(spark, root, perf, past) == (1, "processed")
    assert ingest.ingest_next(spark, root, perf, past) == (2, "duplicate")
    assert ingest.ingest_next(spark, root, perf, past) == (None, "nothing new")
    assert ingest.ingest_dataset(spark, root, 1, perf, past) == "handled before"
    assert states(spark, past) == [(1, "processed"), (2, "duplicate")]


def test_stream_of_folders(spark, folder):
    root, perf, past, check = f"{folder}/csv", f"{folder}/perf", f"{folder}/history", f"{folder}/check"
    write_dataset(spark, root, 1)
    write_dataset(spark, root, 10, shift=5)
    write_dataset(spark, root, 2)
    assert ingest.ingest_stream(spark, root, perf, past, check).awaitTermination(120)
    assert states(spark, past) == [(1, "processed"), (2, "duplicate"), (10, "processed")]
    first = tables.scan_performance(spark, perf).count()
    write_dataset(spark, root, 11, shift=50)
    assert ingest.ingest_stream(spark, root, perf, past, check).awaitTermination(120)
    assert states(spark, past)[-1] == (11, "processed") and len(states(spark, past)) == 4
    assert tables.scan_performance(spark, perf).count() == first + 3
