"""Registered queries: contract, expected results at the smallest scale, plans."""

from pathlib import Path

import pytest
import __spark_entry__ as contract
import check
from bannerloom.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
# covered by tests of their own and by check.py
SLOW = {"stream_ingest", "stream_serve", "seen_state_stream", "change_feed_resume", "tail_append"}
COMPARED = sorted(set(contract.oracle_sql()) - SLOW)

needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


def test_every_expected_result_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@needs_data
def test_flagship(spark):
    assert contract.entry(spark).count() == 152


@needs_data
@pytest.mark.parametrize("name", COMPARED)
def test_result_and_plan(spark, con, name):
    assert check.compare(spark, con, name, SF_DIR) == "ok"


@needs_data
@pytest.mark.parametrize("name", ["serve_with_backfill", "backfill_candidates", "bulk_ordered", "sort_multi", "dereference"])
def test_no_pairing_of_tables(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scratch_is_in_the_shared_folder():
    class Session:  # the setting can only be given when a session starts
        conf = {"spark.checkpoint.dir": "hdfs:///shared/"}

    assert scratch_dir(Session, "x").startswith("hdfs:///shared/x-")
    assert scratch_dir(Session, "x") != scratch_dir(Session, "x")
