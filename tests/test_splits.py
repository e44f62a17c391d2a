"""The layer jobs keep all cores busy: fine scan tasks, and feeds that run side by side."""

import threading

import pytest

from strata import session
from strata.plans import catalogue, jobs
from strata.plans import purchase_order as po
from strata.session import SPLIT_KEY, fine_splits
from strata.sources.batches import committed_files
from strata.sources import feeds
from strata.sources.topic import Topic, produce
from strata.storage import data_files

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def one_task_scans(spark):
    """Spark's own sizes, set so that it packs all files of a folder in one task."""
    keys = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def test_bronze_job_cuts_its_scan_by_split_bytes(spark, tmp_dir, one_task_scans, monkeypatch):
    topic = Topic("t", path=f"{tmp_dir}/topic")
    produce(po.messages(po.documents(spark, SMALL)).repartition(6), topic)
    sizes = [f["bytes"] for f in data_files(spark, topic.path)]
    assert len(sizes) == 6
    monkeypatch.setattr(session, "SPLIT_BYTES", max(sizes) + 1)
    jobs.po_bronze(spark, topic, f"{tmp_dir}/data", f"{tmp_dir}/_checkpoint", "availableNow")
    assert len(committed_files(spark, f"{tmp_dir}/data")) == 6  # one task per 6 files before
    assert SPLIT_KEY not in spark.conf.getAll


def test_topics_are_produced_with_fine_scans(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(feeds, "_TOPICS", {})
    monkeypatch.setattr(feeds, "produce", lambda messages, topic: seen.append(spark.conf.get(SPLIT_KEY)))
    feeds.po_topic(spark, SMALL)
    feeds.plain_topic(spark, SMALL)
    assert seen == [str(session.SPLIT_BYTES)] * 2


def test_split_size_is_taken_back_by_the_last_one_out(spark):
    with fine_splits(spark):
        with fine_splits(spark):
            assert spark.conf.get(SPLIT_KEY) == str(session.SPLIT_BYTES)
        assert spark.conf.get(SPLIT_KEY) == str(session.SPLIT_BYTES)
    assert SPLIT_KEY not in spark.conf.getAll


def test_a_given_split_size_stays(spark):
    spark.conf.set(SPLIT_KEY, "7m")
    try:
        with fine_splits(spark):
            assert spark.conf.get(SPLIT_KEY) == "7m"
        assert spark.conf.get(SPLIT_KEY) == "7m"
    finally:
        spark.conf.unset(SPLIT_KEY)


def test_gold_rejects_runs_both_feeds_at_once(spark, monkeypatch):
    both = threading.Barrier(2, timeout=90)

    def meeting(job):
        def run(*args, **kwargs):
            both.wait()  # breaks if the other feed only starts after this one
            return job(*args, **kwargs)

        return run

    monkeypatch.setattr(jobs, "plain_silver", meeting(jobs.plain_silver))
    monkeypatch.setattr(jobs, "po_silver", meeting(jobs.po_silver))
    rows = catalogue.gold_rejects(spark, SMALL).collect()
    assert sorted(r.job for r in rows) == ["plain", "po"]


def test_items_are_made_once_per_line(spark):
    plan = po.documents(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
