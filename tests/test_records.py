"""The store of current records against a dictionary, over many batches and breaks."""

import os

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import jobs as J
from sparkdesk.streaming import records as R

SCHEMA = "k string, v long"


def batch(spark, number):
    return spark.createDataFrame([(f"k{number % 7}", number), (f"k{number % 5 + 20}", -number)], SCHEMA).coalesce(1)


def by_hand(last):
    store = {}
    for number in range(last + 1):
        store |= {f"k{number % 7}": number, f"k{number % 5 + 20}": -number}
    return store


def stored(spark, path):
    return {r.k: r.v for r in R.current(spark, path, "k").collect()}


def test_fifty_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    for number in range(50):
        R.commit(batch(spark, number), number, path, "k", every=4, buckets=3)
        if number in (4, 49):
            assert stored(spark, path) == by_hand(number)
    # Two snapshots, two pointers, twice `every` places of changes; buckets below the snapshots.
    assert len(os.listdir(path)) == 2 + 2 + 8
    assert sum(len(folders) for _, folders, _ in os.walk(path)) <= 12 + 2 * 3
    opened = {f.split("/store/")[1].split("/")[0] for f in R.current(spark, path, "k").inputFiles()}
    assert len([f for f in opened if f.startswith("snapshot")]) == 1 and len(opened) <= 1 + 4
    found = R.find(spark, path, "k", "k3")
    assert [tuple(r) for r in found.collect()] == [("k3", by_hand(49)["k3"])]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("bucket" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
    assert R.find(spark, path, "k", "nobody").isEmpty()


def test_breaks_between_snapshot_and_pointer(spark, tmp_path, monkeypatch):
    """Every step of a batch is broken off once; the batch that is run again ends as if nothing had happened."""
    path, write = str(tmp_path / "store"), R.write_pointer
    for number in range(5):
        for after_pointer in (False, True):

            def broken(*args, done=after_pointer):
                if done:
                    write(*args)
                raise OSError("lost")

            monkeypatch.setattr(R, "write_pointer", broken)
            if number and not after_pointer:
                before = stored(spark, path)
            if R.committed(spark, path) is None or R.committed(spark, path).last < number:
                with pytest.raises(OSError):
                    R.commit(batch(spark, number), number, path, "k", every=2, buckets=2)
            if number and not after_pointer:
                assert stored(spark, path) == before
        monkeypatch.setattr(R, "write_pointer", write)
        R.commit(batch(spark, number), number, path, "k", every=2, buckets=2)
        assert stored(spark, path) == by_hand(number)


def test_strange_batches_are_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(ValueError):
        R.current(spark, path, "k")
    R.commit(batch(spark, 0), 0, path, "k", owner="a")
    with pytest.raises(ValueError):
        R.commit(batch(spark, 0), 0, path, "k", owner="b")
    with pytest.raises(ValueError):
        R.commit(batch(spark, 2), 2, path, "k", owner="a")
    R.commit(batch(spark, 1).where("false"), 1, path, "k", owner="a")
    assert stored(spark, path) == by_hand(0)


LOG = "submission_id string, seq int, ts timestamp, kind string, job_name string, queue string, application_id string, launcher_state string, yarn_state string, final_status string, tracking_url string, last_error string"


def test_merge_is_the_fold_of_both(spark):
    """Records of any prefix of a log, merged with the rest, are the fold of all."""
    kinds = ["insert", "application_id", "launcher_state", "yarn_status", "last_error"]
    rows = spark.range(400).select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("submission_id"),
        F.col("id").cast("int").alias("seq"),
        F.timestamp_seconds(F.col("id") * 10).alias("ts"),
        F.element_at(F.array(*map(F.lit, kinds)), (F.pmod(F.hash("id"), F.lit(5)) + 1).cast("int")).alias("kind"),
        *[F.when(F.col("id") % 3 != i % 3, F.concat(F.lit(c), "id")).alias(c) for i, c in enumerate(LOG.replace(" string", "").split(", ")[4:])],
    )
    want = {r[0]: tuple(r) for r in J.fold(rows, F.col("seq")).collect()}
    for cut in (0, 37, 200, 399):
        kept = J.fold(rows.where(f"seq < {cut}"), F.col("seq"))
        got = {r[0]: tuple(r) for r in J.merge(kept, rows.where(f"seq >= {cut}"), F.col("seq")).collect()}
        assert got == want


def test_reports_move_the_record(spark):
    at = lambda s: f"timestamp '2024-01-01 00:00:{s:02}'"
    none = "cast(null as string)"
    records = spark.sql(f"""
        select * from values ('a', 'j', 'q', 'app_1', 'S', 'P', {none}, {none}, 'e', {at(1)}, {at(2)}), ('b', 'j', 'q', ' ', 'S', 'P', {none}, 'u', {none}, {at(1)}, {at(2)})
        as t({', '.join(J.RECORD_COLUMNS)})""")
    reports = spark.sql(f"""
        select * from values ('app_1', 'RUNNING', 'UNDEFINED', 'x', {at(5)}), ('app_1', 'FINISHED', 'KILLED', {none}, {at(9)}), (' ', 'F', 'K', 'x', {at(9)}), ('app_2', 'F', 'K', 'x', {at(9)})
        as t(application_id, yarn_state, final_status, tracking_url, reported_at)""")
    got = {r.submission_id: r for r in J.job_status(records, reports, "http://r").collect()}
    assert (got["a"].yarn_state, got["a"].tracking_url, got["a"].updated_at.second, got["a"].last_error) == ("FINISHED", None, 9, "e")
    assert (got["b"].yarn_state, got["b"].tracking_url, got["b"].updated_at.second, got["b"].router_tracking_url) == ("P", "u", 2, None)
