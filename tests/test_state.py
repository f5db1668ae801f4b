"""Streams with state, over restarts: every arrival is a new query on the old checkpoint."""

import time

import pytest

from tidewright.operators import keyed
from tidewright.streaming import state


class Source:
    def __init__(self, spark, folder, form, make, mode="update", expires=False):
        self.spark, self.folder, self.form, self.make, self.mode, self.expires = spark, folder, form, make, mode, expires

    def arrive(self, *rows):
        got = []
        before = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", "2")  # as many state stores
        self.spark.createDataFrame(rows, self.form).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(self.form).parquet(f"{self.folder}/in")
        state.start(self.make(stream), f"{self.folder}/checkpoint", lambda df, _: got.extend(map(tuple, df.collect())), self.mode, self.expires).awaitTermination()
        self.spark.conf.set("spark.sql.shuffle.partitions", before)
        return sorted(got, key=str)


POLICY = {"v": keyed.MERGE, "tag": keyed.STRICTER, "first": keyed.KEEP}
FORM = "k string, n long, at timestamp, v double, tag string, first long"


def day(k):
    from datetime import datetime

    return None if k is None else datetime(2024, 1, k)


def test_corrections_out_of_order_and_over_restarts(spark, tmp_path):
    source = Source(spark, str(tmp_path), FORM, lambda s: state.corrected(s, ["k"], ["n"], "at", POLICY))
    assert source.arrive(("a", 1, day(2), 1.0, "personal-only", 1), ("a", 2, day(1), 9.0, "commercial-ok", 2), ("b", 3, None, None, None, 3)) == [("a", 1, day(2), 1.0, "personal-only", 1), ("b", 3, None, None, None, 3)]
    # a late row of another batch is stale too; one of the same time is taken, and what it doesn't carry stays
    assert source.arrive(("a", 4, day(1), 7.0, "commercial-ok", 4)) == []
    assert source.arrive(("a", 5, day(2), None, "commercial-ok", 5), ("b", 6, day(1), 2.0, "factual-cite", 6)) == [("a", 5, day(2), 1.0, "personal-only", 1), ("b", 6, day(1), 2.0, None, 3)]
    assert source.arrive(("a", 7, None, 5.0, None, 7)) == []


@pytest.mark.parametrize("seconds", [3, 9000])
def test_what_is_not_written_for_long_is_forgotten(spark, tmp_path, seconds):
    source = Source(spark, str(tmp_path), FORM, lambda s: state.corrected(s, ["k"], ["n"], "at", POLICY, seconds / 86400), expires=True)
    source.arrive(("a", 1, day(9), 1.0, "personal-only", 1))
    time.sleep(4)
    assert source.arrive(("a", 2, day(1), 2.0, "commercial-ok", 2)) == ([("a", 2, day(1), 2.0, "commercial-ok", 2)] if seconds == 3 else [])


@pytest.mark.parametrize("seconds", [3, 9000])
def test_keys_seen_within_the_retention(spark, tmp_path, seconds):
    source = Source(spark, str(tmp_path), "k string, v long", lambda s: state.seen_once(s, ["k"], seconds / 86400), "append", True)
    assert source.arrive(("a", 1), ("b", 1)) == [("a", 1), ("b", 1)]
    time.sleep(4)
    assert source.arrive(("a", 2), ("c", 2)) == ([("a", 2), ("c", 2)] if seconds == 3 else [("c", 2)])


def test_runs_within_retention_and_look_back(spark, tmp_path):
    source = Source(spark, str(tmp_path), "job string, at long, n long", lambda s: state.recent_runs(s, "job", "at", "n"))
    d = 86400
    assert source.arrive(("a", 0, 5), ("a", 80 * d, 0), ("a", 80 * d, 2), ("b", None, 1)) == [("a", 80 * d, 3, 2, 1)]
    assert source.arrive(("a", 91 * d, 0)) == [("a", 91 * d, 3, 3, 2)]
    assert source.arrive(("a", 200 * d, 1), ("b", d, 0)) == [("a", 200 * d, 1, 1, 0), ("b", d, 1, 1, 1)]
