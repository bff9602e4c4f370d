"""SCD2 by interval merge, and the table of upserts below it."""

import datetime as dt
import random
import re

import pytest
from helpers import D, rows
from pyspark.sql import functions as F

from histlake.operators.scd import scd2
from histlake.session import scratch_dir
from histlake.sources.keyed import GONE, KeyedTable
from histlake.streaming.history import History

SCHEMA = "k string, seq date, v int, note string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def batch_result(spark, data):
    return rows(scd2(frame(spark, data), ["k"], "seq", track=["v"], tie_break=["note", "v"]))


def history(spark, **kw):
    return History(spark, scratch_dir(spark, "hist"), ["k"], "seq", track=["v"], tie_break=["note", "v"], **kw)


def written(h):
    """Rows of the last commit."""
    return h.table.log.state()["folders"][-1]["rows"]


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_batches_equals_the_batch_operator(spark, seed):
    """Late rows, ties on (key, sequence), null keys and values, repeated rows."""
    r = random.Random(seed)
    data = [(r.choice(["a", "b", "c", None]), D(2025, 1, 1) + dt.timedelta(days=r.randrange(25)), r.choice([1, 2, None]), r.choice("xyz"))
            for _ in range(60)]
    h = history(spark)
    for epoch in range(4):
        h.apply(frame(spark, data[epoch * 15:(epoch + 1) * 15]), "s", epoch)
        assert rows(h.read()) == batch_result(spark, data[:(epoch + 1) * 15]), epoch
    assert rows(h.current()) == rows(h.read().where("__END_AT IS NULL"))
    h.table.compact(force=True)
    assert rows(h.read()) == batch_result(spark, data)
    assert rows(h.current()) == rows(h.read().where("__END_AT IS NULL"))


def test_late_row_splits_a_closed_version(spark):
    h = history(spark)
    h.apply(frame(spark, [("a", D(2025, 1, 1), 1, "x"), ("a", D(2025, 1, 9), 1, "y"), ("a", D(2025, 2, 1), 2, "z")]))
    h.apply(frame(spark, [("a", D(2025, 1, 5), 7, "late")]))
    assert rows(h.read(), "seq", "v", "__START_AT", "__END_AT") == sorted([
        (D(2025, 1, 1), 1, D(2025, 1, 1), D(2025, 1, 5)), (D(2025, 1, 5), 7, D(2025, 1, 5), D(2025, 1, 9)),
        (D(2025, 1, 9), 1, D(2025, 1, 9), D(2025, 2, 1)), (D(2025, 2, 1), 2, D(2025, 2, 1), None)], key=str)


def test_a_late_tie_can_join_two_versions(spark):
    first = [("a", D(2025, 1, 1), 1, "x"), ("a", D(2025, 1, 2), 2, "x"), ("a", D(2025, 1, 3), 1, "x")]
    h = history(spark)
    h.apply(frame(spark, first))
    h.apply(frame(spark, [("a", D(2025, 1, 2), 1, "y")]))  # the larger tie-break wins
    assert rows(h.read()) == batch_result(spark, [*first, ("a", D(2025, 1, 2), 1, "y")])
    assert h.read().count() == 1


def test_an_in_order_batch_writes_what_it_touches(spark):
    """One key of a hundred gets a new row: two versions are written, and neither the
    rows nor the closed versions of other keys are read."""
    h = history(spark)
    days = [D(2025, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    h.apply(frame(spark, [(f"k{i}", d, n, "x") for i in range(100) for n, d in enumerate(days)]))
    assert written(h) == 2000
    h.apply(frame(spark, [("k7", D(2025, 3, 1), 99, "new")]))
    assert written(h) == 2
    h.apply(frame(spark, [("k8", D(2025, 3, 1), 19, "same")]))
    assert written(h) == 1                                   # the open version, extended
    h.apply(frame(spark, [("k9", D(2025, 1, 10), 9, "x")]))  # a repeated row changes nothing
    assert len(h.table.log.state()["folders"]) == 3
    h.apply(frame(spark, [("k9", D(2025, 1, 10), 9, "a")]))  # loses the tie
    h.apply(frame(spark, [("k5", D(2025, 2, 27), 50, "x"), ("k5", D(2025, 1, 19), 77, "z")]))
    assert written(h) == 3                                   # 77 instead of 18, the open version closed, 50


def test_open_versions_are_read_without_the_closed_ones(spark):
    h = history(spark)
    h.apply(frame(spark, [("a", D(2025, 1, d), d, "x") for d in range(1, 9)]))
    plan = h.current()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_part", plan)
    assert h.current().count() == 1


def test_replay_and_failure_leave_the_table(spark, monkeypatch):
    h = history(spark)
    h.apply(frame(spark, [("a", D(2025, 1, 1), 1, "x")]), "s", 0)
    before = rows(h.read())
    h.apply(frame(spark, [("a", D(2025, 1, 1), 1, "x")]), "s", 0)
    assert rows(h.read()) == before and h.table.log.state()["n"] == 1

    def fail(state):
        raise OSError("lost")

    monkeypatch.setattr(h.table.log, "commit", fail)        # all files are written, the commit is not
    with pytest.raises(OSError):
        h.apply(frame(spark, [("a", D(2025, 2, 1), 2, "y")]), "s", 1)
    monkeypatch.undo()
    assert rows(h.read()) == before
    h.apply(frame(spark, [("a", D(2025, 2, 1), 2, "y")]), "s", 1)
    assert rows(h.read()) == batch_result(spark, [("a", D(2025, 1, 1), 1, "x"), ("a", D(2025, 2, 1), 2, "y")])
    assert rows(h.read(1)) == before                          # an earlier state is still there


def test_empty_batches_and_null_sequences(spark):
    h = history(spark)
    h.apply(frame(spark, []), "s", 0)
    assert h.read().count() == 0
    h.apply(frame(spark, [("a", None, 1, "x"), ("b", D(2025, 1, 1), 1, "x")]), "s", 1)
    h.apply(frame(spark, []), "s", 2)
    h.apply(frame(spark, [("a", None, 1, "x")]), "s", 3)
    assert rows(h.read(), "k") == [("b",)]


def test_keyed_table_upserts_removes_folds_and_forgets(spark):
    t = KeyedTable(spark, scratch_dir(spark, "kt"), ["a", "b"])
    make = lambda data: spark.createDataFrame(data, "a int, b string, x double")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.upsert(make([(i, None if i % 3 else "p", float(i)) for i in range(200)]))
    t.upsert(make([(1, None, -1.0), (3, "p", -3.0), (500, "q", 5.0)]))
    t.upsert(make([(2, None, 0.0), (500, "q", 0.0)]).withColumn(GONE, F.lit(True)))
    want = {(i, None if i % 3 else "p"): float(i) for i in range(200)} | {(1, None): -1.0, (3, "p"): -3.0}
    del want[(2, None)]
    got = lambda: {(r.a, r.b): r.x for r in t.read().collect()}
    assert got() == want and len(t.log.state()["folders"]) == 3
    assert not t.compact()                                    # the deltas are small
    assert t.compact(force=True) and got() == want and len(t.log.state()["folders"]) == 1
    t.upsert(make([(1000 + i, "z", 0.0) for i in range(100)]))
    assert t.compact() and len(t.log.state()["folders"]) == 1  # they are not
    t.vacuum(keep=1)
    assert len(got()) == len(want) + 100
    t.upsert(make([(7, None, 7.5)]), "s", 0)
    t.upsert(make([(7, None, 8.5)]), "s", 0)                  # a replay
    assert got()[(7, None)] == 7.5


def test_small_row_folders_are_merged(spark, monkeypatch):
    from histlake.streaming import history as module
    monkeypatch.setattr(module, "ROW_FOLDERS", 2)
    h = history(spark)
    data = [("a", D(2025, 1, 1) + dt.timedelta(days=i), i % 2, "x") for i in range(6)]
    for d in data:
        h.apply(frame(spark, [d]))
    assert len(h.table.log.state()["extra"]["rows"]) <= 4
    h.apply(frame(spark, [("a", D(2025, 1, 3), 9, "z")]))      # late: all stored rows are still found
    assert rows(h.read()) == batch_result(spark, [*data, ("a", D(2025, 1, 3), 9, "z")])


def test_intermediate_rows_lie_in_few_partitions(spark, monkeypatch):
    """However many partitions a shuffle has, a small batch's kept rows are in two a core at most."""
    kept, keep = [], History._keep
    monkeypatch.setattr(History, "_keep", lambda h, *a: kept.append(keep(h, *a)) or kept[-1])
    before, most = spark.conf.get("spark.sql.shuffle.partitions"), 2 * spark.sparkContext.defaultParallelism
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    data = [("a", D(2025, 1, 1), 1, "x"), ("b", D(2025, 1, 5), 1, "x"), ("a", D(2025, 1, 9), 2, "y"), ("b", D(2025, 1, 2), 3, "z")]
    h = history(spark)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", most + 7)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for some in (data[:2], data[2:]):
            h.apply(frame(spark, some))
        parts = [df._jdf.queryExecution().executedPlan().execute().getNumPartitions() for df in kept]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(parts) == 4 and max(parts) <= most
    assert rows(h.read()) == batch_result(spark, data)
