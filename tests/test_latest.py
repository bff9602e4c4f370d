"""SCD1 from keyed state."""

import random

from helpers import D, rows
from pyspark.sql import functions as F

from histlake.operators.scd import scd1
from histlake.session import scratch_dir
from histlake.sources.readers import read_stream
from histlake.streaming.latest import _PROVIDER, LatestRow, combined, latest_stream, rank

SCHEMA = "k string, j int, seq date, v double, note string"


def data(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.choice([1, None]), r.choice([D(2025, 1, d) for d in range(1, 9)] + [None]),
             r.choice([1.0, None, float("nan"), -2.0]), r.choice(["x", "y", None])) for _ in range(n)]


def test_equals_the_batch_operator_across_restarts(spark):
    staging, target, checkpoint = (scratch_dir(spark, n) for n in ("l_stage", "l_target", "l_ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema
    arrived = []
    before = spark.conf.get(_PROVIDER)

    def run(rows_):
        arrived.extend(rows_)
        spark.createDataFrame(rows_, SCHEMA).repartition(2).write.mode("append").parquet(staging)
        return latest_stream(spark, read_stream(spark, staging, schema, max_files_per_trigger=1), ["k", "j"], "seq", target, checkpoint)

    for part in (data(30, 1), data(30, 2), data(5, 3)):       # each a run of its own over the same checkpoint
        got = run(part)
        assert rows(got) == rows(scd1(spark.createDataFrame(arrived, SCHEMA), ["k", "j"], "seq"))
    state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    keys = {(r[0], r[1]) for r in arrived if r[2]}
    assert state.count() == len(keys)                          # one row a key
    assert spark.conf.get(_PROVIDER) == before


def test_ranks_order_as_spark_does(spark):
    values = [1.0, None, float("nan"), -5.0, 0.0, float("inf")]
    ordered = [r.v for r in spark.createDataFrame([(v,) for v in values], "v double").orderBy(F.col("v")).collect()]
    assert str(sorted(values, key=rank)) == str(ordered)


def test_equal_keys_shrink_across_arrow_batches(spark):
    """The largest row of each key of a whole partition, not of ten rows of it; also by columns that Arrow does not sort by."""
    made = spark.createDataFrame(data(300, 4), SCHEMA).where("seq is not null").coalesce(1)
    nested = made.withColumn("s", F.struct("v", "note"))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "10")
        for df, order in ((made, ["seq", "v", "note"]), (nested, ["seq", "s"])):
            got = rows(combined(df, ["k", "j"], order))
            assert str(got) == str(rows(scd1(df, ["k", "j"], "seq", order[1:])))  # NaN is not equal to itself
    finally:
        spark.conf.set(size, before)


def test_a_key_costs_one_read_of_the_state(spark):
    """Keys of a group share its map: no call a key but one read, and a write if it changes."""
    calls = []

    class Map:
        def __init__(self):
            self.rows = {}

        def getValue(self, key):
            calls.append("read")
            return self.rows.get(key)

        def updateValue(self, key, row):
            calls.append("write")
            self.rows[key] = row

    class Handle:
        def getMapState(self, name, key_schema, schema):
            return Map()

    made = LatestRow(spark.createDataFrame([], "k double, seq int").schema, ["k"], ["seq"])
    made.init(Handle())
    give = lambda *some: sorted((tuple(r) for r in made.handleInputRows((0,), iter(some), None)), key=str)
    assert give((0.0, 1, 3), (1.0, 1, 3), (-0.0, 2, 3), (None, 5, 3)) == [(-0.0, 2), (1.0, 1), (None, 5)]
    assert sorted(calls) == ["read"] * 3 + ["write"] * 3
    calls.clear()
    assert give((0.0, 1, 3), (1.0, 7, 3)) == [(1.0, 7)]
    assert sorted(calls) == ["read"] * 2 + ["write"]
