"""Streaming replay: results equal the batch operators; re-runs add nothing."""

import os

from helpers import D, T, rows

from histlake.operators import scd
from histlake.operators.keys import with_key_and_tenure
from histlake.session import local_path, scratch_dir
from histlake.sources.append import AppendTable
from histlake.sources.readers import read_stream
from histlake.streaming import cdc, ingest, reference

SCHEMA = "k string, seq date, v int, note string"
EVENTS = [("a", D(2025, 1, 1), 1, "x"), ("a", D(2025, 3, 1), 1, "y"), ("a", D(2025, 2, 1), 2, "late"),
          ("b", D(2025, 1, 1), 5, "p"), ("b", D(2025, 1, 1), 6, "q"), (None, D(2025, 1, 1), 1, "n"),
          ("c", D(2025, 4, 1), 3, "z"), ("c", D(2025, 5, 1), 4, "w")]


def stage_each(spark, data, path):
    """One file per row, written in the given (out-of-order) order."""
    for i, r in enumerate(data):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_scd2_equals_batch_and_replay_is_idempotent(spark):
    staging = scratch_dir(spark, "t_stage")
    stage_each(spark, EVENTS[:4], staging)
    schema = spark.createDataFrame([], SCHEMA).schema
    target, ckpt = (scratch_dir(spark, n) for n in ("t_target", "t_ckpt"))

    def run():
        return cdc.scd_stream(spark, read_stream(spark, staging, schema, max_files_per_trigger=1),
                              ["k"], "seq", target, ckpt, scd_type=2, track=["v"], tie_break=["note"])
    run()
    stage_each(spark, EVENTS[4:], staging)   # more files arrive later
    run()
    got = rows(run(), "k",  # nothing new: no change
                "v", "note", "__START_AT", "__END_AT")
    expect = rows(scd.scd2(spark.createDataFrame(EVENTS, SCHEMA), ["k"], "seq", track=["v"],
                           tie_break=["note"]), "k", "v", "note", "__START_AT", "__END_AT")
    assert got == expect


def test_stream_scd1_equals_batch(spark):
    staging = scratch_dir(spark, "t_stage")
    stage_each(spark, list(reversed(EVENTS)), staging)
    schema = spark.createDataFrame([], SCHEMA).schema
    got = rows(cdc.scd_stream(spark, read_stream(spark, staging, schema, max_files_per_trigger=2),
                              ["k"], "seq", scratch_dir(spark, "t"), scratch_dir(spark, "c"), scd_type=1, tie_break=["note"]))
    expect = rows(scd.scd1(spark.createDataFrame(EVENTS, SCHEMA), ["k"], "seq", tie_break=["note"]))
    assert got == expect


def test_ingest_rerun_adds_nothing(spark):
    from histlake.schemas import STAGING_SCHEMA
    staging = scratch_dir(spark, "t_stage")
    row = tuple({"cedula": "1-2", "nombre": "A", "fecha_consulta": T(2025, 1, 1)}.get(f.name)
                for f in STAGING_SCHEMA.fields)
    spark.createDataFrame([row, row], STAGING_SCHEMA).write.parquet(staging)
    sink, ck = scratch_dir(spark, "t_sink"), scratch_dir(spark, "t_ck")
    ingest.ingest_stream(spark, staging, STAGING_SCHEMA, sink, ck, transform=with_key_and_tenure)
    ingest.ingest_stream(spark, staging, STAGING_SCHEMA, sink, ck, transform=with_key_and_tenure)
    out = AppendTable(spark, sink).read()
    assert out.count() == 2 and rows(out, "composite_key")[0] == ("A-12",)


def test_new_keys_and_grouped_max_streams(spark):
    schema = "position_name_spanish string, last_seen_at timestamp"
    staging = scratch_dir(spark, "t_stage")
    for r in [("ANALISTA", T(2025, 1, 1)), ("JEFE", T(2025, 1, 2)), ("ANALISTA", T(2025, 1, 3)),
              (None, T(2025, 1, 4))]:
        spark.createDataFrame([r], schema).write.mode("append").parquet(staging)
    st = spark.createDataFrame([], schema).schema
    tgt = scratch_dir(spark, "t_pos")
    reference.new_keys_stream(spark, read_stream(spark, staging, st, max_files_per_trigger=1),
                              "position_name_spanish", "last_seen_at", tgt, scratch_dir(spark, "ck"))
    assert rows(spark.read.parquet(tgt), "position_name_spanish") == [("ANALISTA",), ("JEFE",)]

    log_schema = "status_name_spanish string, run_status string, source_update timestamp, checked_at timestamp"
    lstage = scratch_dir(spark, "t_log")
    for r in [("P", "OK", T(2025, 1, 1), T(2025, 1, 2)), ("P", "FAIL", T(2025, 2, 1), T(2025, 2, 2)),
              ("P", "OK", T(2025, 1, 5), T(2025, 1, 6)), ("E", "OK", T(2024, 1, 1), T(2024, 1, 1))]:
        spark.createDataFrame([r], log_schema).write.mode("append").parquet(lstage)
    lst = spark.createDataFrame([], log_schema).schema
    out = reference.grouped_max_stream(read_stream(spark, lstage, lst, max_files_per_trigger=1),
                                       "status_name_spanish", scratch_dir(spark, "t_ref"),
                                       scratch_dir(spark, "ck"))
    assert rows(spark.read.parquet(out)) == [("E", T(2024, 1, 1), T(2024, 1, 1)),
                                             ("P", T(2025, 1, 5), T(2025, 1, 6))]


def test_distinct_stream(spark):
    schema = "position_name_spanish string, last_seen_at timestamp"
    staging = scratch_dir(spark, "t_stage")
    spark.createDataFrame([("A", T(2025, 1, 1)), ("A", T(2025, 1, 2)), ("B", T(2025, 1, 1)),
                           (None, T(2025, 1, 1))], schema).write.parquet(staging)
    st = spark.createDataFrame([], schema).schema
    out = reference.distinct_stream(spark, read_stream(spark, staging, st), "position_name_spanish",
                                    scratch_dir(spark, "t_d"), scratch_dir(spark, "ck"))
    assert rows(spark.read.parquet(out), "position_name_spanish") == [("A",), ("B",)]


def test_bronze_keeps_few_folders_and_every_row_once(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "b"), ["inst", "day"])
    make = lambda i: spark.createDataFrame([(f"i{(7 * i + k) % 5}", D(2025, 1, 1 + (i + k) % 28), i) for k in range(10)], "inst string, day date, n int").coalesce(1)
    most = 0
    for i in range(50):
        table.append(make(i), "s", i)
        if i % 9 == 0:
            table.append(make(i), "s", i)  # a replay
        most = max(most, len(table.log.state()["folders"]))
    out = table.read()
    assert out.count() == 500 and out.groupBy("n").count().where("count != 10").isEmpty()
    assert most <= 3 * 5  # under FAN of a size class, classes up to 4^4 batches' rows
    files = len(out.inputFiles())
    table.vacuum(keep=1)
    assert table.read().count() == 500 and len(list((tmp_path / "b" / "data").iterdir())) == len(table.log.state()["folders"])
    assert files <= 2 * most


def test_distinct_stream_keeps_no_state(spark):
    staging, target, checkpoint = (scratch_dir(spark, n) for n in ("d_stage", "d_target", "d_ckpt"))
    for i in range(20):
        spark.createDataFrame([(f"k{i}",), (f"k{i // 2}",), (None,)], "k string").coalesce(1).write.mode("append").parquet(staging)
    schema = spark.createDataFrame([], "k string").schema
    for _ in range(2):
        reference.distinct_stream(spark, read_stream(spark, staging, schema, max_files_per_trigger=1), "k", target, checkpoint)
    assert rows(spark.read.parquet(target), "k") == sorted((f"k{i}",) for i in range(20))
    assert not os.path.exists(f"{local_path(checkpoint)}/state")


def test_a_staged_file_is_read_by_several_tasks(spark):
    """Its rows lie in row groups of their own: not all of them in one."""
    import glob

    import pyarrow.parquet as pq
    df = spark.range(900_000).selectExpr("id", "uuid() AS a", "rand(1) AS x")
    path = ingest.stage_files(df, scratch_dir(spark, "t_groups"), 2)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{local_path(path)}/*.parquet")]
    assert len(files) == 2 and sum(m.num_rows for m in files) == 900_000
    assert min(m.num_row_groups for m in files) >= 3
    assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) < 300_000
