"""Plan-shape checks: the physical plans we want at scale."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from histlake.plans import analogs as A
from histlake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@contextmanager
def jobs(spark):
    """Gives a function that tells how many jobs ran inside."""
    import uuid
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "counted")
    try:
        yield lambda: len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_broadcasts_dimensions_and_never_shuffles_fact(spark):
    p = plan(A.snapshot(spark, SF))
    assert p.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in p


def test_filters_and_projection_reach_the_scan(spark):
    df = QUERIES["log_recent"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_no_cartesian_products_anywhere(spark):
    for name in ["work_list", "profile_histogram", "status_distribution", "log_last_run"]:
        p = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_last_run_is_aggregate_join_not_window(spark):
    p = plan(QUERIES["log_last_run"](spark, SF))
    assert "Window" not in p and "BroadcastHashJoin" in p


def test_group_summary_partial_aggregation(spark):
    p = plan(QUERIES["group_summary"](spark, SF))
    assert "partial_sum" in p or "partial_" in p


def test_plain_scd2_single_exchange(spark):
    h = A.orders_history(spark, SF, change_type_col="change_type")
    p = plan(h)
    assert p.count("Exchange hashpartitioning") == 1, p


def test_scd1_is_partial_aggregate(spark):
    p = plan(QUERIES["scd1_latest_log"](spark, SF))
    assert "partial_max_by" in p and "Window" not in p


def test_scd2_over_bucketed_bronze_needs_no_exchange(spark):
    from helpers import rows

    from histlake.operators import scd
    from histlake.sources import write_bucketed
    orders = A.table(spark, SF, "orders")
    write_bucketed(orders, "histlake_orders_bucketed", A.ORDERS_KEYS, 8,
                   sort_by=A.ORDERS_KEYS + ["o_orderdate"])
    bucketed = spark.read.table("histlake_orders_bucketed")
    kw = dict(track=["o_orderstatus"], tie_break=["o_orderkey"], hot_key_rows=None)
    h = scd.scd2(bucketed, A.ORDERS_KEYS, "o_orderdate", partitioned_by_keys=True, **kw)
    p = plan(h)
    assert "Exchange" not in p, p
    assert rows(h) == rows(scd.scd2(orders, A.ORDERS_KEYS, "o_orderdate", **kw))


def test_snapshot_prunes_partitions_at_run_time(spark):
    """On bronze stored by snapshot date, the dates of the broadcast dimensions
    prune its partitions; no job runs while the plan is built."""
    from histlake.operators.snapshot import latest_snapshot
    from histlake.session import scratch_dir
    from histlake.sources.writers import write_clustered
    from histlake.operators.reference import reference_names
    path = write_clustered(A.bronze(spark, SF), scratch_dir(spark, "bronze"), cluster_by=["cedula"],
                           partition_by=["fecha_consulta"])
    stored = spark.read.schema(A.bronze(spark, SF).schema).parquet(path)
    A.paylog(spark, SF).write.parquet(kept := scratch_dir(spark, "paylog"))
    log = spark.read.parquet(kept)
    words = A.dictionary(spark, A.SEGMENT_DICTIONARY)
    inst = reference_names(log, "institution_name_spanish", "institution_name_english", words)
    stat = reference_names(log, "status_name_spanish", "status_name_english", words)
    pos = A.reference_tables(spark, SF)[2]
    with jobs(spark) as ran:
        snap = latest_snapshot(stored, inst, stat, pos, dimension_rows=100)
    assert ran() == 0
    assert "dynamicpruning" in snap._jdf.queryExecution().executedPlan().toString()
    assert snap.count() == A.snapshot(spark, SF).count()


def test_no_job_while_plans_are_built(spark):
    from histlake.operators import audit
    from histlake.operators.snapshot import per_group_latest
    log, bronze = A.log(spark, SF), A.bronze(spark, SF)
    with jobs(spark) as ran:
        audit.last_run(log)
        per_group_latest(bronze)
        audit.work_list(log.select(audit.INST), log.select(audit.STAT), log, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert ran() == 0


def test_broadcast_only_within_the_bound(spark):
    """Over the bound there is no hint, and (with Spark's own size-based
    broadcast switched off) the join is a shuffle join; within it, a
    broadcast hash join."""
    from histlake.operators.joins import broadcast_if_small
    big = spark.range(1000).withColumnRenamed("id", "k")
    facts = spark.range(5000).withColumn("k", F.col("id") % 1000)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for kw in (dict(known_rows=1000, max_rows=100), dict()):
            p = plan(facts.join(broadcast_if_small(big, **kw), "k"))
            assert "BroadcastHashJoin" not in p and ("SortMergeJoin" in p or "ShuffledHashJoin" in p)
        assert "BroadcastHashJoin" in plan(facts.join(broadcast_if_small(big, known_rows=1000), "k"))
    finally:
        spark.conf.set(key, old)


def test_point_lookup_on_stored_history_is_pushed_down(spark):
    from histlake.operators import scd
    from histlake.session import scratch_dir
    path = scratch_dir(spark, "hist")
    A.orders_history(spark, SF).write.parquet(path)
    h = scd.key_history(spark.read.parquet(path), F.col("o_custkey") == 7, "2030-01-01",
                        ["o_custkey", "o_orderpriority", "o_orderstatus"])
    formatted = spark._jvm.PythonSQLUtils.explainString(h._jdf.queryExecution(), "formatted")
    assert any("EqualTo(o_custkey,7)" in line for line in formatted.split("\n")
               if line.startswith("PushedFilters"))
