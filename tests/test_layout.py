"""Layout, replacement and catalog tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from histlake.operators import reference
from histlake.operators.audit import create_last_run_view, last_run
from histlake.sources import readers, writers
from histlake.streaming.ingest import run_to_completion
from histlake.streaming.reference import new_keys_stream


def test_a_hot_value_spreads_and_files_stay_ordered(spark, tmp_path):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("v"))
    sizes = [len(p) for p in writers.cluster(df, ["v"], 8).rdd.glom().collect()]
    assert len([n for n in sizes if n]) == 8 and max(sizes) < 2 * sum(sizes) / 8
    path = writers.write_clustered(df.withColumn("p", F.col("id") % 3), str(tmp_path / "t"), ["v"], partition_by=["p"], partitions=4)
    for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect():
        values = [x.v for x in spark.read.parquet(r.f).collect()]
        assert values == sorted(values)


def test_failed_replace_keeps_the_table_and_comments_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.materialize(spark.range(3), path, table="layout_t", comment="it's a table")
    bad = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.materialize(bad, path)
    assert spark.read.parquet(path).count() == 3
    writers.materialize(spark.range(4), path, table="layout_t", comment="it's a table")
    assert spark.read.table("layout_t").count() == 4 and not (tmp_path / "t.old").exists()
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED layout_t").collect()}
    assert told["Comment"] == "it's a table"
    with pytest.raises(ValueError):
        writers.materialize(spark.range(1), path, comment="nowhere to keep it")
    spark.sql("DROP TABLE layout_t")


def test_declared_table_defaults_not_null_and_stream(spark, tmp_path):
    schema = StructType([StructField("k", LongType(), False), StructField("note", StringType()), StructField("at", TimestampType())])
    name = writers.define_table(spark, "layout_declared", schema, {"at": "current_timestamp()", "note": "'none'"}, path=str(tmp_path / "t"), comment="a 'log'")
    spark.sql(f"INSERT INTO {name} (k) VALUES (1)")
    first = spark.read.table(name).first()
    assert (first.k, first.note) == (1, "none") and first["at"] is not None

    def stream():
        run_to_completion(readers.read_stream_table(spark, name).writeStream.format("parquet").option("path", str(tmp_path / "out"))
                          .option("checkpointLocation", str(tmp_path / "c")))
        return spark.read.schema(schema).parquet(str(tmp_path / "out")).count()

    assert stream() == 1
    spark.sql(f"INSERT INTO {name} VALUES (2, 'x', NULL)")
    assert stream() == 2 and stream() == 2
    with pytest.raises(Exception, match="k is NOT NULL"):
        writers.append_typed(spark.createDataFrame([(None, "x")], "k long, note string"), str(tmp_path / "u"), schema)
    spark.sql(f"DROP TABLE {name}")


def test_view_shows_later_rows_and_equals_the_operator(spark, tmp_path):
    cols = "institution_name_spanish string, status_name_spanish string, run_status string, checked_at timestamp"
    row = lambda i, s, r, day: f"SELECT {i} AS institution_name_spanish, {s} AS status_name_spanish, '{r}' AS run_status, TIMESTAMP '2024-01-0{day}' AS checked_at"
    spark.sql(" UNION ALL ".join([row("'a'", "'x'", "OK", 1), row("'a'", "'x'", "FAIL", 2), row("NULL", "'x'", "OK", 1)])) \
        .to(spark.createDataFrame([], cols).schema).write.option("path", str(tmp_path / "log")).saveAsTable("layout_log")
    view = create_last_run_view(spark, "layout_log", "layout_last_run")
    assert sorted(r.run_status for r in spark.read.table(view).collect()) == ["FAIL", "OK"]
    spark.sql("INSERT INTO layout_log " + row("'a'", "'x'", "OK", 5))
    seen = sorted(map(str, spark.read.table(view).collect()))
    assert seen == sorted(map(str, last_run(spark.read.table("layout_log")).collect())) and len(seen) == 2
    assert spark.read.table(view).filter("report = 'a - x'").first().OK == 1
    spark.sql(f"DROP VIEW {view}")
    spark.sql("DROP TABLE layout_log")


def test_known_keys_are_not_enriched_again(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def enrich(keys):
        def count(batches):
            for b in batches:
                calls.add(b.num_rows)
                yield b
        return keys.mapInArrow(count, keys.schema)

    src = str(tmp_path / "src")
    for names in (["a", "b", "c"], ["a", "b", "c", "d"], ["a", "d"]):
        spark.createDataFrame([(n, 1) for n in names], "name string, seen long").write.mode("append").parquet(src)
        new_keys_stream(spark, readers.read_stream(spark, src, spark.read.parquet(src).schema), "name", "seen", str(tmp_path / "t"),
                        str(tmp_path / "c"), enrich=enrich)
    assert calls.value == 4 and spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_translated_names_do_not_move_the_rows(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = reference.translate_distinct(spark.range(100).withColumn("n", (F.col("id") % 3).cast("string")), "n", lambda s: s + "!", "out")
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in p and "hashpartitioning" not in p
        assert df.filter("out = concat(n, '!')").count() == 100
    finally:
        spark.conf.set(key, old)


def test_html_references(spark):
    from histlake.functions.text import unescape_html
    text = "&lt;&#243;&#xF3;&#XF1;&oacute;&amp;lt;&#128512;&#0;&#xD800;&#1114112;&unknown;"
    assert spark.range(1).select(unescape_html(F.lit(text)).alias("t")).first().t == "<óóñó&lt;😀���&unknown;"
