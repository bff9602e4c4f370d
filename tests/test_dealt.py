import datetime as dt

from pyspark.sql import functions as F

from histlake.sources.append import AppendTable
from histlake.sources.layout import dealt
from histlake.streaming.ingest import stage_files


def counted(spark, df):
    """``df`` with a column that counts the rows it is worked out for."""
    seen = spark.sparkContext.accumulator(0)

    def see(x):
        seen.add(1)
        return x

    return df.withColumn("seen", F.udf(see, "long")("id")), seen


def ranges(df, *by):
    parts = df.withColumn("_p", F.spark_partition_id()).select("_p", *by).collect()
    rank = lambda v: (v is not None, v) if v is not None else (False,)
    found = {}
    for r in parts:
        found.setdefault(r["_p"], []).append(tuple(rank(r[c]) for c in by))
    return [(min(v), max(v), len(v)) for _, v in sorted(found.items())]


def test_staged_rows_are_worked_out_once(spark, tmp_path):
    df, seen = counted(spark, spark.range(5000).withColumn("day", F.expr("date_add(DATE'2020-01-01', cast(id * 7919 % 1000 as int))")))
    path = stage_files(df, str(tmp_path / "staged"), 4, order_by="day")
    assert seen.value == 5000
    back = spark.read.parquet(path)
    assert back.count() == 5000 and back.select("id").distinct().count() == 5000
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.min("day").alias("a"), F.max("day").alias("z"), F.count("*").alias("n")).orderBy("a").collect()
    assert len(files) == 4 and all(900 < f.n < 1600 for f in files)
    assert all(a.z < b.a for a, b in zip(files, files[1:]))


def test_appended_rows_are_worked_out_once(spark, tmp_path):
    df, seen = counted(spark, spark.range(200_000).withColumn("a", F.col("id") % 5))
    table = AppendTable(spark, str(tmp_path / "t"), ["a", "id"])
    assert table.append(df.repartition(3), "s", 0).count() == 200_000
    assert seen.value == 200_000
    assert table.read().agg(F.sum("seen"), F.countDistinct("id")).first()[:] == (199999 * 100_000, 200_000)


def test_ranges_follow_each_other_and_spread_hot_values(spark):
    day = dt.datetime(2021, 5, 1, 12)
    rows = [(None if i % 11 == 0 else f"é{i % 7}", None if i % 13 == 0 else day + dt.timedelta(hours=i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, t timestamp, i long")
    got = ranges(dealt(df, ["s", "t"], 6), "s", "t")
    assert len(got) == 6 and sum(n for *_, n in got) == 3000
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    hot = spark.range(4000).select(F.when(F.col("id") < 3600, 5).otherwise(F.col("id")).alias("k"), "id")
    sizes = [n for *_, n in ranges(dealt(hot, ["k"], 8), "k")]
    assert sum(sizes) == 4000 and max(sizes) < 900
    together = dealt(hot, ["k"], 8, spread=False)
    assert together.where("k = 5").select(F.spark_partition_id()).distinct().count() == 1 and together.count() == 4000


def test_odd_columns_and_empty_tables(spark):
    odd = spark.range(500).select(F.array("id").alias("a"), F.encode(F.col("id").cast("string"), "UTF-8").alias("b"),
                                  F.when(F.col("id") % 3 == 0, float("nan")).otherwise(-0.0).alias("x"), F.lit(None).cast("string").alias("n"), "id")
    for by in (["a"], ["b"], ["x"], ["n"], ["n", "x", "id"]):
        assert dealt(odd, by, 4).select("id").distinct().count() == 500
        assert dealt(odd.limit(0), by, 4).count() == 0
