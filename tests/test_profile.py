"""Profiling and quality report."""

import math
import random

from helpers import rows
from pyspark.sql import functions as F

from histlake.operators import profile


def test_describe_skew_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    d = profile.describe(df, "x").collect()[0]
    assert (d["count"], d["min"], d["p50"], d["max"]) == (5, 1.0, 3.0, 100.0)
    s = profile.skewness_raw_and_log(df, "x").collect()[0]
    assert s["skew_original"] > s["skew_log"] > 0
    h = rows(profile.histogram(df, "x", bins=4), "bin", "count")
    assert h == [(0, 4), (3, 1)]
    assert rows(profile.histogram(df, "x", bins=4, materialize=True), "bin", "count") == h
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert rows(profile.histogram(const, "x", bins=10), "bin", "count") == [(0, 2)]


def test_exact_quantiles_beyond_any_sketch(spark):
    """Coarse sketches and tiny ranges, so that every round is taken; values
    bunched, tied and negative."""
    r = random.Random(4)
    makers = [lambda: r.gauss(0, 1), lambda: float(r.randrange(4)), lambda: 2.0 ** r.randrange(-40, 40), lambda: r.choice([-1.0, 7.5] + [0.0] * 20)]
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    for make in makers:
        values = [make() for _ in range(3000)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, "x double").repartition(5)
        ordered = sorted(values)
        want = [ordered[max(math.ceil(p * 3000), 1) - 1] for p in probabilities]
        assert profile.exact_quantiles(df, "x", probabilities, accuracy=10, pick_rows=20) == want
        assert profile.exact_quantiles(df, "x", probabilities) == want
    assert profile.exact_quantiles(df.limit(0), "x", [0.5]) == [None]
    empty = profile.describe(df.limit(0), "x").first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_exact_quantiles_of_dates_and_decimals(spark):
    df = spark.range(1, 1001).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
                                     (F.col("id") / 100).cast("decimal(10,2)").alias("x"))
    assert str(profile.exact_quantiles(df, "d", [0.5], accuracy=10, pick_rows=5)[0]) == "2021-05-15"
    assert str(profile.exact_quantiles(df, "x", [0.25], accuracy=10, pick_rows=5)[0]) == "2.50"


def test_quality_report(spark):
    df = spark.createDataFrame([("a", "OK", 1), ("a", "BAD", None), (None, "FAIL", 3)],
                               "k string, status string, n int")
    r = rows(profile.quality_report(df, not_null=["k", "n"], unique=["k"],
                                    domains={"status": ["OK", "FAIL", "No Update"]}),
             "check", "column", "violations")
    assert r == [("domain", "status", 1), ("not_null", "k", 1), ("not_null", "n", 1),
                 ("unique", "k", 2)]
    assert profile.not_null_violations(df, ["k", "n"]).count() == 2


def test_observe_quality_counts_during_the_write(spark):
    df = spark.createDataFrame([("a", "OK"), (None, "BAD"), ("c", None)], "k string, status string")
    observed, obs = profile.observe_quality(df, not_null=["k", "status"],
                                            domains={"status": ["OK", "FAIL", "No Update"]})
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "null_k": 1, "null_status": 1, "bad_status": 1}
