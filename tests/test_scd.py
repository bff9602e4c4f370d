"""SCD1 / SCD2 goldens (FIXTURES.md section 2) and properties."""

import random

from helpers import D, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from histlake.operators import scd

SCHEMA = "k string, seq date, v int, note string"


def hist(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return scd.scd2(df, ["k"], "seq", track=["v"], **kw)


def versions(h):
    return rows(h, "k", "v", "__START_AT", "__END_AT")


def test_change_and_unchanged(spark):
    h = hist(spark, [("a", D(2025, 1, 1), 1500, "x"), ("a", D(2025, 6, 1), 1800, "y"),
                     ("b", D(2025, 1, 1), 1500, "first"), ("b", D(2025, 2, 1), 1500, "second")])
    assert versions(h) == [("a", 1500, D(2025, 1, 1), D(2025, 6, 1)),
                           ("a", 1800, D(2025, 6, 1), None),
                           ("b", 1500, D(2025, 1, 1), None)]
    # untracked columns (and the sequence) come from the version's latest row
    assert rows(h.where("k = 'b'"), "note", "seq") == [("second", D(2025, 2, 1))]


def test_return_to_old_value_and_late_rows(spark):
    h = hist(spark, [("r", D(2025, 1, 1), 1, None), ("r", D(2025, 2, 1), 2, None),
                     ("r", D(2025, 3, 1), 1, None),
                     # late row splits: A@01, A@03, late B@02
                     ("s", D(2025, 1, 1), 1, None), ("s", D(2025, 3, 1), 1, None),
                     ("s", D(2025, 2, 1), 2, None),
                     # late row with the same value: one version
                     ("t", D(2025, 1, 1), 1, None), ("t", D(2025, 3, 1), 1, None),
                     ("t", D(2025, 2, 1), 1, None)])
    got = versions(h)
    assert [g for g in got if g[0] == "r"] == [("r", 1, D(2025, 1, 1), D(2025, 2, 1)),
                                              ("r", 1, D(2025, 3, 1), None),
                                              ("r", 2, D(2025, 2, 1), D(2025, 3, 1))]
    assert [g for g in got if g[0] == "s"] == [("s", 1, D(2025, 1, 1), D(2025, 2, 1)),
                                              ("s", 1, D(2025, 3, 1), None),
                                              ("s", 2, D(2025, 2, 1), D(2025, 3, 1))]
    assert [g for g in got if g[0] == "t"] == [("t", 1, D(2025, 1, 1), None)]


def test_null_tracked_null_key_and_null_sequence(spark):
    h = hist(spark, [("n", D(2025, 1, 1), None, None), ("n", D(2025, 2, 1), None, None),
                     ("n", D(2025, 3, 1), 5, None),
                     (None, D(2025, 1, 1), 1, None), (None, D(2025, 2, 1), 1, None),
                     ("z", None, 7, None)])
    got = versions(h)
    assert [g for g in got if g[0] == "n"] == [("n", 5, D(2025, 3, 1), None),
                                              ("n", None, D(2025, 1, 1), D(2025, 3, 1))]
    assert [g for g in got if g[0] is None] == [(None, 1, D(2025, 1, 1), None)]  # one history
    assert not [g for g in got if g[0] == "z"]                                      # rejected
    df = spark.createDataFrame([("z", None, 7, None)], SCHEMA)
    assert scd.null_sequence_rows(df, "seq").count() == 1


def test_tie_on_sequence_is_deterministic(spark):
    data = [("a", D(2025, 1, 1), 1, "p"), ("a", D(2025, 1, 1), 2, "q")]
    h1 = hist(spark, data, tie_break=["note"])
    h2 = hist(spark, list(reversed(data)), tie_break=["note"])
    assert versions(h1) == versions(h2) == [("a", 2, D(2025, 1, 1), None)]


def test_scd1_latest_row_with_tie_break(spark):
    df = spark.createDataFrame([("a", D(2025, 1, 1), 1, "x"), ("a", D(2025, 2, 1), 2, "y"),
                                ("a", D(2025, 2, 1), 3, "z"), ("b", None, 9, "n")], SCHEMA)
    assert rows(scd.scd1(df, ["k"], "seq"), "k", "v", "note") == [("a", 3, "z")]


def test_as_of_change_type_and_history(spark):
    h = hist(spark, [("a", D(2025, 1, 1), 1, None), ("a", D(2025, 6, 1), 2, None)])
    assert rows(scd.as_of(h, D(2025, 3, 1)), "v") == [(1,)]
    assert rows(scd.as_of(h, D(2025, 6, 1)), "v") == [(2,)]
    assert rows(scd.with_change_type(h, ["k"]), "v", "change_type") == [(1, "INSERT"), (2, "UPDATE")]
    kh = scd.key_history(h, None, D(2030, 1, 1), ["k", "v"])
    assert rows(kh, "v", "valid_to") == [(1, D(2025, 6, 1)), (2, D(2030, 1, 1))]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 12),
                          st.sampled_from([1, 2, None])), min_size=1, max_size=25))
def test_scd2_properties(spark, events):
    data = [(k, D(2024, 1, 1 + d), v, str(i)) for i, (k, d, v) in enumerate(events)]
    h = versions(hist(spark, data, tie_break=["note"]))
    shuffled = data[:]
    random.Random(7).shuffle(shuffled)
    assert versions(hist(spark, shuffled, tie_break=["note"])) == h      # arrival order irrelevant
    by_key = {}
    for k, v, s, e in h:
        by_key.setdefault(k, []).append((s, e, v))
    for k, vs in by_key.items():
        vs.sort()
        assert sum(1 for s, e, v in vs if e is None) == 1                  # exactly one open
        for (s1, e1, v1), (s2, e2, v2) in zip(vs, vs[1:]):
            assert e1 == s2 and s1 < s2                                     # contiguous, disjoint
            assert v1 != v2                                                 # adjacent differ


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 40),
                          st.sampled_from([1, 2, None])), min_size=1, max_size=40),
       st.integers(1, 4))
def test_hot_key_chunked_plan_equals_plain_plan(spark, events, chunk_rows):
    """Hot keys split into sequence chunks give exactly the plain result."""
    data = [(k, D(2024, 1, 1) + __import__("datetime").timedelta(days=d), v, str(i % 3))
            for i, (k, d, v) in enumerate(events)]
    df = spark.createDataFrame(data, SCHEMA)
    # default tie-break (all non-key columns) is a total order on distinct rows
    plain = scd.scd2(df, ["k"], "seq", track=["v"], hot_key_rows=None)
    split = scd.scd2(df, ["k"], "seq", track=["v"], hot_key_rows=2, chunk_rows=chunk_rows)
    cols = ("k", "seq", "v", "note", "__START_AT", "__END_AT")
    assert rows(split, *cols) == rows(plain, *cols)


def test_change_type_from_scd2_equals_post_hoc(spark):
    data = [("a", D(2025, 1, 1), 1, None), ("a", D(2025, 6, 1), 2, None), (None, D(2025, 1, 1), 1, None),
            (None, D(2025, 2, 1), 3, None)]
    df = spark.createDataFrame(data, SCHEMA)
    for hot in (None, 1):
        direct = scd.scd2(df, ["k"], "seq", track=["v"], change_type_col="change_type",
                          hot_key_rows=hot, chunk_rows=1)
        post = scd.with_change_type(scd.scd2(df, ["k"], "seq", track=["v"]), ["k"])
        cols = ("k", "v", "__START_AT", "change_type")
        assert rows(direct, *cols) == rows(post, *cols)
        assert sorted(r[3] for r in rows(direct, *cols)) == ["INSERT", "INSERT", "UPDATE", "UPDATE"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["x", None]), st.sampled_from([1, 2]),
                          st.integers(0, 30), st.sampled_from(["p", "q", None]),
                          st.sampled_from([0.5, 1.5])), min_size=1, max_size=45),
       st.integers(1, 5))
def test_hot_key_chunking_multi_column_keys_and_timestamps(spark, events, chunk_rows):
    import datetime as dt
    data = [(a, b, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * h), t1, t2, i)
            for i, (a, b, h, t1, t2) in enumerate(events)]
    df = spark.createDataFrame(data, "a string, b int, ts timestamp, t1 string, t2 double, i long")
    kw = dict(track=["t1", "t2"], change_type_col="ct")
    plain = scd.scd2(df, ["a", "b"], "ts", hot_key_rows=None, **kw)
    split = scd.scd2(df, ["a", "b"], "ts", hot_key_rows=1, chunk_rows=chunk_rows, **kw)
    cols = ("a", "b", "ts", "t1", "t2", "i", "__START_AT", "__END_AT", "ct")
    assert rows(split, *cols) == rows(plain, *cols)


def test_hot_key_chunks_are_row_balanced_even_when_rows_bunch(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    base = dt.datetime(2024, 1, 1)
    data = [("h", base + dt.timedelta(seconds=i), i % 3) for i in range(900)] + \
           [("h", base + dt.timedelta(days=3 * i + 2), i % 3) for i in range(100)] + [("n", base, 1)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v int")
    hot = scd._hot_keys(df, ["k"], "ts", 50, 100)
    x = scd._seq_number(df, "ts")
    sizes = [r[1] for r in df.withColumn("_k", scd._key_struct(["k"])).join(hot, "_k")
             .groupBy(scd._quantile_chunk(x, F.col("_cuts"))).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 110


def test_equal_width_fallback_is_exact(spark, monkeypatch):
    monkeypatch.setattr(scd, "MAX_CUT_VALUES", 0)
    data = [("a", D(2024, 1, 1 + i % 28), i % 2, str(i)) for i in range(40)] + [("b", D(2024, 2, 1), 1, "x")]
    df = spark.createDataFrame(data, SCHEMA)
    plain = scd.scd2(df, ["k"], "seq", track=["v"], hot_key_rows=None)
    split = scd.scd2(df, ["k"], "seq", track=["v"], hot_key_rows=5, chunk_rows=4)
    assert rows(split) == rows(plain)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5),
                          st.sampled_from([1, 2, None])), min_size=1, max_size=30))
def test_scd1_equals_brute_force_latest_row(spark, events):
    """SCD1 = per key, the row with the largest sequence, ties broken by the
    largest remaining columns (NULLs lowest), rows with NULL sequence dropped."""
    data = [(k, D(2024, 1, 1 + d), v, str(i)) for i, (k, d, v) in enumerate(events)]
    got = rows(scd.scd1(spark.createDataFrame(data, SCHEMA), ["k"], "seq"))
    best = {}
    for r in data:
        rank = (r[1], (r[2] is not None, r[2] or 0), r[3])
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    assert got == sorted((r for _, r in best.values()), key=lambda t: tuple((x is None, str(x)) for x in t))
