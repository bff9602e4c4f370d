import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histlake.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, __group string"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The contract word by word: direct distances, one loop at a time."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    longest = max((len(v) for _, v in kept), default=0)
    size = -(-longest // parts)
    kept = [(i, v + [0] * (size * parts - len(v))) for i, v in kept]
    cut = lambda v, p: v[p * size:(p + 1) * size]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign(p, v):
        return min((far(cut(v, p), e), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v in kept:
                members.setdefault(assign(p, v)[1], []).append(cut(v, p))
            for j, m in members.items():
                books[p][j] = [sum(c) // len(m) for c in zip(*m)]
    out = []
    for i, v in kept:
        found = [assign(p, v) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def run(spark, rows, entries=256, rounds=4):
    df = spark.createDataFrame([(i, v, 1, "old", "x") for i, v in rows], SCHEMA).repartition(3)
    ints = vc.integers(df, "embedding", 1024)
    books = vc.fit(ints, "vec_id", entries=entries, rounds=rounds)
    return sorted(((r.vec_id, r.code, r.error) for r in vc.encode(ints, books).collect()), key=str), books


def test_codes_equal_the_plain_version(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([r.gauss(0, 1), 0.5, -0.25]) for _ in range(12)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 12) for i in range(20)]                                          # ties
    rows += [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (3, rows[3][1])]               # repeated and null ids
    rows += [(200, None), (201, [1.0, None] * 6), (202, [float("nan")] * 12), (203, [float("inf")] + [0.0] * 11)]
    rows += [(204, []), (205, [0.1, 0.2, 0.3])]                                                  # short vectors
    got, books = run(spark, rows, entries=16)
    want, want_books = plain(rows, entries=16)
    assert books.entries.tolist() == want_books
    assert got == sorted(want, key=str)


def test_fewer_rows_than_entries_and_empty_table(spark):
    rows = [(2, [1.0, 2.0, 3.0, 4.0]), (1, [0.0, 0.0, 9.0, 9.0])]
    got, books = run(spark, rows)
    assert books.entries.shape == (4, 2, 1) and {e for _, _, e in got} == {0}
    got, books = run(spark, [(1, None)])
    assert got == [] and books.digest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@pytest.mark.parametrize("width", [1, 2, 3, 5, 16, 24])
def test_search_equals_direct_distances(width):
    g = np.random.default_rng(width)
    rows, entries = g.integers(-4, 5, (500, width)), g.integers(-4, 5, (40, width))  # many ties
    entry, distance = vc.nearest(vc.transformed(rows), vc.transformed(entries))
    direct = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert (entry == direct.argmin(1)).all() and (distance == direct.min(1)).all()


def test_sequency_order_counts_sign_changes():
    signs = vc.walsh(np.eye(16, dtype=np.int64), vc.sequency(16))
    assert [(np.diff(signs[:, k]) != 0).sum() for k in range(16)] == list(range(16))


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        run(spark, [(1, [1e20, 0.0, 0.0, 0.0])])


def test_decode_and_group_error(spark):
    rows = [(i, [float(i % 3), 1.0, 2.0, float(i)]) for i in range(8)]
    df = spark.createDataFrame([(i, v, None if i % 2 else 1, "old", "x") for i, v in rows], SCHEMA)
    ints = vc.integers(df, "embedding", 1024)
    books = vc.fit(ints, "vec_id", entries=3, rounds=1)
    coded = vc.with_group_error(vc.encode(ints, books), "label")
    out = coded.withColumn("back", vc.decode(F.col("code"), books)).collect()
    for r in out:
        v = [math.floor(1024 * x) for x in r.embedding]
        assert sum((a - b) ** 2 for a, b in zip(v, r.back)) == r.error
        assert r.label_error == sum(o.error for o in out if o.label == r.label)
