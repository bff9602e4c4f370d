import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, v string, ab long"


def plain(rows, every=100, scale=256):
    """The contract word by word, over all pairs."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for i, lab, v in kept:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in kept if j != i]
        positives = sorted((s for s in scored if s[2] == lab), key=order)[:5]
        for ps, pid, _ in positives:
            inside = sorted((s for s in scored if s[2] != lab and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:5]
            out += [(i, pid, k + 1, s[1], ps, s[0]) for k, s in enumerate(inside)]
    return out


def run(spark, rows, every=100):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = hn.mine(df, "vec_id", "embedding", "label", F.col("id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(r) for r in got.collect()]


def test_equals_all_pairs_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 50)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(400):  # clusters that labels cut across, so that negatives are near
        rows.append((i, [x + r.gauss(0, 0.4) for x in centres[i % 5]], (i // 3) % 4))
    rows += [(1000 + i, centres[0], i % 3) for i in range(60)]                       # one common vector: ties
    rows += [(2000, None, 1), (2001, [1.0] * 8, None), (2002, [float("nan")] * 8, 1), (2003, [1.0, None] + [0.0] * 6, 1)]
    rows += [(2004, [0.0] * 8, 1), (2010, [], 2), (2005, [0.5, 0.5], 2), (None, centres[1], 0), (None, centres[1], 1)]
    rows += [(10, centres[2], 2), (11, centres[3], 1)]                               # repeated ids
    want = plain(rows, every=10)
    assert len(want) > 300
    assert sorted(run(spark, rows, every=10), key=str) == sorted(want, key=str)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2)]) == []
    assert run(spark, [(100, [0.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, [0.0, 0.0], 2)]) == [(100, 2, 1, 3, 0, 0)]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        run(spark, [(100, [1e20, 1.0], 1)])


def test_bounds_hold_also_for_parallel_and_opposite_vectors():
    g = np.random.default_rng(1)
    x = np.floor(256 * g.normal(size=(200, 16)))
    x[50:100], x[100:150], x[199] = 3 * x[:50], -2 * x[:50], 0
    refs = x[:6] / np.linalg.norm(x[:6], axis=1)[:, None]
    norm = np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip(x @ refs.T / np.where(norm > 0, norm, 1)[:, None], -1, 1)).astype(np.float32)
    low, high = hn.bounds(angle, norm, angle, norm)
    score = x @ x.T
    assert (low <= score).all() and (score <= high).all()
    assert (high - low < 1.999 * np.outer(norm, norm))[:199, :6].all()  # and say something near the directions


def test_clustered_data_leave_most_rows_unscored():
    g = np.random.default_rng(2)
    centres = g.normal(size=(16, 32)) * 100
    x = np.floor(centres[np.arange(1600) % 16] + g.normal(size=(1600, 32)) * 4)
    refs = centres / np.linalg.norm(centres, axis=1)[:, None]
    norm = np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip(x @ refs.T / norm[:, None], -1, 1)).astype(np.float32)
    _, high = hn.bounds(angle[:16], norm[:16], angle, norm)
    assert (high >= 0.8 * norm[:16, None] ** 2).mean() < 0.15
