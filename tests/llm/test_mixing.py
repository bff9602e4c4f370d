import math
import random

import oracle_compare
from histlake.llm import mixing as M
from histlake.llm import queries


def filled(words, weights, share, most):
    """Targets by resharing the excess until none is above."""
    total, full = share * sum(words.values()), set()
    order = sorted(words, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    while True:
        left = total - sum(most * words[s] for s in full)
        w = sum(weight[s] for s in words if s not in full)
        level = left / w if w else 0
        more = {s for s in words if s not in full and weight[s] * level >= most * words[s]}
        if not more:
            return {s: most * words[s] if s in full else weight[s] * level for s in words}
        full |= more


def test_query_matches_oracle(spark, sf):
    ok, message = oracle_compare.compare(queries.op8_mixing(spark, sf), oracle_compare.duck(sf), queries.ORACLES["op8_mixing"])
    assert ok, message


def test_targets_and_totals(spark, make_docs):
    rng = random.Random(3)
    sources = ["a", "b", "B", "é", "", None, "one"]
    rows = [(i, "w " * rng.randint(0, 60), None, "one" if i == 0 else rng.choice(sources[:6])) for i in range(600)]
    rows += [(600, None, None, "nothing"), (601, "", None, "nothing"), (None, "some words here", None, "a"), (5, rows[5][1], None, rows[5][3])]
    docs = make_docs(rows, ["1 as mix_size", "'n' as mix_notes", "'x' as rank", "0 as words", "0 as target"])
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    words, taken = {}, {}
    for r in got:
        assert r.mix_size == len((r.text or "").split()) and 0 <= r.mix_copies <= 2
        words[r.source] = words.get(r.source, 0) + r.mix_size
        taken[r.source] = taken.get(r.source, 0) + r.mix_size * r.mix_copies
    want = filled(words, (3, 1, 2), 1.5, 2.0)
    for r in got:
        assert r.mix_source_size == words[r.source]
        assert math.isclose(r.mix_target, want[r.source], abs_tol=1e-6)
    for s in ("a", "b", "B", "é", "", None):
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 60
    copies = {(r.doc_id, r.text, r.source): r.mix_copies for r in got}
    again = M.mix(docs.repartition(7)).collect()
    assert {(r.doc_id, r.text, r.source): r.mix_copies for r in again} == copies
    emitted = M.emit(M.mix(docs))
    assert sum(r.mix_copies for r in got) == emitted.count()
    assert "mix_notes" in emitted.columns and "mix_size" not in emitted.columns and {r.mix_notes for r in got} == {"n"}


def test_rank_over_many_sources(spark):
    names = [f"s{i:04d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, words long").repartition(5)
    got = {r.source: r["rank"] for r in M.ranked(df).collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_empty_table(spark, make_docs):
    assert M.emit(M.mix(make_docs([]))).collect() == []
    assert M.mix(make_docs([(1, None, None, "a")])).first().mix_copies == 0
