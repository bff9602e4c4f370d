"""The pipeline's stages against brute force and planted cases."""

import random

import corpus_pipeline as P
import pytest
from histlake.llm import quality
from histlake.llm.common import table
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as classes
from test_mixing import filled


@pytest.fixture(scope="module")
def stages(spark):
    """The stages' results on one table, each written and read again."""
    sf, out = "/root/testdata/sf0.001", []
    docs = table(spark, sf, "documents")
    for name, stage in P.STAGES:
        after = stage(spark, docs, sf)
        path = P.scratch_dir(spark, f"test-{name}")
        after.write.parquet(path)
        out.append((name, docs, after := spark.read.parquet(path)))
        docs = after
    return sf, out


def test_order_and_columns(stages, spark):
    sf, out = stages
    assert [n for n, _, _ in out] == ["quality_classifier", "language_id", "near_duplicates", "decontamination", "mixing"]
    for name, before, after in out:
        assert after.columns == before.columns + (["mix_copy"] if name == "mixing" else [])
    assert P.ORACLE_SQL is None


def test_filters_keep_clean_documents(stages, spark):
    sf, out = stages
    marks = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    kept = {r.doc_id for r in out[0][2].collect()}
    good = [i for i, q in marks.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    bad = [i for i, q in marks.items() if q == 0]
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)
    before, after = (d.count() for d in out[1][1:])
    assert after >= 0.98 * before


def test_near_duplicates_and_leaks(stages, spark):
    sf, out = stages
    _, before, after = out[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(str(r.doc_id) for r in after.collect()) == sorted({c for _, c, _, _ in classes(rows)})
    _, before, after = out[3]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    found = {d for d, _ in leaks([(r.doc_id, r.text) for r in before.collect()], items)}
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.doc_id for r in before.collect()} - found)


def test_mixing(stages):
    _, before, after = stages[1][4]
    words, taken, copies = {}, {}, {}
    for r in before.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for r in after.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        copies.setdefault(r.doc_id, []).append(r.mix_copy)
    assert all(sorted(c) in ([1], [1, 2]) for c in copies.values())
    want = filled(words, (3, 1, 2), 1.5, 2.0)
    for s, w in want.items():  # few documents a source here
        assert abs(taken.get(s, 0) - w) <= 0.5 * w + 200


def test_run_gives_the_last_stage(stages, spark):
    sf, out = stages
    key = lambda r: (r.doc_id, r.mix_copy)
    assert sorted(map(key, P.run(spark, sf).collect())) == sorted(map(key, out[-1][2].collect()))


def test_odd_rows_pass_every_stage(spark, make_docs):
    sf = "/root/testdata/sf0.001"
    rng = random.Random(8)
    some = [tuple(r) for r in table(spark, sf, "documents").limit(30).collect()]
    rows = [r[:4] for r in some] + [some[0][:4], (900, None, "en", "src1"), (901, "", "en", None), (902, "...", None, "src1"), (None, some[1][1], "en", "src1"),
                                    (903, " ".join(rng.choice(some[2][1].split()) for _ in range(60_000)), None, None), (900, some[3][1], "en", "src2")]
    docs = make_docs(rows, ["'clash' as score", "'x' as key", "1 as lang_id", "2 as mix_copies"])
    for _, stage in P.STAGES:
        assert stage(spark, docs, sf).count() >= 0
    empty = make_docs([])
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf).collect() == []
    assert quality.FEATURES
