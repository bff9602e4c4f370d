import numpy as np
from histlake.llm import quality as Q
from histlake.llm import queries
from histlake.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op6_quality(spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").count()
    marks = [(r.quality, got[r.doc_id]) for r in table(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    assert sum(r.predicted == y for y, r in marks) / len(marks) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_density_difference_matches_plain_formula():
    rng = np.random.default_rng(1)
    d = len(Q.FEATURES)
    covs = []
    for s in (1.0, 2.0):
        a = rng.normal(size=(d, d)) * s
        covs.append(a @ a.T + np.eye(d))
    lower = np.linalg.cholesky(np.array(covs))
    means = rng.normal(size=(2, d))
    model = Q.Model(np.ones(len(Q.COUNTS)), np.array([0.3, 0.7]), means, np.linalg.inv(lower), 2 * np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(1))
    x = rng.normal(size=(20, d))
    logs = [np.log(p) - 0.5 * (np.linalg.slogdet(c)[1] + np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m))
            for p, c, m in zip((0.3, 0.7), covs, means)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def _fit(spark, docs, labels):
    counts = Q.with_counts(docs)
    return counts, Q.fit(counts, Q.corpus_sums(counts), spark.createDataFrame(labels, "doc_id long, quality int"))


def test_edges(spark, make_docs):
    good = [(i, f"Some plain words, number {i}, in a sentence that says little. Another one follows it here.", None, None) for i in range(20)]
    bad = [(100 + i, "BUY!! NOW!! " * (i + 3), None, None) for i in range(20)]
    odd = [(200, None, None, None), (201, "", None, None), (202, "  \n ", None, None), (203, "word " * 100_000, None, None), (0, good[0][1], None, None)]
    docs = make_docs(good + bad + odd, ["1 as id", "'x' as n", "2 as score"])
    labels = [(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)] + [(0, 1), (None, 1), (5, None), (999, 0)]
    counts, model = _fit(spark, docs, labels)
    got = Q.score(counts, model).collect()
    assert len(got) == 45 and all(0 <= r.score <= 1 for r in got)
    by = {r.id: r.score for r in got}
    assert min(by[i] for i in range(20)) > 0.9 and max(by[100 + i] for i in range(20)) < 0.1
    scored = {r.doc_id: r["__s"] for r in Q.score_text(docs, model, out="__s").collect()}
    assert all(abs(scored[i] - by[i]) < 1e-12 for i in by)


def test_one_class_no_label_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b c", None, None), (2, None, None, None)])
    for labels, want in (([(1, 0)], 0.0), ([(1, 1)], 1.0), ([], 1.0)):
        counts, model = _fit(spark, docs, labels)
        assert [r.score for r in Q.score(counts, model).collect()] == [want] * 2
    counts, model = _fit(spark, make_docs([]), [(1, 0)])
    assert Q.score(counts, model).collect() == []
