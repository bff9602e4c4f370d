from collections import Counter

import numpy as np
from histlake.llm import lang_id as L
from histlake.llm import queries
from histlake.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    got = queries.op9_lang_id(spark, sf).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.97
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_counts_are_those_of_the_whole_text():
    text = "Ab é! " * 3000 + "zz"
    c = L.counts_of(text)
    plain = " " + ("ab é " * 3000 + "zz").strip() + " "
    assert c.sum() == sum(len(plain) - n + 1 for n in (1, 2, 3))
    assert L.counts_of("12 !! ") is None and L.counts_of("") is None and L.counts_of(None) is None


def test_document_frequencies_match_brute_force(make_docs):
    rows = [(1, "aa b", "x", None), (2, "aa c", "x", None), (3, "12", "x", None), (4, "b", "y", None)]
    langs, df = L.document_frequencies(make_docs(rows).repartition(3).select("text", "lang"))
    want = Counter(d for _, t, _, _ in rows if (c := L.counts_of(t)) is not None for d in np.flatnonzero(c))
    assert langs == {"x": 2, "y": 1} and {i: n for i, n in enumerate(df) if n} == dict(want)


def test_edges(make_docs):
    rows = [(i, f"the quick brown fox number {i} runs over that hill", "en", None) for i in range(30)]
    rows += [(50 + i, f"der schnelle braune fuchs läuft über jenen hügel {i}", "de", None) for i in range(30)]
    rows += [(100, None, "en", None), (101, "", "en", None), (102, "12 34 !!", "en", None), (103, "the", None, None),
             (104, "жзиклмнопрстуфхц " * 200, None, None), (105, "".join(f"the quick brown fox number {i} runs over that hill " for i in range(5000)), None, None), (1, rows[1][1], "en", None)]
    docs = make_docs(rows, ["'x' as id", "'y' as lang_pred", "1 as score", "2 as lang_id"])
    model = L.fit(docs.filter("doc_id < 103"))
    got = {r.doc_id: r["lang_id"] for r in L.predict(docs.drop("lang_id"), model).collect()}
    assert all(got[i].lang_pred == "en" and not got[i].rejected for i in range(30))
    assert all(got[50 + i].lang_pred == "de" for i in range(30))
    for i in (100, 101, 102):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[104].rejected and got[104].lang_pred in ("en", "de") and not got[103].rejected and not got[105].rejected


def test_nothing_to_learn_from(make_docs):
    model = L.fit(make_docs([]))
    got = L.predict(make_docs([(1, "words", None, None)]), model).first()["lang_id"]
    assert (got.lang_pred, got.rejected) == ("und", True)
    assert L.predict(make_docs([]), model).collect() == []


def test_numeric_signs_are_no_letters():
    assert L._LETTER.search("½ ①² _ 12 ٣") is None and L._LETTER.search("½ é") is not None
