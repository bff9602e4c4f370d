from collections import Counter

import pytest
from histlake.llm import queries
from histlake.llm import token_counts as T
from histlake.llm.common import table

CHANGES = "id long, seq int, op string, text string, source string, lang string"


def brute(rows, tokenizers=T.TOKENIZERS):
    """{(source, lang, tokenizer): (docs, tokens, chars)} of (text, source, lang)."""
    encoders = {n: T.encoder(T.FOLDER, n) for n in tokenizers}
    docs, tokens, chars = Counter(), Counter(), Counter()
    for text, source, lang in rows:
        for n, e in encoders.items():
            docs[source, lang, n] += 1
            tokens[source, lang, n] += len(e.encode_ordinary(text or ""))
            chars[source, lang, n] += len(text or "")
    return {k: (docs[k], tokens[k], chars[k]) for k in docs}


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in df.collect()}


def test_query_matches_brute_force(spark, sf):
    import re
    marks = {}
    for r in table(spark, sf, "labels").collect():
        marks[r.doc_id] = (r.quality, r.toxic)
    rows = []
    for d in table(spark, sf, "documents").collect():
        quality, toxic = marks.get(d.doc_id, (1, 0))
        if not toxic:
            rows.append((re.sub(r"[ \t\n\x0b\f\r]+", " ", d.text) if quality == 0 else d.text, d.source, d.lang))
    assert totals(queries.op1_token_counts(spark, sf)) == brute(rows)


@pytest.fixture
def ledger(spark, tmp_path):
    return T.Ledger(spark, str(tmp_path / "ledger"), T.TOKENIZERS[:1])


def test_inserts_deletes_revisions_and_replays(spark, ledger):
    send = lambda batch, rows: ledger.commit(batch, spark.createDataFrame(rows, CHANGES).selectExpr("*", "1 as tokens", "2 as docs"))
    assert totals(ledger.totals()) == {}
    first = [(1, 0, "insert", "a few words", "s", "en"), (2, 0, "insert", None, None, None), (3, 0, "insert", "more " * 2000, "t", "de"),
             (None, 0, "insert", "no id", "s", "en"), (4, 0, "delete", None, None, None)]
    assert send("1", first)
    want = [("a few words", "s", "en"), (None, None, None), ("more " * 2000, "t", "de")]
    assert totals(ledger.totals()) == brute(want, T.TOKENIZERS[:1])
    assert not send("1", first) and not send("1", [(9, 0, "insert", "other", "s", "en")])
    assert totals(ledger.totals()) == brute(want, T.TOKENIZERS[:1])
    # a move to another source, a deletion, a change of mind within the batch, an equal row again
    assert send("2", [(1, 1, "revise", "a few more words", "u", "en"), (3, 1, "delete", None, None, None), (5, 1, "insert", "x", "s", "en"),
                      (5, 2, "revise", "y z", "s", "en"), (6, 1, "insert", "gone", "s", "en"), (6, 1, "delete", None, None, None),
                      (2, 1, "revise", "text", None, None), (2, 1, "revise", "text", None, None)])
    want = [("a few more words", "u", "en"), ("y z", "s", "en"), ("text", None, None)]
    assert totals(ledger.totals()) == brute(want, T.TOKENIZERS[:1])
    assert send("3", []) and ledger.committed() == ["1", "2", "3"]
    assert totals(ledger.totals()) == brute(want, T.TOKENIZERS[:1])
    assert send("4", [(i, 0, "delete", None, None, None) for i in (1, 2, 5)])
    assert totals(ledger.totals()) == {}
    with pytest.raises(ValueError):
        send("a/b", first)


def test_a_failed_attempt_is_not_read(spark, ledger, tmp_path):
    rows = [(1, 0, "insert", "a few words", "s", "en")]
    ledger.commit("1", spark.createDataFrame(rows, CHANGES))
    (tmp_path / "ledger/deltas/1/_SUCCESS").unlink()  # as if the job had died while it wrote
    assert ledger.committed() == [] and totals(ledger.totals()) == {}
    assert ledger.commit("1", spark.createDataFrame(rows, CHANGES))
    assert totals(ledger.totals()) == brute([("a few words", "s", "en")], T.TOKENIZERS[:1])


def test_query_counts_rows_without_id_and_rows_that_share_one(spark, tmp_path):
    rows = [(1, "one  text", "en", "s"), (1, "another text", "en", "s"), (None, "no id", "en", "s"), (None, "none either", "en", "s"), (None, None, None, None),
            (2, "toxic", "en", "s"), (2, "toxic as well", "de", "s"), (3, "a  b", "en", "t"), (3, "a  b", "en", "t"), (4, "", "en", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 1), (3, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    want = [(t, s, lang) for i, t, lang, s in rows[:5]] + [("a b", "t", "en"), ("", "t", "en")]
    assert totals(queries.op1_token_counts(spark, str(tmp_path))) == brute(want)
