import re

from histlake.llm import license_scan as L
from histlake.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text):
    words = WORD.findall(lower(text))
    hits = [(label, i) for phrase, label in L.BASE_PHRASES.items() for p in [phrase.split()]
            for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(hits)


def test_base_places_match_brute_force_on_the_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r for r in L.license_scan(docs).collect()}
    for d in docs.collect():
        n, hits = brute(d.text)
        assert got[d.doc_id].n_words == n
        assert sorted((x.label, x.start) for x in got[d.doc_id].base) == hits


def test_matching_statistics_match_brute_force():
    auto = L.Automaton(L.TEMPLATES, L.BASE_PHRASES)
    texts = [L.words_of(t) for _, t in L.TEMPLATES] + [L.words_of(p) for p in L.BASE_PHRASES]
    every = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    words = L.words_of("of the license you may not use this this software is furnished to do so this file except in MIT license version 2 0 the License")
    known = [w for w in words if w in auto.vocab]
    for i, _, n in auto.stream([auto.vocab[w] for w in known], 0):
        best = max((m for m in range(1, i + 2) if tuple(known[i + 1 - m:i + 1]) in every), default=0)
        assert n == best


def test_phrases_overlaps_nulls_and_clashing_columns(make_docs):
    rows = [(1, "The MIT License, the mit\nlicense. APACHE LICENSE!", None, None), (2, None, None, None), (3, "", None, None),
            (4, "x " * 50_000 + "GNU General Public License", None, None), (4, "mit licenses", None, None), (5, "Kit license mİt", None, None)]
    docs = make_docs(rows, ["'clash' as n_words", "'clash' as base", "'clash' as labels"])
    got = {(r.doc_id, r.n_words): r for r in L.digest(L.license_scan(docs)).collect()}
    assert (got[1, 8].n_base, got[1, 8].first_word, got[1, 8].last_word, got[1, 8].base_labels) == (3, 1, 6, "apache,mit")
    assert (got[2, 0].n_base, got[2, 0].first_word, got[2, 0].labels, got[2, 0].score) == (0, None, "", 0.0)
    assert got[3, 0].score == 0.0
    assert (got[4, 50_004].first_word, got[4, 50_004].labels, got[4, 50_004].score) == (50_001, "gpl", 1.0)
    assert got[4, 2].n_base == 0 and got[5, 3].n_base == 0
    assert len(got) == 6


def test_template_with_edits_is_chained(make_docs):
    label, text = L.TEMPLATES[0]
    words = text.split()
    words[20] = "CHANGED"
    got = L.digest(L.license_scan(make_docs([(1, "before " + " ".join(words) + " after", None, None)]))).first()
    assert got.labels == label and got.base_labels == "" and 0.8 < got.score < 1 and got.n_spans == 1


def test_empty_table(make_docs):
    assert L.digest(L.license_scan(make_docs([]))).collect() == []
