import math
import random

import numpy as np
from histlake.llm import jaccard_join as J
from histlake.llm.common import table


def brute(rows, similarity=0.8):
    """(class id, links, other sets) of each (id, text) row."""
    cache = J.WordHashes()
    sets = [frozenset(J.shingle_set(t, cache).tolist()) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    near = {s: [o for o in distinct if o != s and min(len(o), len(s)) >= similarity * max(len(o), len(s))
                and len(o & s) >= similarity * len(o | s) - 1e-9] for s in distinct}
    copies = {s: sets.count(s) for s in distinct}
    label = {s: s for s in distinct}

    def find(s):
        while label[s] is not s:
            s = label[s]
        return s

    for s in distinct:
        for o in near[s]:
            label[find(s)] = find(o)
    first = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            first[find(s)] = min(first.get(find(s), i), i)
    return sorted((str(i), str(first.get(find(s), i) if s else i), copies[s] - 1 + sum(copies[o] for o in near[s]) if s else 0,
                   len(near[s]) if s else 0) for (i, _), s in zip(rows, sets))


def result(df):
    return sorted((str(r.id), str(r.class_id), r.n_links, r.n_text_links) for r in df.collect())


def test_whole_table_matches_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    assert result(J.jaccard_join(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_copies_near_copies_and_odd_rows(spark, make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(700):  # one large group: more than a leaf and several blocks of near copies
        w = list(base)
        w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    shared = [word() for _ in range(40)]
    rows += [(1000 + i, " ".join([word() for _ in range(60)] + shared)) for i in range(400)]  # a common passage
    rows += [(2000 + i, " ".join(base)) for i in range(300)] + [(None, " ".join(base)), (2000, " ".join(base))]
    rows += [(3000, None), (3001, ""), (3002, "..."), (3003, "one two"), (3004, "One, two!"), (3005, "w " * 50_000), (3000, "another text")]
    docs = make_docs([(i, t, None, None) for i, t in rows], ["'x' as key", "'y' as c", "1 as n", "2 as class_id"])
    got, want = result(J.jaccard_join(docs)), brute(rows)
    assert len(got) == len(want)
    links, found = sum(w[2] for w in want), sum(g[2] for g in got)
    assert found <= links and found >= 0.999 * links
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    kept = sorted(str(r.doc_id) for r in J.one_of_each(docs).collect())
    assert kept == sorted([*{w[1] for w in want}, "3000"])  # two different rows have the id 3000


def test_unlinked_rows_without_ids_all_stay(make_docs):
    docs = make_docs([(None, f"text number {i} has its own words {i}a {i}b {i}c {i}d", None, None) for i in range(5)] + [(None, None, None, None)])
    assert J.one_of_each(docs).count() == 6


def test_recall_at_the_threshold():
    """A pair at similarity 0.8 survives trees as often as the formula says."""
    assert math.isclose(J.survival(0.8, 1), 0.75 * 0.8 + 0.25 * (1 - 0.2**2))
    runs = J.runs_for(0.8, 0.999, J.DEPTH)
    assert 1 - (1 - J.survival(0.8, J.DEPTH)) ** runs >= 0.999 > 1 - (1 - J.survival(0.8, J.DEPTH)) ** (runs - 1)


def test_similar_agrees_on_both_ways():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    many = J.similar(sets, 0.5)
    for x in range(30):
        for y in range(30):
            a, b = set(sets[x].tolist()), set(sets[y].tolist())
            assert many[x, y] == (x != y and len(a & b) >= 0.5 * len(a | b) - 1e-9)
            assert x == y or J.similar([sets[x], sets[y]], 0.5)[0, 1] == many[x, y]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    name = lambda i: bytearray(i.to_bytes(4, "big"))
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in J.components(df).collect()}
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {v: r for v, r in label.items() if any(r == o and v != w for w, o in label.items()) or v in got}
    assert J.components(df.limit(0)).collect() == []


def test_empty_table(make_docs):
    assert J.jaccard_join(make_docs([])).collect() == []
    assert J.one_of_each(make_docs([])).collect() == []
    assert J.one_of_each(make_docs([(1, "a b c d e f", None, None)] * 3)).count() == 1


def test_a_task_holds_no_more_of_a_large_group(make_docs, monkeypatch):
    from pyspark.sql import GroupedData
    from pyspark.sql import functions as F
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, k = [word() for _ in range(120)], 2000
    texts = [" ".join([*base[:p], word(), *base[p + 1:]]) for p in (rng.randrange(120) for _ in range(k))]
    largest, apply = [], GroupedData.applyInArrow

    def spy(self, func, schema):
        largest.append(self.count().agg(F.max("count")).first()[0])
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", spy)
    got = {r.id: r.n_text_links for r in J.jaccard_join(make_docs([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    sketches, sets = largest
    assert sketches <= 44 * 512 and sets <= 3 * J.BLOCK  # 9 trees of at most 1.25 ** 4 leaves a set, 512 sets
    want = J.similar([J.shingle_set(t, J.WordHashes()) for t in texts], 0.8).sum(1)
    assert 0.999 * want.sum() <= sum(got.values()) <= want.sum() and len(got) == k
