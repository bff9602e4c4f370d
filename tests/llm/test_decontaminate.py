import random
import re
from collections import Counter

from histlake.llm import decontaminate as D
from histlake.llm.common import table
from pyspark.sql import functions as F


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute_whole(docs, items):
    """(similarity, start, words) of the best window; a document shorter than an item is one window."""
    found = {}
    for d, text in docs:
        g = grams(text)
        for k, item in items:
            b = Counter(s := grams(item))
            cut = [(a, g[a:a + len(s)]) for a in range(max(1, len(g) - len(s) + 1))] if s else []
            best = max(((n / (len(w) + len(s) - n), -a, len(w)) for a, w in cut if (n := sum((Counter(w) & b).values()))), default=(0, 0, 0))
            if best[0] >= 0.8:
                found[d, k] = (round(best[0], 9), -best[1], best[2] + 4)
    return found


def brute(docs, items):
    return {k: v[:2] for k, v in brute_whole(docs, items).items()}


def rows_of(df):
    return {(r.id, r["item"]): (round(r.similarity, 9), r.start) for r in df.collect()}


def test_query_table_matches_brute_force(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(D.matches(docs, items)) == want and want
    kept = {r.doc_id for r in D.clean(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_edited_passages_and_odd_rows(spark, make_docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(60)]
    twice = [word() for _ in range(4)] * 8
    items = [(1, " ".join(item)), (2, " ".join(item)), (3, " ".join(twice)), (4, "too few words here"), (5, None), (6, ""), (7, "of " * 40)]
    edited = item[:20] + ["edited"] + item[21:]
    last = item[:-3] + [word() for _ in range(3)]
    rows = [(1, "lead " + " ".join(item).upper() + ", tail", None, None), (2, " ".join(edited), None, None), (3, " ".join(last), None, None),
            (4, " ".join(item[:40]), None, None), (5, "x " + " ".join(twice) + " " + " ".join(twice[:9]), None, None), (6, None, None, None),
            (7, "", None, None), (8, "too few words here", None, None), (9, "plain " * 30_000, None, None), (1, "clean text with the same id", None, None),
            (10, " ".join(word() for _ in range(3000)) + " " + " ".join(item), None, None), (2, " ".join(edited), None, None),
            (None, " ".join(item), None, None), (11, "of " * 60, None, None)]
    docs = make_docs(rows, ["'x' as key", "1 as m", "2 as start", "'y' as item_id"])
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"m": F.lit(1), "doc_id": F.lit(2)})
    want = brute([(a, b) for a, b, _, _ in rows], items)
    assert {(1, 1), (1, 2), (3, 1), (5, 3), (10, 1), (None, 1), (11, 7)} <= want.keys() and not {(2, 1), (4, 1)} & want.keys() - {(2, 1)}
    assert rows_of(D.matches(docs, bench)) == want
    kept = [(r.doc_id, r.text) for r in D.clean(docs, bench).collect()]
    assert len(kept) == sum((d, t) not in {(d, t) for d, t, _, _ in rows if any(k[0] == d and k in want for k in want) and brute([(d, t)], items)}
                            for d, t, _, _ in rows)


def test_blocks_find_all_fingerprints_within_radius(spark):
    rng = random.Random(9)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    right = [(j, 1 + j % 2, rng.getrandbits(64)) for j in range(40)]
    left = [(i, 1 + i % 2, flip(right[i % 40][2], rng.randint(0, 22))) for i in range(200)]
    signed = lambda rows: [(a, m, x - 2**64 if x >= 2**63 else x) for a, m, x in rows]
    got = D.within_radius(spark.createDataFrame(signed(left), "l long, m int, fp long"), spark.createDataFrame(signed(right), "r long, m int, fp long"), 16, 40)
    got = sorted(tuple(r) for r in got.collect())
    assert got == sorted((i, j, d) for i, m, x in left for j, k, y in right if m == k and (d := (x ^ y).bit_count()) <= 16)


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    docs = make_docs([(1, "one two three four five six seven", None, None)])
    assert D.matches(make_docs([]), items).collect() == []
    assert D.matches(docs, items.limit(0)).collect() == []
    assert D.clean(docs, items.limit(0)).count() == 1 and D.clean(docs, items).count() == 0


def test_recall_near_the_threshold(spark, make_docs):
    """Pairs at 0.8 to 0.86: short and long items, distinct and repeated words, and texts
    whose unshared part is one repeated word."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items, rows = [], []
    for n in range(450):
        size = rng.choice([9, 14, 30, 60, 200])
        item = [word() for _ in range(size)]
        if n % 3 == 0:                                   # phrases repeated within the item
            item = (item[: size // 2] * 2)[:size]
        shingles, kind = size - 4, rng.choice(["tail", "one word", "edit"])
        keep = size - round(shingles * rng.uniform(0.09, 0.115))
        filler = [rng.choice(["of", "the"])] * size if kind == "one word" else [word() for _ in range(size)]
        text = item[:keep] + filler[: size - keep] if kind != "edit" else item[:-1][: max(keep, size - 2)] + filler[:1]
        items.append((n, " ".join(item)))
        rows.append((n, " ".join(text)))
    want = {}
    for (i, t), (k, item) in zip(rows, items):
        want |= {key: v for key, v in brute_whole([(i, t)], [(k, item)]).items() if v[0] <= 0.86}
    assert len(want) > 150
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r["item"]): (round(r.similarity, 9), r.start, r.n_words) for r in D.matches(make_docs([(i, t, None, None) for i, t in rows]), bench).collect()}
    assert all(got[k] == v for k, v in want.items() if k in got)
    assert len(want.keys() & got.keys()) >= 0.99 * len(want)


def test_documents_shorter_than_the_item(spark, make_docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(59)]  # 55 shingles
    again = [word() for _ in range(6)] * 8
    items = [(1, " ".join(item)), (2, " ".join(item[:50])), (3, " ".join(item + [word()])), (4, " ".join(again)), (5, "six words are two short shingles")]
    rows = [(n, " ".join(item[:n])) for n in range(40, 60)]  # 48 words: 44 shingles, 0.8
    rows += [(100 + n, " ".join(item[n:])) for n in range(1, 14)]
    rows += [(200, " ".join([*item[:30], "edited", *item[31:56]])), (201, " ".join([*item[:2], "edited", *item[3:56]])), (300, " ".join(again[:42])),
             (301, " ".join(again[:30])), (400, "six words are two short"), (401, "words are two short shingles"), (402, "four words are few")]
    docs = make_docs([(i, t, None, None) for i, t in rows])
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_whole(rows, items)
    assert {(48, 1), (58, 1), (101, 1), (201, 1), (300, 4), (48, 2)} <= want.keys() and not {(47, 1), (200, 1), (301, 4), (400, 5)} & want.keys()
    assert {(r.id, r["item"]): (round(r.similarity, 9), r.start, r.n_words) for r in D.matches(docs, bench).collect()} == want
    assert {r.doc_id for r in D.clean(docs, bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}
