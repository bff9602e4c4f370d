import hashlib
import random
import re
import struct

import xxhash
from histlake.llm import order_minhash as O
from histlake.llm import queries
from histlake.llm.common import table


def _hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else struct.pack("<i" if isinstance(value, Int) else "<q", value)
    return xxhash.xxh64_intdigest(data, seed=seed & (2**64 - 1))


class Int(int):
    """Marks a 32-bit column."""


def chained(*values):
    seed = 42
    for v in values:
        seed = _hash(v, seed)
    return seed


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def brute(text):
    """The fingerprint by its definition."""
    tok = re.findall(rf"[^ \t\n\x0b\f\r]{{1,{O.TOKEN}}}", text or "")
    grams = [tok[i:i + O.K] + [""] * (O.K - len(tok[i:i + O.K])) for i in range(max(1, len(tok) - O.K + 1))] if tok else []
    seen, bins = {}, {}
    for at, g in enumerate(grams):
        name = chained(*g) >> 32
        nth = seen[name] = seen.get(name, -1) + 1
        h = chained(name, Int(nth)) >> 32
        bins.setdefault(h >> 27, []).append((h, at))
    out = []
    for b in range(O.BINS):
        value = 0
        for h, _ in sorted(sorted(bins.get(b, []))[:O.L], key=lambda x: x[1]):
            value = signed(chained(signed(value), h))
        out.append(f"{(value % 2**64) >> 32:08x}" if bins.get(b) else O.EMPTY)
    return "".join(out)


def like(a, b):
    pairs = [(a[i:i + 8], b[i:i + 8]) for i in range(0, len(a), 8)]
    used = [p for p in pairs if p != (O.EMPTY, O.EMPTY)]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_query_matches_brute_force(spark, sf):
    docs = sorted(table(spark, sf, "documents").collect(), key=lambda r: r.doc_id)
    texts = [d.text or "" for d in docs]
    got = {r.doc_id: r for r in queries.op10_order_minhash(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, (d, t) in enumerate(zip(docs, texts)):
        after = texts[(i + 1) % len(texts)]
        edited = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == brute(t) and r.edited_fingerprint == brute(edited)
        assert abs(r.near_edited - like(brute(t), brute(edited))) < 1e-12
        assert abs(r.near_next - like(brute(t), brute(after))) < 1e-12


def test_fingerprints_of_odd_texts(spark):
    texts = [None, "", " \n\t", "one", "one two", "é" * 20, "x" * 70_000, "again and " * 20_000, "one", "😀 b 😀 b 😀 b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").selectExpr("*", "'clash' as part", "1 as n")
    got = {r.i: r.fp for r in O.with_fingerprint(df, "text", "fp").collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    near = words[:200] + ["new"] + words[200:]
    moved = [w for i in range(0, 400, 20) for w in reversed(words[i:i + 20])]
    df = spark.createDataFrame([(" ".join(words), " ".join(near), " ".join(moved))], "a string, b string, c string")
    for c in "abc":
        df = O.with_fingerprint(df, c, f"f{c}")
    r = df.select(O.likeness("fa", "fb").alias("near"), O.likeness("fa", "fc").alias("moved")).first()
    assert r.near > 0.9 and r.moved < 0.2


def test_next_row_over_ranges(spark):
    rng = random.Random(5)
    ids = rng.sample(range(-500, 10_000), 700) + [7_777_777]
    rows = [(i, f"t{i}") for i in ids] + [(None, "null id")]
    for n, parts in ((1, 4), (2, 4), (30, 7), (len(rows), 16), (len(rows), 1)):
        part = rows[-n:]
        df = spark.createDataFrame(part, "id long, text string").repartition(5)
        got = {r.text: r.after for r in O.with_next(df, "id", {"text": "after"}, parts).collect()}
        order = [t for _, t in sorted(part, key=lambda r: (r[0] is None, r[0] or 0))]
        assert got == {t: order[(i + 1) % len(order)] for i, t in enumerate(order)}
    same = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "id long, text string")
    got = sorted((r.text, r.after) for r in O.with_next(same, "id", {"text": "after"}, 3).collect())
    assert got == [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c")]
    assert O.with_next(same.limit(0), "id", {"text": "after"}, 3).collect() == []
