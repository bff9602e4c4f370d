"""Benchmark decontamination with SimHash windows.

A document is compared with a benchmark item through windows of the item's own
length; a document shorter than the item is one window, as a whole.  Windows and items
get a 64-bit SimHash of their five-word shingles, repeated ones numbered (the weighted
similarity stays what it is, and no shingle dominates the fingerprint).  ``RADIUS + 1`` blocks of the fingerprint
are indexed: two fingerprints within ``RADIUS`` bits agree in one block at
least, so the joins on blocks find every such pair.  Candidates are verified by
the exact weighted Jaccard similarity of their shingles.

Only windows that can reach the threshold are fingerprinted: with similarity s,
a window of w shingles has at least (w + m) s / (1 + s) of them in an item of m.
Shingles are therefore looked up first; this drops no window that could match.

Words: lower-cased runs of letters and digits.  Items and documents of fewer
than five words have no shingle and match nothing, as do null texts.  Rows with
equal ids but different texts are compared each on its own and reported under
their id; repeated rows once.  Items with equal texts are all reported.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import cut, joined

#: Words of a shingle, least similarity, and bits in which fingerprints may differ.
#: At similarity 0.8 fingerprints differ in 9.7 bits, give or take 2.9 (of four and five
#: shingles in 12, give or take 3.1).
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 20

_WORDS = r"[\p{L}\p{N}]+"


def shingles(text: Column) -> Column:
    """64-bit hashes of the text's shingles, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORDS), F.lit(0))
    of = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE),
                               lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
    none = F.array().cast("array<bigint>")
    return F.transform(F.array(words), lambda w: F.when(F.size(w) >= SHINGLE, of(w)).otherwise(none))[0]


def simhash(df: DataFrame, key: str, shingle_col: str) -> DataFrame:
    """(key, fp): the SimHash of each row's shingles, the j-th occurrence of one counting
    as a shingle of its own, so that none outweighs the others.

    A sum counts two bits at once, 32 bits apart."""
    one = (1 << 32) + 1
    sums = [F.sum(F.shiftright("s", j).bitwiseAND(F.lit(one))).alias(f"c{j}") for j in range(32)]
    repeats = F.size(F.array_distinct(shingle_col)) < F.size(shingle_col)
    single = lambda rows: rows.select(key, F.explode(shingle_col).alias("s"))
    times = single(df.where(repeats)).groupBy(key, "s").agg(F.count("*").alias("times"))
    numbered = F.transform(F.sequence(F.lit(1).cast("long"), F.col("times")), lambda j: F.when(j == 1, F.col("s")).otherwise(F.xxhash64("s", j)))
    each = single(df.where(~repeats)).unionByName(times.select(key, F.explode(numbered).alias("s")))
    counted = each.groupBy(key).agg(F.count("*").alias("n"), *sums)
    fp = F.lit(0).cast("long")
    for j in range(32):
        low, high = F.col(f"c{j}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright(f"c{j}", 32)
        for bit, ones in ((j, low), (j + 32, high)):
            fp = fp.bitwiseOR(F.shiftleft((ones * 2 > F.col("n")).cast("long"), bit))
    return counted.select(key, fp.alias("fp"))


def masks(radius: int) -> list[int]:
    """``radius + 1`` masks that part 64 bits, as signed longs."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in bits]


def within_radius(left: DataFrame, right: DataFrame, radius: int, right_rows: int) -> DataFrame:
    """Pairs of rows of equal ``m`` whose fingerprints differ in at most ``radius``
    bits; each pair once.  ``left(l, m, fp)``, ``right(r, m, fp)``."""
    blocks = F.array(*[F.lit(m) for m in masks(radius)])
    part = lambda d, fp: d.select("*", F.posexplode(F.transform(blocks, lambda m: F.col(fp).bitwiseAND(m))).alias("block", "value"))
    met = joined(part(left, "fp"), part(right.withColumnRenamed("fp", "fp_r"), "fp_r"), ["m", "block", "value"], "inner",
                 right_rows * (radius + 1), 64)
    differ = F.col("fp").bitwiseXOR(F.col("fp_r"))
    first = F.array_position(F.transform(blocks, lambda m: differ.bitwiseAND(m) == 0), True) - 1
    return met.filter((F.bit_count(differ) <= radius) & (first == F.col("block"))) \
        .select("l", "r", F.bit_count(differ).alias("distance"))


def common(a: str, b: str) -> Column:
    """Size of the intersection of two arrays as multisets."""
    both = F.array_intersect(a, b)
    times = lambda c, x: F.size(F.filter(c, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(both)).otherwise(F.aggregate(both, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))))


def starts(places: str, m: Column, n: Column, least: Column) -> Column:
    """Starts of windows of ``m`` shingles, among ``n``, that hold at least
    ``least`` of the sorted ``places``; with fewer than ``m`` the only start is 0."""
    p = lambda i: F.get(F.col(places), i)
    final = F.greatest(n - m, F.lit(0))
    span = lambda i: F.sequence(F.greatest(p(i + least - 1) - m + 1, F.lit(0)), F.least(p(i), final))
    some = F.filter(F.sequence(F.lit(0), F.size(places) - least), lambda i: F.greatest(p(i + least - 1) - m + 1, F.lit(0)) <= F.least(p(i), final))
    return F.array_distinct(F.flatten(F.transform(some, span)))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(key, id, item, start, n_words, similarity, distance): for each document and
    item the most similar window, the first of equals.  ``key``: see ``row_key``."""
    marks = cut(items.select(F.col(item_col).alias("item"), shingles(F.col(item_text)).alias("item_shingles"))
                .withColumn("m", F.size("item_shingles")).filter("m > 0").distinct()
                .withColumn("r", F.xxhash64("item", "item_shingles")))
    known = cut(marks.select(F.explode("item_shingles").alias("s"), "m").distinct())
    n_known, sizes = known.count(), marks.agg(F.count("*").alias("n"), F.sum(F.lit(64) + 8 * F.col("m") + F.coalesce(F.octet_length(
        F.col("item").cast("string")), F.lit(0))).alias("bytes")).first()
    n_items = sizes.n
    least = F.ceil((F.least("n", "m") + F.col("m")) * (similarity / (1 + similarity)) - 1e-9).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    # documents' shingles that some item has, and the sizes where they are dense enough
    seen = rows.select("key", shingles(F.col("text")).alias("shingles")).select("key", F.size("shingles").alias("n"), "shingles") \
        .select("key", "n", F.posexplode("shingles").alias("place", "s"))
    dense = joined(seen, known, "s", "inner", n_known, 48).groupBy("key", "m").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_set("place")).alias("places")).filter(F.size("places") >= least)
    dense = cut(dense.groupBy("key").agg(F.collect_list(F.struct("m", "places")).alias("sizes")))
    size = dense.agg(F.count("*").alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + F.size(x["places"]))).alias("p")).first()
    back = joined(rows.filter("text is not null"), dense, "key", "inner", size.n + (size.p or 0) // 8, 96).dropDuplicates(["key"])
    windows = back.select("key", "id", shingles(F.col("text")).alias("shingles"), F.explode("sizes").alias("x")) \
        .select("key", "id", "shingles", F.size("shingles").alias("n"), "x.m", "x.places") \
        .withColumn("start", F.explode(starts("places", F.col("m"), F.col("n"), least))) \
        .withColumn("window", F.expr("slice(shingles, start + 1, m)"))
    windows = cut(windows.select("key", "id", "m", "start", "window", F.xxhash64("window").alias("l")))
    # equal windows are fingerprinted once and compared once with the items of a size
    texts = windows.groupBy("l").agg(F.first("window").alias("window"), F.collect_set("m").alias("sizes"))
    prints = simhash(texts, "l", "window").join(texts.select("l", F.explode("sizes").alias("m")), "l")
    near = within_radius(prints, simhash(marks, "r", "item_shingles").join(marks.select("r", "m"), "r"), radius, n_items)
    shared = common("window", "item_shingles")
    alike = joined(near.join(texts.select("l", "window"), "l"), marks.select("r", "item", "item_shingles"), "r", "inner", sizes.bytes or 0, 1) \
        .withColumn("similarity", shared / (F.size("window") + F.size("item_shingles") - shared)) \
        .filter(F.col("similarity") >= similarity).select("l", "item", "similarity", "distance")
    best = F.min(F.struct((-F.col("similarity")).alias("unlike"), "start", "size", "distance"))
    held = windows.select("l", "key", "id", F.size("window").alias("size"), "start").distinct()
    return held.join(alike, "l").groupBy("key", "id", "item").agg(best.alias("b")) \
        .select("key", "id", "item", F.col("b.start").alias("start"), (F.col("b.size") + SHINGLE - 1).alias("n_words"),
                (-F.col("b.unlike")).alias("similarity"), F.col("b.distance").alias("distance"))


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart whose ids are equal and texts are not."""
    return F.xxhash64(id_col, text_col)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    found = cut(matches(docs, items, id_col, text_col).select(F.col("key").alias("__leak")).distinct())
    key = row_key(id_col, text_col)
    side = F.broadcast(found) if found.count() * 16 <= 32 << 20 else found
    return docs.join(side, key == F.col("__leak"), "left_anti")
