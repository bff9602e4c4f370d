"""Order MinHash: fingerprints that are sensitive to edit distance.

A text's tokens (runs of up to ``TOKEN`` non-space characters) give k-mers of
``K`` tokens, each numbered by its occurrence in the text.  Every numbered
k-mer has one hash, whose top bits deal it to one of ``BINS`` bins (the
one-permutation form of MinHash: a bin stands for a permutation).  In each bin
the ``L`` k-mers of smallest hash are put back in text order and their tuple is
hashed.  The likeness of two fingerprints is the share of equal tuples among
bins that are not empty in both.

DataFrame functions only; every step is linear in the text but for two sorts
of its k-mers.  Fingerprints need no shuffle.

A null text counts as empty.  Texts without a token have the fingerprint of
zeros, whose likeness to itself is 1 and to others 0.  Equal texts have equal
fingerprints.  Repeated ids are ordered by text; null ids come last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a token, tokens of a k-mer, bins, and k-mers of a bin's tuple.
TOKEN, K, BINS, L = 8, 2, 32, 2

#: Bits of a packed element that hold its position; 32 hash bits stand above.
POSITION = 31
_BIN = POSITION + 32 - int(math.log2(BINS))
EMPTY = "0" * 8


def _pack(hashed: Column, position: Column) -> Column:
    """Non-negative long: the hash's upper 32 bits, then the position."""
    return F.shiftleft(F.shiftrightunsigned(hashed, 32), POSITION).bitwiseOR(position.cast("long"))


def _id(x: Column) -> Column:
    return F.shiftright(x, POSITION)


def _position(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << POSITION) - 1))


def _bin(x: Column) -> Column:
    return F.shiftright(x, _BIN)


def with_fingerprint(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """``docs`` with the fingerprint of ``text_col``, 8 hex digits a bin."""
    tok, kmers, runs, chosen = (f"__omh_{c}" for c in ("tok", "kmers", "runs", "chosen"))
    df = docs.withColumn(tok, F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(rf"\S{{1,{TOKEN}}}"), F.lit(0)))
    # k-mers in order of their hash; those of one hash stand together, by position
    last = F.size(tok) - K
    hashed = F.when(F.size(tok) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: _pack(F.xxhash64(*[F.coalesce(F.get(tok, i + j), F.lit("")) for j in range(K)]), i)))
    df = df.withColumn(kmers, F.sort_array(hashed)).drop(tok)
    # where each run of one k-mer starts
    df = df.withColumn(runs, F.filter(
        F.when(F.size(kmers) > 0, F.sequence(F.lit(0), F.size(kmers) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (_id(F.get(kmers, i)) != _id(F.get(kmers, i - 1)))))
    # number the occurrences, hash them, and sort by bin and hash
    numbered = F.flatten(F.transform(runs, lambda start, r: F.transform(
        F.slice(kmers, start + 1, F.coalesce(F.get(runs, r + 1), F.size(kmers)) - start),
        lambda x, nth: _pack(F.xxhash64(_id(x), nth), _position(x)))))
    df = df.withColumn(kmers, F.sort_array(numbered)).drop(runs)
    # the L smallest of each bin
    df = df.withColumn(chosen, F.filter(
        kmers, lambda x, i: (i < L) | (_bin(x) != _bin(F.get(kmers, i - L))))).drop(kmers)

    def of_bin(b: Column) -> Column:
        ordered = F.array_sort(F.transform(F.filter(chosen, lambda x: _bin(x) == b), lambda x: F.struct(_position(x).alias("p"), _id(x).alias("id"))))
        tuple_hash = F.aggregate(ordered, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x["id"]))
        digits = F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.nullif(tuple_hash, F.lit(0)), 32))), 8, "0")
        return F.coalesce(digits, F.lit(EMPTY))

    return df.withColumn(out, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), of_bin), "")).drop(chosen)


def likeness(a: str, b: str) -> Column:
    """Share of equal tuples among the bins that are not empty in both."""
    part = lambda c, i: F.substring(F.col(c), i * 8 + 1, F.lit(8))
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    used = F.size(F.filter(bins, lambda i: (part(a, i) != EMPTY) | (part(b, i) != EMPTY)))
    same = F.size(F.filter(bins, lambda i: (part(a, i) != EMPTY) & (part(a, i) == part(b, i))))
    return F.when(used == 0, 1.0).otherwise(same / used)


def with_next(docs: DataFrame, id_col: str, cols: dict[str, str], parts: int) -> DataFrame:
    """``docs`` with columns of the next row by id (after the last: the first).

    Rows are dealt to id ranges cut at ids of the data, so a range's first rows
    are known by their id alone; each also goes to the end of the range before
    it.  One shuffle, no global sort in a task."""
    cuts = docs.agg(F.percentile_approx(id_col, [i / parts for i in range(parts)], 50 * parts)).first()[0]
    cuts = sorted(set(cuts or []))
    n = max(1, len(cuts))
    step = max(1, math.isqrt(n))
    here = F.lit(0)
    if n > 1:  # two short searches: which block of cuts, which cut in it
        blocks = [cuts[i:i + step] for i in range(0, n, step)]
        low = F.array(*[F.lit(b[0]) for b in blocks])
        below = F.size(F.filter(low, lambda c: c <= F.col(id_col))) - 1
        inner = F.get(F.array(*[F.array(*map(F.lit, b + [None] * (step - len(b)))) for b in blocks]), F.greatest(below, F.lit(0)))
        here = F.greatest(F.lit(0), below) * step + F.size(F.filter(inner, lambda c: c <= F.col(id_col))) - 1
        here = F.when(F.col(id_col).isNull(), n - 1).otherwise(F.greatest(here, F.lit(0)))
    df = docs.withColumn("__part", here.cast("int"))
    if n > 1:
        first = F.col(id_col) == F.get(F.array(*map(F.lit, cuts)), F.col("__part"))
        before = F.struct((F.pmod(F.col("__part") - 1, F.lit(n))).cast("int").alias("part"), F.lit(True).alias("guard"))
        own = F.struct(F.col("__part").alias("part"), F.lit(False).alias("guard"))
        df = df.withColumn("__to", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own)))) \
            .withColumn("__part", F.col("__to.part")).withColumn("__guard", F.col("__to.guard")).drop("__to")
    else:
        df = df.withColumn("__guard", F.lit(False))
    w = Window.partitionBy("__part").orderBy("__guard", F.col(id_col).asc_nulls_last(), *cols)
    if n > 1:
        df = df.withColumns({new: F.lead(c).over(w) for c, new in cols.items()})
    else:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        df = df.withColumn("__first", F.first(F.struct(*cols)).over(whole)).withColumn("__last", F.lead(F.lit(1)).over(w).isNull()) \
            .withColumns({new: F.when(F.col("__last"), F.col("__first")[c]).otherwise(F.lead(c).over(w)) for c, new in cols.items()}) \
            .drop("__first", "__last")
    return df.filter(~F.col("__guard")).drop("__part", "__guard")
