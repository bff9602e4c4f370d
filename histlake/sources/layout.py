"""Multi-column file layout along a space-filling curve.

A linear order by (a, b) prunes by ``a`` only: every file holds nearly all values of ``b``.
Here each column's value becomes its rank among up to ``2 ** bits`` ranges of about equal row
counts, and the ranks' bits are interleaved into one long (Z-order).  Files that follow
this key cover a narrow range of *every* column, so Parquet's minima and maxima skip
row groups whichever of the columns a filter names.

The ranges' cut points come from a bounded sample (``SAMPLE_ROWS`` rows); they decide
how good the layout is, never what is in it.  All of it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Rows that the cut points come from, and the most ranges of a column as a power of two.
SAMPLE_ROWS, BITS = 8192, 8
#: Up to so many ranges, of columns of these types, are told apart by comparisons written out one by one.
MAX_BOUNDS, ORDERED = 64, (BooleanType, NumericType, StringType, DateType, TimestampType, TimestampNTZType)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row (maps aside, which have none): spreads equal values."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def sampled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """These columns of at most ``SAMPLE_ROWS`` rows; no other column is worked out for it."""
    return df.select(*cols).withColumn("_h", F.rand(0)).orderBy("_h").limit(SAMPLE_ROWS).drop("_h")


def cut_points(df: DataFrame, cols: Sequence[str], bits: int) -> list[list]:
    """Per column the distinct values that part the sampled rows evenly, ascending."""
    some = sampled(df, cols).collect()
    points = []
    for c in cols:
        values = sorted(v for v in (r[c] for r in some) if v is not None and v == v)
        n = 1 << bits
        points.append(sorted({values[i * len(values) // n] for i in range(1, n)}) if values else [])
    return points


def range_rank(x: Column, points: list) -> Column:
    """How many of ``points`` are at most ``x``; null is rank 0.  A binary search by powers of two."""
    if not points:
        return F.lit(0)
    at = F.array(*[F.lit(p) for p in points])
    steps = [1 << b for b in range((len(points)).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda rank, s: F.when(F.try_element_at(at, rank + s) <= x, rank + s).otherwise(rank))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits in turn, the highest first: one long."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(ranks):
            bit = F.shiftright(r.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - i))
    return out


def curve_key(df: DataFrame, cols: Sequence[str], bits: int | None = None) -> Column:
    """Place of a row of ``df`` on the Z-order curve over ``cols`` (at most 63 bits together)."""
    cols = list(cols)
    bits = bits or min(BITS, 63 // len(cols))
    if bits * len(cols) > 63 or not bits:
        raise ValueError(f"{len(cols)} columns of {bits} bits do not fit a long")
    return interleaved([range_rank(F.col(c), p) for c, p in zip(cols, cut_points(df, cols, bits))], bits)


def along_curve(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted along the curve.  A place that many rows share is
    spread over partitions by the row's hash."""
    z, by = curve_key(df, cols), [F.col("_z"), row_hash(df)]
    placed = df.withColumn("_z", z)
    ranged = dealt(placed, ["_z"], partitions, sample=sampled(df, cols).select(z.alias("_z"))) if partitions else placed.repartitionByRange(*by)
    return ranged.sortWithinPartitions("_z").drop("_z")


def dealt(df: DataFrame, by: Sequence[str], partitions: int, spread: bool = True, sample: DataFrame | None = None) -> DataFrame:
    """``df`` in ``partitions`` ranges of the columns ``by``, like ``repartitionByRange`` but with
    bounds from a sample of these columns alone: ``repartitionByRange`` works out all of
    ``df`` once more for its own.  With ``spread`` a value that fills more than a
    partition is dealt by the row's hash over those it fills; else equal values stay together.
    ``sample``: ``by`` of some rows, if the caller has them for less."""
    keys = [F.col(c) for c in by]
    kinds = {f.name: f.dataType for f in df.select(*by).schema.fields}
    if partitions < 2:
        return df.repartition(1)
    if partitions > MAX_BOUNDS or not all(isinstance(k, ORDERED) for k in kinds.values()):  # no literals, or too many
        return df.repartitionByRange(partitions, *keys, *([row_hash(df)] if spread else []))
    some = (sampled(df, by) if sample is None else sample).orderBy(*by).collect()
    bounds = [tuple(some[i * len(some) // partitions][c] for c in by) for i in range(1, partitions)] if some else []
    upto: dict[tuple, int] = {}  # bounds up to each distinct one, ascending
    for i, b in enumerate(bounds):
        upto[b] = i + 1
    kept, counts = list(upto), [0, *upto.values()]
    key = F.struct(*keys)
    literal = [F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for v, c in zip(b, by)]) for b in kept]

    def place(a: int, z: int) -> Column:
        """The partition of a row that is at or after ``a`` and before more than ``z`` of the bounds."""
        if a < z:
            middle = (a + z + 1) // 2
            return F.when(key < literal[middle - 1], place(a, middle - 1)).otherwise(place(middle, z))
        first, last = counts[max(a - 1, 0)], counts[a]
        if not spread or last - first < 2:
            return F.lit(last)
        return F.when(key == literal[a - 1], first + F.pmod(row_hash(df), F.lit(last - first + 1)).cast("int")).otherwise(F.lit(last))

    return df.repartitionById(partitions, place(0, len(kept)))


def ranked_within(df: DataFrame, group: str, order: Sequence[Column], out: str) -> DataFrame:
    """Adds ``out``, each row's place from 0 within its ``group``, in ``order``.

    Rows are range-partitioned by (group, order), so a group of any size lies in as many
    partitions as it fills and none is sorted by one task.  Only groups that go over a
    partition's end need an offset; there are at most as many (group, partition) pairs of
    those as twice the partitions, which is what is broadcast."""
    from histlake.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    by = [F.col(group).asc_nulls_first(), *order]
    dealt = df.repartitionByRange(*by, row_hash(df)).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy(F.struct(group).alias("_g"), "_part").agg(F.count("*").alias("_n"))
    ends = dealt.groupBy("_part").agg(F.array_distinct(F.array(F.min(F.struct(F.col(group).isNotNull(), group)),
                                                              F.max(F.struct(F.col(group).isNotNull(), group)))).alias("_e"))
    ends = ends.select("_part", F.explode("_e").alias("_e")).select("_part", F.struct(F.col("_e").getField(group).alias(group)).alias("_g"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.join(F.broadcast(ends), ["_g", "_part"]).withColumn("_before", before).where("_before is not null").drop("_n")
    within = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1
    placed = dealt.withColumns({"_within": within, "_g": F.struct(group)}).join(F.broadcast(offsets), ["_g", "_part"], "left")
    return placed.withColumn(out, F.col("_within") + F.coalesce("_before", F.lit(0))).drop("_g", "_part", "_within", "_before")
