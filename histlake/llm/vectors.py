"""Integer vectors shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import cut


def complete(vector: str) -> Column:
    """True for a vector that is not null and has no null or non-finite component."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(F.exists(F.col(vector).cast("array<double>"), odd), F.lit(False))


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, as longs; too large ones stop at a long's ends."""
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """A list column without nulls as rows of ``width``, shorter ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths(), dtype=np.int64)
    flat = np.asarray(column.flatten()).astype(dtype, copy=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds ``out``, each row's place from 0 in ``order``, without one global sort task."""
    dealt = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # a row per partition
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return dealt.withColumn("__within", within).join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part") \
        .withColumn(out, F.col("__before") + F.col("__within")).drop("__part", "__within", "__before")
