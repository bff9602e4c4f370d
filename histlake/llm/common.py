"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.session import checkpoint_root

#: A side is broadcast only if its measured size stays below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives lost executors)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id's text leaves 2 modulo 4; a null
    id's row is none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def joined(left: DataFrame, small: DataFrame, on: str | list[str], how: str, rows: int, row_bytes: int) -> DataFrame:
    """Join that broadcasts ``small`` if its measured ``rows`` times ``row_bytes``
    stay under ``BROADCAST_BYTES``; a shuffled join otherwise.  Same result."""
    return left.join(F.broadcast(small) if rows * row_bytes <= BROADCAST_BYTES else small, on, how)
