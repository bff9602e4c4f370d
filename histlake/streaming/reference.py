"""Streaming reference tables (ST2, ST3, ST4, A20, U3, J5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.reference import new_keys_only
from histlake.sources.writers import materialize
from histlake.streaming.ingest import run_to_completion


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The target table if it exists, else an empty DataFrame *with* the
    schema - no eager count, and only a missing path is treated as empty
    (any other error propagates)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def grouped_max_stream(src: DataFrame, name_col: str, target: str, checkpoint: str,
                       enrich: Callable[[DataFrame], DataFrame] | None = None,
                       status_col: str = "run_status", ok_value: str = "OK") -> str:
    """Streaming grouped maxima of OK runs (ST2): a stateful aggregate in
    ``complete`` mode, one row per name (state bounded by the name count).
    Each micro-batch's full result replaces the target; ``enrich`` (e.g. a
    dictionary translation) runs on that small result."""
    agg = (src.where(F.col(status_col) == F.lit(ok_value))
           .groupBy(name_col)
           .agg(F.max("source_update").alias("last_source_update"),
                F.max("checked_at").alias("last_checked_at")))

    def write(batch: DataFrame, epoch: int) -> None:
        materialize(enrich(batch) if enrich else batch, target)  # beside it, then in its place

    run_to_completion(agg.writeStream.outputMode("complete").foreachBatch(write)
                      .option("checkpointLocation", checkpoint))
    return target


def add_new_keys(spark: SparkSession, batch: DataFrame, key_col: str, seen_col: str | None, target: str,
                 enrich: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Appends the batch's distinct keys (with the earliest ``seen_col``) that the target
    does not have.  A known key costs no enrichment, and a replayed batch finds its keys
    present and adds nothing, so the sink stays exactly-once without transactions."""
    known = batch.where(F.col(key_col).isNotNull())
    keys = known.groupBy(key_col).agg(F.min(seen_col).alias(seen_col)) if seen_col else known.select(key_col).distinct()
    new = new_keys_only(keys, _read_or_empty(spark, target, keys.schema), [key_col])
    (enrich(new) if enrich else new).write.mode("append").parquet(target)


def distinct_stream(spark: SparkSession, src: DataFrame, key_col: str, target: str, checkpoint: str) -> str:
    """Streaming distinct by key (ST3, U3) without state: what has been seen is the sink
    itself, looked up by an anti join per micro-batch, so nothing grows but the table."""
    def write(batch: DataFrame, epoch: int) -> None:
        add_new_keys(spark, batch, key_col, None, target)

    run_to_completion(src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    return target


def new_keys_stream(spark: SparkSession, src: DataFrame, key_col: str, seen_col: str,
                    target: str, checkpoint: str,
                    enrich: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Only-new-keys maintenance (ST4, J5): ``add_new_keys`` per micro-batch."""
    def write(batch: DataFrame, epoch: int) -> None:
        add_new_keys(spark, batch, key_col, seen_col, target, enrich)

    run_to_completion(src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    return target
