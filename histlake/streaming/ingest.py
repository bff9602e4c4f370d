"""Streaming file ingest (S1, S5, ST1, ST6)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from histlake.sources.append import AppendTable
from histlake.sources.layout import dealt
from histlake.sources.readers import read_stream, with_file_path


#: Bytes of a staged file's row groups: the least that Spark makes a split of.
ROW_GROUP = 4 << 20
#: Rows that an intermediate result's partition is worth having for.
PART_ROWS = 100_000


def few_parts(df: DataFrame, at_most: int = 0) -> DataFrame:
    """``df``, of at most that many rows, without partitions that they are not worth; two a
    core stay.  A shuffle of it may write a file for each of them and each of its own."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-at_most // PART_ROWS)))


def stage_files(df: DataFrame, path: str, files: int, order_by: str | None = None) -> str:
    """Write ``df`` as ``files`` Parquet files (a staging area to replay).
    With ``order_by`` each file holds one range of that column, otherwise
    rows are spread by hash, so files arrive out of sequence order.  A row group is
    never read by two tasks: small ones let a micro-batch of one file use every core."""
    staged = dealt(df, [order_by], files, spread=False) if order_by else df.repartition(files)
    staged.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)
    return path


def run_to_completion(writer) -> None:
    """Start a triggered query (``availableNow``) and wait for it: every file
    present at start is processed, in as many micro-batches as the source
    options allow, and the query stops."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(str(err))


def ingest_stream(spark: SparkSession, staging: str, schema: StructType, sink: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, max_files_per_trigger: int | None = None,
                  cluster_by: Sequence[str] = (), file_col: str | None = None, also: Sequence[Callable[[DataFrame, int], None]] = ()) -> AppendTable:
    """Incremental staging -> append-only table with a stateless transform (bronze
    ingest), laid out by ``cluster_by`` and compacted as it grows.

    The checkpoint records processed files and each commit the micro-batch it holds, so
    re-running adds nothing and a restarted job resumes exactly.  ``also``: further
    sinks that take the same micro-batch (rows, epoch), so that none is ever ahead of
    the others by more than a batch; each has to take a replay as a no-op.  ``file_col``
    keeps every row's file, so that ``unread_files`` can tell what has not arrived."""
    table = AppendTable(spark, sink, cluster_by)

    def write(batch: DataFrame, epoch: int) -> None:
        rows = table.append(transform(batch) if transform else batch, checkpoint, epoch)
        for take in also:
            take(rows, epoch)

    src = read_stream(spark, staging, schema, max_files_per_trigger=max_files_per_trigger)
    src = with_file_path(src, file_col) if file_col else src
    run_to_completion(src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    return table
