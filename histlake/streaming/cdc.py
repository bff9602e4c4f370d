"""SCD1 / SCD2 maintained from a stream (SC1, SC2, ST5, D3).

Each micro-batch writes what it changes and nothing else: SCD2 by interval merge
(``streaming.history``), SCD1 by comparing the batch's latest rows with the stored rows
of the same keys.  Both targets are ``KeyedTable`` s: a commit names the micro-batch it
holds, so a replay after a failure between write and checkpoint is a no-op.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.joins import broadcast_if_small
from histlake.operators.scd import scd1
from histlake.sources.keyed import KeyedTable, key_struct
from histlake.streaming.history import History
from histlake.streaming.ingest import run_to_completion


def apply_latest(table: KeyedTable, batch: DataFrame, sequence_by: str, tie_break: Sequence[str] | None = None,
                 source: str | None = None, epoch: int | None = None) -> None:
    """Folds a batch into the latest rows; stored rows that stay the latest are not written."""
    if source is not None and table.seen(source, epoch):
        return
    kept = [scd1(batch, table.ids, sequence_by, tie_break).persist()]
    latest = kept[0]
    if table.log.state() is not None:
        keyed = lambda df: df.withColumn("_k", key_struct(table.ids))
        keys = broadcast_if_small(keyed(latest).select("_k"), known_rows=latest.count())
        stored = keyed(table.read()).join(keys, "_k", "left_semi").drop("_k").persist()
        kept.append(stored)
        both = scd1(latest.unionByName(stored), table.ids, sequence_by, tie_break)
        whole = lambda df, name: keyed(df).select("_k", F.struct(*latest.columns).alias(name))
        both = whole(both, "_new").join(whole(stored, "_old"), "_k", "left")
        latest = both.where(~F.col("_new").eqNullSafe(F.col("_old"))).select("_new.*")
    table.upsert(latest, source, epoch)
    for df in kept:
        df.unpersist()
    table.compact()


def scd_stream(spark: SparkSession, src: DataFrame, keys: Sequence[str], sequence_by: str,
               target: str, checkpoint: str, scd_type: int = 2,
               track: Sequence[str] | None = None, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Run the SCD maintenance over every file of ``src`` available now; returns
    the table as of the last commit (a ``FileNotFoundError`` before the first)."""
    if scd_type == 1:
        table = KeyedTable(spark, target, keys)

        def write(batch: DataFrame, epoch: int) -> None:
            apply_latest(table, batch, sequence_by, tie_break, checkpoint, epoch)
    else:
        table = History(spark, target, keys, sequence_by, track, tie_break)

        def write(batch: DataFrame, epoch: int) -> None:
            table.apply(batch, checkpoint, epoch)

    run_to_completion(src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    return table.read()
