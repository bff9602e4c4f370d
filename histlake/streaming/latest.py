"""The latest row per key from keyed state (SC1, ST5).

The state store holds one entry a key, its latest row; a micro-batch reads and writes the
keys it has and nothing else, whatever the history.  What changed goes out in update
mode and is upserted into a ``KeyedTable``.  ``streaming.cdc.scd_stream(scd_type=1)`` gives
the same table by reading the target instead of a state store.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from histlake.operators.scd import _tie_cols
from histlake.session import checkpoint_root
from histlake.sources.keyed import KeyedTable
from histlake.streaming.ingest import few_parts, run_to_completion

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Bytes that a task looks for equal keys in at a time, and rows it hands on at a time.
HELD, BATCH = 1 << 25, 10_000
#: Groups that keys are dealt to.  Stored state has this number: another needs a new checkpoint.
GROUPS = 1 << 14


def rank(value):
    """Spark's order in Python: null first, NaN last, structs by their fields."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    if isinstance(value, dict):
        return (1, tuple(rank(v) for v in value.values()))
    if isinstance(value, (tuple, list)):
        return (1, tuple(rank(v) for v in value))
    return (1, value)


class LatestRow(StatefulProcessor):
    """Keeps the largest row by ``order`` of each key; emits it when it changes.

    Rows come by groups of keys.  Each key is an entry of its group's map: only the keys
    that a micro-batch has are read and written, each by one round trip to the store."""

    def __init__(self, schema: StructType, keys: Sequence[str], order: Sequence[str]):
        self.schema, self.key_schema = schema, StructType([schema[k] for k in keys])
        self.keys, self.at = ([schema.fieldNames().index(c) for c in cols] for cols in (keys, order))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getMapState("latest", self.key_schema, self.schema)

    def _rank(self, row) -> tuple:
        return tuple(rank(row[i]) for i in self.at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best: dict = {}
        for row in rows:
            row = tuple(row)[:len(self.schema)]
            same = tuple(rank(row[i]) for i in self.keys)
            if same not in best or self._rank(row) > self._rank(best[same]):
                best[same] = row
        names = self.schema.fieldNames()
        for row in best.values():
            at = tuple(row[i] + 0.0 if isinstance(row[i], float) else row[i] for i in self.keys)  # -0.0 is 0.0
            stored = self.latest.getValue(at)
            if stored is None or self._rank(row) > self._rank(stored):
                self.latest.updateValue(at, row)
                yield Row(**dict(zip(names, row)))

    def close(self) -> None:
        pass


def _sortable(kind: pa.DataType) -> bool:
    t = pa.types
    return any(is_one(kind) for is_one in (t.is_boolean, t.is_integer, t.is_floating, t.is_decimal, t.is_date, t.is_timestamp, t.is_string, t.is_large_string,
                                           t.is_binary, t.is_large_binary))


def _by_sorting(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    """The largest row of each key: the first one of it after a sort."""
    by, columns = [], {}
    for i, c in enumerate([*keys, *order]):
        way = "ascending" if i < len(keys) else "descending"
        if pa.types.is_floating(rows.schema.field(c).type):  # Arrow puts NaN behind all numbers, whichever the way
            columns[f"nan{i}"] = pc.is_nan(rows[c])
            by.append((f"nan{i}", way))
        columns[f"c{i}"] = rows[c]
        by.append((f"c{i}", way))
    rows = rows.take(pc.sort_indices(pa.table(columns), sort_keys=by, null_placement="at_end")).combine_chunks()
    first = np.zeros(len(rows), bool)
    first[:1] = True
    for k in keys:
        now, before = rows[k].slice(1), rows[k].slice(0, max(len(rows) - 1, 0))
        other = pc.or_(pc.xor(pc.is_null(now), pc.is_null(before)), pc.fill_null(pc.not_equal(now, before), False))
        first[1:] |= other.to_numpy(zero_copy_only=False)
    return rows.filter(pa.array(first))


def _by_rank(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    """The same for columns that Arrow does not sort by."""
    found: dict = {}
    ids = zip(*[rows[k].to_pylist() for k in keys])
    for i, (key, values) in enumerate(zip(ids, zip(*[rows[c].to_pylist() for c in order]))):
        values = tuple(rank(v) for v in values)
        key = tuple(rank(k) for k in key)
        if key not in found or values > found[key][0]:
            found[key] = (values, i)
    return rows.take(pa.array([i for _, i in found.values()], pa.int64()))


def combined(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The largest row of each key within ``HELD`` bytes of a partition, so that the rows of a
    key shrink where they are read."""
    keys, order = list(keys), list(order)

    def largest(batches: list[pa.RecordBatch]) -> pa.Table:
        rows = pa.Table.from_batches(batches)
        plain = all(_sortable(rows.schema.field(c).type) for c in [*keys, *order])
        return (_by_sorting if plain else _by_rank)(rows, keys, order)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += batch.nbytes
            if size >= HELD:
                rows = largest(kept)
                kept, size = rows.to_batches(), rows.nbytes
                if size > HELD // 2:  # keys that do not repeat
                    yield from rows.to_batches(max_chunksize=BATCH)
                    kept, size = [], 0
        if kept:
            yield from largest(kept).to_batches(max_chunksize=BATCH)

    return df.mapInArrow(best, df.schema)


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside use the state store that keyed state needs; the session's
    setting is as before afterwards (a query keeps its own copy)."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def latest_stream(spark: SparkSession, src: DataFrame, keys: Sequence[str], sequence_by: str, target: str, checkpoint: str,
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """Maintains the latest row per key over every file of ``src`` available now and
    returns the table.  Rows without a sequence value are rejected; ties go to the
    largest ``tie_break`` columns (default: all others), as in ``scd1``."""
    order = [sequence_by, *_tie_cols(src, keys, sequence_by, tie_break)]
    table = KeyedTable(spark, target, keys)
    rows = combined(src.where(F.col(sequence_by).isNotNull()), keys, order)
    rows = combined(rows.repartition(*keys), keys, order)  # state takes a row a key, or few
    rows = rows.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(GROUPS)))
    changed = rows.groupBy("_group").transformWithState(LatestRow(src.schema, keys, order), src.schema, "Update", "None")

    def write(batch: DataFrame, epoch: int) -> None:
        table.upsert(few_parts(batch.checkpoint()), checkpoint, epoch)  # the state is read once, however often the rows are
        table.compact()

    checkpoint_root(spark)
    with keyed_state(spark):
        run_to_completion(changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
    return table.read()
