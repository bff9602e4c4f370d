"""SCD2 kept up to date by interval merge (SC2, S6, ST5).

The history is a ``KeyedTable`` of versions, identified by keys and start, open versions in
folders of their own.  Beside it lie the rows themselves, ordered by key hash.  A batch
costs what it touches:

* **in order** (all of a key's new rows come after its open version's last row): the
  open version's last row is the seed; SCD2 over the seed and the new rows extends
  or closes the open version and adds the new ones.  No earlier row is read;
* **late**: a row inside or before a stored version may split, move or merge versions.
  Everything before the version preceding the one that holds the earliest late row
  stays as it is; from there on the key's stored rows are read again;
* **new keys** start a history.

Only versions that differ from the stored ones are written; those that no longer exist
are removed.  Rows and versions are published by one commit, so a failed or repeated
micro-batch leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.joins import broadcast_if_small
from histlake.operators.scd import DEFAULT_HOT_KEY_ROWS, END_AT, START_AT, scd2
from histlake.sources.keyed import GONE, HASH, KeyedTable, by_hash, key_struct
from histlake.streaming.ingest import few_parts

#: Up to so many touched keys are looked up by literal hashes, which Parquet statistics prune by.
LITERAL_KEYS = 500
#: Folders of rows are merged when there are more than this many small ones.
ROW_FOLDERS = 32


class History:
    """An SCD2 history at ``path``; see the module."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str,
                 track: Sequence[str] | None = None, tie_break: Sequence[str] | None = None):
        self.spark, self.path, self.keys, self.seq = spark, path.rstrip("/"), list(keys), sequence_by
        self.track, self.tie_break = track, tie_break
        self._kept: list[DataFrame] = []
        self.table = KeyedTable(spark, f"{self.path}/versions", [*keys, START_AT], hash_by=keys, part_by=F.col(END_AT).isNull())

    def read(self, number: int | None = None) -> DataFrame:
        return self.table.read(number)

    def current(self) -> DataFrame:
        """Open versions only; closed ones are not scanned."""
        return self.table.read(part=True)

    # --- rows ---

    def _store_rows(self, batch: DataFrame) -> tuple[DataFrame, dict]:
        path = f"{self.path}/rows/{uuid.uuid4().hex}"
        staged = batch.where(F.col(self.seq).isNotNull()).withColumn(HASH, F.xxhash64(*[F.col(k) for k in self.keys]))
        by_hash(staged).write.parquet(path)
        rows = self.spark.read.schema(staged.schema).parquet(path)
        return rows, {"path": path, "rows": rows.count()}

    def _merged(self, folders: list[dict]) -> list[dict]:
        """Row folders with the small ones put together, once there are many."""
        total = sum(f["rows"] for f in folders)
        small = [f for f in folders if f["rows"] * 4 < total]
        if len(small) <= ROW_FOLDERS:
            return folders
        _, one = self._store_rows(self.spark.read.parquet(*[f["path"] for f in small]).drop(HASH))
        return [f for f in folders if f not in small] + [one]

    # --- a batch ---

    def apply(self, batch: DataFrame, source: str = "batch", epoch: int | None = None) -> None:
        """Folds a batch in.  ``source`` and ``epoch`` name a micro-batch: its replay is a no-op."""
        if epoch is not None and self.table.seen(source, epoch):
            return
        state = self.table.log.state()
        stored = state["extra"]["rows"] if state else []
        rows, folder = self._store_rows(batch)
        if not folder["rows"] and state:
            delta = self.read().limit(0)
        elif not any(f["rows"] for f in stored):
            delta = self._scd2(rows.drop(HASH), folder["rows"])
        else:
            delta = self._changes(rows, folder["rows"], stored)
        self.table.upsert(delta, *((source, epoch) if epoch is not None else ()), extra={"rows": self._merged([*stored, folder])})
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
        self.table.compact()

    def _keep(self, df: DataFrame, at_most: int) -> DataFrame:
        """``df``, of at most that many rows, for the rest of the batch: read several times, a
        few steps from stored tables."""
        self._kept.append(few_parts(df, at_most).persist())
        return self._kept[-1]

    def _scd2(self, rows: DataFrame, at_most: int) -> DataFrame:
        """SCD2 of at most that many rows; without enough for a hot key none is looked for."""
        hot = DEFAULT_HOT_KEY_ROWS if at_most > DEFAULT_HOT_KEY_ROWS else None
        return scd2(rows, self.keys, self.seq, track=self.track, tie_break=self.tie_break, hot_key_rows=hot)

    def _with_key(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_k", key_struct(self.keys))

    def _hashes(self, keys: DataFrame, n: int) -> Column | None:
        """A condition on the stored hashes that the scans can skip row groups by."""
        if n > LITERAL_KEYS:
            return None
        return F.col(HASH).isin([r[0] for r in keys.select(HASH).distinct().collect()])  # at most LITERAL_KEYS

    def _changes(self, rows: DataFrame, n_rows: int, stored: list[dict]) -> DataFrame:
        """Versions to write, and ids to remove, for the touched keys."""
        columns = [c for c in rows.columns if c != HASH]
        new = self._with_key(rows)
        touched = self._keep(new.groupBy("_k").agg(F.min(self.seq).alias("_lo"), F.first(HASH).alias(HASH)), n_rows)
        n_touched = touched.count()
        only = self._hashes(touched, n_touched)
        open_now = self._keep(self._with_key(self.table.read(part=True, only=only)).join(
            broadcast_if_small(touched.select("_k", "_lo"), known_rows=n_touched), "_k"), n_touched)
        late = open_now.where(F.col("_lo") <= F.col(self.seq)).select("_k", "_lo")
        n_late = late.count()
        seeds = open_now.where(F.col("_lo") > F.col(self.seq))
        if not n_late:
            return self._diff(self._extended(new, seeds, columns, n_rows + n_touched), seeds.drop("_lo"), n_rows + n_touched)

        # late keys: what is stored from the version before the earliest late row on
        late = late.join(touched.select("_k", HASH), "_k")
        only = self._hashes(late, n_late)
        side = broadcast_if_small(late.select("_k", "_lo"), known_rows=n_late)
        n_stored = sum(f["rows"] for f in stored)  # as many versions at most
        versions = self._keep(self._with_key(self.table.read(only=only)).join(side, "_k"), n_stored)
        # versions follow one another: of those that end by the late row, the last to start
        before = versions.groupBy("_k").agg(F.max(F.when(F.col(END_AT) <= F.col("_lo"), F.col(START_AT))).alias("_from"))
        since = broadcast_if_small(before, known_rows=n_late)
        old = versions.drop("_lo").join(since, "_k").where(F.col("_from").isNull() | (F.col(START_AT) >= F.col("_from"))).drop("_from")
        again = self.spark.read.schema(rows.schema).parquet(*[f["path"] for f in stored]).unionByName(rows)
        if only is not None:
            again = again.where(only)
        again = self._with_key(again).join(since, "_k").where(F.col("_from").isNull() | (F.col(self.seq) >= F.col("_from")))
        in_order = new.join(broadcast_if_small(late.select("_k"), known_rows=n_late), "_k", "left_anti")
        at_most = n_rows + n_touched + n_stored
        fresh = self._extended(in_order.select(*columns).unionByName(again.select(*columns)), seeds, columns, at_most)
        return self._diff(fresh, seeds.drop("_lo").unionByName(old), at_most)

    def _extended(self, new: DataFrame, seeds: DataFrame, columns: list[str], at_most: int) -> DataFrame:
        """SCD2 over the open versions' last rows and the rows after them; keys without a
        seed have all the rows that matter."""
        out = self._scd2(seeds.select(*columns).unionByName(new.select(*columns)), at_most)
        opened = seeds.select("_k", F.col(self.seq).alias("_seed"), F.col(START_AT).alias("_start"))
        out = self._with_key(out).join(opened, "_k", "left")
        start = F.when(F.col(START_AT) == F.col("_seed"), F.col("_start")).otherwise(F.col(START_AT))
        return out.withColumn(START_AT, start).drop("_k", "_seed", "_start")

    def _diff(self, fresh: DataFrame, old: DataFrame, at_most: int) -> DataFrame:
        """``fresh`` without versions that are stored just so, and the ids of ``old`` that are gone."""
        fresh = self._keep(fresh, at_most)
        columns, ids = fresh.columns, [*self.keys, START_AT]
        whole = lambda df, name: df.select(key_struct(ids).alias("_id"), F.struct(*columns).alias(name))
        both = whole(fresh, "_new").join(whole(old, "_old"), "_id", "full_outer")
        changed = both.where(~F.col("_new").eqNullSafe(F.col("_old"))).withColumn(GONE, F.col("_new").isNull())
        return changed.select(F.coalesce("_new", "_old").alias("_r"), GONE).select("_r.*", GONE)
