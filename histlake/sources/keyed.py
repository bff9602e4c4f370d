"""Tables that take upserts: a base, deltas beside it, and a log that says which are live.

Parquet has no MERGE.  A commit therefore writes only the rows that changed, as a new
folder, and then one small log entry that lists the table's folders; until that entry is
there, readers see the table as it was, so a failed write changes nothing.  Reading takes,
for each id, the row of the latest commit.  Only deltas are shuffled for that: the
base loses the ids that a delta holds by an anti join.  ``compact`` folds the deltas in
once they reach a share of the base, so that a row is rewritten a bounded number of
times however many commits there are.

One writer at a time (a streaming query is one); any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histlake.operators.joins import broadcast_if_small

#: Bookkeeping columns: the commit that wrote a row, whether it removes its id, and a
#: hash of the hash columns that files are ordered by, for point lookups.
COMMIT, GONE, HASH = "_commit", "_gone", "_hash"
#: Deltas are folded in above this share of the base's rows, or this number of folders.
FOLD_SHARE, FOLD_FOLDERS = 0.25, 32


class CommitLog:
    """Numbered JSON files in ``path``; the last one is the table's state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._at(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, number: int | None = None) -> dict | None:
        """The last state, or an earlier one by its number; None before the first."""
        numbers = self._numbers()
        if not numbers:
            return None
        file = self._fs.open(self._at(f"{self.path}/{numbers[-1] if number is None else number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def commit(self, state: dict) -> None:
        """Publishes ``state`` as number ``state["n"]``: written aside, then renamed."""
        final = self._at(f"{self.path}/{state['n']:012d}.json")
        if self._fs.exists(final):
            raise RuntimeError(f"commit {state['n']} of {self.path} exists: another writer is at work")
        aside = self._at(f"{self.path}/{uuid.uuid4().hex}.tmp")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self._fs.rename(aside, final):
            raise OSError(f"cannot publish commit {state['n']} of {self.path}")

    def drop_folders(self, folders: Sequence[str]) -> None:
        for f in folders:
            self._fs.delete(self._at(f), True)


def key_struct(cols: Sequence[str]) -> Column:
    """One non-null column, in which null parts equal each other."""
    return F.struct(*[F.col(c) for c in cols])


def by_hash(df: DataFrame, *first: str) -> DataFrame:
    """``df`` dealt by ranges of ``_hash`` and sorted by it (after ``first``) in each file.

    The hash is uniform, so its upper bits are the ranges: no pass to sample them."""
    return df.repartition(F.shiftright(HASH, 48)).sortWithinPartitions(*first, HASH)


class KeyedTable:
    """Rows identified by ``ids``, the latest commit of an id winning.

    ``hash_by``: files are ordered by the hash of these columns (default: ``ids``), so that
    ``lookup`` of a few of them skips the other row groups.  ``part_by``: a condition by which
    rows are kept apart in folders of their own; readers of ``part`` skip the others'.
    """

    def __init__(self, spark: SparkSession, path: str, ids: Sequence[str], hash_by: Sequence[str] | None = None, part_by: Column | None = None):
        self.spark, self.path, self.ids = spark, path.rstrip("/"), list(ids)
        self.hash_by, self.part_by = list(hash_by or ids), part_by
        self.log = CommitLog(spark, f"{self.path}/_log")

    # --- writing ---

    def seen(self, source: str, epoch: int) -> bool:
        """Whether this micro-batch has been committed."""
        state = self.log.state()
        return bool(state) and state["sources"].get(source, -1) >= epoch

    def upsert(self, delta: DataFrame, source: str | None = None, epoch: int | None = None, extra: dict | None = None) -> None:
        """Commits rows of ``delta``, one an id; where it has a column ``_gone`` that is
        true, the id is removed.  With (source, epoch) a replay changes nothing.
        ``extra``: more state to publish in the same commit."""
        state = self.log.state() or {"n": 0, "folders": [], "sources": {}, "extra": {}}
        if source is not None and state["sources"].get(source, -1) >= epoch:
            return
        n = state["n"] + 1
        gone = F.col(GONE) if GONE in delta.columns else F.lit(False)
        folder = self._write(delta.withColumns({GONE: gone, COMMIT: F.lit(n).cast("long")}), n)
        state |= {"n": n, "schema": state.get("schema") or _schema_of(delta).json(), "folders": state["folders"] + ([folder] if folder["rows"] else [])}
        if source is not None:
            state["sources"] = state["sources"] | {source: epoch}
        state["extra"] = state["extra"] | (extra or {})
        self.log.commit(state)

    def _write(self, rows: DataFrame, n: int) -> dict:
        path = f"{self.path}/data/{n:012d}-{uuid.uuid4().hex[:8]}"
        part = F.lit(True) if self.part_by is None else F.coalesce(self.part_by, F.lit(False)) & ~F.col(GONE)
        rows = rows.withColumns({HASH: F.xxhash64(*[F.col(c) for c in self.hash_by]), "_part": part})
        by_hash(rows, "_part").write.partitionBy("_part").parquet(path)
        written = self.spark.read.schema(rows.schema).parquet(path)
        return {"path": path, "rows": written.count()}  # from the files' footers

    def compact(self, force: bool = False) -> bool:
        """Folds the deltas into a new base if they have grown enough."""
        state = self.log.state()
        if not state or len(state["folders"]) < 2:
            return False
        base, deltas = state["folders"][0], state["folders"][1:]
        if not force and sum(d["rows"] for d in deltas) < FOLD_SHARE * base["rows"] and len(deltas) < FOLD_FOLDERS:
            return False
        n = state["n"] + 1
        folder = self._write(self.read().withColumns({GONE: F.lit(False), COMMIT: F.lit(n).cast("long")}), n)
        self.log.commit(state | {"n": n, "folders": [folder]})
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Removes folders that none of the last ``keep`` states names."""
        numbers = self.log._numbers()
        old, live = [self.log.state(i) for i in numbers[:-keep]], [self.log.state(i) for i in numbers[-keep:]]
        named = lambda states: {f["path"] for s in states for f in [*s["folders"], *s["extra"].get("rows", [])]}
        self.log.drop_folders(sorted(named(old) - named(live)))

    # --- reading ---

    def _folder(self, state: dict, folders: list[dict], part: bool | None) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"])).add(GONE, "boolean").add(COMMIT, "long").add(HASH, "long").add("_part", "boolean")
        frames = [self.spark.read.schema(schema).parquet(f["path"]) for f in folders]
        df = reduce(DataFrame.unionByName, frames)
        return df if part is None else df.where(F.col("_part") == F.lit(part))

    def read(self, number: int | None = None, part: bool | None = None, only: Column | None = None) -> DataFrame:
        """The table as of its last commit, or of an earlier one.  ``part``: only rows for
        which ``part_by`` is so.  ``only``: a condition on columns of ``ids`` or ``_hash``, read by each scan."""
        state = self.log.state(number)
        if state is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        columns = StructType.fromJson(json.loads(state["schema"])).fieldNames()
        if not state["folders"]:
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(state["schema"])))
        narrow = lambda df: df if only is None else df.where(only)
        base, deltas = state["folders"][:1], state["folders"][1:]
        kept = narrow(self._folder(state, base, part)).where(~F.col(GONE))
        if not deltas:
            return kept.select(*columns)
        changed = narrow(self._folder(state, deltas, None)).withColumn("_id", key_struct(self.ids))
        latest = changed.groupBy("_id").agg(F.max_by(F.struct(*columns, GONE, "_part"), F.col(COMMIT)).alias("_r"))
        ids = broadcast_if_small(changed.select("_id").distinct(), known_rows=sum(d["rows"] for d in deltas))
        kept = kept.withColumn("_id", key_struct(self.ids)).join(ids, "_id", "left_anti").select(*columns)
        fresh = latest.where(~F.col(f"_r.{GONE}") & (F.lit(True) if part is None else F.col("_r._part") == F.lit(part)))
        return kept.unionByName(fresh.select(*[F.col(f"_r.{c}").alias(c) for c in columns]))


def _schema_of(delta: DataFrame) -> StructType:
    return StructType([f for f in delta.schema.fields if f.name not in (GONE, COMMIT, HASH, "_part")])
