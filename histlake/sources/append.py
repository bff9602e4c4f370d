"""Append-only tables that stay laid out however small their batches are (S5, ST1).

A batch is written as one folder, clustered by the table's columns, and published by one log
entry that names the micro-batch, so a replay adds nothing.  Many small batches would
leave many small files; folders of about the same size are therefore merged ``FAN`` at
a time, along the space-filling curve over the cluster columns.  The number of folders
grows with the logarithm of the rows, and a row is rewritten that often at most.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from histlake.sources.keyed import CommitLog
from histlake.sources.writers import cluster

#: Folders of a size class that are merged into one of the next class.
FAN = 4
#: Rows worth a file of their own while there are fewer files than cores; then 16 times as many.
FILE_ROWS = 1 << 16


class AppendTable:
    """Rows at ``path``, laid out by ``cluster_by`` (none: as they come)."""

    def __init__(self, spark: SparkSession, path: str, cluster_by: Sequence[str] = ()):
        self.spark, self.path, self.cluster_by = spark, path.rstrip("/"), list(cluster_by)
        self.log = CommitLog(spark, f"{self.path}/_log")

    def _write(self, rows: DataFrame, n: int, curve: bool, n_rows: int) -> dict:
        path = f"{self.path}/data/{n:012d}-{uuid.uuid4().hex[:8]}"
        cores = self.spark.sparkContext.defaultParallelism
        files = max(1, min(cores, n_rows // FILE_ROWS), n_rows // (16 * FILE_ROWS))
        (cluster(rows, self.cluster_by, files, curve) if self.cluster_by else rows).write.parquet(path)
        return {"path": path, "rows": self.spark.read.schema(rows.schema).parquet(path).count()}  # from the footers

    def append(self, rows: DataFrame, source: str | None = None, epoch: int | None = None) -> DataFrame:
        """Adds ``rows``; with (source, epoch) a micro-batch that is there already is not
        added again.  Returns the rows, read from where they are stored if they just were."""
        state = self.log.state() or {"n": 0, "folders": [], "sources": {}, "schema": rows.schema.json()}
        if source is not None and state["sources"].get(source, -1) >= epoch:
            return rows
        n = state["n"] + 1
        folder = self._write(rows, n, False, rows.count() if self.cluster_by else 0)
        sources = state["sources"] | ({source: epoch} if source is not None else {})
        self.log.commit(state | {"n": n, "folders": state["folders"] + ([folder] if folder["rows"] else []), "sources": sources})
        self.compact()
        return self.spark.read.schema(rows.schema).parquet(folder["path"])

    def compact(self) -> int:
        """Merges size classes that are full, smallest first; returns how many merges it took."""
        merges = 0
        while True:
            state = self.log.state()
            classes: dict[int, list[dict]] = {}
            for f in state["folders"] if state else []:
                classes.setdefault(int(math.log(max(f["rows"], 1), FAN)), []).append(f)
            full = [fs for _, fs in sorted(classes.items()) if len(fs) >= FAN]
            if not full:
                return merges
            old, n = full[0], state["n"] + 1
            one = self._write(self._frame(state, old), n, True, sum(f["rows"] for f in old))
            self.log.commit(state | {"n": n, "folders": [f for f in state["folders"] if f not in old] + [one]})
            merges += 1

    def vacuum(self, keep: int = 2) -> None:
        """Removes folders that none of the last ``keep`` states names."""
        numbers = self.log._numbers()
        named = lambda ns: {f["path"] for i in ns for f in self.log.state(i)["folders"]}
        self.log.drop_folders(sorted(named(numbers[:-keep]) - named(numbers[-keep:])))

    def _frame(self, state: dict, folders: list[dict]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"]))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f["path"] for f in folders])

    def read(self, number: int | None = None) -> DataFrame:
        """The table as of its last commit, or of an earlier one."""
        state = self.log.state(number)
        if state is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        return self._frame(state, state["folders"])
