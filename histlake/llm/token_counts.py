"""Token counts kept by signed deltas.

A ledger holds, for each committed batch, signed entries per document (id,
source, language, tokenizer; +/- documents, tokens, characters) and their sums
per source, language and tokenizer.  Totals are the sums of all batches'
deltas, so a batch of changes costs its own size plus a lookup of the changed
documents' entries.

Changes are rows (id, seq, op, text, source, lang).  ``insert`` and ``revise``
set a document's counts (its former ones are taken back), ``delete`` takes them
back.  Deleting an unknown document changes nothing.  Of several changes to an
id in a batch the one of highest seq holds, of equal ones a deletion, then the
greatest (text, source, lang).

A batch is committed when its deltas folder has Spark's ``_SUCCESS`` file, which
is written last.  Committing a batch id again is a no-op; what a failed attempt
left is not read and is overwritten.  One writer at a time.

Null texts count 0 tokens; null sources and languages are groups of their own;
changes without an id or with another operation are ignored.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm.common import joined

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Tokenizer versions, by their rank files.
TOKENIZERS = ("byte_bpe_50k", "byte_bpe_multi_50k")
FOLDER = "/opt/tokenizers"

GROUP = ["source", "lang", "tokenizer"]
SUMS = ["docs", "tokens", "chars"]


def encoder(folder: str, name: str):
    """Tokenizer of a rank file that every executor has."""
    import tiktoken

    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(rows: DataFrame, text_col: str = "text", tokenizers: tuple[str, ...] = TOKENIZERS, folder: str = FOLDER) -> DataFrame:
    """``rows`` without the text, with ``chars`` and one row per tokenizer with its ``tokens``."""
    keep = [c for c in rows.columns if c != text_col]
    schema = rows.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [(name, encoder(folder, name)) for name in tokenizers]
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(len(keep))]
            chars = pa.array([len(t) for t in texts], pa.int64())
            for name, e in encoders:
                tokens = pa.array([len(e.encode_ordinary(t)) for t in texts], pa.int64())
                yield pa.record_batch([*b.columns[:len(keep)], chars, pa.array([name] * len(texts), pa.string()), tokens],
                                      names=[*keep, "chars", "tokenizer", "tokens"])

    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + ["chars long, tokenizer string, tokens long"])
    return rows.select(*keep, text_col).mapInArrow(run, out)


class Ledger:
    """Token rollup stored under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, tokenizers: tuple[str, ...] = TOKENIZERS, folder: str = FOLDER):
        self.spark, self.path, self.tokenizers, self.folder = spark, path.rstrip("/"), tokenizers, folder

    def _folder(self, kind: str, batch: str) -> str:
        return f"{self.path}/{kind}/{batch}"

    def committed(self) -> list[str]:
        """Ids of the committed batches."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        done = jvm.org.apache.hadoop.fs.Path
        return sorted(x.getPath().getName() for x in fs.listStatus(top) if fs.exists(done(x.getPath(), "_SUCCESS")))

    def _read(self, kind: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(self._folder(kind, b)) for b in self.committed()]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of changes; False if it was committed before."""
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"not a batch id: {batch!r}")
        if batch in self.committed():
            return False
        columns = ["text", "source", "lang"]
        order = F.struct("seq", (F.col("op") == "delete").alias("gone"), *columns)
        rows = changes.select("id", "seq", "op", *columns).filter("id is not null and op in ('insert', 'revise', 'delete')")
        # texts are shuffled only if an id has several changes
        if not rows.groupBy("id").count().filter("count > 1").isEmpty():
            last = rows.groupBy("id").agg(F.max(order).alias("o"), F.max_by("op", order).alias("op"))
            rows = last.select("id", F.col("o.seq").alias("seq"), "op", "o.text", "o.source", "o.lang")
        now = count_tokens(rows.filter("op <> 'delete'").select("id", "source", "lang", "text"), "text", self.tokenizers, self.folder) \
            .withColumn("docs", F.lit(1).cast("long"))
        entries = now.select("id", *GROUP, *SUMS)
        before = self._read("entries")
        if before is not None:
            ids = rows.select("id").distinct()
            n = ids.count()
            held = joined(before, ids, "id", "left_semi", n, 16).groupBy("id", *GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
            back = held.filter("docs <> 0 or tokens <> 0 or chars <> 0").select("id", *GROUP, *[(-F.col(c)).alias(c) for c in SUMS])
            entries = entries.unionByName(back)
        entries.write.mode("overwrite").parquet(self._folder("entries", batch))
        stored = self.spark.read.parquet(self._folder("entries", batch))
        stored.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).write.mode("overwrite") \
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._folder("deltas", batch))
        return True

    def totals(self) -> DataFrame:
        """Documents, tokens and characters by source, language and tokenizer."""
        deltas = self._read("deltas")
        if deltas is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, docs long, tokens long, chars long")
        return deltas.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS]).filter("docs <> 0 or tokens <> 0")
