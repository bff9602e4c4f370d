"""Materialisation and layout."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histlake.sources.layout import along_curve, curve_key, dealt, row_hash


def replace_folder(spark: SparkSession, new: str, path: str) -> str:
    """Put the finished folder ``new`` in the place of ``path``.

    Two renames: until the first the old table is there, after the second the
    new one.  A job that fails while it writes ``new`` leaves ``path`` as it is;
    a crash between the renames leaves the old table beside it as ``.old``."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    target, old = at(path), at(path.rstrip("/") + ".old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at(new), target):
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(old, True)
    return path


def materialize(df: DataFrame, path: str, comment: str | None = None,
                cluster_by: Sequence[str] | None = None, table: str | None = None, curve: bool = False) -> str:
    """Full recompute-and-replace of a derived table (materialised view, S7).

    The result is written beside ``path`` and then takes its place, so a failed
    run leaves the former table readable.  ``cluster_by`` lays the files out by
    those columns (S8; along a ``curve`` over them, if asked) so Parquet min/max
    statistics let later filters skip row groups.  ``table`` registers the folder in the catalog; ``comment`` becomes
    that table's comment and needs one.
    """
    if comment and not table:
        raise ValueError("a comment belongs to a catalog table: give its name")
    spark = df.sparkSession
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    (cluster(df, cluster_by, curve=curve) if cluster_by else df).write.parquet(new)
    replace_folder(spark, new, path)
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
        spark.catalog.createTable(table, path=path, source="parquet", description=comment)
    return path


def cluster(df: DataFrame, cols: Sequence[str], partitions: int | None = None, curve: bool = False) -> DataFrame:
    """Range-partition, then sort within partitions, by ``cols``.

    With ``curve`` and several columns, rows follow a space-filling curve instead, so
    that a filter on any of the columns prunes (``sources.layout``); a linear order
    prunes by the first only.

    Equal values would share a partition, so a hash of the row is the last
    range column: a hot value spreads over several partitions, each still a
    narrow range of ``cols``.  The in-file sort gives tight per-row-group
    min/max ranges for data skipping.
    """
    cols = list(cols)
    if curve and len(cols) > 1:
        return along_curve(df, cols, partitions)
    ranged = dealt(df, cols, partitions) if partitions else df.repartitionByRange(*cols, row_hash(df))
    return ranged.sortWithinPartitions(*cols)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str],
                    partition_by: Sequence[str] | None = None,
                    mode: str = "overwrite", partitions: int | None = None,
                    timestamp_type: str | None = None, curve: bool = False) -> str:
    """Clustered Parquet write (S8, S12); ``curve`` as in ``cluster``, within each
    partition folder.  ``partition_by`` adds directory
    partitioning on low-cardinality columns (e.g. a status); rows are then
    ordered by those first, as the writer needs them, and by ``cluster_by``
    inside each file.  ``timestamp_type`` (``INT96``, ``TIMESTAMP_MICROS``,
    ``TIMESTAMP_MILLIS``) pins the physical timestamp encoding for this write
    only."""
    if curve and partition_by:
        z = curve_key(df, cluster_by)
        rows = cluster(df.withColumn("_z", z), [*partition_by, "_z"], partitions).drop("_z")
    else:
        rows = cluster(df, [*(partition_by or []), *cluster_by], partitions, curve)
    w = rows.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if timestamp_type:
        spark = df.sparkSession
        key = "spark.sql.parquet.outputTimestampType"
        old = spark.conf.get(key)
        spark.conf.set(key, timestamp_type)
        try:
            w.parquet(path)
        finally:
            spark.conf.set(key, old)
    else:
        w.parquet(path)
    return path


def append_typed(df: DataFrame, path: str, schema: StructType,
                 defaults: dict | None = None) -> str:
    """Append rows to a table with a declared schema.

    Columns are cast to the declared types (no string-typed inserts), and
    ``defaults`` fills NULLs of columns that declare a default, e.g.
    ``{"checked_at": F.current_timestamp()}``.  A NULL that is left in a column
    declared NOT NULL fails the write.
    """
    defaults = defaults or {}
    cols = []
    for field in schema.fields:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            c = F.coalesce(c, defaults[field.name])
        c = c.cast(field.dataType)
        if not field.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{field.name} is NOT NULL")).cast(field.dataType))
        cols.append(c.alias(field.name))
    df.select(*cols).write.mode("append").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, bucket_by: Sequence[str], buckets: int,
                   sort_by: Sequence[str] | None = None, mode: str = "overwrite",
                   path: str | None = None) -> str:
    """Store ``df`` as a catalog table bucketed (and sorted) by ``bucket_by``.

    Readers that group, window or join on those columns get the hash
    partitioning from the scan itself, so Spark plans no exchange for them -
    e.g. ``scd2(..., partitioned_by_keys=True)`` over bronze bucketed by the
    SCD keys reads the history without shuffling it.  ``path`` keeps the
    files there (an external table, e.g. in the shared folder) instead of
    the warehouse directory.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *bucket_by)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


def define_table(spark: SparkSession, name: str, schema: StructType, defaults: dict[str, str] | None = None,
                 path: str | None = None, comment: str | None = None) -> str:
    """Create the catalog table ``name`` (S10): declared types, NOT NULL where the
    schema says so, and SQL default expressions (``{"checked_at":
    "current_timestamp()"}``) for columns an INSERT leaves out."""
    defaults = defaults or {}
    cols = [f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
            + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields]
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE {name} ({', '.join(cols)}) USING parquet"
              + (f" LOCATION {quote(path)}" if path else "") + (f" COMMENT {quote(comment)}" if comment else ""))
    return name
