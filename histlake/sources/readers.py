"""Batch and streaming scans with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_batch(spark: SparkSession, path: str, schema: StructType | None = None,
               file_name_col: str | None = None) -> DataFrame:
    """Batch Parquet scan.  With ``schema`` the files are read against it:
    extra source columns are dropped and missing ones come back NULL (S2).
    ``file_name_col`` adds each row's source file name from the hidden
    ``_metadata`` column (file provenance, F21) - no extra pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return with_file_name(df, file_name_col) if file_name_col else df


def with_file_name(df: DataFrame, name: str) -> DataFrame:
    """Add the source file name of every row (batch or streaming file scans)."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Catalog table by name, or a Parquet directory when a path is given (S3)."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def read_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = None,
                latest_first: bool = False) -> DataFrame:
    """Incremental Parquet directory source: each file is processed once; the
    set of seen files lives in the query's checkpoint (S1, S4).  A schema is
    mandatory - streaming sources never infer."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if latest_first:
        reader = reader.option("latestFirst", "true")
    return reader.parquet(path)


def read_stream_table(spark: SparkSession, name: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental scan of a catalog table by name (S4): what was appended since
    the query's checkpoint."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.table(name)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per staged file (path, size, modification time) without
    reading the file contents - replaces a driver-side directory listing
    (S13).  Runs as a distributed scan of file metadata."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.parquet")
          .load(path))
    return df.select(F.col("path"), F.col("length"), F.col("modificationTime"))


def _plain_path(path: Column) -> Column:
    """One spelling of a local path (``file:/x`` and ``file:///x`` are the same file)."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def with_file_path(df: DataFrame, name: str) -> DataFrame:
    """Add the full path of every row's source file (batch or streaming file scans)."""
    return df.select("*", _plain_path(F.col("_metadata.file_path")).alias(name))


def unread_files(inventory: DataFrame, table: DataFrame, file_col: str) -> DataFrame:
    """Files of the inventory (S13) that no row of ``table`` comes from: not ingested yet,
    or without rows.  The table's paths are reduced to distinct ones before the anti join."""
    read = table.select(F.col(file_col).alias("path")).distinct()
    return inventory.withColumn("path", _plain_path(F.col("path"))).join(read, "path", "left_anti")
