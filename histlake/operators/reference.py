"""Reference (dimension) tables and translation.

Translation is a dictionary join, not a model call: the dictionary is a
DataFrame ``(source, target)``; unknown names keep their original text and
``translated = false``.  ``translate_distinct`` applies an arbitrary
vectorised function to the *distinct* names only, then joins back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from histlake.operators.joins import broadcast_if_small
from histlake.session import checkpoint_root


def translate(df: DataFrame, col: str, dictionary: DataFrame, out_col: str,
              source: str = "source", target: str = "target",
              flag_col: str | None = None, keep_missing: bool = True,
              dictionary_rows: int | None = None) -> DataFrame:
    """Left-join ``df[col]`` to a dictionary; ``out_col`` is the target text,
    or the original when the word is missing (``keep_missing``).

    The dictionary is reduced to one target per source (deterministic
    ``min``) and broadcast when its size is checked small
    (``dictionary_rows``: a known upper bound, e.g. for a literal list).
    """
    d = (dictionary.groupBy(F.col(source).alias("_src"))
         .agg(F.min(F.col(target)).alias("_tgt")))
    d = broadcast_if_small(d, known_rows=dictionary_rows)
    j = df.join(d, df[col] == d["_src"], "left")
    out = F.coalesce(F.col("_tgt"), F.col(col)) if keep_missing else F.col("_tgt")
    j = j.withColumn(out_col, out)
    if flag_col:
        j = j.withColumn(flag_col, F.col("_tgt").isNotNull())
    return j.drop("_src", "_tgt")


def translate_distinct(df: DataFrame, col: str, fn: Callable[[pd.Series], pd.Series],
                       out_col: str) -> DataFrame:
    """Apply ``fn`` (pandas Series -> Series, e.g. a model client) to the
    distinct values of ``col`` only, as an Arrow-batched pandas UDF, then
    join the result back.  The expensive call runs once per distinct name,
    distributed over executors, never once per row: the names' results are
    checkpointed, which also tells how many there are, so a short list is
    broadcast and the rows stay where they are."""
    def _apply(names: pd.Series) -> pd.Series:   # type hints select the Series -> Series UDF
        return fn(names)

    udf = F.pandas_udf(_apply, StringType())
    names = df.select(F.col(col).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    checkpoint_root(df.sparkSession)
    translated = names.withColumn("_out", udf(F.col("_name"))).checkpoint()
    translated = broadcast_if_small(translated, known_rows=translated.count())
    j = df.join(translated, df[col] == translated["_name"], "left")
    return j.withColumn(out_col, F.col("_out")).drop("_name", "_out")


def latest_ok_by(log: DataFrame, name_col: str, status_col: str = "run_status",
                 ok_value: str = "OK", update_col: str = "source_update",
                 checked_col: str = "checked_at") -> DataFrame:
    """Grouped maxima of successful runs per name (A20): filter first, then a
    partial + final aggregate.  Output: name, last_source_update,
    last_checked_at."""
    return (log.where(F.col(status_col) == F.lit(ok_value))
            .groupBy(name_col)
            .agg(F.max(update_col).alias("last_source_update"),
                 F.max(checked_col).alias("last_checked_at")))


def reference_names(log: DataFrame, name_col: str, english_col: str,
                    dictionary: DataFrame, dictionary_rows: int | None = None, **kw) -> DataFrame:
    """Institution / status reference table (C8, C9): latest OK source update
    and check per name, plus the translated name."""
    stats = latest_ok_by(log, name_col, **kw)
    return translate(stats, name_col, dictionary, english_col,
                     dictionary_rows=dictionary_rows).select(
        name_col, "last_source_update", "last_checked_at", english_col)


def position_reference(bronze: DataFrame, dictionary: DataFrame,
                       position_col: str = "cargo", seen_col: str = "fecha_actualizacion",
                       existing: DataFrame | None = None,
                       dictionary_rows: int | None = None) -> DataFrame:
    """Position reference (C10, batch form): one row per non-NULL position
    with the earliest time it was seen (deterministic stand-in for 'first row
    seen'), minus positions already in ``existing`` (J5), translated."""
    positions = (bronze.where(F.col(position_col).isNotNull())
                 .groupBy(F.col(position_col).alias("position_name_spanish"))
                 .agg(F.min(seen_col).alias("last_seen_at")))
    if existing is not None:
        positions = new_keys_only(positions, existing, ["position_name_spanish"])
    return translate(positions, "position_name_spanish", dictionary,
                     "position_name_english", dictionary_rows=dictionary_rows).select(
        "position_name_spanish", "last_seen_at", "position_name_english")


def new_keys_only(candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``candidates`` whose key is not yet in ``existing`` (J5, ST4):
    a left anti join on the key columns only (existing side pruned to them
    and de-duplicated, so a repeated key is never buffered twice)."""
    keys = list(keys)
    seen = existing.select(*keys).distinct()
    return candidates.join(seen, on=keys, how="left_anti")
