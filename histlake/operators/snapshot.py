"""Silver layer: latest snapshot and inactive keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.operators.joins import broadcast_if_small
from histlake.operators.scd import END_AT, START_AT
from histlake.schemas import PAYROLL_KEYS, SNAPSHOT_COLUMNS

SNAPSHOT_KEYS = ["id_number", "first_name", "last_name", "position_sp", "status_sp"]


def latest_snapshot(bronze: DataFrame, institutions: DataFrame, statuses: DataFrame,
                    positions: DataFrame, *, institution_col: str = "institucion",
                    status_col: str = "estado", position_col: str = "cargo",
                    sequence_col: str = "fecha_consulta",
                    columns: Sequence[tuple[str, str]] = SNAPSHOT_COLUMNS,
                    dimension_rows: int | None = None) -> DataFrame:
    """Rows whose sequence date equals the latest OK source update of their
    institution **and** of their status (two equality joins), enriched with
    the translated names; the position join is a left join (Q3, Q4).

    One lazy plan.  The three dimensions hold one row per name; they are
    broadcast if ``dimension_rows`` (a proven upper bound the caller holds)
    or their size in bytes says so, and the fact side is then not shuffled.
    On bronze partitioned by the sequence date the date equality prunes
    partitions at run time (dynamic partition pruning).
    """
    inst = broadcast_if_small(institutions.select(
        F.col("institution_name_spanish").alias("_i_name"),
        F.col("last_source_update").alias("_i_date"),
        F.col("institution_name_english")), known_rows=dimension_rows)
    stat = broadcast_if_small(statuses.select(
        F.col("status_name_spanish").alias("_s_name"),
        F.col("last_source_update").alias("_s_date"),
        F.col("status_name_english")), known_rows=dimension_rows)
    pos = broadcast_if_small(positions.select(
        F.col("position_name_spanish").alias("_p_name"),
        F.col("position_name_english")), known_rows=dimension_rows)
    seq = F.col(sequence_col)
    joined = (bronze
              .join(inst, (F.col(institution_col) == F.col("_i_name")) & (seq == F.col("_i_date")), "inner")
              .join(stat, (F.col(status_col) == F.col("_s_name")) & (seq == F.col("_s_date")), "inner")
              .join(pos, F.col(position_col) == F.col("_p_name"), "left"))
    return joined.select(*[F.col(src).alias(dst) for src, dst in columns])


def per_group_latest(bronze: DataFrame, groups: Sequence[str] = ("institucion", "estado"),
                     sequence_col: str = "fecha_consulta") -> DataFrame:
    """X1 (opt-in variant, never substituted for ``latest_snapshot``): rows at
    the latest sequence of their own group.

    Grouped maximum (partial aggregate, skew-proof) joined back on
    (group, sequence) with NULL-safe group equality, in place of a window
    that would put a hot group in one task.
    """
    groups = list(groups)
    maxima = bronze.groupBy(*groups).agg(F.max(sequence_col).alias("_latest"))
    maxima = maxima.select(*[F.col(g).alias(f"_g_{g}") for g in groups], "_latest")
    cond = F.col(sequence_col) == F.col("_latest")
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return bronze.join(maxima, cond, "inner").select(*bronze.columns)


def inactive(history: DataFrame, snapshot: DataFrame, detected_at: Column | str | None = None,
             keys: Sequence[str] = PAYROLL_KEYS, snapshot_keys: Sequence[str] = SNAPSHOT_KEYS,
             extra: Sequence[str] = ("institucion", "salario", "gasto", "fecha_de_inicio"),
             start_col: str = START_AT, end_col: str = END_AT) -> DataFrame:
    """Current SCD2 versions absent from the latest snapshot.

    Plain equality on the key columns: a NULL key part never matches, so such
    rows are always reported (Q10).  The snapshot side is pruned to its keys
    and de-duplicated before the anti join; AQE splits a skewed left side.
    """
    keys = list(keys)
    active = (history.where(F.col(end_col).isNull())
              .select(*keys, *extra, start_col))
    latest = snapshot.select(*[F.col(s).alias(k) for s, k in zip(snapshot_keys, keys)]).distinct()
    if detected_at is None:
        det = F.current_timestamp()
    elif isinstance(detected_at, Column):
        det = detected_at
    else:
        det = F.lit(detected_at).cast("timestamp")
    return (active.join(latest, on=keys, how="left_anti")
            .select(*keys, *extra, F.col(start_col).alias("last_active_date"),
                    det.alias("detected_at")))
