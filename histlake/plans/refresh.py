"""Full recompute of the derived tables in dependency order.

bronze + SCD2 history + reference tables -> latest snapshot -> inactive
keys and the two gold summaries.  Each table is written (clustered by its
query columns) and the next stage reads the *stored* table, so lineage is
cut at every materialised view and a lost executor never replays the
upstream stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histlake.operators import snapshot as snap
from histlake.operators import summaries
from histlake.operators.profile import observe_quality
from histlake.sources.writers import cluster, materialize

LAYOUT = {
    "snapshot": ["institution_sp", "status_sp"],
    "inactive": ["cedula"],
    "gold_employee": ["id_number"],
    "gold_details": ["id_number"],
    "gold_groups": ["institution_sp", "status_sp"],
}

COMMENTS = {
    "snapshot": "latest snapshot with translated names",
    "inactive": "current versions missing from the snapshot",
    "gold_employee": "per-person summary",
    "gold_details": "positions of each person",
    "gold_groups": "institution / status / position summary",
}


def refresh(spark: SparkSession, bronze: DataFrame, history: DataFrame, institutions: DataFrame,
            statuses: DataFrame, positions: DataFrame, base_path: str,
            detected_at=None, dimension_rows: int | None = None, database: str | None = None) -> dict:
    """Recompute and replace every derived table under ``base_path``;
    returns ``name -> path`` plus ``snapshot_quality``: row and NULL-key
    counts observed while the snapshot was written (no extra pass).
    ``gold_details`` holds the per-person details as rows; the person table has
    no list of them, so no person's rows meet in one task.  ``database``
    registers the tables there, with their comments."""
    base = base_path.rstrip("/")
    paths: dict = {name: f"{base}/{name}" for name in LAYOUT}
    # observe above the clustering exchange: the range sampling pass runs the
    # plan below it once more and would count rows twice
    latest, quality = observe_quality(
        cluster(snap.latest_snapshot(bronze, institutions, statuses, positions,
                                     dimension_rows=dimension_rows), LAYOUT["snapshot"]),
        not_null=["id_number", "first_name", "last_name", "position_sp", "status_sp"])

    def keep(name: str, df: DataFrame, laid_out: bool = False) -> None:
        materialize(df, paths[name], cluster_by=None if laid_out else LAYOUT[name],
                    table=f"{database}.{name}" if database else None, comment=COMMENTS[name] if database else None)

    keep("snapshot", latest, laid_out=True)
    paths["snapshot_quality"] = quality.get
    stored = spark.read.parquet(paths["snapshot"])
    keep("inactive", snap.inactive(history, stored, detected_at=detected_at))
    keep("gold_employee", summaries.employee_summary(stored, details=False))
    keep("gold_details", summaries.employee_positions(stored))
    keep("gold_groups", summaries.group_summary(stored))
    return paths
