"""The whole triggered flow, in dependency order (section 3 of the survey):

staging files -> bronze (key + tenure), and with each micro-batch of it the SCD2
history and the new positions; audit log -> latest attempt per (institution,
status) (SCD1) and the institution / status reference tables; then the materialised views
(snapshot, inactive, gold) via ``plans.refresh``.

Every streaming stage runs ``availableNow`` over its own checkpoint, so a
run processes exactly the files that arrived since the previous run, and a
failed run is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.keys import with_key_and_tenure
from histlake.operators.reference import translate
from histlake.plans.refresh import refresh
from histlake.schemas import (AUDIT_LOG_SCHEMA, PAYROLL_KEYS, PAYROLL_SEQUENCE, PAYROLL_TRACKED,
                              STAGING_SCHEMA)
from histlake.sources.readers import read_stream
from histlake.streaming.cdc import scd_stream
from histlake.streaming.history import History
from histlake.streaming.ingest import ingest_stream
from histlake.streaming.reference import add_new_keys, grouped_max_stream

#: Bronze is laid out by what snapshots and reports select by.
BRONZE_LAYOUT = ["institucion", "fecha_actualizacion"]


def run_triggered_flow(spark: SparkSession, staging: str, audit_log: str, dictionary: DataFrame,
                       base_path: str, detected_at=None) -> dict:
    """Run every stage once over what has arrived; returns the table paths
    (and the snapshot quality counters from ``refresh``)."""
    base = base_path.rstrip("/")
    p = {name: f"{base}/{name}" for name in
         ["bronze", "scd2", "log_latest", "institutions", "statuses",
          "positions", "tables"]}

    def ckpt(name: str) -> str:
        return f"{base}/_checkpoints/{name}"

    def words(col: str, out: str):
        return lambda df: translate(df, col, dictionary, out)

    history = History(spark, p["scd2"], PAYROLL_KEYS, PAYROLL_SEQUENCE, track=PAYROLL_TRACKED)

    def new_positions(rows: DataFrame, epoch: int) -> None:
        seen = rows.select(F.col("cargo").alias("position_name_spanish"), F.col("fecha_actualizacion").alias("last_seen_at"))
        add_new_keys(spark, seen, "position_name_spanish", "last_seen_at", p["positions"],
                     enrich=words("position_name_spanish", "position_name_english"))

    bronze = ingest_stream(spark, staging, STAGING_SCHEMA, p["bronze"], ckpt("bronze"), transform=with_key_and_tenure,
                           cluster_by=BRONZE_LAYOUT, also=[lambda rows, epoch: history.apply(rows, ckpt("bronze"), epoch), new_positions])
    # latest attempt per (institution, status): SCD1 on the audit log
    scd_stream(spark, read_stream(spark, audit_log, AUDIT_LOG_SCHEMA),
               ["institution_name_spanish", "status_name_spanish"], "checked_at",
               p["log_latest"], ckpt("log_latest"), scd_type=1)
    grouped_max_stream(read_stream(spark, audit_log, AUDIT_LOG_SCHEMA), "institution_name_spanish",
                       p["institutions"], ckpt("institutions"),
                       enrich=words("institution_name_spanish", "institution_name_english"))
    grouped_max_stream(read_stream(spark, audit_log, AUDIT_LOG_SCHEMA), "status_name_spanish",
                       p["statuses"], ckpt("statuses"),
                       enrich=words("status_name_spanish", "status_name_english"))

    tables = refresh(spark, bronze.read(), history.read(),
                     spark.read.parquet(p["institutions"]), spark.read.parquet(p["statuses"]),
                     spark.read.parquet(p["positions"]), p["tables"], detected_at=detected_at)
    p.update(tables)
    return p
