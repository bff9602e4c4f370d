"""Declared schemas (no inference) and the Spanish -> English rename map."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, FloatType, StringType,
                               StructField, StructType, TimestampType)

# ---------------------------------------------------------------------------
# Everything in this module must equal the source data's and
# the documented tables' names - column names and order, key / tracked
# column lists, run statuses and the snapshot's output names.
# ---------------------------------------------------------------------------

# Staging / bronze input: twelve nullable columns, applied with ``.schema()``.
STAGING_SCHEMA = StructType([
    StructField("nombre", StringType(), True),
    StructField("apellido", StringType(), True),
    StructField("cedula", StringType(), True),
    StructField("cargo", StringType(), True),
    StructField("salario", DoubleType(), True),
    StructField("gasto", DoubleType(), True),
    StructField("estado", StringType(), True),
    StructField("fecha_de_inicio", DateType(), True),
    StructField("fecha_actualizacion", TimestampType(), True),
    StructField("fecha_consulta", TimestampType(), True),
    StructField("archivo", StringType(), True),
    StructField("institucion", StringType(), True),
])

# Payroll configuration of the generic operators.
PAYROLL_KEYS = ["cedula", "nombre", "apellido", "cargo", "estado"]
PAYROLL_SEQUENCE = "fecha_consulta"
PAYROLL_TRACKED = ["salario", "gasto", "fecha_de_inicio"]
# composite key parts, in order; the id part has its dashes removed
PAYROLL_KEY_PARTS = ["nombre", "apellido", "institucion", "cargo", "cedula"]

# Audit log of extraction attempts.  NOT NULL is declared but not enforced by
# Parquet, hence ``operators.profile.not_null_violations``.
AUDIT_LOG_SCHEMA = StructType([
    StructField("institution_name_spanish", StringType(), False),
    StructField("status_name_spanish", StringType(), False),
    StructField("run_status", StringType(), False),
    StructField("source_update", TimestampType(), False),
    StructField("checked_at", TimestampType(), True),
    StructField("start_at", TimestampType(), False),
    StructField("end_at", TimestampType(), False),
    StructField("time", FloatType(), False),
])
AUDIT_LOG_NOT_NULL = ["institution_name_spanish", "status_name_spanish", "run_status",
                      "source_update", "start_at", "end_at", "time"]
RUN_STATUSES = ["OK", "FAIL", "No Update"]

# Bronze -> silver snapshot projection (source column, output column), in the
# output order of the 17-column snapshot.
SNAPSHOT_COLUMNS = [
    ("composite_key", "composite_key"),
    ("nombre", "first_name"),
    ("apellido", "last_name"),
    ("cedula", "id_number"),
    ("salario", "salary"),
    ("gasto", "allowance"),
    ("estado", "status_sp"),
    ("status_name_english", "status_en"),
    ("institucion", "institution_sp"),
    ("institution_name_english", "institution_en"),
    ("cargo", "position_sp"),
    ("position_name_english", "position_en"),
    ("fecha_de_inicio", "start_date"),
    ("fecha_actualizacion", "query_date"),
    ("fecha_consulta", "snapshot_date"),
    ("antiguedad", "years_of_service"),
    ("archivo", "file"),
]
