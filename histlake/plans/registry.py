"""Registered queries: ``name -> (spark builder, DuckDB oracle SQL | None)``.

Every builder takes ``(spark, sf_dir)`` and reads the whole base tables (or
relations Spark derives from them).  Computed columns carry the same alias
in the DataFrame and in the SQL.  Money sums are rounded to 4 places and
averages / moments to 6 in *both*, so summation order cannot change the
compared text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators import audit, profile, reference, scd, snapshot as snap, summaries
from histlake.plans import analogs as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def nudge(n: int) -> float:
    """Offset added before display rounding to ``n`` places, in Spark and in
    the SQL alike: far above double-precision noise (~1e-11 here), far below
    the displayed precision.  A value lying exactly on a decimal tie (common
    for averages of money) then rounds the same way in both engines, although
    one rounds the decimal text and the other the binary value."""
    return 10.0 ** -(n + 3)


def rnd(c: str | Column, n: int, alias: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(nudge(n)), n).alias(alias or (c if isinstance(c, str) else None))


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


SNAP = A.SNAPSHOT_CTES

# =============================================================== bronze / keys
@query("bronze_keys_tenure", with_ctes(A.PAY_SQL, A.BRONZE_SQL, body="""
SELECT source_row, cedula, composite_key, fecha_consulta, fecha_de_inicio, antiguedad FROM bronze"""))
def bronze_keys_tenure(spark, sf):
    return A.bronze(spark, sf).select("source_row", "cedula", "composite_key", "fecha_consulta",
                                      "fecha_de_inicio", "antiguedad")


# ============================================================ silver snapshot
@query("snapshot_latest", with_ctes(SNAP, body="SELECT * FROM snapshot"))
def snapshot_latest(spark, sf):
    return A.snapshot(spark, sf)


@query("snapshot_per_group_latest", with_ctes(A.PAY_SQL, A.BRONZE_SQL, body="""
SELECT source_row, institucion, estado, fecha_consulta, salario FROM bronze
QUALIFY fecha_consulta = max(fecha_consulta) OVER (PARTITION BY institucion, estado)"""))
def snapshot_per_group_latest(spark, sf):
    return snap.per_group_latest(A.bronze(spark, sf)).select(
        "source_row", "institucion", "estado", "fecha_consulta", "salario")


# ======================================================================= gold
@query("employee_summary", with_ctes(SNAP, body="""
SELECT id_number,
       CASE WHEN count(DISTINCT first_name) + count(DISTINCT last_name) > 2 THEN 1 ELSE 0 END AS multiple_names,
       round((sum(salary)) + 1e-07, 4) AS total_salary, round((sum(allowance)) + 1e-07, 4) AS total_allowance,
       round((sum(salary) + sum(allowance)) + 1e-07, 4) AS total_compensation,
       count(DISTINCT position_sp) AS distinct_position_count,
       min(start_date) AS first_start_date, max(start_date) AS last_start_date,
       max(years_of_service) AS total_years_of_service,
       count(*) AS position_rows
FROM snapshot GROUP BY id_number"""))
def employee_summary(spark, sf):
    s = summaries.employee_summary(A.snapshot(spark, sf))
    return s.select("id_number", "multiple_names", rnd("total_salary", 4),
                    rnd("total_allowance", 4), rnd("total_compensation", 4),
                    "distinct_position_count", "first_start_date", "last_start_date",
                    "total_years_of_service",
                    F.json_array_length("positions_details_json").cast("long").alias("position_rows"))


@query("employee_positions_json", with_ctes(SNAP, body="""
SELECT id_number, to_json(list(struct_pack(first_name := first_name, last_name := last_name,
         status := status_sp, institution := institution_sp, position := position_sp,
         salary := salary, allowance := allowance, start_date := start_date,
         years_of_service := years_of_service)
       ORDER BY first_name, last_name, status_sp, institution_sp, position_sp, salary, allowance,
                start_date, years_of_service))::VARCHAR AS positions_details_json
FROM snapshot GROUP BY id_number"""))
def employee_positions_json(spark, sf):
    return summaries.employee_summary(A.snapshot(spark, sf)).select("id_number", "positions_details_json")


GROUP_SQL = with_ctes(SNAP, body="""
SELECT institution_sp, institution_en, status_sp, status_en, position_sp, position_en,
       round((sum(salary)) + 1e-07, 4) AS total_salary, round((avg(salary)) + 1e-09, 6) AS avg_salary,
       round((sum(allowance)) + 1e-07, 4) AS total_allowance, round((avg(allowance)) + 1e-09, 6) AS avg_allowance,
       round((sum(salary + allowance)) + 1e-07, 4) AS total_compensation,
       count(*) AS employee_count, count(DISTINCT id_number) AS unique_employee_count,
       min(start_date) AS first_start_date, max(start_date) AS last_start_date,
       round((avg(years_of_service)) + 1e-09, 6) AS avg_years_of_service,
       min(years_of_service) AS min_years_of_service, max(years_of_service) AS max_years_of_service
FROM snapshot
GROUP BY institution_sp, institution_en, status_sp, status_en, position_sp, position_en""")


@query("employee_detail_parts", with_ctes(SNAP, body="""
SELECT id_number, CAST((rn - 1) // 2 AS BIGINT) AS part, count(*) AS positions,
       round(sum(salary) + 1e-07, 4) AS salary, CAST(min(start_date) AS VARCHAR) AS first_start
FROM (SELECT *, row_number() OVER (PARTITION BY id_number ORDER BY first_name NULLS FIRST, last_name NULLS FIRST, status_sp NULLS FIRST,
        institution_sp NULLS FIRST, position_sp NULLS FIRST, salary NULLS FIRST, allowance NULLS FIRST, start_date NULLS FIRST,
        years_of_service NULLS FIRST) AS rn FROM snapshot)
GROUP BY id_number, part"""))
def employee_detail_parts(spark, sf):
    """The details JSON in parts of two positions, read back from its text."""
    parts = summaries.employee_detail_parts(A.snapshot(spark, sf), part_rows=2)
    back = F.from_json("details_json", "array<struct<salary: double, start_date: string>>")
    return parts.select("id_number", "part", "positions", rnd(F.aggregate(back["salary"], F.lit(0.0), lambda s, x: s + x), 4, "salary"),
                        F.array_min(back["start_date"]).alias("first_start"))


@query("employee_detail_sizes", with_ctes(SNAP, body="""
SELECT max(n) AS max_positions, count(*) AS persons,
       CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS persons_over_threshold
FROM (SELECT id_number, count(*) AS n FROM snapshot GROUP BY id_number)"""))
def employee_detail_sizes(spark, sf):
    """Size report of the per-person detail lists (skew check before the JSON)."""
    return summaries.details_group_sizes(A.snapshot(spark, sf), threshold=1)


@query("group_summary", GROUP_SQL)
def group_summary(spark, sf):
    g = summaries.group_summary(A.snapshot(spark, sf))
    return g.select(*summaries.GROUP_COLUMNS, rnd("total_salary", 4), rnd("avg_salary", 6),
                    rnd("total_allowance", 4), rnd("avg_allowance", 6),
                    rnd("total_compensation", 4), "employee_count", "unique_employee_count",
                    "first_start_date", "last_start_date", rnd("avg_years_of_service", 6),
                    "min_years_of_service", "max_years_of_service")


@query("by_institution", with_ctes(SNAP, body="""
SELECT institution_en, count(*) AS total_employees, round((sum(salary)) + 1e-07, 4) AS total_salary_budget,
       round((sum(allowance)) + 1e-07, 4) AS total_allowance_budget, round((avg(salary)) + 1e-09, 6) AS avg_salary,
       max(salary) AS max_salary
FROM snapshot GROUP BY institution_en ORDER BY total_employees DESC"""))
def by_institution(spark, sf):
    b = summaries.by_institution(A.snapshot(spark, sf))
    return b.select("institution_en", "total_employees", rnd("total_salary_budget", 4),
                    rnd("total_allowance_budget", 4), rnd("avg_salary", 6), "max_salary")


@query("tenure_by_institution", with_ctes(SNAP, body="""
SELECT institution_en, round((avg(years_of_service)) + 1e-09, 6) AS avg_years_service,
       min(years_of_service) AS min_years, max(years_of_service) AS max_years
FROM snapshot GROUP BY institution_en ORDER BY avg_years_service DESC"""))
def tenure_by_institution(spark, sf):
    t = summaries.tenure_by_institution(A.snapshot(spark, sf))
    return t.select("institution_en", rnd("avg_years_service", 6), "min_years", "max_years")


@query("top_100_compensation", with_ctes(SNAP, body="""
SELECT id_number, concat(first_name, ' ', last_name) AS full_name, institution_en, position_en,
       salary, allowance, round((salary + allowance) + 1e-07, 4) AS total_compensation
FROM snapshot ORDER BY salary + allowance DESC NULLS LAST, id_number, composite_key LIMIT 100"""))
def top_100_compensation(spark, sf):
    t = summaries.top_compensation(A.snapshot(spark, sf), k=100)
    return t.withColumn("total_compensation", rnd("total_compensation", 4))


@query("status_distribution", with_ctes(SNAP, body="""
SELECT status_en, count(*) AS employee_count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS percentage
FROM snapshot GROUP BY status_en ORDER BY employee_count DESC"""))
def status_distribution(spark, sf):
    return summaries.status_distribution(A.snapshot(spark, sf))


# ======================================================================== SCD
ORD_SCD = A.ORDERS_SCD_SQL


@query("scd2_history", with_ctes(ORD_SCD, body="SELECT * FROM oh_h"))
def scd2_history(spark, sf):
    return A.orders_history(spark, sf)


@query("scd2_history_split_keys", with_ctes(ORD_SCD, body="SELECT * FROM oh_h"))
def scd2_history_split_keys(spark, sf):
    """SCD2 with the hot-key path forced: every key with more than 4 rows is
    split into sequence chunks of about 2 rows and stitched back - must equal
    the plain history exactly."""
    return A.orders_history(spark, sf, hot_key_rows=4, chunk_rows=2)


@query("scd2_history_bucketed", with_ctes(ORD_SCD, body="SELECT * FROM oh_h"))
def scd2_history_bucketed(spark, sf):
    """SCD2 over orders stored bucketed by the SCD keys: the history is
    computed without any exchange (the scan already hash-partitions it)."""
    import uuid
    from histlake.session import scratch_dir
    from histlake.sources.writers import write_bucketed
    name = f"histlake_orders_{uuid.uuid4().hex[:8]}"
    write_bucketed(A.table(spark, sf, "orders"), name, A.ORDERS_KEYS, 16,
                   sort_by=A.ORDERS_KEYS + ["o_orderdate"], path=scratch_dir(spark, name))
    return scd.scd2(spark.read.table(name), A.ORDERS_KEYS, "o_orderdate", track=["o_orderstatus"],
                    tie_break=["o_orderkey"], partitioned_by_keys=True)


@query("scd2_current", with_ctes(ORD_SCD, body="SELECT * FROM oh_h WHERE __END_AT IS NULL"))
def scd2_current(spark, sf):
    return scd.current(A.orders_history(spark, sf))


@query("scd2_as_of", with_ctes(ORD_SCD, body="""
SELECT * FROM oh_h WHERE __START_AT <= TIMESTAMP '1998-01-01 00:00:00'
  AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '1998-01-01 00:00:00')"""))
def scd2_as_of(spark, sf):
    return scd.as_of(A.orders_history(spark, sf), F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))


@query("scd2_history_point", with_ctes(ORD_SCD, body=f"""
SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, __START_AT AS valid_from,
       coalesce(__END_AT, TIMESTAMP '{A.DETECTED_AT}') AS valid_to,
       CASE WHEN __START_AT = min(__START_AT) OVER (PARTITION BY o_custkey, o_orderpriority)
            THEN 'INSERT' ELSE 'UPDATE' END AS change_type
FROM oh_h ORDER BY __START_AT DESC"""))
def scd2_history_point(spark, sf):
    h = A.orders_history(spark, sf)
    return scd.key_history(h, None, F.lit(A.DETECTED_AT).cast("timestamp_ntz"),
                           ["o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"],
                           change_type="change_type", keys=A.ORDERS_KEYS) \
        .orderBy(F.col("valid_from").desc())


@query("scd2_history_of_key", with_ctes(ORD_SCD, body=f"""
SELECT o_custkey, o_orderpriority, o_orderstatus, __START_AT AS valid_from,
       coalesce(__END_AT, TIMESTAMP '{A.DETECTED_AT}') AS valid_to
FROM oh_h WHERE o_custkey = 7 AND o_orderpriority LIKE '%-%'"""))
def scd2_history_of_key(spark, sf):
    """The history of one key, chosen by column and string predicates (P5, P12,
    C14).  They are on key columns, so Spark applies them to the orders before
    their history is built."""
    return scd.key_history(A.orders_history(spark, sf, hot_key_rows=None), (F.col("o_custkey") == 7) & F.col("o_orderpriority").like("%-%"),
                           F.lit(A.DETECTED_AT).cast("timestamp_ntz"), ["o_custkey", "o_orderpriority", "o_orderstatus"])


@query("scd2_change_type", with_ctes(ORD_SCD, body="""
SELECT *, CASE WHEN __START_AT = min(__START_AT) OVER (PARTITION BY o_custkey, o_orderpriority)
               THEN 'INSERT' ELSE 'UPDATE' END AS change_type FROM oh_h"""))
def scd2_change_type(spark, sf):
    return A.orders_history(spark, sf, change_type_col="change_type")


@query("scd2_change_type_post_hoc", ORACLES["scd2_change_type"])
def scd2_change_type_post_hoc(spark, sf):
    """X3 added to a stored history: first start per key by aggregate, joined back."""
    return scd.with_change_type(A.orders_history(spark, sf), A.ORDERS_KEYS)


@query("scd2_payroll_history", with_ctes(A.PAY_SQL, A.BRONZE_SQL, A.PAY_SCD_SQL,
                                         body="SELECT * FROM ph_h"))
def scd2_payroll_history(spark, sf):
    return A.pay_history(spark, sf)


@query("scd1_latest_log", with_ctes(A.LOG_SQL, body="""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY institution_name_spanish, status_name_spanish
    ORDER BY checked_at DESC, run_status DESC NULLS LAST, source_update DESC NULLS LAST,
             start_at DESC NULLS LAST, end_at DESC NULLS LAST, time DESC NULLS LAST) AS _rn
  FROM log WHERE checked_at IS NOT NULL) WHERE _rn = 1"""))
def scd1_latest_log(spark, sf):
    return scd.scd1(A.log(spark, sf), audit.PAIR, "checked_at")


# =================================================================== inactive
INACTIVE_CTES = ",\n".join([SNAP, A.PAY_SCD_SQL, A.INACTIVE_SQL])


@query("inactive_keys", with_ctes(INACTIVE_CTES, body="SELECT * FROM inactive"))
def inactive_keys(spark, sf):
    return A.inactive(spark, sf)


@query("inactive_listing", with_ctes(INACTIVE_CTES, body="""
SELECT cedula, concat(nombre, ' ', apellido) AS full_name, institucion, cargo, estado, salario,
       last_active_date AS became_active_on
FROM inactive
ORDER BY last_active_date DESC NULLS LAST, cedula, nombre, apellido, cargo, estado LIMIT 100"""))
def inactive_listing(spark, sf):
    return summaries.inactive_listing(A.inactive(spark, sf))


@query("inactive_count", with_ctes(INACTIVE_CTES, body="SELECT count(*) AS inactive_count FROM inactive"))
def inactive_count(spark, sf):
    return summaries.inactive_count(A.inactive(spark, sf))


@query("reconcile_counts", with_ctes(SNAP, A.PAY_SCD_SQL, body="""
SELECT 'SCD Active Records' AS source, count(*) AS count FROM ph_h WHERE __END_AT IS NULL
UNION ALL
SELECT 'Latest Snapshot' AS source, count(*) AS count FROM snapshot"""))
def reconcile_counts(spark, sf):
    return summaries.reconcile_counts(A.pay_history(spark, sf), A.snapshot(spark, sf))


# ================================================================== audit log
LOG = A.LOG_SQL
LAST_RUN_SQL = """last_run AS (
  SELECT *, concat(institution_name_spanish, ' - ', status_name_spanish) AS report,
         CASE WHEN run_status = 'OK' THEN 1 ELSE 0 END AS OK,
         CASE WHEN run_status <> 'OK' THEN 1 ELSE 0 END AS ERROR,
         max(checked_at) OVER (PARTITION BY institution_name_spanish, status_name_spanish) AS last_run
  FROM log QUALIFY last_run = checked_at)"""


def _last_run(spark, sf):
    return audit.last_run(A.log(spark, sf))


@query("log_last_run", with_ctes(LOG, LAST_RUN_SQL, body="SELECT * FROM last_run"))
def log_last_run(spark, sf):
    return _last_run(spark, sf)


@query("log_labelled", with_ctes(LOG, body="""
SELECT *, concat(institution_name_spanish, ' - ', status_name_spanish) AS report FROM log"""))
def log_labelled(spark, sf):
    return audit.labelled(A.log(spark, sf))


@query("log_recent", with_ctes(LOG, body=f"""
SELECT institution_name_spanish, status_name_spanish, run_status, source_update, checked_at,
       time AS execution_time_seconds
FROM log WHERE checked_at >= DATE '{A.AS_OF_DATE}' - INTERVAL 7 DAY ORDER BY checked_at DESC"""))
def log_recent(spark, sf):
    return audit.recent(A.log(spark, sf), A.AS_OF_DATE, days=7)


@query("log_status_table", with_ctes(LOG, LAST_RUN_SQL, body="""
SELECT date_trunc('second', start_at) AS start_second, report, run_status,
       date_trunc('day', source_update) AS source_day, round((avg(time)) + 1e-09, 6) AS avg_time,
       CAST(sum(OK) AS BIGINT) AS ok_count, CAST(sum(ERROR) AS BIGINT) AS error_count
FROM last_run GROUP BY ALL"""))
def log_status_table(spark, sf):
    t = audit.status_table(_last_run(spark, sf))
    return t.withColumn("avg_time", rnd("avg_time", 6))


@query("log_daily_time", with_ctes(LOG, body="""
SELECT date_trunc('day', start_at) AS day, round((avg(time)) + 1e-09, 6) AS avg_time, count(*) AS runs
FROM log GROUP BY ALL"""))
def log_daily_time(spark, sf):
    return audit.daily_time(A.log(spark, sf)).withColumn("avg_time", rnd("avg_time", 6))


@query("log_freshness", with_ctes(LOG, LAST_RUN_SQL, body="""
SELECT max(source_update) AS last_source_update, max(checked_at) AS last_checked_at FROM last_run"""))
def log_freshness(spark, sf):
    return audit.freshness(_last_run(spark, sf))


@query("log_ok_ratio", with_ctes(LOG, LAST_RUN_SQL, body="""
SELECT count(DISTINCT report) AS reports, CAST(sum(OK) AS BIGINT) AS files_downloaded,
       CAST(sum(ERROR) AS BIGINT) AS errors,
       round((sum(OK) / CAST(nullif(count(DISTINCT report), 0) AS DOUBLE)) + 1e-09, 6) AS downloaded_ratio,
       round((sum(ERROR) / CAST(nullif(count(DISTINCT report), 0) AS DOUBLE)) + 1e-09, 6) AS error_ratio
FROM last_run"""))
def log_ok_ratio(spark, sf):
    r = audit.ok_ratio(_last_run(spark, sf))
    return r.select("reports", "files_downloaded", "errors", rnd("downloaded_ratio", 6),
                    rnd("error_ratio", 6))


_LATER = ("institution_name_spanish, status_name_spanish, 'OK' AS run_status, source_update, checked_at + INTERVAL 365 DAYS AS checked_at, "
          "start_at, end_at, time")


@query("log_view_counters", with_ctes(
    LOG.replace("log AS", "log_before AS", 1),
    f"log AS (SELECT * FROM log_before UNION ALL SELECT {_LATER} FROM log_before WHERE run_status = 'FAIL')", LAST_RUN_SQL, body="""
SELECT count(DISTINCT report) AS reports, CAST(sum(OK) AS BIGINT) AS files_downloaded,
       CAST(sum(ERROR) AS BIGINT) AS errors,
       max(source_update) AS last_source_update, max(checked_at) AS last_checked_at
FROM last_run"""))
def log_view_counters(spark, sf):
    """The last-run view in the catalog (S9) over a stored log; failed runs are
    appended as repeated a year later *after* the view is made, and the
    dashboard's counters on the view see them."""
    import uuid
    from histlake.session import scratch_dir
    run = uuid.uuid4().hex[:8]
    stored, name = f"histlake_log_{run}", f"histlake_last_run_{run}"
    A.log(spark, sf).write.option("path", scratch_dir(spark, stored)).saveAsTable(stored)
    audit.create_last_run_view(spark, stored, name)
    spark.sql(f"INSERT INTO {stored} SELECT {_LATER} FROM {stored} WHERE run_status = 'FAIL'")
    return spark.sql(f"""
        SELECT count(DISTINCT report) AS reports, sum(OK) AS files_downloaded, sum(ERROR) AS errors,
               max(source_update) AS last_source_update, max(checked_at) AS last_checked_at
        FROM {name}""")


WORK_BASE_URL = "https://example.org/report"


@query("work_list", with_ctes(LOG, body=f"""
SELECT i.institution_name_spanish, s.status_name_spanish,
       '{WORK_BASE_URL}' || '?&Ne=' || replace(url_encode(i.institution_name_spanish), '%2F', '/')
         || '&N=&A=&C=&E=' || replace(url_encode(s.status_name_spanish), '%2F', '/') AS url
FROM (SELECT DISTINCT institution_name_spanish FROM log) i,
     (SELECT DISTINCT status_name_spanish FROM log) s
WHERE NOT EXISTS (
  SELECT 1 FROM log l WHERE l.run_status = 'OK' AND l.source_update >= TIMESTAMP '{A.AS_OF_DATE} 00:00:00'
    AND l.institution_name_spanish = i.institution_name_spanish
    AND l.status_name_spanish = s.status_name_spanish)"""))
def work_list(spark, sf):
    log = A.log(spark, sf)
    return audit.work_list(log.select("institution_name_spanish"), log.select("status_name_spanish"),
                           log, F.lit(f"{A.AS_OF_DATE} 00:00:00").cast("timestamp_ntz"),
                           base_url=WORK_BASE_URL)


@query("audit_rows", with_ctes(LOG, body=f"""
SELECT institution_name_spanish, status_name_spanish, run_status, source_update,
       TIMESTAMP '{A.DETECTED_AT}' AS checked_at, start_at, end_at,
       CAST(date_diff('microsecond', start_at, end_at) / 1000000.0 AS FLOAT) AS time,
       CAST(sum(CASE WHEN run_status = 'OK' THEN 1 ELSE 0 END) OVER () AS BIGINT) AS updates
FROM log"""))
def audit_rows(spark, sf):
    """Attempts -> typed audit rows appended to a table, read back."""
    from histlake.schemas import AUDIT_LOG_SCHEMA
    from histlake.session import scratch_dir
    from histlake.sources.writers import append_typed
    attempts = A.log(spark, sf).drop("checked_at", "time")
    rows = audit.audit_rows(attempts, F.lit(A.DETECTED_AT).cast("timestamp"))
    path = append_typed(rows, scratch_dir(spark, "audit_log"), AUDIT_LOG_SCHEMA)
    stored = spark.read.schema(AUDIT_LOG_SCHEMA).parquet(path)
    updates = audit.updates_count(stored).scalar()
    return stored.withColumn("updates", updates)


@query("declared_log_table", with_ctes(LOG, body=f"""
SELECT institution_name_spanish, status_name_spanish, coalesce(run_status, 'none') AS run_status,
       count(*) AS runs, min(checked_at) AS first_checked_at FROM (
  SELECT institution_name_spanish, status_name_spanish, run_status, TIMESTAMP '{A.DETECTED_AT}' AS checked_at FROM log
  UNION ALL SELECT institution_name_spanish, status_name_spanish, run_status, checked_at FROM log)
GROUP BY 1, 2, 3"""))
def declared_log_table(spark, sf):
    """A table with NOT NULL and default columns (S10): one INSERT leaves the
    check time to its default, one gives it; then read as a stream by name (S4)
    into a table that is summarised."""
    import uuid
    from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType
    from histlake.session import scratch_dir
    from histlake.sources.readers import read_stream_table
    from histlake.sources.writers import define_table
    from histlake.streaming.ingest import run_to_completion
    run = uuid.uuid4().hex[:8]
    name, out = f"histlake_declared_{run}", scratch_dir(spark, "declared_out")
    schema = StructType([StructField("institution_name_spanish", StringType(), False), StructField("status_name_spanish", StringType(), False),
                         StructField("run_status", StringType()), StructField("checked_at", TimestampNTZType(), False)])
    define_table(spark, name, schema, {"checked_at": f"TIMESTAMP_NTZ '{A.DETECTED_AT}'"}, path=scratch_dir(spark, name))
    log, some = A.log(spark, sf), ["institution_name_spanish", "status_name_spanish", "run_status"]
    log.createOrReplaceTempView(f"{name}_in")
    spark.sql(f"INSERT INTO {name} ({', '.join(some)}) SELECT {', '.join(some)} FROM {name}_in")
    spark.sql(f"INSERT INTO {name} SELECT {', '.join(some)}, checked_at FROM {name}_in")
    spark.catalog.dropTempView(f"{name}_in")
    run_to_completion(read_stream_table(spark, name).writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", scratch_dir(spark, "declared_ckpt")))
    rows = spark.read.schema(schema).parquet(out)
    return rows.groupBy("institution_name_spanish", "status_name_spanish", F.coalesce("run_status", F.lit("none")).alias("run_status")) \
        .agg(F.count("*").alias("runs"), F.min("checked_at").alias("first_checked_at"))


# =========================================================== reference tables
def _dict_sql(name, pairs):
    return A.dictionary_sql(name, pairs)


# user ids have no translation: an empty dictionary keeps every name as is
EMPTY_DICT_SQL = "inst_dict(source, target) AS (SELECT NULL::VARCHAR, NULL::VARCHAR WHERE false)"


@query("reference_institutions", with_ctes(LOG, EMPTY_DICT_SQL,
                                           A.reference_sql("r", "institution_name_spanish",
                                                      "institution_name_english", "inst_dict", "log"),
                                           body="SELECT * FROM r"))
def reference_institutions(spark, sf):
    empty = spark.createDataFrame([], "source string, target string")
    return reference.reference_names(A.log(spark, sf), "institution_name_spanish",
                                     "institution_name_english", empty, dictionary_rows=0)


@query("reference_statuses", with_ctes(LOG, _dict_sql("ev_dict", A.EVENT_TYPE_DICTIONARY),
                                       A.reference_sql("r", "status_name_spanish", "status_name_english",
                                                  "ev_dict", "log"),
                                       body="SELECT * FROM r"))
def reference_statuses(spark, sf):
    return reference.reference_names(A.log(spark, sf), "status_name_spanish", "status_name_english",
                                     A.dictionary(spark, A.EVENT_TYPE_DICTIONARY),
                                     dictionary_rows=len(A.EVENT_TYPE_DICTIONARY))


@query("reference_positions", with_ctes(A.PAY_SQL, A.PAYLOG_SQL, A.REFERENCE_SQL,
                                        body="SELECT * FROM pos_ref"))
def reference_positions(spark, sf):
    return A.reference_tables(spark, sf)[2]  # positions


KNOWN_SINCE = "1995-06-01 00:00:00"  # orders start on 1995-01-01: about half the titles come first after it


@query("new_positions_only", with_ctes(A.PAY_SQL, A.PAYLOG_SQL, A.REFERENCE_SQL, body=f"""
SELECT c.position_name_spanish, c.last_seen_at,
       coalesce(d.target, c.position_name_spanish) AS position_name_english
FROM (SELECT cargo || ' ' || cedula AS position_name_spanish, min(fecha_actualizacion) AS last_seen_at
      FROM pay WHERE cargo || ' ' || cedula IS NOT NULL GROUP BY 1) c
LEFT JOIN (SELECT source, min(target) AS target FROM prio_dict GROUP BY source) d
  ON c.position_name_spanish = d.source
WHERE c.last_seen_at >= TIMESTAMP '{KNOWN_SINCE}'"""))
def new_positions_only(spark, sf):
    """Titles (a position with its holder) of all payroll rows that a reference table
    made from the first months' rows does not have yet."""
    words = A.dictionary(spark, A.PRIORITY_DICTIONARY)
    pay = A.pay(spark, sf).withColumn("cargo", F.concat("cargo", F.lit(" "), "cedula"))
    existing = reference.position_reference(pay.where(F.col("fecha_actualizacion") < F.lit(KNOWN_SINCE).cast("timestamp_ntz")), words,
                                            dictionary_rows=len(A.PRIORITY_DICTIONARY))
    return reference.position_reference(pay, words, existing=existing, dictionary_rows=len(A.PRIORITY_DICTIONARY))


@query("translate_lookup_udf", with_ctes(_dict_sql("lang_dict", A.LANGUAGE_DICTIONARY), body="""
SELECT d.doc_id, d.lang, coalesce(l.target, d.lang) AS lang_label
FROM documents d LEFT JOIN lang_dict l ON d.lang = l.source"""))
def translate_lookup_udf(spark, sf):
    """Translation through a vectorised function (pandas UDF) applied to the
    distinct languages only, joined back to every document."""
    table = dict(A.LANGUAGE_DICTIONARY)

    def to_label(names):
        return names.map(table).fillna(names)
    docs = A.table(spark, sf, "documents").select("doc_id", "lang")
    return reference.translate_distinct(docs, "lang", to_label, "lang_label")


@query("translate_lookup", with_ctes(_dict_sql("lang_dict", A.LANGUAGE_DICTIONARY), body="""
SELECT d.doc_id, d.lang, coalesce(l.target, d.lang) AS lang_label, l.target IS NOT NULL AS translated
FROM documents d LEFT JOIN (SELECT source, min(target) AS target FROM lang_dict GROUP BY source) l
  ON d.lang = l.source"""))
def translate_lookup(spark, sf):
    docs = A.table(spark, sf, "documents").select("doc_id", "lang")
    return A.translated(docs, "lang", A.LANGUAGE_DICTIONARY, "lang_label", flag_col="translated")


# ======================================================================= text
def _unescape_sql(expr: str) -> str:
    from histlake.functions.text import HTML_ENTITIES
    for entity, char in HTML_ENTITIES:
        expr = f"replace({expr}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return expr


@query("html_list_items", r"""
SELECT page_id, CAST(position AS BIGINT) AS position, item FROM (
  SELECT page_id, position, """ + _unescape_sql("raw") + r""" AS item FROM (
    SELECT page_id, generate_subscripts(items, 1) AS position, unnest(items) AS raw
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items
          FROM pages)))
WHERE trim(item) <> '' AND NOT contains(trim(item), 'Seleccione')""")
def html_list_items(spark, sf):
    from histlake.functions.text import list_items
    return list_items(A.table(spark, sf, "pages"), "html", "page_id")


@query("html_elements", r"""
SELECT page_id, CAST(position AS BIGINT) AS position, href, """ + _unescape_sql("raw") + r""" AS item FROM (
  SELECT page_id, generate_subscripts(items, 1) AS position, unnest(items) AS raw, unnest(links) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items,
               regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS links FROM pages))""")
def html_elements(spark, sf):
    """Every link of every page with its text, by the tokeniser."""
    from histlake.functions.html import attribute, elements
    from histlake.functions.text import unescape_html
    found = A.table(spark, sf, "pages").select("page_id", F.posexplode(elements(F.col("html"), "a")).alias("at", "e"))
    return found.select("page_id", (F.col("at") + 1).cast("long").alias("position"), attribute(F.col("e.tag"), "href").alias("href"),
                        unescape_html(F.col("e.text")).alias("item"))


@query("drop_down_options", """
WITH o AS (SELECT c_custkey, unnest([c_mktsegment || ' ó ñ', 'Región & ' || c_name]) AS option FROM customer)
SELECT c_custkey, option, replace(url_encode(option), '%2F', '/') AS quoted FROM o""")
def drop_down_options(spark, sf):
    """Options of a page's drop-down (T3): the placeholder is left out (F19),
    named and numeric references are decoded, names quoted for a URL (F17)."""
    from histlake.functions.text import select_options, url_quote
    c = A.spread(A.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name"))
    html = F.concat(F.lit('<form><select id="otra"><option>no</option></select><select class="c" id="lista">'
                          '<option value="">Seleccione una</option><option> </option><option value="1">'), F.col("c_mktsegment"),
                    F.lit(" &oacute; &#241;</option><option>Regi&#xF3;n &amp; "), F.col("c_name"), F.lit("</option></select></form>"))
    return c.select("c_custkey", F.explode(select_options(html, "lista")).alias("option")).withColumn("quoted", url_quote(F.col("option")))


PAGE_TEXT_PREFIX = "Fecha de actualización de los datos: "


@query("page_date_extract", f"""
WITH t AS (
  SELECT event_id, '{PAGE_TEXT_PREFIX}' || strftime(ts, '%d/%m/%Y %I:%M:%S %p') || ' (hora local)' AS text,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE 'attachment; filename="planilla_' || event_type || '.xlsx"' END AS header
  FROM events),
m AS (SELECT *, nullif(regexp_extract(text,
  'Fecha de actualización de los datos:\\s+(\\d{{1,2}}/\\d{{1,2}}/\\d+\\s+\\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}\\s+\\w+)', 1), '') AS s
  FROM t)
SELECT event_id,
       try_strptime(regexp_replace(s, '\\s+\\w+$', ''), '%d/%m/%Y %H:%M:%S') AS update_compat,
       try_strptime(s, '%d/%m/%Y %I:%M:%S %p') AS update_strict,
       CASE WHEN regexp_extract(coalesce(header, ''), 'filename="(.*?).xlsx"', 1) = '' THEN 'reporte'
            ELSE regexp_extract(coalesce(header, ''), 'filename="(.*?).xlsx"', 1) END AS file_name
FROM m""")
def page_date_extract(spark, sf):
    from histlake.functions.text import extract_update_date, file_name_from_header
    e = A.table(spark, sf, "events")
    t = e.select("event_id",
                 F.concat(F.lit(PAGE_TEXT_PREFIX), F.date_format("ts", "dd/MM/yyyy hh:mm:ss a"),
                          F.lit(" (hora local)")).alias("text"),
                 F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit('attachment; filename="planilla_'), F.col("event_type"),
                                      F.lit('.xlsx"'))).alias("header"))
    return t.select("event_id",
                    extract_update_date(F.col("text")).alias("update_compat"),
                    extract_update_date(F.col("text"), strict=True).alias("update_strict"),
                    file_name_from_header(F.col("header")).alias("file_name"))


@query("sheet_clean", with_ctes(A.RAW_CELLS_SQL, A.SHEET_CLEAN_SQL, body="SELECT * FROM sheet_clean"))
def sheet_clean(spark, sf):
    from histlake.functions.text import clean_sheets
    return clean_sheets(A.raw_cells(spark, sf))


@query("sheet_clean_staged", ORACLES["sheet_clean"])
def sheet_clean_staged(spark, sf):
    """Cleaned sheet rows written as staging Parquet - partitioned by status,
    clustered by institution, timestamps as INT96 - and read back with the
    declared schema."""
    from histlake.functions.text import clean_sheets
    from histlake.schemas import STAGING_SCHEMA
    from histlake.session import scratch_dir
    from histlake.sources.readers import read_batch
    from histlake.sources.writers import write_clustered
    path = write_clustered(clean_sheets(A.raw_cells(spark, sf)), scratch_dir(spark, "staging"),
                           cluster_by=["institucion", "cedula"], partition_by=["estado"], timestamp_type="INT96")
    return read_batch(spark, path, STAGING_SCHEMA)


@query("union_missing_columns", """
SELECT p_partkey, p_name, p_brand FROM part WHERE p_size <= 25
UNION ALL BY NAME
SELECT p_partkey, p_type, p_size FROM part WHERE p_size > 25""")
def union_missing_columns(spark, sf):
    p = A.table(spark, sf, "part")
    a = p.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_brand")
    b = p.where(F.col("p_size") > 25).select("p_partkey", "p_type", "p_size")
    return a.unionByName(b, allowMissingColumns=True)


# ==================================================================== profile
COMP_SQL = "comp AS (SELECT salario + gasto AS total_compensation FROM pay)"


def _compensation(spark, sf):
    return A.pay(spark, sf).select((F.col("salario") + F.col("gasto")).alias("total_compensation"))


QUANTILES = [0.001, 0.01, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99, 0.999]


@query("profile_summary", with_ctes(A.PAY_SQL, COMP_SQL, body="""
SELECT count(total_compensation) AS count, round((avg(total_compensation)) + 1e-09, 6) AS mean,
       round((stddev_samp(total_compensation)) + 1e-09, 6) AS stddev, min(total_compensation) AS min,
       quantile_disc(total_compensation, 0.25) AS p25, quantile_disc(total_compensation, 0.5) AS p50,
       quantile_disc(total_compensation, 0.75) AS p75, max(total_compensation) AS max
FROM comp"""))
def profile_summary(spark, sf):
    d = profile.describe(_compensation(spark, sf), "total_compensation", materialize=True)
    return d.select("count", rnd("mean", 6), rnd("stddev", 6), "min", "p25", "p50", "p75", "max")


@query("profile_quantiles", "\nUNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS probability, quantile_disc(l_extendedprice, {p}) AS value FROM lineitem" for p in QUANTILES))
def profile_quantiles(spark, sf):
    """Exact deciles and outer quantiles of the line prices, by small sketches
    and counts (a row per probability)."""
    values = profile.exact_quantiles(A.table(spark, sf, "lineitem"), "l_extendedprice", QUANTILES)
    return spark.createDataFrame(list(zip(QUANTILES, values)), "probability double, value double")


@query("profile_skew", with_ctes(A.PAY_SQL, COMP_SQL, body="""
SELECT round((avg(power(x - m, 3)) / power(var_pop(x), 1.5)) + 1e-09, 6) AS skew_original,
       round((avg(power(lx - lm, 3)) / power(var_pop(lx), 1.5)) + 1e-09, 6) AS skew_log
FROM (SELECT total_compensation AS x, avg(total_compensation) OVER () AS m,
             ln(1 + total_compensation) AS lx, avg(ln(1 + total_compensation)) OVER () AS lm FROM comp)"""))
def profile_skew(spark, sf):
    s = profile.skewness_raw_and_log(_compensation(spark, sf), "total_compensation")
    return s.select(rnd("skew_original", 6), rnd("skew_log", 6))


HIST_BIN = "CAST(CASE WHEN b.w > 0 THEN least(floor((v.x - b.lo) / b.w), 99) ELSE 0 END AS INTEGER)"


@query("profile_histogram", with_ctes(
    A.PAY_SQL, COMP_SQL,
    "v AS (SELECT ln(1 + total_compensation) AS x FROM comp)",
    "b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 100.0 AS w FROM v)",
    body=f"""
SELECT {HIST_BIN} AS bin,
       round((any_value(b.lo) + {HIST_BIN} * any_value(b.w)) + 1e-09, 6) AS bin_start,
       round((any_value(b.lo) + ({HIST_BIN} + 1) * any_value(b.w)) + 1e-09, 6) AS bin_end,
       count(*) AS count
FROM v, b WHERE v.x IS NOT NULL GROUP BY 1"""))
def profile_histogram(spark, sf):
    c = _compensation(spark, sf).select(F.log1p("total_compensation").alias("log_compensation"))
    h = profile.histogram(c, "log_compensation", bins=100, materialize=True)
    return h.select("bin", rnd("bin_start", 6), rnd("bin_end", 6), "count")


@query("quality_report", """
SELECT 'not_null' AS "check", c AS "column", n AS violations FROM (
  SELECT 'o_orderkey' AS c, count(*) - count(o_orderkey) AS n FROM orders UNION ALL
  SELECT 'o_custkey', count(*) - count(o_custkey) FROM orders UNION ALL
  SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM orders UNION ALL
  SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM orders UNION ALL
  SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM orders)
UNION ALL
SELECT 'domain', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
UNION ALL
SELECT 'domain', 'o_orderpriority',
       count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM orders
UNION ALL
SELECT 'unique', 'o_custkey,o_orderdate', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""")
def quality_report(spark, sf):
    o = A.table(spark, sf, "orders")
    return profile.quality_report(
        o, not_null=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
        unique=["o_custkey", "o_orderdate"],
        domains={"o_orderstatus": ["F", "O", "P"],
                 "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})


_ODD = """(SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS customer,
  CASE WHEN o_orderkey % 13 = 0 THEN 'x' || o_totalprice ELSE CAST(o_totalprice AS VARCHAR) END AS price FROM orders)"""
_RULES = {"not_null:customer": "customer IS NULL", "domain:o_orderpriority": "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
          "cast:price": "o_orderkey % 13 = 0", "check:recent": "NOT o_orderdate >= DATE '1995-06-01'",
          "unique:customer,o_orderdate": "n > 1"}


@query("quality_set_apart", f"""
WITH r AS (SELECT *, count(*) OVER (PARTITION BY customer, o_orderdate) AS n FROM {_ODD}),
f AS (SELECT *, {" OR ".join(f"coalesce({c}, false)" for c in _RULES.values())} AS bad FROM r)
{" UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) AS rows FROM f WHERE {c} HAVING count(*) > 0" for name, c in _RULES.items())}
UNION ALL SELECT 'rejected', count(*) FROM f WHERE bad UNION ALL SELECT 'accepted', count(*) FROM f WHERE NOT bad""")
def quality_set_apart(spark, sf):
    """Orders (some customers and prices made bad) loaded with constraints: one pass
    stores good and bad rows apart, the latter with their reasons; counts per rule."""
    o = A.table(spark, sf, "orders")
    o = o.withColumns({"customer": F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")),
                       "price": F.when(F.col("o_orderkey") % 13 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string"))})
    checked = profile.with_violations(
        o, not_null=["customer"], domains={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}, casts={"price": "double"},
        checks={"recent": F.col("o_orderdate") >= F.lit("1995-06-01").cast("date")}, unique=["customer", "o_orderdate"])
    return profile.violation_counts(*profile.set_apart(checked, _scratch(spark, "orders_checked")))


# =================================================================== layout
@query("clustered_write_readback", "SELECT * FROM lineitem")
def clustered_write_readback(spark, sf):
    """lineitem written range-clustered by ship date and partitioned by
    return flag, then read back (partition column restored by discovery)."""
    from histlake.session import scratch_dir
    from histlake.sources.writers import write_clustered
    li = A.table(spark, sf, "lineitem")
    path = write_clustered(li, scratch_dir(spark, "lineitem_clustered"), cluster_by=["l_shipdate"],
                           partition_by=["l_returnflag"])
    return spark.read.parquet(path).select(*li.columns)


@query("curve_write_readback", "SELECT * FROM lineitem")
def curve_write_readback(spark, sf):
    """lineitem written along a space-filling curve over ship date, part and
    supplier, so that filters on any of them skip row groups; then read back."""
    from histlake.sources.writers import write_clustered
    li = A.table(spark, sf, "lineitem")
    path = write_clustered(li, _scratch(spark, "lineitem_curve"), ["l_shipdate", "l_partkey", "l_suppkey"], curve=True)
    return spark.read.parquet(path).select(*li.columns)


# ================================================================ streaming
def _scratch(spark, name):
    from histlake.session import scratch_dir
    return scratch_dir(spark, name)


def _staged(spark, df, name, files=4, order_by=None):
    from histlake.streaming.ingest import stage_files
    path = stage_files(df, _scratch(spark, f"{name}_staging"), files, order_by)
    return path, df.schema


@query("stream_ingest", ORACLES["bronze_keys_tenure"])
def stream_ingest(spark, sf):
    """Staged payroll files -> streaming bronze (key + tenure) -> read back."""
    from histlake.operators.keys import with_key_and_tenure
    from histlake.streaming.ingest import ingest_stream
    path, schema = _staged(spark, A.pay(spark, sf), "pay", files=4, order_by="fecha_consulta")
    sink = ingest_stream(spark, path, schema, _scratch(spark, "bronze"), _scratch(spark, "ckpt"),
                         transform=with_key_and_tenure, max_files_per_trigger=1, cluster_by=["institucion", "fecha_actualizacion"])
    return sink.read().select("source_row", "cedula", "composite_key",
                                           "fecha_consulta", "fecha_de_inicio", "antiguedad")


@query("staged_files_unread", """
SELECT 4 AS staged, 1 AS unread, count(*) AS rows_read FROM orders WHERE o_orderdate < DATE '1996-06-01'""")
def staged_files_unread(spark, sf):
    """Three files of orders arrive and are ingested, then a fourth one with all later
    orders: the inventory of staged files against the paths that bronze's rows carry."""
    from histlake.sources.readers import file_inventory, unread_files
    from histlake.streaming.ingest import ingest_stream
    orders = A.table(spark, sf, "orders")
    staging, day = _scratch(spark, "inventory_staging"), F.col("o_orderdate")
    arrivals = [day < "1995-06-01", (day >= "1995-06-01") & (day < "1996-01-01"), (day >= "1996-01-01") & (day < "1996-06-01"), day >= "1996-06-01"]
    arrive = lambda some: orders.where(some).coalesce(1).write.mode("append").parquet(staging)
    for some in arrivals[:3]:
        arrive(some)
    bronze = ingest_stream(spark, staging, orders.schema, _scratch(spark, "bronze"), _scratch(spark, "ckpt"), file_col="source_file").read()
    arrive(arrivals[3])
    files = file_inventory(spark, staging)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    counts = count(files, "staged").unionByName(count(unread_files(files, bronze, "source_file"), "unread")).unionByName(count(bronze, "rows_read"))
    of = lambda name: F.max(F.when(F.col("what") == name, F.col("n")))
    return counts.agg(of("staged").cast("int").alias("staged"), of("unread").cast("int").alias("unread"), of("rows_read").alias("rows_read"))


@query("stream_grouped_max", ORACLES["reference_statuses"])
def stream_grouped_max(spark, sf):
    """Streaming status reference table (complete-mode aggregate + translation)."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.reference import grouped_max_stream
    path, schema = _staged(spark, A.log(spark, sf), "log", files=4)
    target = grouped_max_stream(
        read_stream(spark, path, schema, max_files_per_trigger=1), "status_name_spanish",
        _scratch(spark, "statuses"), _scratch(spark, "ckpt"),
        enrich=lambda b: A.translated(b, "status_name_spanish", A.EVENT_TYPE_DICTIONARY,
                                      "status_name_english"))
    return spark.read.parquet(target).select("status_name_spanish", "last_source_update",
                                             "last_checked_at", "status_name_english")


@query("stream_distinct", with_ctes(A.PAY_SQL, body="""
SELECT DISTINCT cargo AS position_name_spanish FROM pay WHERE cargo IS NOT NULL"""))
def stream_distinct(spark, sf):
    """Streaming distinct positions: each micro-batch's minus those the sink has."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.reference import distinct_stream
    src_df = A.pay(spark, sf).select(F.col("cargo").alias("position_name_spanish"),
                                     F.col("fecha_actualizacion").alias("last_seen_at"))
    path, schema = _staged(spark, src_df, "positions", files=4)
    target = distinct_stream(spark, read_stream(spark, path, schema, max_files_per_trigger=1),
                             "position_name_spanish", _scratch(spark, "positions"),
                             _scratch(spark, "ckpt"))
    return spark.read.parquet(target).select("position_name_spanish")


@query("stream_new_keys", with_ctes(A.PAY_SQL, A.dictionary_sql("prio_dict", A.PRIORITY_DICTIONARY),
                                    body="""
SELECT c.cargo AS position_name_spanish, coalesce(d.target, c.cargo) AS position_name_english
FROM (SELECT DISTINCT cargo FROM pay WHERE cargo IS NOT NULL) c
LEFT JOIN (SELECT source, min(target) AS target FROM prio_dict GROUP BY source) d ON c.cargo = d.source"""))
def stream_new_keys(spark, sf):
    """Only-new-positions maintenance over several micro-batches."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.reference import new_keys_stream
    src_df = A.pay(spark, sf).select(F.col("cargo").alias("position_name_spanish"),
                                     F.col("fecha_actualizacion").alias("last_seen_at"))
    path, schema = _staged(spark, src_df, "positions", files=4)
    target = new_keys_stream(
        spark, read_stream(spark, path, schema, max_files_per_trigger=1), "position_name_spanish",
        "last_seen_at", _scratch(spark, "positions"), _scratch(spark, "ckpt"),
        enrich=lambda b: A.translated(b, "position_name_spanish", A.PRIORITY_DICTIONARY,
                                      "position_name_english"))
    return spark.read.parquet(target).select("position_name_spanish", "position_name_english")


@query("stream_scd1", ORACLES["scd1_latest_log"])
def stream_scd1(spark, sf):
    """SCD1 of the audit log maintained over out-of-order micro-batches."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.cdc import scd_stream
    log = A.log(spark, sf)
    path, schema = _staged(spark, log, "log", files=4)
    latest = scd_stream(spark, read_stream(spark, path, schema, max_files_per_trigger=1),
                        audit.PAIR, "checked_at", _scratch(spark, "scd1"), _scratch(spark, "ckpt"), scd_type=1)
    return latest.select(*log.columns)


@query("stream_scd1_state", ORACLES["scd1_latest_log"])
def stream_scd1_state(spark, sf):
    """SCD1 of the audit log from keyed state, over out-of-order micro-batches."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.latest import latest_stream
    log = A.log(spark, sf)
    path, schema = _staged(spark, log, "log", files=4)
    latest = latest_stream(spark, read_stream(spark, path, schema, max_files_per_trigger=2), audit.PAIR, "checked_at",
                           _scratch(spark, "scd1_state"), _scratch(spark, "ckpt"))
    return latest.select(*log.columns)


@query("stream_scd2", ORACLES["scd2_history"])
def stream_scd2(spark, sf):
    """SCD2 of orders maintained over out-of-order micro-batches (late rows
    split versions exactly as in the batch result)."""
    from histlake.sources.readers import read_stream
    from histlake.streaming.cdc import scd_stream
    orders = A.table(spark, sf, "orders")
    path, schema = _staged(spark, orders, "orders", files=4)
    history = scd_stream(spark, read_stream(spark, path, schema, max_files_per_trigger=1),
                         A.ORDERS_KEYS, "o_orderdate", _scratch(spark, "scd2"), _scratch(spark, "ckpt"), scd_type=2,
                         track=["o_orderstatus"], tie_break=["o_orderkey"])
    return history.select(*orders.columns, "__START_AT", "__END_AT")


# ==================================================== materialised refresh
@query("refresh_gold_groups", GROUP_SQL)
def refresh_gold_groups(spark, sf):
    """All derived tables recomputed and stored in dependency order; the
    stored gold group table is read back."""
    from histlake.plans.refresh import refresh
    from histlake.session import scratch_dir
    inst, stat, pos, bound = A.reference_tables(spark, sf)
    paths = refresh(spark, A.bronze(spark, sf), A.pay_history(spark, sf), inst, stat, pos,
                    scratch_dir(spark, "tables"), detected_at=A.DETECTED_AT, dimension_rows=bound)
    g = spark.read.parquet(paths["gold_groups"])
    return g.select(*summaries.GROUP_COLUMNS, rnd("total_salary", 4), rnd("avg_salary", 6),
                    rnd("total_allowance", 4), rnd("avg_allowance", 6),
                    rnd("total_compensation", 4), "employee_count", "unique_employee_count",
                    "first_start_date", "last_start_date", rnd("avg_years_of_service", 6),
                    "min_years_of_service", "max_years_of_service")


# ========================================================== end-to-end flow
FLOW_DICTIONARY = A.SEGMENT_DICTIONARY + A.ORDER_STATUS_DICTIONARY + A.PRIORITY_DICTIONARY


@query("flow_snapshot", with_ctes(
    A.PAY_SQL, A.BRONZE_SQL, A.PAYLOG_SQL, A.dictionary_sql("flow_dict", FLOW_DICTIONARY),
    A.reference_sql("inst_ref", "institution_name_spanish", "institution_name_english", "flow_dict"),
    A.reference_sql("stat_ref", "status_name_spanish", "status_name_english", "flow_dict"),
    """pos_ref AS (
  SELECT DISTINCT b.cargo AS position_name_spanish,
         coalesce(d.target, b.cargo) AS position_name_english
  FROM bronze b LEFT JOIN (SELECT source, min(target) AS target FROM flow_dict GROUP BY source) d
    ON b.cargo = d.source
  WHERE b.cargo IS NOT NULL)""",
    A.SNAPSHOT_SQL, body="SELECT * FROM snapshot"))
def flow_snapshot(spark, sf):
    """The triggered flow end to end: payroll rows staged as files and the OK
    log as the audit log -> bronze, SCD2, latest log, reference tables,
    positions, refresh; the stored snapshot is returned."""
    from histlake.schemas import AUDIT_LOG_SCHEMA
    from histlake.session import scratch_dir
    from histlake.streaming.flow import run_triggered_flow
    from histlake.streaming.ingest import stage_files
    staging = stage_files(A.pay(spark, sf).drop("source_row"), scratch_dir(spark, "flow_staging"), 4,
                          order_by="fecha_consulta")
    log = A.paylog(spark, sf).select(
        "institution_name_spanish", "status_name_spanish", "run_status", "source_update",
        "checked_at", F.col("checked_at").alias("start_at"), F.col("checked_at").alias("end_at"),
        F.lit(0.0).cast("float").alias("time"))
    audit_log = scratch_dir(spark, "flow_log")
    log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT_LOG_SCHEMA.fields]) \
       .write.parquet(audit_log)
    paths = run_triggered_flow(spark, staging, audit_log, A.dictionary(spark, FLOW_DICTIONARY),
                               scratch_dir(spark, "flow"))
    return spark.read.parquet(paths["snapshot"])
