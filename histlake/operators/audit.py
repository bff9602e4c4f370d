"""Extraction audit log: work list, audit rows, last-run view and the
dashboard queries (J6, T5, T7, W1, W2, A11, A14-A16, C11, C18, C21-C24,
C26, P9, P11, P13, F3, F6, F20).

Column names follow the audit-log schema (``schemas.AUDIT_LOG_SCHEMA``);
every operator takes the log as a DataFrame, so the same code runs on the
stored table or on a stream's batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.functions.text import url_quote

INST = "institution_name_spanish"
STAT = "status_name_spanish"
PAIR = [INST, STAT]


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def labelled(log: DataFrame) -> DataFrame:
    """``SELECT *, concat(institution, ' - ', status) AS report``."""
    return log.select("*", F.concat(F.col(INST), F.lit(" - "), F.col(STAT)).alias("report"))


def last_run(log: DataFrame) -> DataFrame:
    """The last-run view (C11): every row of a pair at its latest
    ``checked_at`` (all ties kept, NULL ``checked_at`` dropped), with
    ``report``, ``OK`` / ``ERROR`` flags (``No Update`` counts as error) and
    ``last_run``.

    Planned as grouped maxima (partial aggregate) joined back on
    (pair, checked_at) - equal to ``max() OVER (PARTITION BY pair)`` +
    filter, but a hot pair never lands in a single task.
    """
    maxima = log.groupBy(*PAIR).agg(F.max("checked_at").alias("last_run"))
    maxima = maxima.select(F.col(INST).alias("_mi"), F.col(STAT).alias("_ms"), "last_run")
    cond = (F.col(INST).eqNullSafe(F.col("_mi")) & F.col(STAT).eqNullSafe(F.col("_ms"))
            & (F.col("checked_at") == F.col("last_run")))
    joined = log.join(maxima, cond, "inner")
    ok = F.col("run_status") == F.lit("OK")
    return joined.select(
        *[F.col(c) for c in log.columns],
        F.concat(F.col(INST), F.lit(" - "), F.col(STAT)).alias("report"),
        F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("OK"),
        F.when(F.col("run_status") != F.lit("OK"), F.lit(1)).otherwise(F.lit(0)).alias("ERROR"),
        F.col("last_run"))


LAST_RUN_SQL = """
SELECT l.*, concat(l.institution_name_spanish, ' - ', l.status_name_spanish) AS report,
       CASE WHEN l.run_status = 'OK' THEN 1 ELSE 0 END AS OK,
       CASE WHEN l.run_status <> 'OK' THEN 1 ELSE 0 END AS ERROR, m.last_run
FROM {log} l JOIN (SELECT institution_name_spanish AS mi, status_name_spanish AS ms, max(checked_at) AS last_run
                   FROM {log} GROUP BY institution_name_spanish, status_name_spanish) m
  ON l.institution_name_spanish <=> m.mi AND l.status_name_spanish <=> m.ms AND l.checked_at = m.last_run
"""


def create_last_run_view(spark: SparkSession, log_table: str, name: str) -> str:
    """The last-run view in the catalog (S9, C11): ``last_run`` as SQL over the
    log table, evaluated at every query, so it shows rows appended later."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {LAST_RUN_SQL.format(log=log_table)}")
    return name


def recent(log: DataFrame, as_of_date, days: int = 7) -> DataFrame:
    """Runs checked in the last ``days`` days before ``as_of_date``, newest
    first (C18, P11, O3).  The date bound is a literal, so it is pushed to
    the Parquet scan."""
    since = F.date_sub(F.lit(as_of_date).cast("date"), days)
    return (log.where(F.col("checked_at") >= since)
            .select(INST, STAT, "run_status", "source_update", "checked_at",
                    F.col("time").alias("execution_time_seconds"))
            .orderBy(F.col("checked_at").desc()))


def status_table(last_run_df: DataFrame) -> DataFrame:
    """Dashboard run-status table (C21, A14): grouped by start second,
    report, status and source day; average time and OK / ERROR sums."""
    return last_run_df.groupBy(
        F.date_trunc("second", F.col("start_at")).alias("start_second"),
        F.col("report"), F.col("run_status"),
        F.date_trunc("day", F.col("source_update")).alias("source_day"),
    ).agg(F.avg("time").alias("avg_time"),
          F.sum("OK").alias("ok_count"),
          F.sum("ERROR").alias("error_count"))


def daily_time(log: DataFrame) -> DataFrame:
    """Daily average run time series."""
    return (log.groupBy(F.date_trunc("day", F.col("start_at")).alias("day"))
            .agg(F.avg("time").alias("avg_time"), F.count(F.lit(1)).alias("runs")))


def freshness(last_run_df: DataFrame) -> DataFrame:
    """Freshness counters (C23, A12): last source update and last run."""
    return last_run_df.agg(F.max("source_update").alias("last_source_update"),
                           F.max("checked_at").alias("last_checked_at"))


def ok_ratio(last_run_df: DataFrame) -> DataFrame:
    """Files-downloaded and error counters against the number of reports
    (C24, A16); ratios are NULL when there is no report."""
    agg = last_run_df.agg(F.countDistinct("report").alias("reports"),
                          F.sum("OK").alias("files_downloaded"),
                          F.sum("ERROR").alias("errors"))
    denom = F.when(F.col("reports") > 0, F.col("reports").cast("double"))
    return agg.select("reports", "files_downloaded", "errors",
                      (F.col("files_downloaded") / denom).alias("downloaded_ratio"),
                      (F.col("errors") / denom).alias("error_ratio"))


def work_list(institutions: DataFrame, statuses: DataFrame, log: DataFrame, current_update,
              base_url: str | None = None) -> DataFrame:
    """Pairs (institution x status) still to extract.

    A pair is skipped iff an ``OK`` row exists with ``source_update >=
    current_update``; ``FAIL`` pairs are retried.  The status names, a short
    list, are a scalar-subquery array exploded beside each institution; the
    up-to-date pairs go by one anti join.  One lazy plan; the product itself
    is the requested output.  A NULL name is a name of either list, and a
    pair with one is never up to date.
    """
    inst = institutions.select(F.col(institutions.columns[0]).alias(INST)).distinct()
    stat = statuses.select(F.col(statuses.columns[0]).alias(STAT)).distinct()
    names = stat.agg(F.sort_array(F.collect_list(F.struct(STAT)))).scalar()
    pairs = inst.select(INST, F.inline(names))
    done = (log.where((F.col("run_status") == F.lit("OK")) &
                      (F.col("source_update") >= _ts(current_update)))
            .select(*PAIR).distinct())
    todo = pairs.join(done, on=PAIR, how="left_anti")
    if base_url:
        todo = todo.withColumn("url", F.concat(
            F.lit(base_url), F.lit("?&Ne="), url_quote(F.col(INST)),
            F.lit("&N=&A=&C=&E="), url_quote(F.col(STAT))))
    return todo


def elapsed_seconds(start: str, end: str) -> Column:
    """``(end - start).total_seconds()`` with microsecond precision."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1_000_000.0)


def audit_rows(results: DataFrame, run_ts) -> DataFrame:
    """Typed audit rows for a batch of attempts (T7): ``time`` is the elapsed
    seconds, ``checked_at`` the run's construction time (one value per run,
    Q18) unless the row carries its own."""
    checked = F.col("checked_at") if "checked_at" in results.columns else F.lit(None)
    return results.select(
        F.col(INST).cast("string"), F.col(STAT).cast("string"),
        F.col("run_status").cast("string"),
        F.col("source_update").cast("timestamp"),
        F.coalesce(checked.cast("timestamp"), _ts(run_ts)).alias("checked_at"),
        F.col("start_at").cast("timestamp"), F.col("end_at").cast("timestamp"),
        elapsed_seconds("start_at", "end_at").cast("float").alias("time"))


def updates_count(audit: DataFrame) -> DataFrame:
    """Number of successful downloads in a batch of audit rows."""
    return audit.agg(F.sum(F.when(F.col("run_status") == F.lit("OK"), 1).otherwise(0))
                     .alias("updates"))
