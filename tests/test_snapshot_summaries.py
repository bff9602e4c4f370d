"""Snapshot, inactive detection and gold summaries on hand-made rows
(Q3, Q4, Q10, Q13-Q16)."""

import json

from helpers import D, T, rows
from pyspark.sql import functions as F

from histlake.operators import scd, snapshot, summaries
from histlake.operators.keys import with_key_and_tenure
from histlake.schemas import PAYROLL_KEYS, PAYROLL_TRACKED, STAGING_SCHEMA


def staging(spark, data):
    out = []
    for d in data:
        base = {f.name: None for f in STAGING_SCHEMA.fields}
        base.update(d)
        out.append(tuple(base[f.name] for f in STAGING_SCHEMA.fields))
    return with_key_and_tenure(spark.createDataFrame(out, STAGING_SCHEMA))


def refs(spark):
    inst = spark.createDataFrame(
        [("TE", T(2025, 2, 1), T(2025, 2, 2), "ELECTORAL COURT"),
         ("LAG", T(2025, 1, 1), T(2025, 1, 2), "LAGGING BODY")],
        "institution_name_spanish string, last_source_update timestamp, last_checked_at timestamp, "
        "institution_name_english string")
    stat = spark.createDataFrame(
        [("PERMANENTE", T(2025, 2, 1), T(2025, 2, 2), "PERMANENT")],
        "status_name_spanish string, last_source_update timestamp, last_checked_at timestamp, "
        "status_name_english string")
    pos = spark.createDataFrame([("ANALISTA", T(2025, 1, 1), "ANALYST")],
                                "position_name_spanish string, last_seen_at timestamp, "
                                "position_name_english string")
    return inst, stat, pos


def payroll(spark):
    common = dict(estado="PERMANENTE", fecha_de_inicio=D(2020, 1, 15))
    return staging(spark, [
        dict(nombre="ANA", apellido="PEREZ", cedula="1-1", cargo="ANALISTA", salario=100.0,
             gasto=10.0, institucion="TE", fecha_consulta=T(2025, 2, 1), **common),
        dict(nombre="ANNA", apellido="PEREZ", cedula="1-1", cargo="JEFE", salario=200.0,
             gasto=None, institucion="TE", fecha_consulta=T(2025, 2, 1), **common),
        # older snapshot row of a vanished employee
        dict(nombre="LUIS", apellido="DIAZ", cedula="2-2", cargo="ANALISTA", salario=50.0,
             gasto=5.0, institucion="TE", fecha_consulta=T(2025, 1, 1), **common),
        # lagging institution: its latest date is older than the status' latest -> dropped
        dict(nombre="EVA", apellido="RUIZ", cedula="3-3", cargo="ANALISTA", salario=70.0,
             gasto=7.0, institucion="LAG", fecha_consulta=T(2025, 1, 1), **common),
        # NULL key part: always inactive
        dict(nombre="SIN", apellido=None, cedula="4-4", cargo="ANALISTA", salario=10.0,
             gasto=1.0, institucion="TE", fecha_consulta=T(2025, 2, 1), **common),
        # two first names and no last names (2 + 0 is not flagged)
        dict(nombre="X", apellido=None, cedula="5-5", cargo="A", salario=1.0, gasto=None,
             institucion="TE", fecha_consulta=T(2025, 2, 1), **common),
        dict(nombre="Y", apellido=None, cedula="5-5", cargo="B", salario=1.0, gasto=None,
             institucion="TE", fecha_consulta=T(2025, 2, 1), **common),
    ])


def test_latest_snapshot_equality_joins_and_left_position(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    got = rows(s, "id_number", "first_name", "position_sp", "position_en", "institution_en")
    ids = {g[0] for g in got}
    assert "3-3" not in ids and "2-2" not in ids           # lagging institution / old date
    assert ("1-1", "ANA", "ANALISTA", "ANALYST", "ELECTORAL COURT") in got
    assert ("1-1", "ANNA", "JEFE", None, "ELECTORAL COURT") in got   # left join keeps NULL
    assert len(s.columns) == 17


def test_per_group_latest_keeps_lagging_institution(spark):
    p = snapshot.per_group_latest(payroll(spark))
    assert "3-3" in {r[0] for r in rows(p, "cedula")}


def test_inactive_null_keys_and_vanished(spark):
    b = payroll(spark)
    h = scd.scd2(b, PAYROLL_KEYS, "fecha_consulta", track=PAYROLL_TRACKED)
    s = snapshot.latest_snapshot(b, *refs(spark))
    ina = snapshot.inactive(h, s, detected_at="2025-03-01 00:00:00")
    got = {r[0] for r in rows(ina, "cedula")}
    assert {"2-2", "3-3", "4-4", "5-5"} <= got and "1-1" not in got
    assert rows(ina.where("cedula = '2-2'"), "last_active_date") == [(T(2025, 1, 1),)]


def test_employee_summary_flags_totals_and_json(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    e = {r["id_number"]: r for r in summaries.employee_summary(s).collect()}
    one = e["1-1"]
    assert one["multiple_names"] == 1                      # ANA / ANNA + PEREZ = 3 > 2
    assert one["total_salary"] == 300.0 and one["total_allowance"] == 10.0
    assert one["total_compensation"] == 310.0              # sum + sum
    assert one["distinct_position_count"] == 2
    # Q15: years of service is the maximum over positions, not a sum
    assert one["total_years_of_service"] == max(d["years_of_service"] for d in
                                                json.loads(one["positions_details_json"]))
    details = json.loads(one["positions_details_json"])
    assert [d["first_name"] for d in details] == ["ANA", "ANNA"]   # sorted
    assert "allowance" not in details[1]                    # NULL fields omitted
    five = e["5-5"]
    assert five["multiple_names"] == 0                     # 2 + 0 is not flagged
    assert five["total_allowance"] is None and five["total_compensation"] is None


def test_group_summary_row_level_compensation(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    g = summaries.group_summary(s).where("position_sp = 'JEFE'").collect()[0]
    assert g["total_compensation"] is None and g["total_salary"] == 200.0


def test_status_distribution_and_counts(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    d = rows(summaries.status_distribution(s), "status_en", "employee_count", "percentage")
    assert d == [("PERMANENT", 5, 100.0)]
    b = payroll(spark)
    h = scd.scd2(b, PAYROLL_KEYS, "fecha_consulta", track=PAYROLL_TRACKED)
    rc = dict(rows(summaries.reconcile_counts(h, s), "source", "count"))
    assert rc == {"SCD Active Records": 7, "Latest Snapshot": 5}


def test_promotion_opens_new_key_and_old_key_stays_open(spark):
    """Q9: the key includes the position; a promotion opens a new history
    and the old one is never closed, so it shows up as inactive."""
    common = dict(nombre="ANA", apellido="PEREZ", cedula="9-9", estado="PERMANENTE",
                  institucion="TE", salario=1.0, gasto=1.0, fecha_de_inicio=D(2020, 1, 1))
    b = staging(spark, [dict(cargo="ANALISTA", fecha_consulta=T(2025, 1, 1), **common),
                        dict(cargo="JEFE", fecha_consulta=T(2025, 2, 1), **common)])
    h = scd.scd2(b, PAYROLL_KEYS, "fecha_consulta", track=PAYROLL_TRACKED)
    assert rows(h, "cargo", "__END_AT") == [("ANALISTA", None), ("JEFE", None)]
    s = snapshot.latest_snapshot(b, *refs(spark))
    assert rows(snapshot.inactive(h, s), "cargo") == [("ANALISTA",)]


def test_details_group_sizes(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    r = summaries.details_group_sizes(s, threshold=1).collect()[0]
    assert (r["max_positions"], r["persons"], r["persons_over_threshold"]) == (2, 3, 2)


def test_employee_summary_without_details(spark):
    s = snapshot.latest_snapshot(payroll(spark), *refs(spark))
    full = {r["id_number"]: r for r in summaries.employee_summary(s).collect()}
    lean = {r["id_number"]: r for r in summaries.employee_summary(s, details=False).collect()}
    assert set(full) == set(lean)
    for k in full:
        assert lean[k]["positions_details_json"] is None
        assert lean[k]["total_salary"] == full[k]["total_salary"]
    p = summaries.employee_summary(s, details=False)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p


def test_snapshot_in_the_repeated_hour(spark):
    """The hour that a clock repeats when daylight saving ends: the instants stay apart."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.timestamp_seconds(F.lit(1730615400))  # 2024-11-03 06:30 UTC, 01:30 for the second time
        bronze = spark.range(1).select(
            *[F.lit(c).alias(c) for c in ("composite_key", "nombre", "apellido", "cedula", "estado", "institucion", "cargo", "archivo")],
            F.lit(1.0).alias("salario"), F.lit(2.0).alias("gasto"), F.current_date().alias("fecha_de_inicio"),
            at.alias("fecha_actualizacion"), at.alias("fecha_consulta"), F.lit(0.5).alias("antiguedad"))
        dim = lambda name, value, when: spark.range(1).select(
            F.lit(value).alias(f"{name}_name_spanish"), when.alias("last_source_update"), F.lit("x").alias(f"{name}_name_english"))
        hour = F.expr("INTERVAL 1 HOUR")
        pos = dim("position", "cargo", at)
        for i, s, n in ((at, at, 1), (at - hour, at - hour, 0), (at, at - hour, 0)):
            assert snapshot.latest_snapshot(bronze, dim("institution", "institucion", i), dim("status", "estado", s), pos).count() == n
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
