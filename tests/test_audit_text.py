"""Audit log, work list, text clean-up."""

from urllib.parse import quote

from helpers import T, rows
from pyspark.sql import functions as F

from histlake.functions import text
from histlake.operators import audit

LOG_SCHEMA = ("institution_name_spanish string, status_name_spanish string, run_status string, "
              "source_update timestamp, checked_at timestamp, start_at timestamp, "
              "end_at timestamp, time float")


def log(spark):
    s, e = T(2025, 1, 1, 10), T(2025, 1, 1, 10, 0, 30)
    return spark.createDataFrame([
        ("TRIBUNAL", "PERMANENTE", "OK", T(2025, 1, 1), T(2025, 1, 2), s, e, 30.0),
        ("TRIBUNAL", "PERMANENTE", "FAIL", T(2025, 1, 1), T(2025, 1, 3), s, e, 1.0),
        ("TRIBUNAL", "EVENTUAL", "No Update", T(2025, 1, 1), T(2025, 1, 3), s, e, 2.0),
        ("TRIBUNAL", "EVENTUAL", "OK", T(2025, 1, 1), T(2025, 1, 3), s, e, 3.0),   # tie
        ("O'HIGGINS", "EVENTUAL", "OK", T(2024, 12, 1), T(2025, 1, 2), s, e, 4.0),  # old OK
        ("O'HIGGINS", "PERMANENTE", "OK", T(2025, 1, 1), None, s, e, 5.0),         # NULL checked
    ], LOG_SCHEMA)


def test_last_run_keeps_ties_drops_null_and_flags(spark):
    lr = audit.last_run(log(spark))
    got = rows(lr, "institution_name_spanish", "status_name_spanish", "run_status", "OK", "ERROR")
    # all ties on the latest checked_at are kept; the pair whose only row has a
    # NULL checked_at disappears; "No Update" counts as an error
    assert got == [("O'HIGGINS", "EVENTUAL", "OK", 1, 0),
                   ("TRIBUNAL", "EVENTUAL", "No Update", 0, 1),
                   ("TRIBUNAL", "EVENTUAL", "OK", 1, 0),
                   ("TRIBUNAL", "PERMANENTE", "FAIL", 0, 1)]
    assert rows(lr.where("report = 'TRIBUNAL - EVENTUAL'"), "last_run")[0] == (T(2025, 1, 3),)
    ratio = audit.ok_ratio(lr).collect()[0]
    assert (ratio["reports"], ratio["files_downloaded"], ratio["errors"]) == (3, 2, 2)


def test_work_list_retries_fail_and_stale_ok(spark):
    lg = log(spark)
    inst = spark.createDataFrame([("TRIBUNAL",), ("O'HIGGINS",)], "n string")
    stat = spark.createDataFrame([("PERMANENTE",), ("EVENTUAL",)], "n string")
    wl = audit.work_list(inst, stat, lg, T(2025, 1, 1), base_url="https://h/r")
    got = rows(wl, "institution_name_spanish", "status_name_spanish")
    # up to date: TRIBUNAL/PERMANENTE (OK), TRIBUNAL/EVENTUAL (OK), O'HIGGINS/PERMANENTE (OK)
    assert got == [("O'HIGGINS", "EVENTUAL")]
    url = rows(wl, "url")[0][0]
    assert url == "https://h/r?&Ne=" + quote("O'HIGGINS") + "&N=&A=&C=&E=" + quote("EVENTUAL")
    plan = wl._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_url_quote_matches_path_quote(spark):
    samples = ["MINISTERIO DE SALUD", "A/B*C~D+E", "Cédula ñ & co.", "50% (x)"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(text.url_quote(F.col("s"))).collect()]
    assert got == [quote(s) for s in samples]


def test_audit_rows_typed_and_updates(spark):
    attempts = log(spark).drop("checked_at", "time")
    a = audit.audit_rows(attempts, "2025-02-01 00:00:00")
    assert dict(a.dtypes)["time"] == "float"
    assert {r[0] for r in rows(a, "time")} == {30.0}
    assert {r[0] for r in rows(a, "checked_at")} == {T(2025, 2, 1)}
    assert audit.updates_count(a).collect()[0][0] == 4


def test_update_date_compat_vs_strict(spark):
    df = spark.createDataFrame([
        (1, "x Fecha de actualización de los datos: 05/01/2025 01:30:00 PM y"),
        (2, "Fecha de actualización de los datos: 5/1/2025 1:30:00 AM"),
        (3, "no date here"),
    ], "id int, t string")
    got = rows(df.select("id", text.extract_update_date(F.col("t")).alias("c"),
                         text.extract_update_date(F.col("t"), strict=True).alias("s")), "id", "c", "s")
    assert got == [(1, T(2025, 1, 5, 1, 30), T(2025, 1, 5, 13, 30)),
                   (2, T(2025, 1, 5, 1, 30), T(2025, 1, 5, 1, 30)),
                   (3, None, None)]


def test_select_options_and_file_names(spark):
    html = ('<select id="status_list"><option value="">Seleccione un estado</option>'
            '<option> </option><option>PERMANENTE</option><option>EVENTUAL</option></select>'
            '<select id="other"><option>NO</option></select>')
    df = spark.createDataFrame([(html,), ("<p>nothing</p>",)], "h string")
    got = [r[0] for r in df.select(text.select_options(F.col("h"), "status_list")).collect()]
    assert got == [["PERMANENTE", "EVENTUAL"], []]
    hdr = spark.createDataFrame([('attachment; filename="Planilla_01.xlsx"',), ("inline",), (None,)], "h string")
    assert [r[0] for r in hdr.select(text.file_name_from_header(F.col("h"))).collect()] == \
        ["Planilla_01", "reporte", "reporte"]


def test_clean_sheets_header_rows_and_casts(spark):
    cells = [
        ("f1", "s1", 3, ["", "", "", "", "Fecha de actualización: 05/01/2025 01:30:00 PM"]),
        ("f1", "s1", 5, [" Nombre ", "Apellido", "Cédula", "Cargo", "Salario", "Gasto", "Estado",
                         "Fecha de Inicio"]),
        ("f1", "s1", 6, ["ANA", "PEREZ", "8-1-2", "ANALISTA", "1500.5", "n/a", "PERMANENTE", "5/1/2020"]),
        ("f1", "s2", 5, ["Salario", "NOMBRE", "cedula", "Cargo", "Gasto", "Apellido", "Estado",
                         "Fecha de Inicio"]),
        ("f1", "s2", 6, ["99", "LUIS", "1-1", "JEFE", "10", "DIAZ", "EVENTUAL", "31/12/2019"]),
        ("f1", "s2", 4, ["junk"] * 8),
    ]
    raw = spark.createDataFrame(cells, "file string, sheet string, row_no int, cells array<string>")
    out = text.clean_sheets(raw, institution=F.lit("TRIBUNAL"), site_update=F.lit("2025-01-15 00:00:00"))
    got = rows(out, "nombre", "apellido", "cedula", "salario", "gasto", "fecha_de_inicio",
               "fecha_actualizacion", "institucion", "archivo")
    import datetime as dt
    assert got == [("ANA", "PEREZ", "8-1-2", 1500.5, None, dt.date(2020, 1, 5), T(2025, 1, 5, 1, 30),
                    "TRIBUNAL", "f1"),
                   ("LUIS", "DIAZ", "1-1", 99.0, 10.0, dt.date(2019, 12, 31), T(2025, 1, 5, 1, 30),
                    "TRIBUNAL", "f1")]


def test_html_entities_decoded_like_a_parser(spark):
    html = ('<select id="s.1"><option>A &amp; B</option><option>&lt;x&gt; &quot;q&quot;</option>'
            '<option>&amp;lt;</option></select>')
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(text.select_options(F.col("h"), "s.1")).collect()[0][0]
    assert got == ["A & B", '<x> "q"', "&lt;"]


def test_work_list_explodes_the_shorter_list_either_way(spark):
    lg = log(spark)
    inst = spark.createDataFrame([("TRIBUNAL",)], "n string")
    stat = spark.createDataFrame([("PERMANENTE",), ("EVENTUAL",), ("TEMPORAL",)], "n string")
    got = rows(audit.work_list(inst, stat, lg, T(2025, 1, 1)),
               "institution_name_spanish", "status_name_spanish")
    assert got == [("TRIBUNAL", "TEMPORAL")]
