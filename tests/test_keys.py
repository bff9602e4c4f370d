"""Composite key and tenure (C1; Q1, Q2)."""

from helpers import D, T, rows

from histlake.operators.keys import with_key_and_tenure
from histlake.schemas import STAGING_SCHEMA


def _staging(spark, data):
    full = []
    for d in data:
        base = {f.name: None for f in STAGING_SCHEMA.fields}
        base.update(d)
        full.append(tuple(base[f.name] for f in STAGING_SCHEMA.fields))
    return spark.createDataFrame(full, STAGING_SCHEMA)


def test_composite_key_skips_null_keeps_empty_and_strips_dashes(spark):
    df = _staging(spark, [
        dict(nombre="ANA", apellido="PEREZ", institucion="TE", cargo="ANALISTA", cedula="8-123-4567"),
        dict(nombre="ANA", apellido=None, institucion="TE", cargo="X", cedula="1-2"),
        dict(nombre="ANA", apellido="", institucion="TE", cargo="X", cedula="1-2"),
        dict(nombre=None, apellido=None, institucion=None, cargo=None, cedula=None),
    ])
    keys = [r[0] for r in rows(with_key_and_tenure(df), "composite_key")]
    assert "ANA-PEREZ-TE-ANALISTA-81234567" in keys
    assert "ANA-TE-X-12" in keys          # NULL part skipped
    assert "ANA--TE-X-12" in keys         # empty part kept
    assert "" in keys                     # never NULL


def test_tenure_months_between_branches(spark):
    df = _staging(spark, [
        # same day of month -> whole months
        dict(cedula="a", fecha_consulta=T(2025, 1, 15, 12, 0), fecha_de_inicio=D(2020, 1, 15)),
        # both month ends -> whole months
        dict(cedula="b", fecha_consulta=T(2025, 2, 28), fecha_de_inicio=D(2024, 11, 30)),
        # neither -> 31-day fraction including time of day
        dict(cedula="c", fecha_consulta=T(2025, 1, 20, 12, 0), fecha_de_inicio=D(2024, 12, 5)),
        # NULL start -> NULL
        dict(cedula="d", fecha_consulta=T(2025, 1, 20), fecha_de_inicio=None),
    ])
    got = dict(rows(with_key_and_tenure(df), "cedula", "antiguedad"))
    assert got["a"] == 60 / 12
    assert got["b"] == 3 / 12
    months_c = round(1 + ((20 - 5) * 86400 + 12 * 3600) / (31 * 86400.0), 8)
    assert abs(got["c"] - months_c / 12) < 1e-12
    assert got["d"] is None


def test_bronze_adds_exactly_two_columns_and_session_is_utc(spark):
    """Q27: bronze = input + composite_key + antiguedad.  Q6: one time zone."""
    from histlake.session import apply_defaults
    df = _staging(spark, [dict(cedula="1")])
    out = with_key_and_tenure(df)
    assert out.columns == df.columns + ["composite_key", "antiguedad"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
