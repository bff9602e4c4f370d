"""Bronze enrichment: composite key and tenure (C1: F1, F2, F4, P1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.schemas import PAYROLL_KEY_PARTS


def composite_key(parts: Sequence[str], strip_dashes: Sequence[str] = ("cedula",),
                  sep: str = "-") -> Column:
    """``concat_ws`` of the parts: NULL parts are skipped, empty strings kept.
    Parts named in ``strip_dashes`` lose every ``-`` first.  Never NULL, and
    not guaranteed unique (see ``operators.profile.quality_report``)."""
    cols = [F.regexp_replace(F.col(p), "-", "") if p in strip_dashes else F.col(p)
            for p in parts]
    return F.concat_ws(sep, *cols)


def tenure_years(as_of: str, start: str) -> Column:
    """``months_between(as_of, start) / 12``: whole months when the days of
    month match or both are month-ends, else a 31-day fraction; NULL if
    either side is NULL."""
    return F.months_between(F.col(as_of), F.col(start)) / 12


def with_key_and_tenure(df: DataFrame, parts: Sequence[str] = PAYROLL_KEY_PARTS,
                        id_col: str = "cedula", as_of: str = "fecha_consulta",
                        start: str = "fecha_de_inicio", key_name: str = "composite_key",
                        tenure_name: str = "antiguedad") -> DataFrame:
    """Bronze-raw projection: the input plus ``composite_key`` and tenure.
    A narrow, per-row projection - it streams and never shuffles."""
    return df.withColumns({
        key_name: composite_key(parts, strip_dashes=(id_col,)),
        tenure_name: tenure_years(as_of, start),
    })
