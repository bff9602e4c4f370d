"""Text clean-up as built-in column expressions.

Everything here is a JVM-side expression (regex, higher-order array
functions, try-casts), so it runs inside whole-stage code generation over
whole texts - no Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.functions.html import elements

from histlake.operators.joins import broadcast_if_small

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for equal results.
# ---------------------------------------------------------------------------
# Update-date text on the index page, and in cell E3 of a report sheet:
PAGE_UPDATE_PATTERN = r"Fecha de actualización de los datos:\s+(\d{1,2}/\d{1,2}/\d+\s+\d{1,2}:\d{1,2}:\d{1,2}\s+\w+)"
SHEET_UPDATE_PATTERN = r".*?:\s+(\d{2}/\d{2}/\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2}\s+\w{2})"
# Download file name inside a Content-Disposition header:
FILE_NAME_PATTERN = r'filename="(.*?).xlsx"'
# Drop-down placeholder entry:
PLACEHOLDER = "Seleccione"
# Report sheet layout (1-based sheet rows / cells):
HEADER_ROW = 5
FIRST_DATA_ROW = 6
UPDATE_ROW = 3
UPDATE_CELL = 5
# HTML character references decoded in extracted element text (name, char);
# "&amp;" is decoded last so "&amp;lt;" becomes "&lt;", not "<":
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                 ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&oacute;", "ó"),
                 ("&uacute;", "ú"), ("&uuml;", "ü"), ("&ntilde;", "ñ"), ("&Aacute;", "Á"),
                 ("&Eacute;", "É"), ("&Iacute;", "Í"), ("&Oacute;", "Ó"), ("&Uacute;", "Ú"),
                 ("&Uuml;", "Ü"), ("&Ntilde;", "Ñ"), ("&iexcl;", "¡"), ("&iquest;", "¿"),
                 ("&ordf;", "ª"), ("&ordm;", "º"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]
# Day-first date formats of the source:
START_DATE_FORMAT = "d/M/yyyy"
COMPAT_TS_FORMAT = "d/M/yyyy H:m:s"      # hour read as 0-23, AM/PM marker ignored
STRICT_TS_FORMAT = "d/M/yyyy h:m:s a"    # 12-hour clock with marker
# ---------------------------------------------------------------------------


def url_quote(c: Column) -> Column:
    """Percent-encode like a path-safe URL quote: unreserved characters and
    ``/`` stay, space becomes ``%20``.  Built on ``url_encode`` (form
    encoding) with four fix-ups."""
    enc = F.url_encode(c)
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.replace(enc, F.lit("%2F"), F.lit("/"))


def normalise_name(c: Column) -> Column:
    """Header normalisation: strip, lower-case, spaces to ``_``, and the
    accented id column name to its plain spelling."""
    s = F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), " ", "_")
    return F.when(s == F.lit("cédula"), F.lit("cedula")).otherwise(s)


def unescape_html(c: Column) -> Column:
    """Decode HTML character references of element text, as an HTML parser's
    text accessor does: numeric ones (decimal and hexadecimal) and the named
    ones of ``HTML_ENTITIES``; ``&amp;`` last, so that ``&amp;lt;`` is ``&lt;``.
    Text without ``&`` is taken as it is."""
    plain = c
    for pattern, base in ((r"&#(0*\d{1,7});", 10), (r"&#[xX](0*[0-9A-Fa-f]{1,6});", 16)):
        prefix = "&#" if base == 10 else "&#x"
        c = F.aggregate(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), 1)), F.replace(c, F.lit("&#X"), F.lit("&#x")),
                        lambda s, n: F.replace(s, F.concat(F.lit(prefix), n, F.lit(";")), _code_point(F.conv(n, base, 16))))
    for entity, char in HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.when(F.contains(plain, F.lit("&")), c).otherwise(plain)


def _code_point(hexadecimal: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    n = F.conv(hexadecimal, 16, 10).cast("int")
    valid = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.when(valid, hexadecimal).otherwise("20"), 8, "0")), "UTF-32")).otherwise("\ufffd")


def drop_blank_and_placeholder(items: Column, placeholder: str = PLACEHOLDER) -> Column:
    """remove blank entries and entries containing the placeholder."""
    return F.filter(items, lambda x: (F.trim(x) != F.lit("")) &
                    ~F.contains(F.trim(x), F.lit(placeholder)))


def select_options(html: Column, select_id: str, placeholder: str = PLACEHOLDER) -> Column:
    """Option texts of the first ``<select id=select_id>`` (T3) as an array; an absent
    element gives an empty array."""
    items = F.transform(elements(html, "option", "select", select_id), lambda e: unescape_html(e["text"]))
    return drop_blank_and_placeholder(items, placeholder)


LIST_ITEM_PATTERN = r'<li><a href="[^"]*">([^<]*)</a></li>'


def list_items(df: DataFrame, html_col: str, id_col: str,
               pattern: str = LIST_ITEM_PATTERN, placeholder: str = PLACEHOLDER) -> DataFrame:
    """One row per extracted item: (id, 1-based position, item) (T3 over a
    table of pages).  Blank and placeholder entries are dropped after the
    position is assigned."""
    items = df.select(F.col(id_col),
                      F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)))
    return (items.select(F.col(id_col), (F.col("pos") + 1).cast("long").alias("position"),
                         unescape_html(F.col("col")).alias("item"))
            .where((F.trim("item") != F.lit("")) & ~F.contains(F.trim("item"), F.lit(placeholder))))


def extract_update_date(text: Column, pattern: str = PAGE_UPDATE_PATTERN,
                        strict: bool = False) -> Column:
    """Regex-extract then parse a day-first timestamp.

    ``strict=False`` reproduces the source parser, which reads the hour as
    0-23 and ignores AM/PM (``01:30 PM`` -> 01:30); ``strict=True`` honours
    the marker (13:30).  No match or a bad value gives NULL, not an error.
    """
    s = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    if strict:
        return F.try_to_timestamp(s, F.lit(STRICT_TS_FORMAT))
    return F.try_to_timestamp(F.regexp_replace(s, r"\s+\w+$", ""), F.lit(COMPAT_TS_FORMAT))


def file_name_from_header(header: Column, default: str = "reporte") -> Column:
    """File name from a Content-Disposition header, or ``default`` (F16)."""
    m = F.regexp_extract(F.coalesce(header, F.lit("")), FILE_NAME_PATTERN, 1)
    return F.when(m == F.lit(""), F.lit(default)).otherwise(m)


def _cell(names: Column, cells: Column, name: str) -> Column:
    pos = F.array_position(names, F.lit(name)).cast("int")
    return F.when(pos > 0, F.try_element_at(cells, pos))


def clean_sheets(raw_cells: DataFrame, institution: Column | None = None,
                 site_update: Column | None = None) -> DataFrame:
    """Turn decoded sheet rows into staging rows.

    ``raw_cells``: ``file, sheet, row_no (1-based), cells ARRAY<STRING>`` and
    optional ``institution`` / ``site_update`` provenance columns.  Row 5 of
    each sheet is the header (normalised), rows >= 6 are data, cell 5 of
    row 3 of the file's first sheet holds the update text; the first sheet is
    the lowest ``sheet_no`` (the workbook's order), or name without that column.  Columns are
    matched by name, so sheets with different column orders union
    correctly; numbers that do not parse become NULL.
    """
    headers = (raw_cells.where(F.col("row_no") == HEADER_ROW)
               .select("file", "sheet",
                       F.transform("cells", normalise_name).alias("_names")))
    updates = (raw_cells.where(F.col("row_no") == UPDATE_ROW)
               .groupBy("file")
               .agg(F.min_by(F.try_element_at("cells", F.lit(UPDATE_CELL)),
                             F.col("sheet_no" if "sheet_no" in raw_cells.columns else "sheet"))
                    .alias("_update_text")))
    data = raw_cells.where(F.col("row_no") >= FIRST_DATA_ROW)
    j = (data.join(broadcast_if_small(headers), ["file", "sheet"], "inner")
         .join(broadcast_if_small(updates), ["file"], "left"))
    names, cells = F.col("_names"), F.col("cells")

    def text(name):
        return _cell(names, cells, name)

    inst = institution if institution is not None else (
        F.col("institution") if "institution" in raw_cells.columns else F.lit(None).cast("string"))
    site = site_update if site_update is not None else (
        F.col("site_update") if "site_update" in raw_cells.columns else F.lit(None).cast("timestamp"))
    return j.select(
        text("nombre").alias("nombre"),
        text("apellido").alias("apellido"),
        text("cedula").alias("cedula"),
        text("cargo").alias("cargo"),
        text("salario").try_cast("double").alias("salario"),
        text("gasto").try_cast("double").alias("gasto"),
        text("estado").alias("estado"),
        F.try_to_timestamp(text("fecha_de_inicio"), F.lit(START_DATE_FORMAT)).cast("date")
         .alias("fecha_de_inicio"),
        extract_update_date(F.col("_update_text"), SHEET_UPDATE_PATTERN).alias("fecha_actualizacion"),
        site.cast("timestamp").alias("fecha_consulta"),
        F.col("file").alias("archivo"),
        inst.alias("institucion"),
    )
