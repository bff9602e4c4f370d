"""Payroll-shaped relations derived from the TPC-H-like test tables.

Each relation exists twice: as a Spark DataFrame (what the operators run on)
and as a DuckDB SQL common table expression (what the oracle runs on).  Both
derive from the same base tables with the same expressions.

* ``pay``    - orders x customer x nation as payroll rows (one per order)
* ``bronze`` - pay + composite key + tenure
* ``paylog`` - the OK extraction log the reference tables come from
* ``log``    - events as the extraction audit log
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.keys import with_key_and_tenure
from histlake.operators.reference import position_reference, reference_names
from histlake.operators.snapshot import latest_snapshot

# ---------------------------------------------------------------------------
# Translation dictionaries of the analog name columns
# (source name, translated name).  "4-NOT SPECIFIED" is left out on purpose.
# ---------------------------------------------------------------------------
SEGMENT_DICTIONARY = [("AUTOMOBILE", "AUTOMOVIL"), ("BUILDING", "CONSTRUCCION"),
                      ("FURNITURE", "MUEBLES"), ("HOUSEHOLD", "HOGAR"),
                      ("MACHINERY", "MAQUINARIA")]
ORDER_STATUS_DICTIONARY = [("F", "FINALIZADO"), ("O", "ABIERTO"), ("P", "PENDIENTE")]
PRIORITY_DICTIONARY = [("1-URGENT", "URGENTE"), ("2-HIGH", "ALTA"), ("3-MEDIUM", "MEDIA"),
                       ("5-LOW", "BAJA")]
EVENT_TYPE_DICTIONARY = [("click", "clic"), ("error", "error"), ("purchase", "compra"),
                         ("signup", "registro"), ("view", "vista")]
LANGUAGE_DICTIONARY = [("de", "German"), ("en", "English"), ("fr", "French")]
# fixed "now" of the deterministic queries
AS_OF_DATE = "2024-01-30"
DETECTED_AT = "2024-02-01 00:00:00"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the shuffle's partitions: rows that take long lie in so few
    bytes that one task would read them all."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dictionary(spark: SparkSession, pairs) -> DataFrame:
    return spark.createDataFrame(pairs, "source string, target string")


def translated(df: DataFrame, col: str, pairs, out_col: str, **kw) -> DataFrame:
    """Dictionary translation with a literal (size-known) dictionary."""
    from histlake.operators.reference import translate
    return translate(df, col, dictionary(df.sparkSession, pairs), out_col,
                     dictionary_rows=len(pairs), **kw)


def dictionary_sql(name: str, pairs) -> str:
    rows = ", ".join("('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in pairs)
    return f"{name}(source, target) AS (VALUES {rows})"


# ----------------------------------------------------------------- pay / bronze
def pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
         .join(n, c["c_nationkey"] == n["n_nationkey"], "inner"))
    return j.select(
        F.col("c_name").alias("nombre"),
        F.col("n_name").alias("apellido"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.col("o_custkey").cast("string"))
         .alias("cedula"),
        F.col("o_orderpriority").alias("cargo"),
        F.col("o_totalprice").alias("salario"),
        (F.col("o_totalprice") * F.lit(0.1)).alias("gasto"),
        F.col("o_orderstatus").alias("estado"),
        F.col("o_orderdate").cast("date").alias("fecha_de_inicio"),
        F.col("o_orderdate").alias("fecha_actualizacion"),
        (F.date_trunc("quarter", F.col("o_orderdate")).cast("timestamp_ntz")
         + F.expr("INTERVAL 3 MONTHS")).alias("fecha_consulta"),
        F.concat(F.col("c_mktsegment"), F.lit("_"), F.col("o_orderpriority")).alias("archivo"),
        F.col("c_mktsegment").alias("institucion"),
        F.col("o_orderkey").alias("source_row"),
    )


PAY_SQL = """pay AS (
  SELECT c.c_name AS nombre, n.n_name AS apellido,
         CAST(c.c_nationkey AS VARCHAR) || '-' || CAST(o.o_custkey AS VARCHAR) AS cedula,
         o.o_orderpriority AS cargo, o.o_totalprice AS salario,
         o.o_totalprice * CAST(0.1 AS DOUBLE) AS gasto, o.o_orderstatus AS estado,
         CAST(o.o_orderdate AS DATE) AS fecha_de_inicio, o.o_orderdate AS fecha_actualizacion,
         CAST(date_trunc('quarter', o.o_orderdate) AS TIMESTAMP) + INTERVAL 3 MONTH AS fecha_consulta,
         c.c_mktsegment || '_' || o.o_orderpriority AS archivo, c.c_mktsegment AS institucion,
         o.o_orderkey AS source_row
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def months_between_sql(r: str, d: str) -> str:
    """DuckDB form of Spark's ``months_between(r, d)`` (rounded to 8 places)."""
    rt, dt = f"CAST({r} AS TIMESTAMP)", f"CAST({d} AS TIMESTAMP)"
    m = f"(year({rt})*12 + month({rt}) - year({dt})*12 - month({dt}))"
    return (f"round(CASE WHEN day({rt}) = day({dt}) OR (CAST({rt} AS DATE) = last_day({rt}) "
            f"AND CAST({dt} AS DATE) = last_day({dt})) THEN {m} ELSE {m} + "
            f"(epoch({rt} - date_trunc('month', {rt})) - epoch({dt} - date_trunc('month', {dt})))"
            f" / (31*86400.0) END, 8)")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_key_and_tenure(pay(spark, sf_dir))


BRONZE_SQL = f"""bronze AS (
  SELECT *, concat_ws('-', nombre, apellido, institucion, cargo, regexp_replace(cedula, '-', '', 'g'))
              AS composite_key,
         {months_between_sql('fecha_consulta', 'fecha_de_inicio')} / 12 AS antiguedad
  FROM pay)"""


# ----------------------------------------------------- reference tables / snapshot
def paylog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OK extraction log implied by the payroll rows, in audit-log column names."""
    p = pay(spark, sf_dir)
    return p.select(F.col("institucion").alias("institution_name_spanish"),
                    F.col("estado").alias("status_name_spanish"),
                    F.lit("OK").alias("run_status"),
                    F.col("fecha_consulta").alias("source_update"),
                    F.col("fecha_actualizacion").alias("checked_at"),
                    F.col("cargo"))


PAYLOG_SQL = """paylog AS (
  SELECT institucion AS institution_name_spanish, estado AS status_name_spanish, 'OK' AS run_status,
         fecha_consulta AS source_update, fecha_actualizacion AS checked_at, cargo
  FROM pay)"""


def reference_tables(spark: SparkSession, sf_dir: str):
    """The three reference tables of the snapshot.  Maxima and minima are
    decomposable, so one grouped pre-aggregate per (institution, status,
    position), materialised once, feeds all three exactly - one pass over
    the log instead of three."""
    from histlake.session import checkpoint_root
    checkpoint_root(spark)
    log = (paylog(spark, sf_dir)
           .groupBy("institution_name_spanish", "status_name_spanish", "run_status", "cargo")
           .agg(F.max("source_update").alias("source_update"),
                F.max("checked_at").alias("checked_at"),
                F.min("checked_at").alias("first_checked_at"))
           .checkpoint(eager=True))
    # every reference table has at most as many rows as this pre-aggregate
    bound = log.count()
    inst = reference_names(log, "institution_name_spanish", "institution_name_english",
                           dictionary(spark, SEGMENT_DICTIONARY),
                           dictionary_rows=len(SEGMENT_DICTIONARY))
    stat = reference_names(log, "status_name_spanish", "status_name_english",
                           dictionary(spark, ORDER_STATUS_DICTIONARY),
                           dictionary_rows=len(ORDER_STATUS_DICTIONARY))
    pos = position_reference(log, dictionary(spark, PRIORITY_DICTIONARY),
                             position_col="cargo", seen_col="first_checked_at",
                             dictionary_rows=len(PRIORITY_DICTIONARY))
    return inst, stat, pos, bound


def reference_sql(name: str, col: str, english: str, dict_name: str, source: str = "paylog") -> str:
    return f"""{name} AS (
  SELECT r.{col}, r.last_source_update, r.last_checked_at,
         coalesce(d.target, r.{col}) AS {english}
  FROM (SELECT {col}, max(source_update) AS last_source_update, max(checked_at) AS last_checked_at
        FROM {source} WHERE run_status = 'OK' GROUP BY {col}) r
  LEFT JOIN (SELECT source, min(target) AS target FROM {dict_name} GROUP BY source) d
    ON r.{col} = d.source)"""


REFERENCE_SQL = ",\n".join([
    dictionary_sql("seg_dict", SEGMENT_DICTIONARY),
    dictionary_sql("ostat_dict", ORDER_STATUS_DICTIONARY),
    dictionary_sql("prio_dict", PRIORITY_DICTIONARY),
    reference_sql("inst_ref", "institution_name_spanish", "institution_name_english", "seg_dict"),
    reference_sql("stat_ref", "status_name_spanish", "status_name_english", "ostat_dict"),
    """pos_ref AS (
  SELECT r.position_name_spanish, r.last_seen_at,
         coalesce(d.target, r.position_name_spanish) AS position_name_english
  FROM (SELECT cargo AS position_name_spanish, min(checked_at) AS last_seen_at
        FROM paylog WHERE cargo IS NOT NULL GROUP BY cargo) r
  LEFT JOIN (SELECT source, min(target) AS target FROM prio_dict GROUP BY source) d
    ON r.position_name_spanish = d.source)"""])


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    inst, stat, pos, bound = reference_tables(spark, sf_dir)
    return latest_snapshot(bronze(spark, sf_dir), inst, stat, pos, dimension_rows=bound)


SNAPSHOT_SQL = """snapshot AS (
  SELECT b.composite_key, b.nombre AS first_name, b.apellido AS last_name, b.cedula AS id_number,
         b.salario AS salary, b.gasto AS allowance, b.estado AS status_sp,
         s.status_name_english AS status_en, b.institucion AS institution_sp,
         i.institution_name_english AS institution_en, b.cargo AS position_sp,
         p.position_name_english AS position_en, b.fecha_de_inicio AS start_date,
         b.fecha_actualizacion AS query_date, b.fecha_consulta AS snapshot_date,
         b.antiguedad AS years_of_service, b.archivo AS file
  FROM bronze b
  JOIN inst_ref i ON b.institucion = i.institution_name_spanish AND b.fecha_consulta = i.last_source_update
  JOIN stat_ref s ON b.estado = s.status_name_spanish AND b.fecha_consulta = s.last_source_update
  LEFT JOIN pos_ref p ON b.cargo = p.position_name_spanish)"""

SNAPSHOT_CTES = ",\n".join([PAY_SQL, BRONZE_SQL, PAYLOG_SQL, REFERENCE_SQL, SNAPSHOT_SQL])


# -------------------------------------------------------------------- audit log
def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as extraction attempts: institution = user, status = event
    type, outcome from the value, duration = value seconds."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("institution_name_spanish"),
        F.col("event_type").alias("status_name_spanish"),
        F.when(F.col("value") < 10, F.lit("FAIL")).when(F.col("value") < 20, F.lit("No Update"))
         .otherwise(F.lit("OK")).alias("run_status"),
        F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("source_update"),
        F.col("ts").alias("checked_at"),
        F.col("ts").alias("start_at"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))).alias("end_at"),
        F.col("value").cast("float").alias("time"),
    )


LOG_SQL = """log AS (
  SELECT CAST(user_id AS VARCHAR) AS institution_name_spanish, event_type AS status_name_spanish,
         CASE WHEN value < 10 THEN 'FAIL' WHEN value < 20 THEN 'No Update' ELSE 'OK' END AS run_status,
         CAST(date_trunc('day', ts) AS TIMESTAMP) AS source_update, ts AS checked_at, ts AS start_at,
         ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS end_at,
         CAST(value AS FLOAT) AS time
  FROM events)"""


# ------------------------------------------------------------ SCD oracle SQL
def scd2_sql(prefix: str, source: str, columns: list[str], keys: list[str], seq: str,
             tracked: list[str], tie: list[str]) -> str:
    """CTEs ``{prefix}_h`` = the SCD2 history of ``source`` in DuckDB SQL
    (dedup by tie-break, NULL-safe change flags, running version, per-version
    aggregate, join back to the version's latest row, lead for the end)."""
    k = ", ".join(keys)
    tie_order = ", ".join(f"{c} DESC NULLS LAST" for c in tie) or seq
    w = f"PARTITION BY {k} ORDER BY {seq}"
    chg = " OR ".join([f"row_number() OVER ({w}) = 1"] +
                      [f"{t} IS DISTINCT FROM lag({t}) OVER ({w})" for t in tracked])
    on = " AND ".join([f"g.{c} IS NOT DISTINCT FROM v.{c}" for c in keys] +
                      ["g._ver = v._ver", f"v.{seq} = g._last"])
    cols = ", ".join(f"v.{c}" for c in columns)
    return f"""{prefix}_d AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {k}, {seq} ORDER BY {tie_order}) AS _rn
    FROM {source} WHERE {seq} IS NOT NULL) WHERE _rn = 1),
{prefix}_c AS (SELECT *, CASE WHEN {chg} THEN 1 ELSE 0 END AS _chg FROM {prefix}_d),
{prefix}_v AS (SELECT *, sum(_chg) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _ver
  FROM {prefix}_c),
{prefix}_g AS (SELECT {k}, _ver, min({seq}) AS __START_AT, max({seq}) AS _last FROM {prefix}_v
  GROUP BY {k}, _ver),
{prefix}_h AS (SELECT {cols}, g.__START_AT,
  lead(g.__START_AT) OVER (PARTITION BY {", ".join("g." + c for c in keys)} ORDER BY g.__START_AT)
    AS __END_AT
  FROM {prefix}_g g JOIN {prefix}_v v ON {on})"""


ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                  "o_orderpriority"]
ORDERS_KEYS = ["o_custkey", "o_orderpriority"]
ORDERS_SCD_SQL = scd2_sql("oh", "orders", ORDERS_COLUMNS, ORDERS_KEYS, "o_orderdate",
                          ["o_orderstatus"], ["o_orderkey"])

BRONZE_COLUMNS = ["nombre", "apellido", "cedula", "cargo", "salario", "gasto", "estado",
                  "fecha_de_inicio", "fecha_actualizacion", "fecha_consulta", "archivo",
                  "institucion", "source_row", "composite_key", "antiguedad"]
PAY_SCD_SQL = scd2_sql("ph", "bronze", BRONZE_COLUMNS,
                       ["cedula", "nombre", "apellido", "cargo", "estado"], "fecha_consulta",
                       ["salario", "gasto", "fecha_de_inicio"], ["source_row"])


def orders_history(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    from histlake.operators.scd import scd2
    return scd2(table(spark, sf_dir, "orders"), ORDERS_KEYS, "o_orderdate",
                track=["o_orderstatus"], tie_break=["o_orderkey"], **kw)


def pay_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histlake.operators.scd import scd2
    from histlake.schemas import PAYROLL_KEYS, PAYROLL_SEQUENCE, PAYROLL_TRACKED
    return scd2(bronze(spark, sf_dir), PAYROLL_KEYS, PAYROLL_SEQUENCE, track=PAYROLL_TRACKED,
                tie_break=["source_row"])


INACTIVE_SQL = f"""inactive AS (
  SELECT h.cedula, h.nombre, h.apellido, h.cargo, h.estado, h.institucion, h.salario, h.gasto,
         h.fecha_de_inicio, h.__START_AT AS last_active_date,
         TIMESTAMP '{DETECTED_AT}' AS detected_at
  FROM ph_h h
  WHERE h.__END_AT IS NULL AND NOT EXISTS (
    SELECT 1 FROM snapshot s WHERE s.id_number = h.cedula AND s.first_name = h.nombre
      AND s.last_name = h.apellido AND s.position_sp = h.cargo AND s.status_sp = h.estado))"""


def inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histlake.operators.snapshot import inactive as inactive_op
    return inactive_op(pay_history(spark, sf_dir), snapshot(spark, sf_dir), detected_at=DETECTED_AT)


# ------------------------------------------------------------- text analogs
# Fixed values of the sheet analog: two column layouts (the second used by
# the sheets named below) and the update text in cell E3.
SHEET_LAYOUT_A = ["Nombre", "Apellido", " Cédula ", "Cargo", "Salario", "Gasto", "Estado",
                  "Fecha de Inicio"]
SHEET_LAYOUT_B = ["Cargo", "Salario", "Nombre", "Apellido", "CEDULA", "Gasto", "Fecha de Inicio",
                  "Estado"]
SHEETS_WITH_LAYOUT_B = ["SMALL", "STANDARD"]
# the sheets in workbook order, and the update text of the n-th (day n)
SHEET_ORDER = ["STANDARD", "SMALL", "PROMO", "MEDIUM", "LARGE", "ECONOMY"]
SHEET_UPDATE_TEXT = ("Fecha de actualización: 0", "/01/2025 01:30:00 PM")
SITE_UPDATE = "2025-01-15 00:00:00"


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded sheet rows built from ``part``: one file per brand, one sheet
    per type family, a header row (5), an update row (3) and one data row
    per part (row 6 + part key)."""
    p = table(spark, sf_dir, "part")
    sheet = F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))
    layout_b = sheet.isin(SHEETS_WITH_LAYOUT_B)
    nombre, apellido = F.col("p_name"), F.col("p_brand")
    cedula, cargo = F.col("p_partkey").cast("string"), F.col("p_type")
    salario = F.col("p_retailprice").cast("string")
    gasto = F.when(F.col("p_size") > 45, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    estado = F.when(F.col("p_size") > 25, F.lit("PERMANENTE")).otherwise(F.lit("EVENTUAL"))
    fecha = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")), "dd/MM/yyyy")
    cells = F.when(layout_b, F.array(cargo, salario, nombre, apellido, cedula, gasto, fecha, estado)) \
             .otherwise(F.array(nombre, apellido, cedula, cargo, salario, gasto, estado, fecha))
    data = p.select(F.col("p_brand").alias("file"), sheet.alias("sheet"),
                    (F.col("p_partkey") + 6).cast("long").alias("row_no"), cells.alias("cells"))
    number = F.array_position(F.array(*[F.lit(x) for x in SHEET_ORDER]), F.col("sheet"))
    sheets = data.select("file", "sheet").distinct()
    header = sheets.select("file", "sheet", F.lit(5).cast("long").alias("row_no"),
                           F.when(F.col("sheet").isin(SHEETS_WITH_LAYOUT_B),
                                  F.array(*[F.lit(x) for x in SHEET_LAYOUT_B]))
                            .otherwise(F.array(*[F.lit(x) for x in SHEET_LAYOUT_A])).alias("cells"))
    update = sheets.select("file", "sheet", F.lit(3).cast("long").alias("row_no"),
                           F.array(F.lit(""), F.lit(""), F.lit(""), F.lit(""),
                                   F.concat(F.lit(SHEET_UPDATE_TEXT[0]), number.cast("string"),
                                            F.lit(SHEET_UPDATE_TEXT[1]))).alias("cells"))
    out = data.unionByName(header).unionByName(update)
    return out.withColumns({"sheet_no": number, "institution": F.concat(F.lit("INST "), F.col("file")),
                            "site_update": F.lit(SITE_UPDATE).cast("timestamp")})


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


RAW_CELLS_SQL = f"""raw_cells AS (
  SELECT p_brand AS file, split_part(p_type, ' ', 1) AS sheet, p_partkey + 6 AS row_no,
    CASE WHEN split_part(p_type, ' ', 1) IN ({", ".join("'" + s + "'" for s in SHEETS_WITH_LAYOUT_B)})
      THEN [p_type, CAST(p_retailprice AS VARCHAR), p_name, p_brand, CAST(p_partkey AS VARCHAR),
            CASE WHEN p_size > 45 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END,
            strftime(DATE '2000-01-01' + p_size, '%d/%m/%Y'),
            CASE WHEN p_size > 25 THEN 'PERMANENTE' ELSE 'EVENTUAL' END]
      ELSE [p_name, p_brand, CAST(p_partkey AS VARCHAR), p_type, CAST(p_retailprice AS VARCHAR),
            CASE WHEN p_size > 45 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END,
            CASE WHEN p_size > 25 THEN 'PERMANENTE' ELSE 'EVENTUAL' END,
            strftime(DATE '2000-01-01' + p_size, '%d/%m/%Y')] END AS cells
  FROM part
  UNION ALL
  SELECT DISTINCT p_brand, split_part(p_type, ' ', 1), 5,
    CASE WHEN split_part(p_type, ' ', 1) IN ({", ".join("'" + s + "'" for s in SHEETS_WITH_LAYOUT_B)})
      THEN {_sql_list(SHEET_LAYOUT_B)} ELSE {_sql_list(SHEET_LAYOUT_A)} END
  FROM part
  UNION ALL
  SELECT DISTINCT p_brand, split_part(p_type, ' ', 1), 3, ['', '', '', '', '{SHEET_UPDATE_TEXT[0]}'
    || CAST(list_position({_sql_list(SHEET_ORDER)}, split_part(p_type, ' ', 1)) AS VARCHAR) || '{SHEET_UPDATE_TEXT[1]}']
  FROM part)"""


def _cell_sql(name: str) -> str:
    return (f"CASE WHEN list_position(h.names, '{name}') > 0 "
            f"THEN d.cells[list_position(h.names, '{name}')] END")


SHEET_CLEAN_SQL = f"""sheet_headers AS (
  SELECT file, sheet, list_transform(cells, lambda x:
           CASE WHEN lower(replace(trim(x), ' ', '_')) = 'cédula' THEN 'cedula'
                ELSE lower(replace(trim(x), ' ', '_')) END) AS names
  FROM raw_cells WHERE row_no = 5),
sheet_updates AS (
  SELECT file, arg_min(cells[5], list_position({_sql_list(SHEET_ORDER)}, sheet)) AS update_text FROM raw_cells WHERE row_no = 3 GROUP BY file),
sheet_clean AS (
  SELECT {_cell_sql('nombre')} AS nombre, {_cell_sql('apellido')} AS apellido,
         {_cell_sql('cedula')} AS cedula, {_cell_sql('cargo')} AS cargo,
         TRY_CAST({_cell_sql('salario')} AS DOUBLE) AS salario,
         TRY_CAST({_cell_sql('gasto')} AS DOUBLE) AS gasto,
         {_cell_sql('estado')} AS estado,
         CAST(try_strptime({_cell_sql('fecha_de_inicio')}, '%d/%m/%Y') AS DATE) AS fecha_de_inicio,
         try_strptime(regexp_replace(regexp_extract(u.update_text,
             '.*?:\\s+(\\d{{2}}/\\d{{2}}/\\d{{4}}\\s+\\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}\\s+\\w{{2}})', 1),
             '\\s+\\w+$', ''), '%d/%m/%Y %H:%M:%S') AS fecha_actualizacion,
         TIMESTAMP '{SITE_UPDATE}' AS fecha_consulta, d.file AS archivo,
         'INST ' || d.file AS institucion
  FROM raw_cells d JOIN sheet_headers h ON d.file = h.file AND d.sheet = h.sheet
  LEFT JOIN sheet_updates u ON d.file = u.file
  WHERE d.row_no >= 6)"""
