"""ANSI SQL (DuckDB dialect) equivalents of :mod:`flagstar.plans.driver_tables`.

Each statement runs on the driver's tables registered as views and must give
the same rows, column names and types as the Spark query of the same name.
"""

from __future__ import annotations

# Shared building blocks ------------------------------------------------------
_APPT = """
appt AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         o.o_custkey AS id_paciente,
         l.l_suppkey AS id_doctor,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_shipdate END AS fecha_hora,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER)
           AS tiempo_espera_minutos,
         l.l_quantity AS duracion_minutos,
         l.l_extendedprice AS costo,
         l.l_returnflag AS estado
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

_SILVER = _APPT + """,
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey
      ORDER BY fecha_hora NULLS FIRST, tiempo_espera_minutos NULLS FIRST, id_paciente NULLS FIRST,
               duracion_minutos NULLS FIRST, costo NULLS FIRST, estado NULLS FIRST) AS rn
    FROM appt) WHERE rn = 1
),
silver AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, id_paciente, id_doctor, fecha_hora,
         CASE WHEN tiempo_espera_minutos < 0 THEN 0 ELSE tiempo_espera_minutos END AS tiempo_espera_minutos,
         duracion_minutos, costo, estado,
         concat_ws(',',
           CASE WHEN fecha_hora IS NULL THEN 'missing_fecha_hora' END,
           CASE WHEN tiempo_espera_minutos < 0 THEN 'tiempo_espera_corregido' END) AS flags
  FROM dedup
)"""

_FACT = _SILVER + """,
fact AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, id_paciente, id_doctor,
         CASE WHEN fecha_hora IS NOT NULL THEN CAST(strftime(fecha_hora, '%Y%m%d') AS INTEGER) ELSE -1 END
           AS id_tiempo,
         duracion_minutos, tiempo_espera_minutos, costo, estado,
         flags <> '' AS tiene_flag_calidad
  FROM silver
)"""


def _calendar(source: str, col: str) -> str:
    return f"""
cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id_tiempo,
         CAST(d AS DATE) AS fecha,
         dayname(d) AS dia_semana,
         CAST(month(d) AS INTEGER) AS mes,
         CAST(quarter(d) AS INTEGER) AS trimestre,
         CAST(year(d) AS INTEGER) AS anio,
         dayofweek(d) IN (0, 6) AS es_fin_de_semana
  FROM (SELECT unnest(generate_series(min(CAST({col} AS DATE)), max(CAST({col} AS DATE)), INTERVAL 1 DAY)) AS d
        FROM {source} WHERE {col} IS NOT NULL)
  UNION ALL
  SELECT -1, CAST(NULL AS DATE), 'Desconocido', CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
         CAST(NULL AS INTEGER), CAST(NULL AS BOOLEAN)
)"""


_DIM_PACIENTE = """
dim_paciente AS (
  SELECT c_custkey AS id_paciente, c_name AS nombre, c_nationkey AS id_nacion, c_mktsegment AS segmento
  FROM customer
)"""

_DIM_DOCTOR = """
dim_doctor AS (
  SELECT s.s_suppkey AS id_doctor, s.s_name AS nombre, n.n_name AS especialidad
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

_STAR = (
    "WITH " + _FACT.lstrip() + "," + _calendar("silver", "fecha_hora") + "," + _DIM_PACIENTE + "," + _DIM_DOCTOR
    + """,
star AS (
  SELECT f.*, d.nombre, d.especialidad,
         c.fecha, c.dia_semana, c.mes, c.trimestre, c.anio, c.es_fin_de_semana,
         p.nombre AS nombre_paciente, p.id_nacion, p.segmento
  FROM fact f
  JOIN dim_doctor d ON f.id_doctor = d.id_doctor
  JOIN cal c ON f.id_tiempo = c.id_tiempo
  JOIN dim_paciente p ON f.id_paciente = p.id_paciente
)
"""
)

_KPIS = """
SELECT count(*) AS total_citas,
       CAST(avg(tiempo_espera_minutos) AS DOUBLE) AS tiempo_espera_prom,
       coalesce(CAST(sum(CAST(costo AS DECIMAL(28,6))) AS DOUBLE), 0.0) AS ingresos_totales,
       coalesce(CAST(100 AS DOUBLE) * CAST(count(*) FILTER (WHERE tiene_flag_calidad) AS DOUBLE)
                / NULLIF(CAST(count(*) AS DOUBLE), 0.0), 0.0) AS pct_con_flag
FROM star"""

# Patients from the customers' own columns: what the text form must come back to.
_PATIENTS = r"""
WITH p AS (
  SELECT *, NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$') AS bad_email
  FROM (SELECT c_name AS nombre, c_mktsegment, c_nationkey,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS id_paciente,
               CASE WHEN c_nationkey < 3 THEN NULL ELSE make_date(1910 + c_nationkey, 2, 3) END AS fecha_nacimiento,
               CASE WHEN c_acctbal > 9000 THEN c_name ELSE c_mktsegment || '@' || c_name || '.mx' END AS email
        FROM customer)
)"""

SQL: dict[str, str] = {
    "flag_missing": "WITH " + _APPT.lstrip() + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fecha_hora,
       concat_ws(',', CASE WHEN fecha_hora IS NULL THEN 'missing_fecha_hora' END) AS flags
FROM appt""",
    "flag_and_clamp": "WITH " + _APPT.lstrip() + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN tiempo_espera_minutos < 0 THEN 0 ELSE tiempo_espera_minutos END AS tiempo_espera_minutos,
       concat_ws(',',
         CASE WHEN fecha_hora IS NULL THEN 'missing_fecha_hora' END,
         CASE WHEN tiempo_espera_minutos < 0 THEN 'tiempo_espera_corregido' END) AS flags
FROM appt""",
    "flag_range": """
SELECT c_custkey, c_acctbal,
       concat_ws(',', CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN 'acctbal_fuera_de_rango' END) AS flags
FROM customer""",
    "flag_regex": r"""
SELECT page_id, url,
       concat_ws(',', CASE WHEN NOT regexp_matches(url, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN 'email_invalido' END)
         AS flags
FROM pages""",
    "flag_regex_text": r"""
SELECT doc_id,
       concat_ws(',', CASE WHEN regexp_matches(text, '[^@\s]+@[^@\s]+\.[^@\s]+') THEN 'email_en_texto' END) AS flags
FROM documents""",
    "flag_date_bounds": """
SELECT o_orderkey, o_orderdate,
       concat_ws(',', CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-01-01'
                             OR CAST(o_orderdate AS DATE) < DATE '1995-06-01'
                           THEN 'fecha_nacimiento_invalida' END) AS flags
FROM orders""",
    "flag_null_or_negative": """
SELECT event_id, resultado,
       concat_ws(',', CASE WHEN resultado < 0 OR resultado IS NULL THEN 'resultado_fuera_de_rango' END) AS flags
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(NULL AS DOUBLE) ELSE value END AS resultado
      FROM events)""",
    "quality_summary": "WITH " + _SILVER.lstrip() + """
SELECT 'citas' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE flags <> '') AS flagged_rows,
       coalesce(CAST(100 AS DOUBLE) * CAST(count(*) FILTER (WHERE flags <> '') AS DOUBLE)
                / NULLIF(CAST(count(*) AS DOUBLE), 0.0), 0.0) AS pct_flagged
FROM silver""",
    "flag_audit": "WITH " + _SILVER.lstrip() + """
SELECT flag, count(*) AS rows
FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM silver WHERE flags <> '')
GROUP BY flag""",
    "dirty_rows": "WITH " + _SILVER.lstrip() + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, flags FROM silver WHERE flags <> ''""",
    "clean_rows": "WITH " + _SILVER.lstrip() + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, tiempo_espera_minutos FROM silver WHERE flags = ''""",
    "dedup_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
                 l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
                 l_shipdate NULLS FIRST) AS rn
      FROM lineitem)
WHERE rn = 1""",
    "dup_count": """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicates_removed
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "dedup_text": """
SELECT doc_id, text, lang, source, n_chars
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS FIRST) AS rn FROM documents)
WHERE rn = 1""",
    "dim_paciente": "WITH " + _DIM_PACIENTE.lstrip() + " SELECT * FROM dim_paciente",
    "dim_doctor": "WITH " + _DIM_DOCTOR.lstrip() + " SELECT * FROM dim_doctor",
    "age_years": """
SELECT o_orderkey,
       CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-02') / 365.25) AS INTEGER) AS edad,
       CAST(year(DATE '2024-01-02') - year(o_orderdate)
            - CASE WHEN month(o_orderdate) > 1 OR (month(o_orderdate) = 1 AND day(o_orderdate) > 2)
                   THEN 1 ELSE 0 END AS INTEGER) AS edad_exacta
FROM orders""",
    "calendar_dim": "WITH " + _calendar("orders", "o_orderdate").lstrip() + " SELECT * FROM cal",
    "fact_build": "WITH " + _FACT.lstrip() + " SELECT * FROM fact",
    "orphans_customer": "WITH " + _FACT.lstrip() + "," + _DIM_PACIENTE + """
SELECT f.* FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM dim_paciente p
                  WHERE p.id_paciente = f.id_paciente AND p.segmento <> 'MACHINERY')""",
    "orphan_report": "WITH " + _FACT.lstrip() + "," + _calendar("silver", "fecha_hora") + "," + _DIM_PACIENTE + ","
    + _DIM_DOCTOR + """,
report AS (
  SELECT 'paciente' AS fk_name, 'id_paciente' AS fact_key,
         (SELECT count(*) FROM fact f WHERE NOT EXISTS (
            SELECT 1 FROM dim_paciente p WHERE p.id_paciente = f.id_paciente AND p.segmento <> 'MACHINERY'))
           AS orphan_rows
  UNION ALL
  SELECT 'doctor', 'id_doctor', (SELECT count(*) FROM fact f WHERE NOT EXISTS (
            SELECT 1 FROM dim_doctor d WHERE d.id_doctor = f.id_doctor))
  UNION ALL
  SELECT 'tiempo', 'id_tiempo', (SELECT count(*) FROM fact f WHERE NOT EXISTS (
            SELECT 1 FROM cal c WHERE c.id_tiempo = f.id_tiempo))
)
SELECT *, orphan_rows = 0 AS passed FROM report""",
    "star_view": _STAR + "SELECT * FROM star",
    "kpis": _STAR + _KPIS,
    "kpis_clean": _STAR.replace(
        "\nstar AS (", "\nstar_all AS ("
    ).rstrip()
    + """,
star AS (
  SELECT * FROM star_all
  WHERE especialidad IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13')
    AND NOT tiene_flag_calidad
)
""" + _KPIS,
    "monthly": _STAR + """
SELECT anio, mes, count(*) AS total_citas, concat_ws('-', CAST(anio AS VARCHAR), lpad(CAST(mes AS VARCHAR), 2, '0'))
         AS periodo
FROM star WHERE id_tiempo <> -1 AND anio IS NOT NULL AND mes IS NOT NULL
GROUP BY anio, mes""",
    "by_status": _STAR + """
SELECT estado, count(*) AS total FROM star WHERE estado IS NOT NULL GROUP BY estado""",
    "wait_by_specialty": _STAR + """
SELECT especialidad, round_even(avg(tiempo_espera_minutos), 1) AS tiempo_espera_minutos
FROM star WHERE especialidad IS NOT NULL GROUP BY especialidad""",
    "top_doctors": _STAR + """
SELECT nombre, count(*) AS total_citas FROM star WHERE nombre IS NOT NULL
GROUP BY nombre ORDER BY total_citas DESC, nombre ASC LIMIT 10""",
    "specialty_domain": _STAR + """
SELECT DISTINCT especialidad FROM star WHERE especialidad IS NOT NULL""",
    "check_silver": "WITH " + _SILVER.lstrip() + """,
report AS (
  SELECT 'pk_unique' AS check_name,
         (SELECT (SELECT count(*) FROM silver)
                 - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM silver)))
           AS violations
  UNION ALL SELECT 'column_present:data_quality_flag', 0
  UNION ALL SELECT 'null_date_flagged',
         (SELECT count(*) FROM silver WHERE fecha_hora IS NULL AND NOT contains(flags, 'missing_fecha_hora'))
  UNION ALL SELECT 'no_row_loss',
         (SELECT abs((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM appt))
                     - (SELECT count(*) FROM silver)))
)
SELECT *, violations = 0 AS passed FROM report""",
    "check_gold": "WITH " + _FACT.lstrip() + "," + _calendar("silver", "fecha_hora") + "," + _DIM_PACIENTE + ","
    + _DIM_DOCTOR + """,
report AS (
  SELECT 'not_null:id_tiempo' AS check_name, (SELECT count(*) FROM fact WHERE id_tiempo IS NULL) AS violations
  UNION ALL SELECT 'single_unknown_member', (SELECT abs(count(*) - 1) FROM cal WHERE id_tiempo = -1)
  UNION ALL SELECT 'columns_absent', 0
  UNION ALL SELECT 'no_orphans:id_doctor',
    (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_doctor d WHERE d.id_doctor = f.id_doctor))
  UNION ALL SELECT 'no_orphans:id_paciente',
    (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_paciente p WHERE p.id_paciente = f.id_paciente))
  UNION ALL SELECT 'no_orphans:id_tiempo',
    (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM cal c WHERE c.id_tiempo = f.id_tiempo))
)
SELECT *, violations = 0 AS passed FROM report""",
    "csv_landing": "SELECT *, c_mktsegment AS turno, CAST(NULL AS VARCHAR) AS _corrupt_record FROM customer",
    "landing_status": """
SELECT 'customer' AS table_name, count(*) AS rows, 'OK' AS status FROM customer
UNION ALL SELECT 'ausente', 0, 'MISSING'
UNION ALL SELECT 'TOTAL', count(*), 'FAILED' FROM customer""",
    "check_lake": """
WITH report AS (
  SELECT 'table_exists:customer' AS check_name, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END::BIGINT AS violations
  FROM customer
  UNION ALL SELECT 'table_exists:ausente', 1
)
SELECT *, violations = 0 AS passed FROM report""",
    "orphans_lab": """
SELECT 'cita' AS fk_name, 'id_cita' AS fact_key, count(*) AS orphan_rows, count(*) = 0 AS passed
FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND CAST(o.o_orderdate AS DATE) >= DATE '1995-06-01')""",
    "top_doctors_id": _STAR + """
SELECT nombre, id_doctor, count(*) AS total_citas FROM star WHERE nombre IS NOT NULL
GROUP BY nombre, id_doctor ORDER BY total_citas DESC, nombre ASC, id_doctor ASC LIMIT 10""",
    "flag_regex_email": _PATIENTS + """
SELECT nombre, email, concat_ws(',', CASE WHEN bad_email THEN 'email_invalido' END) AS flags FROM p""",
    "silver_pacientes": _PATIENTS + """
SELECT nombre, id_paciente, fecha_nacimiento,
       concat_ws(',', CASE WHEN bad_email THEN 'email_invalido' END,
                 CASE WHEN id_paciente IS NULL THEN 'valor_no_interpretable_id_paciente' END,
                 CASE WHEN fecha_nacimiento IS NULL THEN 'valor_no_interpretable_fecha_nacimiento' END) AS flags
FROM p""",
    "silver_doctores": """
SELECT s_name AS nombre, CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS id_doctor,
       CASE WHEN s_nationkey >= 3 THEN CASE WHEN s_nationkey > 20 THEN s_nationkey * 3 ELSE s_nationkey END END::INTEGER AS anios_experiencia,
       lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cedula_profesional,
       concat_ws(',', CASE WHEN s_nationkey > 20 THEN 'experiencia_fuera_de_rango' END,
                 CASE WHEN s_acctbal < 0 THEN 'valor_no_interpretable_id_doctor' END,
                 CASE WHEN s_nationkey < 3 THEN 'valor_no_interpretable_anios_experiencia' END) AS flags
FROM supplier""",
    "silver_citas": """
SELECT o_orderkey AS id_cita, o_custkey AS id_paciente,
       CASE WHEN o_orderpriority[1] NOT IN ('1', '2') THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS fecha_hora,
       CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_totalprice >= 100000 THEN 7 END::INTEGER AS tiempo_espera_minutos,
       CASE WHEN o_totalprice <= 400000 THEN o_totalprice END AS costo,
       concat_ws(',', CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'missing_fecha_hora' END,
                 CASE WHEN o_orderstatus = 'P' THEN 'tiempo_espera_corregido' END,
                 CASE WHEN o_orderstatus <> 'P' AND o_totalprice < 100000 THEN 'valor_no_interpretable_tiempo_espera_minutos' END,
                 CASE WHEN o_totalprice > 400000 THEN 'valor_no_interpretable_costo' END) AS flags
FROM orders""",
    "silver_lab": """
SELECT event_id AS id_resultado, CASE WHEN event_type <> 'view' THEN user_id END AS id_cita,
       CASE WHEN event_type = 'click' THEN -value WHEN event_type NOT IN ('error', 'signup') THEN value END AS resultado,
       concat_ws(',', CASE WHEN event_type IN ('error', 'signup') OR (event_type = 'click' AND value > 0) OR value < 0 THEN 'resultado_fuera_de_rango' END,
                 CASE WHEN event_type = 'view' THEN 'valor_no_interpretable_id_cita' END) AS flags
FROM events""",
    "csv_headers": """
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS nombre, CAST(c_nationkey AS VARCHAR) AS pais FROM customer)
SELECT id, nombre, pais, NULL::VARCHAR AS turno, NULL::VARCHAR AS _corrupt_record FROM c
UNION ALL SELECT id, nombre, pais, 'si', NULL FROM c
UNION ALL SELECT id, nombre, NULL, NULL, id || ',' || nombre || ',sobra' FROM c""",
    "layers_recovery": """
WITH c AS (
  SELECT count(*) AS n, count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000) AS f, sum(CAST(c_acctbal AS DECIMAL(38,6)))::DOUBLE AS s,
         count(*) FILTER (c_acctbal + 1000 NOT BETWEEN 0 AND 9000) AS f2, sum(CAST(c_acctbal + 1000 AS DECIMAL(38,6)))::DOUBLE AS s2
  FROM customer
), o AS (SELECT count(*) AS n FROM orders)
SELECT '1 first' AS step, 'bronze:ok,silver:ok,gold:ok' AS stages, c.n AS silver_rows, f AS silver_flagged, c.n AS gold_rows, s AS gold_sum, o.n AS gold_orders FROM c, o
UNION ALL SELECT '2 broken', 'bronze:ok,silver:failed', c.n, f, c.n, s, o.n FROM c, o
UNION ALL SELECT '3 repeated', 'bronze:ok,silver:ok,gold:ok', c.n, f2, c.n, s2, o.n FROM c, o
UNION ALL SELECT '4 orphans', 'bronze:ok,silver:ok,gold:failed', c.n, f, c.n, s2, o.n FROM c, o""",
    "dim_paciente_edad": _PATIENTS + """
SELECT id_paciente, nombre,
       CAST(floor(date_diff('day', fecha_nacimiento, DATE '2024-01-02') / 365.25) AS INTEGER) AS edad,
       c_mktsegment AS genero, CAST(c_nationkey AS VARCHAR) AS ciudad
FROM p""",
    "latest_partition": """
SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "load_report": """
WITH counts AS (
  SELECT 'customer' AS table_name, count(*) AS rows FROM customer
  UNION ALL SELECT 'orders', count(*) FROM orders
  UNION ALL SELECT 'events', count(*) FROM events
)
SELECT table_name, rows, CASE WHEN rows > 0 THEN 'OK' ELSE 'FAILED' END AS status FROM counts
UNION ALL
SELECT 'TOTAL', CAST(sum(rows) AS BIGINT), CASE WHEN sum(rows) > 0 THEN 'OK' ELSE 'FAILED' END FROM counts""",
}

# The layered run writes and re-reads the same appointments, so its monthly
# mart equals the in-memory one.
SQL["medallion_monthly"] = SQL["monthly"]
# The streamed Silver holds every event once with the same flag as the batch rule.
SQL["stream_silver"] = SQL["flag_null_or_negative"]
