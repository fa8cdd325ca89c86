"""The operators on the driver's TPC-H-like tables.

The driver's tables play the roles of the hospital model: an "appointment"
is a line item joined to its order (patient = customer, doctor = supplier,
specialty = supplier's nation, appointment time = ship date, wait = days from
order to shipment, cost = extended price, status = return flag). Every
function takes ``(spark, sf_dir)`` and returns a DataFrame whose work grows
with the input tables; nothing is sampled or capped except the top-k report.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.functions.dates import age_years
from flagstar.functions.numeric import money_sum
from flagstar.functions.rules import contains_email, is_missing, outside_dates, outside_range, regex_mismatch
from flagstar.operators import checks as V
from flagstar.operators.dedup import dedup_by_key, duplicate_count
from flagstar.operators.integrity import ForeignKey, orphan_report, orphans
from flagstar.operators.marts import count_by, domain, kpis, mean_by, monthly, select_rows, top_k
from flagstar.operators.quality import (
    FLAG_COL,
    Rule,
    TableSpec,
    apply_rules,
    clean_rows,
    dirty_rows,
    flag_audit,
    quality_summary,
    refine,
)
from flagstar.operators.star import (
    DimRef,
    calendar_dim,
    calendar_from_bounds,
    calendar_size,
    date_bound_metrics,
    date_bounds,
    fact_build,
    project_dim,
    star_view,
    with_age,
    with_date_attributes,
)
from flagstar.plans import hospital as H
from flagstar.plans.medallion import Domain, run_layers
from flagstar.session import scratch_dir
from flagstar.sources.landing import land_by_date, land_csv, load_report, read_latest, table_counts
from flagstar.sources.layers import materialize, read_source, read_table, write_table
from flagstar.streaming.silver_stream import refine_stream

# ---------------------------------------------------------------------------
# Fixed parameters of the driver-table queries (the oracle SQL uses the same).
APPT_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
MISSING_DATE_LINE = 7  # line number whose ship date is treated as not recorded
AS_OF = _dt.date(2024, 1, 2)
ORDER_DATE_MIN, ORDER_DATE_AS_OF = "1995-06-01", "2001-01-01"
ACCTBAL_MIN, ACCTBAL_MAX = 0, 9000
FLAG_ACCTBAL = "acctbal_fuera_de_rango"
FLAG_EMAIL_IN_TEXT = "email_en_texto"
EXCLUDED_SEGMENT = "MACHINERY"
SELECTED_SPECIALTIES = ("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13")
TOP_K = 10
# Total orders that decide which duplicate survives (all non-key columns).
APPT_TIEBREAK = ("fecha_hora", "tiempo_espera_minutos", "id_paciente", "duracion_minutos", "costo", "estado")
LINEITEM_TIEBREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus", "l_shipdate")
# ---------------------------------------------------------------------------

FACT_COLUMNS = (
    *APPT_KEY,
    "id_paciente", "id_doctor", "id_tiempo", "duracion_minutos",
    "tiempo_espera_minutos", "costo", "estado", "tiene_flag_calidad",
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, sf_dir, name)


def _flags_text(col: str = FLAG_COL) -> F.Column:
    return F.array_join(F.col(col), ",").alias("flags")


# --------------------------------------------------------------------- roles
def _appointment_time() -> F.Column:
    """A line item's appointment time: its ship date, where that counts as recorded."""
    return F.when(F.col("l_linenumber") == MISSING_DATE_LINE, F.lit(None)).otherwise(F.col("l_shipdate"))


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The "citas" role: line items joined to their orders."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        *[li[c] for c in APPT_KEY],
        F.col("o_custkey").alias("id_paciente"),
        li["l_suppkey"].alias("id_doctor"),
        _appointment_time().alias("fecha_hora"),
        F.datediff(F.to_date(F.col("l_shipdate")), F.to_date(F.col("o_orderdate"))).alias("tiempo_espera_minutos"),
        F.col("l_quantity").alias("duracion_minutos"),
        F.col("l_extendedprice").alias("costo"),
        F.col("l_returnflag").alias("estado"),
    )


def appointment_spec() -> TableSpec:
    return TableSpec(
        "citas", APPT_KEY, H.appointment_rules(), H.appointment_repairs(),
        order_by=APPT_TIEBREAK,
    )


def silver_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(appointments(spark, sf_dir), appointment_spec())


def patient_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient role: customers, without the sensitive balance column."""
    c = _t(spark, sf_dir, "customer")
    return project_dim(
        c,
        [F.col("c_custkey").alias("id_paciente"), F.col("c_name").alias("nombre"),
         F.col("c_nationkey").alias("id_nacion"), F.col("c_mktsegment").alias("segmento")],
        forbidden=("c_acctbal",),
    )


def doctor_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doctor role: suppliers with their nation's name as specialty."""
    s = _t(spark, sf_dir, "supplier")
    n = _t(spark, sf_dir, "nation")
    # A plain scan: Spark's size-based auto-broadcast decides from the file size.
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
    return project_dim(
        j,
        [F.col("s_suppkey").alias("id_doctor"), F.col("s_name").alias("nombre"),
         F.col("n_name").alias("especialidad")],
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_build(silver_appointments(spark, sf_dir), "fecha_hora", FACT_COLUMNS)


def silver_and_calendar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DimRef]:
    """Silver appointments written once to shared scratch storage, and the
    calendar for their date range.

    The fact and the calendar both derive from Silver; writing it once (the
    date bounds ride on that write as an Observation) means the join and the
    dedup shuffle run once instead of once per consumer.
    """
    silver, metrics = materialize(
        silver_appointments(spark, sf_dir),
        scratch_dir(spark, "silver-citas"),
        date_bound_metrics("fecha_hora"),
    )
    lo, hi = metrics.get("date_lo"), metrics.get("date_hi")
    return silver, DimRef(calendar_from_bounds(spark, lo, hi), "id_tiempo", known_rows=calendar_size(lo, hi))


def covering_calendar(spark: SparkSession, sf_dir: str) -> DimRef:
    """A calendar for all line items' appointment times.

    Every Silver date is one of them, so each fact finds its day; days outside
    the fact's own range find no fact. One column is scanned, nothing shuffled
    but two dates a task.
    """
    times = _t(spark, sf_dir, "lineitem").select(_appointment_time().alias("fecha_hora"))
    lo, hi = date_bounds(times, "fecha_hora")
    return DimRef(calendar_from_bounds(spark, lo, hi), "id_tiempo", known_rows=calendar_size(lo, hi))


def doctor_ref(spark: SparkSession, sf_dir: str) -> DimRef:
    """The doctor dimension with its row count.

    Spark takes the product of the two tables' sizes as the size of suppliers
    joined to nations, and would shuffle the fact for a dimension that is small;
    counting it reads three short columns.
    """
    doctors = doctor_dim(spark, sf_dir)
    return DimRef(doctors, "id_doctor", known_rows=doctors.count())


def star_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star with date attributes computed from each appointment's own date
    instead of joined from the calendar (same rows and values; one plan)."""
    f = fact_build(silver_appointments(spark, sf_dir), "fecha_hora", [*FACT_COLUMNS, "fecha_hora"])
    dated = with_date_attributes(f, "fecha_hora").drop("fecha_hora")
    return star_view(
        dated,
        [
            doctor_ref(spark, sf_dir),
            DimRef(patient_dim(spark, sf_dir), "id_paciente", rename={"nombre": "nombre_paciente"}),
        ],
    )


def star(spark: SparkSession, sf_dir: str, with_calendar: bool = True) -> DataFrame:
    """Fact with doctor, date and patient dimensions (P7 renames).

    The calendar covers every date of the fact by construction (each fact
    key is a day of some line item, or the unknown member), so joining it never
    drops a row; it only adds date attributes. Marts that use none of them pass
    ``with_calendar=False``: same rows. The star reads Silver once, so Silver is
    not written for it.
    """
    f = fact_build(silver_appointments(spark, sf_dir), "fecha_hora", FACT_COLUMNS)
    return star_view(
        f,
        [
            doctor_ref(spark, sf_dir),
            *([covering_calendar(spark, sf_dir)] if with_calendar else []),
            DimRef(patient_dim(spark, sf_dir), "id_paciente", rename={"nombre": "nombre_paciente"}),
        ],
    )


# ------------------------------------------------------------------- quality
def q_flag_missing(spark, sf_dir):
    """Q4 + Q8."""
    out = apply_rules(appointments(spark, sf_dir), [Rule(H.FLAG_MISSING_DATE, lambda: is_missing("fecha_hora"))])
    return out.select(*APPT_KEY, "fecha_hora", _flags_text())


def q_flag_and_clamp(spark, sf_dir):
    """Q4 + Q5 + Q6 + Q8: flags judged on the arriving value, then the repair."""
    out = apply_rules(appointments(spark, sf_dir), H.appointment_rules(), H.appointment_repairs())
    return out.select(*APPT_KEY, "tiempo_espera_minutos", _flags_text())


def q_flag_range(spark, sf_dir):
    """Q3: a value outside an inclusive range."""
    rule = Rule(FLAG_ACCTBAL, lambda: outside_range("c_acctbal", ACCTBAL_MIN, ACCTBAL_MAX))
    return apply_rules(_t(spark, sf_dir, "customer"), [rule]).select("c_custkey", "c_acctbal", _flags_text())


def q_flag_regex(spark, sf_dir):
    """Q1: the e-mail format rule over a text column."""
    rule = Rule(H.FLAG_EMAIL, lambda: regex_mismatch("url", H.EMAIL_PATTERN))
    return apply_rules(_t(spark, sf_dir, "pages").select("page_id", "url"), [rule]).select(
        "page_id", "url", _flags_text()
    )


def q_flag_regex_text(spark, sf_dir):
    """Q1 polarity flipped: whole documents that contain an e-mail-like token."""
    rule = Rule(FLAG_EMAIL_IN_TEXT, lambda: contains_email("text"))
    return apply_rules(_t(spark, sf_dir, "documents").select("doc_id", "text"), [rule]).select(
        "doc_id", _flags_text()
    )


def q_flag_date_bounds(spark, sf_dir):
    """Q2: a date must lie in [min, as_of)."""
    rule = Rule(H.FLAG_BIRTH_DATE, lambda: outside_dates("o_orderdate", ORDER_DATE_MIN, ORDER_DATE_AS_OF))
    return apply_rules(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [rule]).select(
        "o_orderkey", "o_orderdate", _flags_text()
    )


def q_flag_null_or_negative(spark, sf_dir):
    """Q7: negative or missing result (error events carry no value)."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("resultado"),
    )
    return apply_rules(ev, H.lab_rules()).select("event_id", "resultado", _flags_text())


def q_quality_summary(spark, sf_dir):
    """Q10."""
    return quality_summary(silver_appointments(spark, sf_dir), "citas")


def q_flag_audit(spark, sf_dir):
    """Q11."""
    return flag_audit(silver_appointments(spark, sf_dir))


def q_dirty_rows(spark, sf_dir):
    """F2."""
    return dirty_rows(silver_appointments(spark, sf_dir)).select(*APPT_KEY, _flags_text())


def q_clean_rows(spark, sf_dir):
    """F3."""
    return clean_rows(silver_appointments(spark, sf_dir)).select(*APPT_KEY, "tiempo_espera_minutos")


# --------------------------------------------------------------------- dedup
def q_dedup_key(spark, sf_dir):
    """One line item per (order, line number); lowest part, then supplier, then the rest."""
    return dedup_by_key(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINEITEM_TIEBREAK)


def q_dup_count(spark, sf_dir):
    """D2 + A11."""
    return duplicate_count(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dedup_text(spark, sf_dir):
    """D1 on whole texts: one document per distinct text, lowest doc_id."""
    return dedup_by_key(_t(spark, sf_dir, "documents"), ["text"], ["doc_id"])


# --------------------------------------------------------------------- star
def q_dim_paciente(spark, sf_dir):
    """P2."""
    return patient_dim(spark, sf_dir)


def q_dim_doctor(spark, sf_dir):
    """P1 + G2."""
    return doctor_dim(spark, sf_dir)


def q_age_years(spark, sf_dir):
    """G1: age at a fixed date, source approximation and exact."""
    o = _t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        age_years("o_orderdate", AS_OF).alias("edad"),
        age_years("o_orderdate", AS_OF, exact=True).alias("edad_exacta"),
    )


def q_calendar_dim(spark, sf_dir):
    """S10 S11 A2 G3 G4 U1."""
    return calendar_dim(_t(spark, sf_dir, "orders"), "o_orderdate")


def q_fact_build(spark, sf_dir):
    """G5 + Q9 + P3."""
    return fact(spark, sf_dir)


def q_orphans_customer(spark, sf_dir):
    """Facts whose patient is not in a filtered patient dimension."""
    dim = patient_dim(spark, sf_dir).filter(F.col("segmento") != EXCLUDED_SEGMENT)
    return orphans(fact(spark, sf_dir), dim, "id_paciente")


def q_orphan_report(spark, sf_dir):
    """One row per foreign key."""
    silver, cal = silver_and_calendar(spark, sf_dir)
    f = fact_build(silver, "fecha_hora", FACT_COLUMNS)
    keys = [
        ForeignKey("paciente", "id_paciente",
                   patient_dim(spark, sf_dir).filter(F.col("segmento") != EXCLUDED_SEGMENT), "id_paciente"),
        ForeignKey("doctor", "id_doctor", doctor_dim(spark, sf_dir), "id_doctor"),
        ForeignKey("tiempo", "id_tiempo", cal.df, "id_tiempo", known_rows=cal.known_rows),
    ]
    return orphan_report(f, keys)


def q_star_view(spark, sf_dir):
    """J3 + G7 + P7."""
    return star(spark, sf_dir)


# --------------------------------------------------------------------- marts
def q_kpis(spark, sf_dir):
    """M1 over all rows."""
    return kpis(star(spark, sf_dir, with_calendar=False))


def q_kpis_clean(spark, sf_dir):
    """M1 with the dashboard's filters: chosen specialties, clean rows only."""
    return kpis(select_rows(star(spark, sf_dir, with_calendar=False), "especialidad", SELECTED_SPECIALTIES,
                            clean_only=True))


def q_monthly(spark, sf_dir):
    """M2."""
    return monthly(star_with_dates(spark, sf_dir))


def q_by_status(spark, sf_dir):
    """M3."""
    return count_by(star(spark, sf_dir, with_calendar=False), "estado", "total")


def q_wait_by_specialty(spark, sf_dir):
    """M4."""
    return mean_by(star(spark, sf_dir, with_calendar=False), "especialidad", "tiempo_espera_minutos", 1)


def q_top_doctors(spark, sf_dir):
    """M5."""
    return top_k(star(spark, sf_dir, with_calendar=False), "nombre", TOP_K, "total_citas")


def q_top_doctors_id(spark, sf_dir):
    """A10 by name and id: two doctors of one name stay two."""
    return top_k(star(spark, sf_dir, with_calendar=False), ["nombre", "id_doctor"], TOP_K, "total_citas")


def q_specialty_domain(spark, sf_dir):
    """M6."""
    return domain(star(spark, sf_dir, with_calendar=False), "especialidad")


# -------------------------------------------------------------------- checks
def q_check_silver(spark, sf_dir):
    """V2 V3 V4 V5 on the Silver appointments.

    The raw appointments feed both Silver and the no-row-loss check; they are
    written once so the lineitem-orders join runs once, not twice.
    """
    raw, _ = materialize(appointments(spark, sf_dir), scratch_dir(spark, "appointments"))
    silver, _ = materialize(refine(raw, appointment_spec()), scratch_dir(spark, "silver-citas"))
    return V.run_checks([
        V.column_present(silver, FLAG_COL),
        V.silver_contract(raw, silver, APPT_KEY, "fecha_hora", H.FLAG_MISSING_DATE),
    ])


def q_check_gold(spark, sf_dir):
    """V6 V7 V8 V9 on the Gold tables."""
    silver, cal = silver_and_calendar(spark, sf_dir)
    f = fact_build(silver, "fecha_hora", FACT_COLUMNS)
    pat = patient_dim(spark, sf_dir)
    return V.run_checks([
        V.not_null(f, "id_tiempo"),
        V.single_unknown_member(cal.df),
        V.columns_absent(pat, ["c_acctbal"]),
        V.no_orphans_each(f, [
            ForeignKey("doctor", "id_doctor", doctor_dim(spark, sf_dir), "id_doctor"),
            ForeignKey("paciente", "id_paciente", pat, "id_paciente"),
            ForeignKey("tiempo", "id_tiempo", cal.df, "id_tiempo", known_rows=cal.known_rows),
        ]),
    ])


def q_orphans_lab(spark, sf_dir):
    """G6 between Silver tables: lab results (line items) whose appointment is not among the kept orders."""
    lab = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id_cita"))
    kept = _t(spark, sf_dir, "orders").filter(F.to_date("o_orderdate") >= F.lit(ORDER_DATE_MIN).cast("date"))
    return orphan_report(lab, [H.lab_foreign_key({"citas": kept.select(F.col("o_orderkey").alias("id_cita"))})])


# ------------------------------------------------- text -> Silver (Q12 and G1)
def patients_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the text a source would deliver: ids with a letter, ids
    written ``n.0``, dates that do not parse, addresses without an ``@``."""
    key, name, balance = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_acctbal")
    return _t(spark, sf_dir, "customer").select(
        F.when(balance < 0, F.concat(F.lit("A"), key))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(key, F.lit(".0")))
        .otherwise(key).alias("id_paciente"),
        name.alias("nombre"),
        F.when(F.col("c_nationkey") < 3, F.lit("sin dato"))
        .otherwise(F.concat(F.lit("19"), (F.col("c_nationkey") + 10).cast("string"), F.lit("-02-03")))
        .alias("fecha_nacimiento"),
        F.col("c_mktsegment").alias("genero"),
        F.col("c_nationkey").cast("string").alias("ciudad"),
        F.when(balance > ACCTBAL_MAX, name)
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit("@"), name, F.lit(".mx"))).alias("email"),
        F.lit("555").alias("telefono"),
        F.lit("2020-01-01").alias("fecha_registro"),
    )


def q_silver_pacientes(spark, sf_dir):
    """Text-typed patients through their registered spec; every raw id keeps its row."""
    silver = refine(patients_as_text(spark, sf_dir), H.table_specs(AS_OF)["pacientes"])
    return silver.select("nombre", "id_paciente", "fecha_nacimiento", _flags_text())


def _text(column: str) -> F.Column:
    return F.col(column).cast("string")


def q_silver_doctores(spark, sf_dir):
    """Suppliers as doctors in text, some ids and years of experience not numbers."""
    nation = F.col("s_nationkey")
    doctors = _t(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") < 0, F.concat(F.lit("D"), _text("s_suppkey"))).otherwise(_text("s_suppkey")).alias("id_doctor"),
        F.col("s_name").alias("nombre"),
        _text("s_nationkey").alias("especialidad"),
        F.when(nation < 3, F.lit("diez")).when(nation > 20, (nation * 3).cast("string")).otherwise(_text("s_nationkey")).alias("anios_experiencia"),
        F.lpad(_text("s_suppkey"), 8, "0").alias("cedula_profesional"),
    )
    return refine(doctors, H.table_specs(AS_OF)["doctores"]).select("nombre", "id_doctor", "anios_experiencia", "cedula_profesional", _flags_text())


def q_silver_citas(spark, sf_dir):
    """Q4-Q6 Q12: orders as appointments in text: dates missing or not dates, waits
    negative or not numbers, costs not numbers; several of them in one row."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    citas = _t(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("id_cita"),
        _text("o_custkey").alias("id_paciente"),
        F.lit("1").alias("id_doctor"),
        F.when(priority.startswith("1"), F.lit("pronto")).when(~priority.startswith("2"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("fecha_hora"),
        F.lit("30").alias("duracion_minutos"),
        F.when(status == "P", F.lit("-5")).when(price < 100_000, F.lit("poco")).otherwise(F.lit("7")).alias("tiempo_espera_minutos"),
        F.col("o_orderpriority").alias("motivo"),
        F.when(price > 400_000, F.concat(F.lit("$"), _text("o_totalprice"))).otherwise(_text("o_totalprice")).alias("costo"),
        F.col("o_orderstatus").alias("estado"),
    )
    return refine(citas, H.table_specs(AS_OF)["citas"]).select(
        "id_cita", "id_paciente", F.date_format("fecha_hora", "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"), "tiempo_espera_minutos", "costo", _flags_text()
    )


def q_silver_lab(spark, sf_dir):
    """Q7 Q12: events as lab results in text: results negative, missing or not numbers."""
    kind = F.col("event_type")
    lab = _t(spark, sf_dir, "events").select(
        _text("event_id").alias("id_resultado"),
        F.when(kind == "view", F.lit("sin cita")).otherwise(_text("user_id")).alias("id_cita"),
        kind.alias("tipo_examen"),
        F.when(kind == "error", F.lit("positivo")).when(kind == "click", F.concat(F.lit("-"), _text("value"))).when(kind != "signup", _text("value")).alias("resultado"),
        F.lit("").alias("valor_referencia"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha_resultado"),
    )
    return refine(lab, H.table_specs(AS_OF)["resultados_lab"]).select("id_resultado", "id_cita", "resultado", _flags_text())


def q_dim_paciente_edad(spark, sf_dir):
    """G1: the patient dimension with its age and without contact data."""
    silver = refine(patients_as_text(spark, sf_dir), H.table_specs(AS_OF)["pacientes"])
    aged = with_age(silver, "fecha_nacimiento", AS_OF)
    return project_dim(aged, ["id_paciente", "nombre", "edad", "genero", "ciudad"], forbidden=H.PATIENT_FORBIDDEN)


def q_flag_regex_email(spark, sf_dir):
    """Q1 with both outcomes: addresses with and without an ``@``."""
    rule = Rule(H.FLAG_EMAIL, lambda: regex_mismatch("email", H.EMAIL_PATTERN))
    return apply_rules(patients_as_text(spark, sf_dir).select("nombre", "email"), [rule]).select(
        "nombre", "email", _flags_text()
    )


# ------------------------------------------------------------------- sources
def q_csv_landing(spark, sf_dir):
    """Customers exported as CSV with a column that no schema declares,
    landed with the declared schema, read back: nothing is lost."""
    root = scratch_dir(spark, "csv-landing")
    customer = _t(spark, sf_dir, "customer")
    exported = customer.withColumn("turno", F.col("c_mktsegment"))
    exported.write.mode("overwrite").option("header", True).csv(f"{root}/source/customer")
    land_csv(spark, "customer", f"{root}/source/customer", f"{root}/bronze", AS_OF, schema=customer.schema)
    return read_latest(spark, f"{root}/bronze/customer")


def q_csv_headers(spark, sf_dir):
    """S1 without a schema: a folder of files with different headers (another
    order, a column more) and lines with a cell too many; read back whole."""
    root = scratch_dir(spark, "csv-headers")
    customer = _t(spark, sf_dir, "customer").select(_text("c_custkey").alias("id"), F.col("c_name").alias("nombre"), _text("c_nationkey").alias("pais"))
    plain = lambda df, name: df.write.option("header", True).csv(f"{root}/source/{name}")
    plain(customer, "a")
    plain(customer.select("pais", "nombre", F.col("id"), F.lit("si").alias("turno")), "b")
    lines = customer.select(F.concat_ws(",", "id", "nombre", F.lit("sobra")).alias("id,nombre"))
    lines.write.option("header", True).option("sep", "|").csv(f"{root}/source/c")  # three cells under two names
    land_csv(spark, "clientes", f"{root}/source/*", f"{root}/bronze", AS_OF)
    return read_latest(spark, f"{root}/bronze/clientes")


def q_landing_status(spark, sf_dir):
    """A source that is there, one that is missing, and the total."""
    root = scratch_dir(spark, "landing-status")
    customer = _t(spark, sf_dir, "customer")
    customer.write.option("header", True).csv(f"{root}/source/customer")
    landed = [
        land_csv(spark, name, f"{root}/source/{name}", f"{root}/bronze", AS_OF, schema=customer.schema)
        for name in ("customer", "ausente")
    ]
    return load_report(spark, landed).select("table_name", "rows", "status")


def q_check_lake(spark, sf_dir):
    """Existence of a written table and of one that is not there."""
    root = scratch_dir(spark, "check-lake")
    write_table(_t(spark, sf_dir, "customer"), f"{root}/customer")
    return V.run_checks([V.table_exists(spark, root, "customer", min_rows=1), V.table_exists(spark, root, "ausente")])


def q_latest_partition(spark, sf_dir):
    """Events landed with one load date per event day; newest read back."""
    root = scratch_dir(spark, "latest")
    land_by_date(_t(spark, sf_dir, "events"), f"{root}/bronze/events", "ts")
    return read_latest(spark, f"{root}/bronze/events")


def q_load_report(spark, sf_dir):
    """Rows per table and the total."""
    return table_counts({n: _t(spark, sf_dir, n) for n in ("customer", "orders", "events")})


def q_medallion_monthly(spark, sf_dir):
    """Appointments through Bronze, Silver and Gold files, then M2."""
    root = scratch_dir(spark, "layers")
    spec = appointment_spec()
    domain_cfg = Domain(
        specs={"citas": spec},
        build_gold=lambda s: {
            "fact_citas": fact_build(s["citas"], "fecha_hora", FACT_COLUMNS),
            "dim_tiempo": calendar_dim(s["citas"], "fecha_hora"),
            "dim_doctor": doctor_dim(spark, sf_dir),
            "dim_paciente": patient_dim(spark, sf_dir),
        },
        foreign_keys=lambda g: ("fact_citas", [
            ForeignKey("paciente", "id_paciente", g["dim_paciente"], "id_paciente"),
            ForeignKey("doctor", "id_doctor", g["dim_doctor"], "id_doctor"),
            ForeignKey("tiempo", "id_tiempo", g["dim_tiempo"], "id_tiempo"),
        ]),
    )
    statuses = run_layers(spark, root, domain_cfg, frames={"citas": appointments(spark, sf_dir)},
                          load_date=AS_OF, strict=True)
    failed = [s for s in statuses if not s.ok]
    if failed:
        raise RuntimeError(f"stage {failed[0].stage} failed: {failed[0].detail.get('error')}")
    g = {n: read_table(spark, f"{root}/gold/{n}") for n in ("fact_citas", "dim_tiempo", "dim_doctor", "dim_paciente")}
    s = star_view(g["fact_citas"], [
        DimRef(g["dim_doctor"], "id_doctor"),
        DimRef(g["dim_tiempo"], "id_tiempo"),
        DimRef(g["dim_paciente"], "id_paciente", rename={"nombre": "nombre_paciente"}),
    ])
    return monthly(s)


def q_layers_recovery(spark, sf_dir):
    """What readers see of Silver and Gold after a first load, after
    a second one that breaks off in Silver, after its repetition under the same run
    id, and after a third one that the foreign-key gate stops."""
    root = scratch_dir(spark, "recovery")
    customer, orders = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    clients = TableSpec("clientes", ("c_custkey",), (Rule(FLAG_ACCTBAL, lambda: outside_range("c_acctbal", ACCTBAL_MIN, ACCTBAL_MAX)),))
    broken = Rule("averia", lambda: F.raise_error(F.lit("averia")).cast("boolean"))

    def domain_of(*rules):
        return Domain(
            specs={"clientes": clients, "pedidos": TableSpec("pedidos", ("o_orderkey",), rules)},
            build_gold=lambda s: {
                "dim_cliente": project_dim(s["clientes"], ["c_custkey", "c_acctbal"]),
                "fact_pedidos": s["pedidos"].select("o_orderkey", "o_custkey", "o_totalprice"),
            },
            foreign_keys=lambda g: ("fact_pedidos", [ForeignKey("cliente", "o_custkey", g["dim_cliente"], "c_custkey")]),
        )

    richer = customer.withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    strangers = orders.withColumn("o_custkey", -1 - F.col("o_custkey"))
    day = lambda n: AS_OF + _dt.timedelta(days=n)
    runs = [
        ("1 first", domain_of(), {"clientes": customer, "pedidos": orders}, day(0), "r1"),
        ("2 broken", domain_of(broken), {"clientes": richer, "pedidos": orders}, day(1), "r2"),
        ("3 repeated", domain_of(), {"clientes": richer, "pedidos": orders}, day(1), "r2"),
        ("4 orphans", domain_of(), {"clientes": customer, "pedidos": strangers}, day(2), "r3"),
    ]
    seen = []
    for step, dom, frames, date, run in runs:
        statuses = run_layers(spark, root, dom, frames=frames, load_date=date, strict=True, on_orphan="fail", run=run)
        silver = read_table(spark, f"{root}/silver/clientes").agg(F.count("*").alias("n"), F.count_if(F.size(FLAG_COL) > 0).alias("f")).first()
        gold = read_table(spark, f"{root}/gold/dim_cliente").agg(F.count("*").alias("n"), money_sum("c_acctbal").alias("s")).first()
        known = read_table(spark, f"{root}/gold/fact_pedidos").agg(F.count_if(F.col("o_custkey") >= 0).alias("n")).first()
        told = ",".join(f"{s.stage}:{'ok' if s.ok else 'failed'}" for s in statuses)
        seen.append((step, told, silver["n"], silver["f"], gold["n"], gold["s"], known["n"]))
    schema = "step string, stages string, silver_rows bigint, silver_flagged bigint, gold_rows bigint, gold_sum double, gold_orders bigint"
    return spark.createDataFrame(seen, schema)


def q_stream_silver(spark, sf_dir):
    """Silver as a stream: events landed one load date per day, refined
    incrementally (Q7 rule, dedup per event and date), read back."""
    root = scratch_dir(spark, "stream")
    ev = _t(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("resultado"),
        "ts",
    )
    land_by_date(ev, f"{root}/bronze/events", "ts", keep_date_col=False)
    spec = TableSpec("events", ("event_id",), H.lab_rules(), order_by=("resultado",))
    query = refine_stream(
        spark, f"{root}/bronze/events", ev.drop("ts").schema, spec,
        f"{root}/silver/events", checkpoint=f"{root}/checkpoint/events",
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return read_table(spark, f"{root}/silver/events").select("event_id", "resultado", _flags_text())


QUERIES = {
    "flag_missing": q_flag_missing,
    "flag_and_clamp": q_flag_and_clamp,
    "flag_range": q_flag_range,
    "flag_regex": q_flag_regex,
    "flag_regex_text": q_flag_regex_text,
    "flag_date_bounds": q_flag_date_bounds,
    "flag_null_or_negative": q_flag_null_or_negative,
    "quality_summary": q_quality_summary,
    "flag_audit": q_flag_audit,
    "dirty_rows": q_dirty_rows,
    "clean_rows": q_clean_rows,
    "dedup_key": q_dedup_key,
    "dup_count": q_dup_count,
    "dedup_text": q_dedup_text,
    "dim_paciente": q_dim_paciente,
    "dim_doctor": q_dim_doctor,
    "age_years": q_age_years,
    "calendar_dim": q_calendar_dim,
    "fact_build": q_fact_build,
    "orphans_customer": q_orphans_customer,
    "orphan_report": q_orphan_report,
    "star_view": q_star_view,
    "kpis": q_kpis,
    "kpis_clean": q_kpis_clean,
    "monthly": q_monthly,
    "by_status": q_by_status,
    "wait_by_specialty": q_wait_by_specialty,
    "top_doctors": q_top_doctors,
    "specialty_domain": q_specialty_domain,
    "check_silver": q_check_silver,
    "check_gold": q_check_gold,
    "csv_landing": q_csv_landing,
    "latest_partition": q_latest_partition,
    "load_report": q_load_report,
    "medallion_monthly": q_medallion_monthly,
    "stream_silver": q_stream_silver,
    "flag_regex_email": q_flag_regex_email,
    "silver_pacientes": q_silver_pacientes,
    "dim_paciente_edad": q_dim_paciente_edad,
    "orphans_lab": q_orphans_lab,
    "top_doctors_id": q_top_doctors_id,
    "landing_status": q_landing_status,
    "check_lake": q_check_lake,
    "silver_doctores": q_silver_doctores,
    "silver_citas": q_silver_citas,
    "silver_lab": q_silver_lab,
    "csv_headers": q_csv_headers,
    "layers_recovery": q_layers_recovery,
}
