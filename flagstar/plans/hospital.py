"""The hospital domain: four source tables, their quality rules and the star.

This is one configuration of the generic operators; nothing in
``flagstar.operators`` knows these names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flagstar.functions.rules import (
    clamp_below,
    is_missing,
    negative,
    outside_dates,
    outside_range,
    regex_mismatch,
)
from flagstar.operators import checks as V
from flagstar.operators.integrity import ForeignKey
from flagstar.operators.marts import count_by, kpis, mean_by, monthly, select_rows, top_k
from flagstar.operators.marts import domain as domain_of
from flagstar.operators.quality import FLAG_COL, Repair, Rule, TableSpec, parsed
from flagstar.operators.star import DimRef, calendar_dim, fact_build, project_dim, star_view, with_age
from flagstar.plans.medallion import Domain
from flagstar.sources.landing import read_latest, tables_ready
from flagstar.sources.layers import read_table

# ---------------------------------------------------------------------------
# Fixed values that must equal the source model's for identical results:
# flag names, the e-mail pattern, the date and range bounds.
FLAG_EMAIL = "email_invalido"
FLAG_BIRTH_DATE = "fecha_nacimiento_invalida"
FLAG_EXPERIENCE = "experiencia_fuera_de_rango"
FLAG_MISSING_DATE = "missing_fecha_hora"
FLAG_WAIT_FIXED = "tiempo_espera_corregido"
FLAG_LAB_RESULT = "resultado_fuera_de_rango"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MIN_BIRTH_DATE = "1900-01-01"
EXPERIENCE_MIN, EXPERIENCE_MAX = 0, 60
PATIENT_FORBIDDEN = ("email", "telefono")
# ---------------------------------------------------------------------------

# Bronze keeps every value as text: no inference pass over the files, and
# codes such as cedula_profesional keep their leading zeros. Silver types the
# columns with try_cast (see ``SILVER_TYPES``), so a bad cell becomes NULL and
# is flagged instead of failing the job.
BRONZE_SCHEMAS: dict[str, StructType] = {
    "pacientes": StructType(
        [StructField(c, StringType()) for c in (
            "id_paciente", "nombre", "fecha_nacimiento", "genero", "ciudad",
            "email", "telefono", "fecha_registro",
        )]
    ),
    "doctores": StructType(
        [StructField(c, StringType()) for c in (
            "id_doctor", "nombre", "especialidad", "anios_experiencia", "cedula_profesional",
        )]
    ),
    "citas": StructType(
        [StructField(c, StringType()) for c in (
            "id_cita", "id_paciente", "id_doctor", "fecha_hora", "duracion_minutos",
            "tiempo_espera_minutos", "motivo", "costo", "estado",
        )]
    ),
    "resultados_lab": StructType(
        [StructField(c, StringType()) for c in (
            "id_resultado", "id_cita", "tipo_examen", "resultado", "valor_referencia", "fecha_resultado",
        )]
    ),
}

# Identifiers are 64-bit: at scale they pass 2^31, and an id that does not fit
# would become NULL and collapse with every other NULL key in deduplication.
SILVER_TYPES: dict[str, dict[str, str]] = {
    "pacientes": {"id_paciente": "bigint", "fecha_nacimiento": "date", "fecha_registro": "date"},
    "doctores": {"id_doctor": "bigint", "anios_experiencia": "int"},
    "citas": {
        "id_cita": "bigint", "id_paciente": "bigint", "id_doctor": "bigint", "fecha_hora": "timestamp",
        "duracion_minutos": "int", "tiempo_espera_minutos": "int", "costo": "double",
    },
    "resultados_lab": {
        "id_resultado": "bigint", "id_cita": "bigint", "resultado": "double", "fecha_resultado": "timestamp",
    },
}


def patient_rules(as_of) -> tuple[Rule, ...]:
    """Q1 e-mail format, Q2 birth date in [1900-01-01, as_of)."""
    return (
        Rule(FLAG_EMAIL, lambda: regex_mismatch("email", EMAIL_PATTERN)),
        Rule(FLAG_BIRTH_DATE, lambda: outside_dates("fecha_nacimiento", MIN_BIRTH_DATE, as_of)),
    )


def doctor_rules() -> tuple[Rule, ...]:
    """Q3 years of experience in [0, 60]."""
    return (Rule(FLAG_EXPERIENCE, lambda: outside_range("anios_experiencia", EXPERIENCE_MIN, EXPERIENCE_MAX)),)


def appointment_rules(ts_col: str = "fecha_hora", wait_col: str = "tiempo_espera_minutos") -> tuple[Rule, ...]:
    """Q4 missing date, Q5 negative wait (judged on the value as it arrived)."""
    return (
        Rule(FLAG_MISSING_DATE, lambda: is_missing(ts_col)),
        Rule(FLAG_WAIT_FIXED, lambda: negative(wait_col)),
    )


def appointment_repairs(wait_col: str = "tiempo_espera_minutos") -> tuple[Repair, ...]:
    """Q6 negative wait becomes 0; NULL stays NULL."""
    return (Repair(wait_col, lambda: clamp_below(wait_col, 0)),)


def lab_rules() -> tuple[Rule, ...]:
    """Q7 result negative or missing (0 is valid)."""
    return (Rule(FLAG_LAB_RESULT, lambda: negative("resultado", null_is_bad=True)),)


def table_specs(as_of) -> dict[str, TableSpec]:
    """Q12: the rule registry, one spec per source table."""
    return {
        "pacientes": TableSpec("pacientes", ("id_paciente",), patient_rules(as_of), types=SILVER_TYPES["pacientes"]),
        "doctores": TableSpec("doctores", ("id_doctor",), doctor_rules(), types=SILVER_TYPES["doctores"]),
        "citas": TableSpec(
            "citas", ("id_cita",), appointment_rules(), appointment_repairs(), types=SILVER_TYPES["citas"]
        ),
        "resultados_lab": TableSpec(
            "resultados_lab", ("id_resultado",), lab_rules(), types=SILVER_TYPES["resultados_lab"]
        ),
    }


FACT_COLUMNS = (
    "id_cita", "id_paciente", "id_doctor", "id_tiempo", "duracion_minutos",
    "tiempo_espera_minutos", "costo", "estado", "tiene_flag_calidad",
)


def build_gold(silver: Mapping[str, DataFrame], as_of, exact_age: bool = False) -> dict[str, DataFrame]:
    """The four Gold tables from the Silver tables."""
    pacientes = with_age(silver["pacientes"], "fecha_nacimiento", as_of, exact=exact_age)
    dim_paciente = project_dim(
        pacientes, ["id_paciente", "nombre", "edad", "genero", "ciudad"], forbidden=PATIENT_FORBIDDEN
    )
    dim_doctor = project_dim(silver["doctores"], ["id_doctor", "nombre", "especialidad", "anios_experiencia"])
    citas = silver["citas"]
    return {
        "dim_paciente": dim_paciente,
        "dim_doctor": dim_doctor,
        "dim_tiempo": calendar_dim(citas, "fecha_hora"),
        "fact_citas": fact_build(citas, "fecha_hora", FACT_COLUMNS),
    }


def foreign_keys(gold: Mapping[str, DataFrame]) -> tuple[str, list[ForeignKey]]:
    """The fact's three foreign keys."""
    keys = [
        ForeignKey("paciente", "id_paciente", gold["dim_paciente"], "id_paciente"),
        ForeignKey("doctor", "id_doctor", gold["dim_doctor"], "id_doctor"),
        ForeignKey("tiempo", "id_tiempo", gold["dim_tiempo"], "id_tiempo"),
    ]
    return "fact_citas", keys


def foreign_keys_of(gold: Mapping[str, DataFrame]) -> tuple[DataFrame, list[ForeignKey]]:
    """The fact and its three keys, for checks."""
    fact, keys = foreign_keys(gold)
    return gold[fact], keys


def lab_foreign_key(silver: Mapping[str, DataFrame]) -> ForeignKey:
    """Lab results must point at an existing appointment (documented rule)."""
    return ForeignKey("cita", "id_cita", silver["citas"], "id_cita")


def domain(as_of, exact_age: bool = False):
    """The hospital model as a :class:`~flagstar.plans.medallion.Domain` for ``run_layers``."""
    return Domain(
        specs=table_specs(as_of),
        build_gold=lambda silver: build_gold(silver, as_of, exact_age),
        foreign_keys=foreign_keys,
        bronze_schemas=BRONZE_SCHEMAS,
        silver_foreign_keys=lambda silver: [("resultados_lab", lab_foreign_key(silver))],
    )


GOLD_TABLES = ("dim_paciente", "dim_doctor", "dim_tiempo", "fact_citas")


def star_from_gold(spark, gold_root: str) -> DataFrame:
    """The fact joined to its three dimensions, read from Gold files.

    The doctor's name stays ``nombre``; the patient's becomes ``nombre_paciente``.
    Dimensions read from files are broadcast only under the row cap.
    """
    g = {t: read_table(spark, f"{gold_root}/{t}") for t in GOLD_TABLES}
    return star_view(
        g["fact_citas"],
        [
            DimRef(g["dim_doctor"], "id_doctor"),
            DimRef(g["dim_tiempo"], "id_tiempo"),
            DimRef(g["dim_paciente"], "id_paciente", rename={"nombre": "nombre_paciente"}),
        ],
    )


def dashboard_marts(
    spark,
    gold_root: str,
    specialties=None,
    clean_only: bool = False,
    top: int = 10,
) -> dict[str, DataFrame]:
    """M1-M6 over the Gold star, with the dashboard's two filters.

    ``specialties=None`` selects every non-NULL specialty (the default
    selection is the whole choice list); ``clean_only`` drops flagged rows.
    Each mart re-reads the star from Gold files (a scan plus broadcast joins),
    which is cheaper than pinning a fact-sized cache no caller could release.
    """
    star = star_from_gold(spark, gold_root)
    chosen = select_rows(star, "especialidad", specialties, clean_only=clean_only)
    return {
        "especialidades": domain_of(star, "especialidad"),
        "kpis": kpis(chosen),
        "citas_por_mes": monthly(chosen),
        "citas_por_estado": count_by(chosen, "estado", "total"),
        "espera_por_especialidad": mean_by(chosen, "especialidad", "tiempo_espera_minutos", 1),
        "top_doctores": top_k(chosen, "nombre", top, "total_citas"),
    }


SILVER_KEYS = {"pacientes": "id_paciente", "doctores": "id_doctor", "citas": "id_cita", "resultados_lab": "id_resultado"}


def contract_checks(spark, root: str) -> DataFrame:
    """The data contract of a written lake (V1-V9), one row per check.

    Silver: every table exists, has a unique key and the flag column, every
    appointment without a date carries its flag, and no appointment was lost
    between the newest Bronze partition and Silver. Gold: every table exists,
    the fact's date key is never NULL, the unknown date exists exactly once,
    no patient contact data is exposed, and no fact row is an orphan.
    Missing tables are reported as failed existence checks; checks that need
    them are skipped, but for the loss check: without Bronze it has failed.
    """
    silver_root, gold_root = f"{root}/silver", f"{root}/gold"
    rows = []
    have_silver = tables_ready(spark, silver_root, list(SILVER_KEYS))
    for t in SILVER_KEYS:
        rows.append(V.table_exists(spark, silver_root, t, f"silver_exists:{t}"))
    if have_silver:
        silver = {t: read_table(spark, f"{silver_root}/{t}") for t in SILVER_KEYS}
        try:
            bronze = read_latest(spark, f"{root}/bronze/citas")
        except FileNotFoundError:
            bronze = None
        for t, key in SILVER_KEYS.items():
            if t != "citas" or bronze is None:
                rows.append(V.pk_unique(silver[t], [key], f"pk_unique:{t}"))
            rows.append(V.column_present(silver[t], FLAG_COL, f"flag_column:{t}"))
        if bronze is None:  # whether rows were lost can't be told: not passed
            rows.append(V.null_date_flagged(silver["citas"], "fecha_hora", FLAG_MISSING_DATE))
            rows.append(V.failed(spark, "no_row_loss"))
        else:
            # the raw id where it does not parse, so such rows count one by one
            id_type = SILVER_TYPES["citas"]["id_cita"]
            number = parsed("id_cita", id_type)
            raw = F.when(number.isNull(), F.col("id_cita").cast("string"))
            landed = bronze.select(number.alias("id_cita"), raw.alias("raw_id"))
            kept = silver["citas"].select("id_cita", F.lit(None).cast("string").alias("raw_id"), "fecha_hora", FLAG_COL)
            found = V.silver_contract(landed, kept, ["id_cita", "raw_id"], "fecha_hora", FLAG_MISSING_DATE)
            name = F.when(F.col("check_name") == "pk_unique", F.lit("pk_unique:citas")).otherwise(F.col("check_name"))
            rows.append(found.withColumn("check_name", name))
    have_gold = tables_ready(spark, gold_root, list(GOLD_TABLES))
    for t in GOLD_TABLES:
        rows.append(V.table_exists(spark, gold_root, t, f"gold_exists:{t}"))
    if have_gold:
        g = {t: read_table(spark, f"{gold_root}/{t}") for t in GOLD_TABLES}
        rows.append(V.not_null(g["fact_citas"], "id_tiempo"))
        rows.append(V.single_unknown_member(g["dim_tiempo"]))
        rows.append(V.columns_absent(g["dim_paciente"], PATIENT_FORBIDDEN, "no_personal_data:dim_paciente"))
        rows.append(V.no_orphans_each(*foreign_keys_of(g)))
    return V.run_checks(rows)
