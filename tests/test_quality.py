"""Quality rules Q1-Q12 with the boundary rows of FIXTURES.md."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flagstar.operators.quality import (
    FLAG_COL,
    Repair,
    Rule,
    TableSpec,
    apply_rules,
    clean_rows,
    dirty_rows,
    flag_audit,
    quality_summary,
    refine,
    typed,
)
from flagstar.plans import hospital as H

AS_OF = dt.date(2024, 1, 2)


def _flags(df, key="k"):
    return {r[key]: list(r[FLAG_COL]) for r in df.select(key, FLAG_COL).collect()}


def test_email_rule_boundaries(spark):
    df = spark.createDataFrame(
        [(1, "a@b.c"), (2, "bad"), (3, "a@b."), (4, "a@@b.c"), (5, ""), (6, None)], "k int, email string"
    )
    got = _flags(apply_rules(df, H.patient_rules(AS_OF)[:1]))
    assert got == {1: [], 2: ["email_invalido"], 3: ["email_invalido"], 4: ["email_invalido"],
                   5: ["email_invalido"], 6: []}


def test_birth_date_rule_boundaries(spark):
    df = spark.createDataFrame(
        [(1, dt.date(1899, 12, 31)), (2, dt.date(1900, 1, 1)), (3, AS_OF), (4, AS_OF - dt.timedelta(days=1)),
         (5, None)],
        "k int, fecha_nacimiento date",
    )
    got = _flags(apply_rules(df, H.patient_rules(AS_OF)[1:]))
    flag = "fecha_nacimiento_invalida"
    assert got == {1: [flag], 2: [], 3: [flag], 4: [], 5: []}


def test_experience_rule_boundaries(spark):
    df = spark.createDataFrame([(1, -1), (2, 0), (3, 60), (4, 61), (5, None)], "k int, anios_experiencia int")
    got = _flags(apply_rules(df, H.doctor_rules()))
    flag = "experiencia_fuera_de_rango"
    assert got == {1: [flag], 2: [], 3: [], 4: [flag], 5: []}


def test_wait_flag_uses_value_before_repair_and_keeps_rule_order(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 6, 10), -5), (2, dt.datetime(2024, 1, 6), 0), (3, dt.datetime(2024, 1, 6), None),
         (4, None, -5)],
        "k int, fecha_hora timestamp, tiempo_espera_minutos int",
    )
    out = apply_rules(df, H.appointment_rules(), H.appointment_repairs())
    got = {r["k"]: (r["tiempo_espera_minutos"], list(r[FLAG_COL])) for r in out.collect()}
    assert got == {
        1: (0, ["tiempo_espera_corregido"]),
        2: (0, []),
        3: (None, []),
        4: (0, ["missing_fecha_hora", "tiempo_espera_corregido"]),
    }
    assert dict(out.dtypes)["tiempo_espera_minutos"] == "int"


def test_lab_rule_zero_is_valid_null_is_bad(spark):
    df = spark.createDataFrame([(1, -0.1), (2, 0.0), (3, None), (4, 5.0)], "k int, resultado double")
    flag = "resultado_fuera_de_rango"
    assert _flags(apply_rules(df, H.lab_rules())) == {1: [flag], 2: [], 3: [flag], 4: []}


def test_unparseable_text_becomes_null_and_is_flagged(spark):
    df = spark.createDataFrame(
        [("1", "abc", "not a date"), ("2", "1.5", "2024-01-06 10:00:00")], "k string, resultado string, fecha_hora string"
    )
    t = typed(df, {"k": "int", "resultado": "double", "fecha_hora": "timestamp"})
    out = apply_rules(t, [*H.lab_rules(), H.appointment_rules()[0]])
    got = _flags(out)
    assert got[1] == ["resultado_fuera_de_rango", "missing_fecha_hora"]
    assert got[2] == []


def test_empty_rule_set_gives_empty_array_and_duplicate_flag_names_merge(spark):
    df = spark.createDataFrame([(1, 5), (2, -5)], "k int, v int")
    assert _flags(apply_rules(df, [])) == {1: [], 2: []}
    rules = [Rule("bad", F.col("v") < 0), Rule("bad", "v > 100")]
    assert _flags(apply_rules(df, rules)) == {1: [], 2: ["bad"]}


def test_repair_on_unknown_column_is_rejected(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        apply_rules(df, [], [Repair("nope", F.lit(0))])


def test_summary_audit_and_row_filters(spark):
    df = spark.createDataFrame(
        [(1, None, -1), (2, dt.datetime(2024, 1, 1), 3), (3, None, 2), (4, dt.datetime(2024, 1, 2), 1)],
        "k int, fecha_hora timestamp, tiempo_espera_minutos int",
    )
    silver = apply_rules(df, H.appointment_rules(), H.appointment_repairs())
    s = quality_summary(silver, "citas").first()
    assert (s["table_name"], s["total_rows"], s["flagged_rows"], s["pct_flagged"]) == ("citas", 4, 2, 50.0)
    audit = {r["flag"]: r["rows"] for r in flag_audit(silver).collect()}
    assert audit == {"missing_fecha_hora": 2, "tiempo_espera_corregido": 1}
    assert sorted(r["k"] for r in dirty_rows(silver).collect()) == [1, 3]
    assert sorted(r["k"] for r in clean_rows(silver).collect()) == [2, 4]


def test_summary_of_empty_table_is_zero_percent(spark):
    df = spark.createDataFrame([], f"k int, {FLAG_COL} array<string>")
    s = quality_summary(df, "t").first()
    assert (s["total_rows"], s["flagged_rows"], s["pct_flagged"]) == (0, 0, 0.0)


def test_refine_types_dedups_and_flags(spark):
    spec = TableSpec("citas", ("id",), H.appointment_rules(), H.appointment_repairs(),
                     order_by=("fecha_hora",), types={"id": "int", "fecha_hora": "timestamp",
                                                      "tiempo_espera_minutos": "int"})
    df = spark.createDataFrame(
        [("1", "2024-01-02 00:00:00", "-3"), ("1", "2024-01-01 00:00:00", "4"), ("2", "garbage", "1")],
        "id string, fecha_hora string, tiempo_espera_minutos string",
    ).repartition(3)
    out = {r["id"]: (r["tiempo_espera_minutos"], list(r[FLAG_COL])) for r in refine(df, spec).collect()}
    assert out == {1: (4, []), 2: (1, ["missing_fecha_hora"])}
