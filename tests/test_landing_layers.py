"""S1-S12 landing and R1 layered run on literal CSV fixtures."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flagstar.operators.quality import FLAG_COL
from flagstar.plans import hospital as H
from flagstar.plans.medallion import run_layers
from flagstar.sources.landing import land_csv, load_report, read_latest, table_counts, tables_ready
from flagstar.sources.layers import read_table

AS_OF = dt.date(2024, 1, 2)

DOCTORES = """id_doctor,nombre,especialidad,anios_experiencia,cedula_profesional
1,Dr. Uno,Cardiologia,10,01234567
2,Dr. Dos,Pediatria,61,12345678
2,Dr. Dos bis,Pediatria,5,12345678
3,Dr. Tres,Cardiologia,-1,00000001
"""
PACIENTES = """id_paciente,nombre,fecha_nacimiento,genero,ciudad,email,telefono,fecha_registro
1,Ana,1990-01-02,F,Villahermosa,ana@x.mx,555,2020-01-01
2,Beto,1899-12-31,M,Centro,bad,556,2021-05-05
3,Caro,,F,Centro,,557,2022-02-02
"""
CITAS = """id_cita,id_paciente,id_doctor,fecha_hora,duracion_minutos,tiempo_espera_minutos,motivo,costo,estado
1,1,1,2024-01-06 10:00:00,30,-5,Control,250.50,completada
2,2,2,,20,10,Dolor,300.00,cancelada
3,3,3,not a date,15,0,Fiebre,abc,no_asistio
4,9,1,2024-01-01 09:00:00,45,,Chequeo,1000.25,completada
4,9,1,2024-01-01 09:00:00,45,,Chequeo,1000.25,completada
"""
RESULTADOS = """id_resultado,id_cita,tipo_examen,resultado,valor_referencia,fecha_resultado
1,1,Glucosa,0,Normal,2024-01-06 10:00:00
2,1,Colesterol,-0.1,Fuera de rango,2024-01-06 10:00:00
3,4,Hemoglobina,abc,Normal,
4,99,Glucosa,5,Normal,
"""


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_landing_keeps_leading_zeros_and_reruns_idempotently(spark, tmp_path):
    src = _write(tmp_path / "src" / "doctores.csv", DOCTORES)
    bronze = str(tmp_path / "bronze")
    schema = H.BRONZE_SCHEMAS["doctores"]
    r1 = land_csv(spark, "doctores", src, bronze, "2024-01-01", schema=schema)
    r2 = land_csv(spark, "doctores", src, bronze, "2024-01-02", schema=schema)
    r3 = land_csv(spark, "doctores", src, bronze, "2024-01-02", schema=schema)
    assert (r1.rows, r1.status, r2.rows, r3.rows) == (4, "OK", 4, 4)
    whole = spark.read.parquet(f"{bronze}/doctores")
    dates = {str(r["load_date"]): r["n"] for r in whole.groupBy("load_date").agg(F.count("*").alias("n")).collect()}
    assert dates == {"2024-01-01": 4, "2024-01-02": 4}
    latest = read_latest(spark, f"{bronze}/doctores")
    assert "load_date" not in latest.columns
    assert latest.count() == 4
    assert sorted(r["cedula_profesional"] for r in latest.collect())[0] == "00000001"


def test_missing_source_and_missing_partitions(spark, tmp_path):
    r = land_csv(spark, "citas", str(tmp_path / "nope.csv"), str(tmp_path / "bronze"), AS_OF)
    assert (r.rows, r.status) == (0, "MISSING")
    with pytest.raises(FileNotFoundError):
        read_latest(spark, str(tmp_path / "bronze" / "citas"))
    rep = load_report(spark, [r]).first()
    assert (rep["table_name"], rep["status"]) == ("citas", "MISSING")


def test_tables_ready_and_counts(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "gold" / "a"))
    assert tables_ready(spark, str(tmp_path / "gold"), ["a"])
    assert not tables_ready(spark, str(tmp_path / "gold"), ["a", "b"])
    counts = {r["table_name"]: (r["rows"], r["status"]) for r in table_counts(
        {"x": spark.range(2), "y": spark.range(0)}).collect()}
    assert counts == {"x": (2, "OK"), "y": (0, "FAILED"), "TOTAL": (2, "OK")}


def _sources(tmp_path):
    return {
        "pacientes": _write(tmp_path / "src" / "pacientes.csv", PACIENTES),
        "doctores": _write(tmp_path / "src" / "doctores.csv", DOCTORES),
        "citas": _write(tmp_path / "src" / "citas.csv", CITAS),
        "resultados_lab": _write(tmp_path / "src" / "resultados_lab.csv", RESULTADOS),
    }


def test_hospital_layers_end_to_end(spark, tmp_path):
    root = str(tmp_path / "lake")
    statuses = run_layers(spark, root, H.domain(AS_OF), sources=_sources(tmp_path), load_date=AS_OF)
    assert [(s.stage, s.ok) for s in statuses] == [("bronze", True), ("silver", True), ("gold", True)], statuses

    silver = {t: read_table(spark, f"{root}/silver/{t}") for t in ("pacientes", "doctores", "citas", "resultados_lab")}
    doc = {r["id_doctor"]: list(r[FLAG_COL]) for r in silver["doctores"].collect()}
    assert doc == {1: [], 2: ["experiencia_fuera_de_rango"], 3: ["experiencia_fuera_de_rango"]}
    pac = {r["id_paciente"]: list(r[FLAG_COL]) for r in silver["pacientes"].collect()}
    assert pac == {1: [], 2: ["email_invalido", "fecha_nacimiento_invalida"], 3: []}
    citas = {r["id_cita"]: (r["tiempo_espera_minutos"], r["costo"], list(r[FLAG_COL])) for r in silver["citas"].collect()}
    assert citas == {
        1: (0, 250.5, ["tiempo_espera_corregido"]),
        2: (10, 300.0, ["missing_fecha_hora"]),
        3: (0, None, ["missing_fecha_hora", "valor_no_interpretable_costo"]),
        4: (None, 1000.25, []),
    }
    lab = {r["id_resultado"]: list(r[FLAG_COL]) for r in silver["resultados_lab"].collect()}
    assert lab == {1: [], 2: ["resultado_fuera_de_rango"], 3: ["resultado_fuera_de_rango"], 4: []}

    gold = {t: read_table(spark, f"{root}/gold/{t}") for t in ("dim_paciente", "dim_doctor", "dim_tiempo", "fact_citas")}
    assert not {"email", "telefono"} & set(gold["dim_paciente"].columns)
    assert {r["id_paciente"]: r["edad"] for r in gold["dim_paciente"].collect()} == {1: 33, 2: 124, 3: None}
    fact = {r["id_cita"]: (r["id_tiempo"], r["tiene_flag_calidad"]) for r in gold["fact_citas"].collect()}
    assert fact == {1: (20240106, True), 2: (-1, True), 3: (-1, True), 4: (20240101, False)}
    assert gold["dim_tiempo"].count() == 6 + 1
    orphans = {o["fk_name"]: o["orphan_rows"] for o in statuses[2].detail["orphans"]}
    assert orphans == {"paciente": 1, "cita": 1}  # lab result 4 points at a missing appointment


def test_strict_run_stops_on_missing_source(spark, tmp_path):
    srcs = _sources(tmp_path)
    srcs["citas"] = str(tmp_path / "src" / "missing.csv")
    statuses = run_layers(spark, str(tmp_path / "lake"), H.domain(AS_OF), sources=srcs, load_date=AS_OF, strict=True)
    assert [(s.stage, s.ok) for s in statuses] == [("bronze", False)]
    assert "MISSING" in statuses[0].detail["error"]


def test_orphans_can_fail_the_gold_stage(spark, tmp_path):
    statuses = run_layers(spark, str(tmp_path / "lake"), H.domain(AS_OF), sources=_sources(tmp_path),
                          load_date=AS_OF, on_orphan="fail")
    assert [(s.stage, s.ok) for s in statuses] == [("bronze", True), ("silver", True), ("gold", False)]


def test_silver_stage_reports_flag_share(spark, tmp_path):
    statuses = run_layers(spark, str(tmp_path / "lake"), H.domain(AS_OF), sources=_sources(tmp_path), load_date=AS_OF)
    silver = statuses[1].detail
    assert silver["citas"] == {"rows": 4, "duplicates_removed": 1, "flagged": 3, "pct_flagged": 75.0}
    assert silver["doctores"]["rows"] == 3 and silver["doctores"]["flagged"] == 2
    assert silver["doctores"]["duplicates_removed"] == 1


def test_dashboard_marts_on_gold(spark, tmp_path):
    root = str(tmp_path / "lake")
    run_layers(spark, root, H.domain(AS_OF), sources=_sources(tmp_path), load_date=AS_OF)
    m = H.dashboard_marts(spark, f"{root}/gold")
    # appointment 4 points at a missing patient: the inner star drops it
    k = m["kpis"].first()
    assert (k["total_citas"], k["ingresos_totales"]) == (3, 550.5)
    assert k["pct_con_flag"] == 100.0
    assert [tuple(r) for r in m["citas_por_mes"].collect()] == [(2024, 1, 1, "2024-01")]
    assert [r[0] for r in m["especialidades"].collect()] == ["Cardiologia", "Pediatria"]
    clean = H.dashboard_marts(spark, f"{root}/gold", specialties=["Cardiologia"], clean_only=True)
    assert clean["kpis"].first()["total_citas"] == 0
    top = [tuple(r) for r in m["top_doctores"].collect()]
    assert top == [("Dr. Dos", 1), ("Dr. Tres", 1), ("Dr. Uno", 1)]


def test_empty_newest_landing_is_the_latest_partition(spark, tmp_path):
    root = str(tmp_path / "bronze" / "t")
    from flagstar.sources.landing import write_partition

    assert write_partition(spark.createDataFrame([(1,), (2,)], "k int"), root, "2024-01-01") == 2
    assert write_partition(spark.createDataFrame([], "k int"), root, "2024-01-02") == 0
    latest = read_latest(spark, root)
    assert latest.columns == ["k"] and latest.count() == 0
    assert write_partition(spark.createDataFrame([(7,)], "k int"), root, "2024-01-03") == 1
    assert [r["k"] for r in read_latest(spark, root).collect()] == [7]


def test_layers_with_an_empty_source_table(spark, tmp_path):
    srcs = _sources(tmp_path)
    srcs["resultados_lab"] = _write(tmp_path / "src" / "empty_lab.csv", RESULTADOS.splitlines()[0] + "\n")
    statuses = run_layers(spark, str(tmp_path / "lake"), H.domain(AS_OF), sources=srcs, load_date=AS_OF)
    assert [(s.stage, s.ok) for s in statuses] == [("bronze", True), ("silver", True), ("gold", True)]
    assert statuses[0].detail["resultados_lab"] == {"rows": 0, "status": "EMPTY"}
    assert statuses[1].detail["resultados_lab"]["rows"] == 0


def test_contract_checks_on_a_written_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    run_layers(spark, root, H.domain(AS_OF), sources=_sources(tmp_path), load_date=AS_OF)
    got = {r["check_name"]: (r["violations"], r["passed"]) for r in H.contract_checks(spark, root).collect()}
    assert all(passed for name, (_, passed) in got.items() if name != "no_orphans:id_paciente"), got
    assert got["no_orphans:id_paciente"] == (1, False)  # appointment 4 points at a missing patient
    assert got["no_row_loss"] == (0, True)  # the exact duplicate of appointment 4 is the only row removed
    assert len(got) == 4 + 8 + 2 + 4 + 3 + 3


def test_contract_checks_without_bronze_fail_the_loss_check(spark, tmp_path):
    for t, key in H.SILVER_KEYS.items():
        row = f"1L AS {key}, timestamp'2024-01-02' AS fecha_hora, array() AS {H.FLAG_COL}"
        spark.sql(f"SELECT {row}").withColumn(H.FLAG_COL, F.col(H.FLAG_COL).cast("array<string>")).write.parquet(f"{tmp_path}/silver/{t}")
    got = {r["check_name"]: r["passed"] for r in H.contract_checks(spark, str(tmp_path)).collect()}
    assert not got["no_row_loss"] and got["pk_unique:citas"]


def test_contract_checks_report_missing_tables(spark, tmp_path):
    got = {r["check_name"]: r["passed"] for r in H.contract_checks(spark, str(tmp_path / "nothing")).collect()}
    assert got and not any(got.values())


def test_malformed_csv_lines_are_kept_not_dropped(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from flagstar.sources.landing import read_csv

    src = _write(tmp_path / "src" / "t.csv", "id,n\n1,7\n2,not a number\n3\n")
    schema = StructType([StructField("id", IntegerType()), StructField("n", IntegerType())])
    df = read_csv(spark, src, schema=schema, keep_corrupt=True).cache()
    got = {r["id"]: (r["n"], r["_corrupt_record"]) for r in df.collect()}
    assert got[1] == (7, None)
    assert got[2][0] is None and got[2][1] == "2,not a number"
    assert got[3][0] is None and got[3][1] == "3"
    assert df.count() == 3


def test_command_line_runs_layers_checks_and_marts(spark, tmp_path, capsys):
    import json as _json

    from flagstar.__main__ import main

    src = tmp_path / "src"
    _sources(tmp_path)
    root = str(tmp_path / "lake")
    assert main(["layers", "--source-dir", str(src), "--root", root, "--as-of", "2024-01-02"]) == 0
    stages = [_json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")]
    assert [s["stage"] for s in stages] == ["bronze", "silver", "gold"] and all(s["ok"] for s in stages)
    assert main(["checks", "--root", root]) == 1  # appointment 4 points at a missing patient
    checks = [_json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")]
    assert [c["check_name"] for c in checks if not c["passed"]] == ["no_orphans:id_paciente"]
    assert main(["marts", "--root", root, "--rows", "5"]) == 0
    assert "== kpis" in capsys.readouterr().out
    assert main(["marts", "--root", str(tmp_path / "no-lake")]) == 2


def test_inferred_schema_loses_leading_zeros_declared_text_keeps_them(spark, tmp_path):
    src = _write(tmp_path / "src" / "doctores.csv", DOCTORES)
    bronze = str(tmp_path / "bronze")
    land_csv(spark, "inferred", src, bronze, "2024-01-01", infer_schema=True)
    land_csv(spark, "declared", src, bronze, "2024-01-01", schema=H.BRONZE_SCHEMAS["doctores"])
    inferred = {r["cedula_profesional"] for r in read_latest(spark, f"{bronze}/inferred").collect()}
    declared = {r["cedula_profesional"] for r in read_latest(spark, f"{bronze}/declared").collect()}
    assert 1234567 in inferred and "01234567" in declared


def test_csv_columns_are_matched_by_header_name(spark, tmp_path):
    from flagstar.sources.landing import read_csv

    schema = H.BRONZE_SCHEMAS["doctores"]
    swapped = _write(tmp_path / "src" / "swapped.csv",
                     "cedula_profesional,id_doctor,especialidad,nombre,anios_experiencia,extra\n"
                     "01234567,1,Cardiologia,Dr. Uno,10,zzz\n")
    row = read_csv(spark, swapped, schema=schema).first()
    assert row.asDict() == {"id_doctor": "1", "nombre": "Dr. Uno", "especialidad": "Cardiologia",
                            "anios_experiencia": "10", "cedula_profesional": "01234567"}
    short = _write(tmp_path / "src" / "short.csv", "id_doctor,nombre\n1,Dr. Uno\n")
    with pytest.raises(ValueError):
        read_csv(spark, short, schema=schema)


def test_large_identifiers_survive_typing(spark, tmp_path):
    big = 2**40
    src = _write(tmp_path / "src" / "citas.csv",
                 "id_cita,id_paciente,id_doctor,fecha_hora,duracion_minutos,tiempo_espera_minutos,motivo,costo,estado\n"
                 f"{big + 1},1,1,2024-01-06 10:00:00,30,5,a,1.0,completada\n"
                 f"{big + 2},1,1,2024-01-06 11:00:00,30,5,b,1.0,completada\n")
    from flagstar.operators.quality import refine
    from flagstar.sources.landing import read_csv

    silver = refine(read_csv(spark, src, schema=H.BRONZE_SCHEMAS["citas"]), H.table_specs(AS_OF)["citas"])
    assert sorted(r["id_cita"] for r in silver.collect()) == [big + 1, big + 2]
