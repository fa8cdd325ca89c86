"""Dimensions, calendar, unknown member, fact, star view."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flagstar.functions.dates import age_years
from flagstar.operators.quality import FLAG_COL
from flagstar.operators.star import (
    DimRef,
    calendar_dim,
    calendar_from_bounds,
    fact_build,
    project_dim,
    star_view,
)


def test_age_approximation_and_exact(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 2),), (None,)], "b date")
    out = df.select(
        age_years("b", "2024-01-02").alias("approx"), age_years("b", "2024-01-02", exact=True).alias("exact")
    ).collect()
    assert [tuple(r) for r in out] == [(33, 34), (None, None)]


def test_age_is_off_around_birthdays_like_the_source_model(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2001, 1, 1),)], "b date")
    one = df.filter(F.year("b") == 2000).select(age_years("b", "2001-01-01")).first()[0]
    zero = df.filter(F.year("b") == 2001).select(age_years("b", "2002-01-01")).first()[0]
    exact = df.filter(F.year("b") == 2001).select(age_years("b", "2002-01-01", exact=True)).first()[0]
    assert (one, zero, exact) == (1, 0, 1)


def test_calendar_fills_gaps_and_adds_unknown_member(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 8),), (dt.datetime(2024, 1, 11, 9),), (None,)], "fecha_hora timestamp"
    )
    cal = calendar_dim(df, "fecha_hora")
    rows = {r["id_tiempo"]: r for r in cal.collect()}
    assert len(rows) == 11 + 1
    assert rows[-1]["dia_semana"] == "Desconocido" and rows[-1]["fecha"] is None
    sat = rows[20240106]
    assert (sat["dia_semana"], sat["mes"], sat["trimestre"], sat["anio"], sat["es_fin_de_semana"]) == (
        "Saturday", 1, 1, 2024, True)
    assert rows[20240107]["es_fin_de_semana"] and not rows[20240108]["es_fin_de_semana"]
    assert dict(cal.dtypes) == {
        "id_tiempo": "int", "fecha": "date", "dia_semana": "string", "mes": "int",
        "trimestre": "int", "anio": "int", "es_fin_de_semana": "boolean",
    }


def test_calendar_single_day_and_no_dates(spark):
    one = spark.createDataFrame([(dt.datetime(2024, 3, 5),)] * 3, "fecha_hora timestamp")
    assert sorted(r["id_tiempo"] for r in calendar_dim(one, "fecha_hora").collect()) == [-1, 20240305]
    none = spark.createDataFrame([(None,)], "fecha_hora timestamp")
    assert [r["id_tiempo"] for r in calendar_dim(none, "fecha_hora").collect()] == [-1]
    assert calendar_from_bounds(spark, dt.date(2000, 1, 1), dt.date(2099, 12, 31)).count() == 36525 + 1


def test_fact_points_missing_dates_at_unknown_member(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 6, 10), ["x"]), (2, None, []), (3, dt.datetime(2023, 12, 31, 23, 59), [])],
        f"id int, fecha_hora timestamp, {FLAG_COL} array<string>",
    )
    f = fact_build(df, "fecha_hora", ["id", "id_tiempo", "tiene_flag_calidad"])
    assert f.columns == ["id", "id_tiempo", "tiene_flag_calidad"]
    assert sorted(tuple(r) for r in f.collect()) == [(1, 20240106, True), (2, -1, False), (3, 20231231, False)]


def test_project_dim_refuses_forbidden_columns(spark):
    df = spark.createDataFrame([(1, "n", "e@x.y")], "id int, nombre string, email string")
    assert project_dim(df, ["id", "nombre"], forbidden=["email"]).columns == ["id", "nombre"]
    with pytest.raises(ValueError):
        project_dim(df, ["id", "email"], forbidden=["email", "telefono"])


def test_star_view_renames_collisions_and_drops_orphans(spark):
    fact = spark.createDataFrame([(1, 10, 100), (2, 11, 100), (3, 99, 100)], "id int, id_doctor int, id_paciente int")
    doc = spark.createDataFrame([(10, "Dr A"), (11, "Dr B")], "id_doctor int, nombre string")
    pat = spark.createDataFrame([(100, "Ana")], "id_paciente int, nombre string")
    with pytest.raises(ValueError):
        star_view(fact, [DimRef(doc, "id_doctor"), DimRef(pat, "id_paciente")])
    s = star_view(fact, [DimRef(doc, "id_doctor"), DimRef(pat, "id_paciente", rename={"nombre": "nombre_paciente"})])
    assert sorted(tuple(r) for r in s.select("id", "nombre", "nombre_paciente").collect()) == [
        (1, "Dr A", "Ana"), (2, "Dr B", "Ana")]


def test_star_view_broadcasts_only_under_the_row_cap(spark):
    from helpers import plan_text

    fact = spark.range(2000).selectExpr("id", "id % 500 AS k")
    dim = spark.range(500).selectExpr("id AS k", "id * 2 AS v")
    small = plan_text(star_view(fact, [DimRef(dim, "k", broadcast_max_rows=1000)]))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan_text(star_view(fact, [DimRef(dim, "k", broadcast_max_rows=100)]))
        assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_star_view_shuffles_the_fact_before_broadcast_attributes_widen_it(spark):
    from helpers import plan_text

    fact = spark.createDataFrame([(1, 10, 100), (2, 11, 101), (3, 99, 100), (4, 10, 999), (5, None, 100)],
                                 "id int, id_doctor int, id_paciente int")
    doc = spark.createDataFrame([(10, "Dr A"), (11, "Dr B"), (11, "Dr C")], "id_doctor int, nombre string")
    pat = spark.createDataFrame([(100, "Ana"), (101, None)], "id_paciente int, paciente string")
    dims = [DimRef(doc, "id_doctor", known_rows=3), DimRef(pat, "id_paciente")]
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        s = star_view(fact, dims)
        simple = plan_text(s, "simple")
        assert simple.index("BroadcastHashJoin") < simple.index("SortMergeJoin")  # the outer join is printed first
        assert s.columns == ["id_paciente", "id_doctor", "id", "nombre", "paciente"]
        assert sorted(map(tuple, s.collect()), key=repr) == [
            (100, 10, 1, "Dr A", "Ana"), (101, 11, 2, "Dr B", None), (101, 11, 2, "Dr C", None)]
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def test_star_view_joins_an_attribute_of_an_earlier_dimension(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11)], "id int, id_doctor int")
    doc = spark.createDataFrame([(10, 7), (11, 8)], "id_doctor int, id_area int")
    area = spark.createDataFrame([(7, "Norte")], "clave int, area string")
    s = star_view(fact, [DimRef(doc, "id_doctor", known_rows=2), DimRef(area, "clave", fact_key="id_area")])
    assert s.columns == ["id_doctor", "id", "id_area", "area"]
    assert [tuple(r) for r in s.collect()] == [(10, 1, 7, "Norte")]


def test_star_query_writes_no_silver_and_shuffles_no_fact_by_doctor(spark, tmp_path, monkeypatch):
    from helpers import plan_text

    from flagstar.plans import driver_tables as D

    day = lambda d: dt.datetime(2024, 1, d, 10)
    tables = {
        "lineitem": ([(1, 5, 10, 1, 2.0, 9.0, "A", day(6)), (1, 5, 10, 1, 2.0, 9.0, "A", day(9)), (1, 6, 11, 7, 1.0, 8.0, "R", day(30)),
                      (2, 5, 77, 1, 1.0, 8.0, "R", day(20)), (None, 5, 10, 1, 1.0, 8.0, "R", day(31)), (1, 7, 11, 2, 1.0, 8.0, "N", None)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                     " l_returnflag string, l_shipdate timestamp"),
        "orders": ([(1, 100, day(2)), (2, 100, day(3))], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "customer": ([(100, "Ana", 3, "BUILDING", 1.0)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "supplier": ([(10, "Dr A", 1), (11, "Dr B", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(1, "N1")], "n_nationkey int, n_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(D, "materialize", lambda *a, **k: pytest.fail("Silver written for one reader"))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        s = D.q_star_view(spark, str(tmp_path))
        plan = plan_text(s, "simple")
        assert "hashpartitioning(id_paciente" in plan and "hashpartitioning(id_doctor" not in plan
        got = s.select("l_linenumber", "nombre", "id_tiempo", "fecha", "dia_semana", "nombre_paciente", "tiene_flag_calidad")
        assert sorted(map(tuple, got.collect())) == [
            (1, "Dr A", 20240106, dt.date(2024, 1, 6), "Saturday", "Ana", False),
            (2, "Dr B", -1, None, "Desconocido", "Ana", True),
            (7, "Dr B", -1, None, "Desconocido", "Ana", True)]
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
