"""J1/J2/G6 orphans and M1-M6 marts."""

from __future__ import annotations

import datetime as dt

import pytest

from flagstar.operators.integrity import ForeignKey, OrphanError, enforce, orphan_count, orphan_report, orphans
from flagstar.operators.marts import count_by, domain, kpis, mean_by, monthly, select_rows, top_k
from helpers import plan_text


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "id int, fk int")
    dim = spark.createDataFrame([(10,)], "pk int")
    assert sorted(r["id"] for r in orphans(fact, dim, "fk", "pk").collect()) == [2, 3]
    assert orphan_count(fact, dim, "fk", "pk").first()["orphan_rows"] == 2


def test_orphan_report_and_enforce(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, 5)], "id int, a int, b int")
    da = spark.createDataFrame([(10,)], "a int")
    db = spark.createDataFrame([(5,)], "b int")
    rep = orphan_report(fact, [ForeignKey("A", "a", da, "a"), ForeignKey("B", "b", db, "b")])
    got = {r["fk_name"]: (r["orphan_rows"], r["passed"]) for r in rep.collect()}
    assert got == {"A": (1, False), "B": (0, True)}
    assert [r["fk_name"] for r in enforce(rep, "warn")] == ["A"]
    with pytest.raises(OrphanError):
        enforce(rep, "fail")


def _star(spark):
    return spark.createDataFrame(
        [
            (20240105, 2024, 1, "completada", "Cardio", "Dr A", 10, 100.10, False),
            (20240106, 2024, 1, "cancelada", "Cardio", "Dr B", 20, 200.20, True),
            (20240210, 2024, 2, "completada", "Neuro", "Dr B", 5, 0.30, False),
            (-1, None, None, None, None, "Dr C", None, 1.00, True),
        ],
        "id_tiempo int, anio int, mes int, estado string, especialidad string, nombre string, "
        "tiempo_espera_minutos int, costo double, tiene_flag_calidad boolean",
    )


def test_kpis(spark):
    k = kpis(_star(spark)).first()
    assert k["total_citas"] == 4
    assert k["tiempo_espera_prom"] == pytest.approx(35 / 3)
    assert k["ingresos_totales"] == 301.6
    assert k["pct_con_flag"] == 50.0


def test_kpis_on_empty_selection(spark):
    k = kpis(select_rows(_star(spark), "especialidad", ["none"])).first()
    assert (k["total_citas"], k["tiempo_espera_prom"], k["ingresos_totales"], k["pct_con_flag"]) == (0, None, 0.0, 0.0)


def test_filters_exclude_null_category_and_flagged_rows(spark):
    s = select_rows(_star(spark), "especialidad", None, clean_only=True)
    assert sorted(r["id_tiempo"] for r in s.collect()) == [20240105, 20240210]


def test_monthly_excludes_unknown_and_pads_month(spark):
    assert [tuple(r) for r in monthly(_star(spark)).collect()] == [(2024, 1, 2, "2024-01"), (2024, 2, 1, "2024-02")]


def test_count_by_drops_null_sorted_desc(spark):
    assert [tuple(r) for r in count_by(_star(spark), "estado").collect()] == [("completada", 2), ("cancelada", 1)]


def test_mean_by_rounds_half_even(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.5), ("b", 2.35), ("b", 2.35)], "g string, v double")
    assert [tuple(r) for r in mean_by(df, "g", "v", 1).collect()] == [("a", 2.2), ("b", 2.4)]


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(n,) for n in ["d", "c", "c", "b", "a", "a", None, None, None]], "nombre string")
    assert [tuple(r) for r in top_k(df, "nombre", 2).collect()] == [("a", 2), ("c", 2)]


def test_domain_sorted_distinct_not_null(spark):
    assert [r[0] for r in domain(_star(spark), "especialidad").collect()] == ["Cardio", "Neuro"]


def test_orphan_report_keeps_key_types(spark):
    rows_of = lambda cols, *r: spark.createDataFrame(list(r), cols)
    fact = rows_of("a long, b string, c date, d int, e long", (1, "x", dt.date(2024, 1, 1), 0, 0), (2, "0", None, 7, None), (0, None, dt.date(1970, 1, 1), 7, 9))
    dims = {"a": rows_of("a long", (1,), (0,)), "b": rows_of("b string", ("x",)), "c": rows_of("c date", (dt.date(2024, 1, 1),)), "d": rows_of("d string", ("7",), ("no",)), "e": rows_of("e int", (0,), (None,))}
    rep = orphan_report(fact, [ForeignKey(k.upper(), k, d, k) for k, d in dims.items()])
    assert {r["fk_name"]: r["orphan_rows"] for r in rep.collect()} == {"A": 1, "B": 2, "C": 2, "D": 1, "E": 2}
    plain = orphan_report(fact, [ForeignKey("A", "a", dims["a"], "a"), ForeignKey("B", "b", dims["b"], "b")])
    assert "as string" not in plan_text(plain, "simple")
