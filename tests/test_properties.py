"""Property checks: operators against plain-Python definitions on random rows."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flagstar.operators.dedup import dedup_by_key
from flagstar.operators.quality import FLAG_COL, apply_rules
from flagstar.plans import hospital as H

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

ts = st.one_of(st.none(), st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 1, 1)))
waits = st.one_of(st.none(), st.integers(min_value=-500, max_value=500))


@SETTINGS
@given(st.lists(st.tuples(ts, waits), min_size=1, max_size=40))
def test_appointment_rules_match_their_definition(spark, rows):
    df = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(rows)],
                               "k int, fecha_hora timestamp, tiempo_espera_minutos int")
    out = {r["k"]: (r["tiempo_espera_minutos"], list(r[FLAG_COL]))
           for r in apply_rules(df, H.appointment_rules(), H.appointment_repairs()).collect()}
    for i, (t, w) in enumerate(rows):
        flags = (["missing_fecha_hora"] if t is None else []) + (
            ["tiempo_espera_corregido"] if w is not None and w < 0 else [])
        repaired = None if w is None else max(w, 0)
        assert out[i] == (repaired, flags)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-100, max_value=100)), min_size=1, max_size=40))
def test_experience_rule_matches_its_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, anios_experiencia int")
    out = {r["k"]: list(r[FLAG_COL]) for r in apply_rules(df, H.doctor_rules()).collect()}
    for i, v in enumerate(values):
        assert out[i] == (["experiencia_fuera_de_rango"] if v is not None and (v < 0 or v > 60) else [])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 9)),
                min_size=1, max_size=60),
       st.integers(min_value=1, max_value=6))
def test_dedup_keeps_the_smallest_row_per_key(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(parts)
    got = sorted(tuple(r) for r in dedup_by_key(df, ["k"], ["a"]).collect())
    best: dict[int, tuple] = {}
    for k, a, b in rows:
        key = (a is not None, a if a is not None else 0, b)  # NULLs first, then a, then b
        if k not in best or key < best[k][0]:
            best[k] = (key, (k, a, b))
    assert got == sorted(v for _, v in best.values())
