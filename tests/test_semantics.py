"""Remaining rows of the fidelity table and one-pass metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flagstar.operators.quality import FLAG_COL, apply_rules
from flagstar.operators.star import DimRef, calendar_dim, star_view
from flagstar.plans import hospital as H
from flagstar.session import scratch_dir
from flagstar.sources.layers import materialize


def test_null_keys_never_join(spark):
    """#13: NULL foreign keys do not meet NULL dimension keys (SQL semantics)."""
    fact = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    dim = spark.createDataFrame([(None, "x"), (5, "y")], "k int, v string")
    assert [tuple(r) for r in star_view(fact, [DimRef(dim, "k")]).select("id", "v").collect()] == [(2, "y")]


def test_missing_result_date_is_not_flagged(spark):
    """#18: only the result value is checked, not its date."""
    df = spark.createDataFrame([(1, 5.0, None)], "k int, resultado double, fecha_resultado timestamp")
    assert apply_rules(df, H.lab_rules()).first()[FLAG_COL] == []


def test_unknown_member_label_is_configurable(spark):
    """#19."""
    df = spark.createDataFrame([(None,)], "fecha_hora timestamp")
    row = calendar_dim(df, "fecha_hora", unknown_label="Fecha Desconocida").first()
    assert (row["id_tiempo"], row["dia_semana"]) == (-1, "Fecha Desconocida")


def test_rules_do_not_depend_on_run_day(spark):
    """#10: with a fixed as_of the same birth date gets the same flag on any day."""
    df = spark.createDataFrame([(dt.date(2030, 1, 1),)], "fecha_nacimiento date")
    past = apply_rules(df, H.patient_rules(dt.date(2031, 1, 1))[1:]).first()[FLAG_COL]
    future = apply_rules(df, H.patient_rules(dt.date(2029, 1, 1))[1:]).first()[FLAG_COL]
    assert (past, future) == ([], ["fecha_nacimiento_invalida"])


def test_observed_metrics_equal_the_written_table(spark):
    """One-pass metrics: counts observed on a write that follows a shuffle and a
    filter equal recounts of the written files."""
    src = spark.range(50_000).select(
        (F.col("id") % 997).alias("k"), F.col("id").alias("v"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.current_timestamp()).alias("fecha_hora"),
    )
    agg = src.groupBy("k").agg(F.max("v").alias("v"), F.max("fecha_hora").alias("fecha_hora")).filter("k % 2 = 0")
    written, m = materialize(
        agg, scratch_dir(spark, "obs-test"),
        {"missing": F.count_if(F.col("fecha_hora").isNull()), "lo": F.min("k"), "hi": F.max("k")},
    )
    assert m["rows"] == written.count() == 499
    assert m["missing"] == written.filter(F.col("fecha_hora").isNull()).count()
    assert (m["lo"], m["hi"]) == (0, 996)
