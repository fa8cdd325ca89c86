"""Incremental Silver over Bronze landings (Structured Streaming)."""

from __future__ import annotations

import os

from flagstar.operators.quality import FLAG_COL, TableSpec
from flagstar.plans import hospital as H
from flagstar.sources.landing import write_partition
from flagstar.streaming import refine_stream


def _run(spark, bronze, silver, ckpt, schema, spec):
    q = refine_stream(spark, bronze, schema, spec, silver, checkpoint=ckpt)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_refines_only_new_landings(spark, tmp_path):
    bronze, silver, ckpt = (str(tmp_path / p) for p in ("bronze/lab", "silver/lab", "ckpt"))
    schema_ddl = "id_resultado int, resultado double"
    spec = TableSpec("lab", ("id_resultado",), H.lab_rules(), order_by=("resultado",))

    day1 = spark.createDataFrame([(1, 5.0), (2, -1.0), (2, 3.0)], schema_ddl)
    write_partition(day1, bronze, "2024-01-01")
    _run(spark, bronze, silver, ckpt, day1.schema, spec)
    first = {(str(r["load_date"]), r["id_resultado"]): list(r[FLAG_COL]) for r in spark.read.parquet(silver).collect()}
    # duplicate id 2 resolved deterministically: lowest resultado survives
    assert first == {("2024-01-01", 1): [], ("2024-01-01", 2): ["resultado_fuera_de_rango"]}
    day1_files = sorted(os.listdir(f"{silver}/load_date=2024-01-01"))

    day2 = spark.createDataFrame([(1, None), (3, 0.0)], schema_ddl)
    write_partition(day2, bronze, "2024-01-02")
    _run(spark, bronze, silver, ckpt, day1.schema, spec)
    both = {(str(r["load_date"]), r["id_resultado"]): list(r[FLAG_COL]) for r in spark.read.parquet(silver).collect()}
    assert both == {
        ("2024-01-01", 1): [],
        ("2024-01-01", 2): ["resultado_fuera_de_rango"],
        ("2024-01-02", 1): ["resultado_fuera_de_rango"],
        ("2024-01-02", 3): [],
    }
    assert sorted(os.listdir(f"{silver}/load_date=2024-01-01")) == day1_files  # earlier date not rewritten


def test_date_split_across_micro_batches_is_written_whole(spark, tmp_path):
    bronze, silver, ckpt = (str(tmp_path / p) for p in ("bronze/lab", "silver/lab", "ckpt"))
    spec = TableSpec("lab", ("id_resultado",), H.lab_rules(), order_by=("resultado",))
    part = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id_resultado int, resultado double")
    write_partition(part, bronze, "2024-01-01")
    _run(spark, bronze, silver, ckpt, part.schema, spec)
    # a late file for the same date (e.g. listed after the first batch ran)
    late = spark.createDataFrame([(3, -1.0), (1, 4.0)], "id_resultado int, resultado double")
    late.write.mode("append").parquet(f"{bronze}/load_date=2024-01-01")
    _run(spark, bronze, silver, ckpt, part.schema, spec)
    got = {r["id_resultado"]: (r["resultado"], list(r[FLAG_COL])) for r in spark.read.parquet(silver).collect()}
    assert got == {1: (4.0, []), 2: (6.0, []), 3: (-1.0, ["resultado_fuera_de_rango"])}
