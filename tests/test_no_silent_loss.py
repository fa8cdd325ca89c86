"""Rows, text and published tables that must survive bad input."""

from __future__ import annotations

from flagstar.sources.landing import land_csv, read_latest

import pytest
from pyspark.sql import functions as F

from flagstar.functions.numeric import money_sum
from flagstar.operators import checks as V
from flagstar.operators.dedup import dedup_by_key
from flagstar.operators.quality import FLAG_COL, TableSpec, refine
from flagstar.sources.layers import write_table
from flagstar.streaming.silver_stream import touched_dates

SPEC = TableSpec("t", ("id",), types={"id": "bigint", "cost": "double"})


def test_unparsed_keys_stay_apart(spark):
    df = spark.createDataFrame([("A1", "1"), ("A2", "x"), ("A2", "x"), ("3.0", "2"), (None, "1"), (None, "1")], "id string, cost string")
    got = sorted(((r.id, r.cost, tuple(r[FLAG_COL])) for r in refine(df, SPEC).collect()), key=str)
    bad_id, bad_cost = "valor_no_interpretable_id", "valor_no_interpretable_cost"
    assert got == sorted([(None, 1.0, (bad_id,)), (None, None, (bad_id, bad_cost)), (3, 2.0, ()), (None, 1.0, ())], key=str)


def test_whole_numbers_with_decimals_are_ids(spark):
    df = spark.range(1000).select(F.concat("id", F.lit(".0")).alias("id"), F.lit("1").alias("cost"))
    assert refine(df, SPEC).select("id").distinct().count() == 1000


def test_loss_check_sees_a_dropped_row(spark):
    before = spark.createDataFrame([("A1",), ("A2",), ("3",)], "id string")
    assert V.run_checks([V.no_row_loss(before, before.limit(2), ["id"])]).first()["passed"] is False


def test_money_keeps_fractions_and_large_values(spark):
    df = spark.createDataFrame([(10.005,)] * 3, "x double")
    assert df.agg(money_sum("x").alias("s")).first()["s"] == 30.015
    assert spark.createDataFrame([(1e17,), (1e35,)], "x double").agg(money_sum("x").alias("s")).first()["s"] == pytest.approx(1e35)


def test_window_dedup_does_not_depend_on_order(spark):
    rows = [(1, 5, c) for c in "badc"]
    got = {
        dedup_by_key(spark.createDataFrame(rows[k:] + rows[:k], "k int, o int, v string").repartition(n), ["k"], [F.col("o").asc()]).first()["v"]
        for k in range(4)
        for n in (1, 3)
    }
    assert got == {"a"}


def test_dedup_with_maps_inside_arrays(spark):
    df = spark.createDataFrame([(1, [{"a": 1}], 2), (1, [{"a": 1}], 1)], "k int, m array<map<string,int>>, o int")
    assert [r.o for r in dedup_by_key(df, ["k"], ["k", "o"]).collect()] == [1]


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_table(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception, match="boom"):
        write_table(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    assert write_table(spark.read.parquet(path).where("id > 0"), path) == 2
    assert spark.read.parquet(path).count() == 2


def test_undated_rows_are_touched(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-01-02")], "id int, d string")
    assert [r.id for r in df.filter(touched_dates(df.where("id < 3").select("d"), "d")).collect()] == [1, 2]


def test_landing_keeps_undeclared_columns_and_ragged_lines(spark, tmp_path):
    src = tmp_path / "t.csv"
    src.write_text("id,n,turno\n1,a,noche\n2,b,dia,sobra\n3\n")
    result = land_csv(spark, "t", str(src), str(tmp_path / "bronze"), "2024-01-01", schema=spark.createDataFrame([], "id string, n string").schema)
    rows = {r["id"]: r for r in read_latest(spark, str(tmp_path / "bronze" / "t")).collect()}
    assert result.rows == 3 and set(rows) == {"1", "2", "3"}
    assert (rows["1"]["turno"], rows["1"]["_corrupt_record"]) == ("noche", None)
    assert rows["2"]["_corrupt_record"] == "2,b,dia,sobra" and rows["3"]["_corrupt_record"] == "3"


def test_newest_landing_without_files_is_passed_over(spark, tmp_path):
    root = tmp_path / "bronze" / "t"
    spark.range(2).write.parquet(str(root / "load_date=2024-01-01"))
    (root / "load_date=2024-01-02").mkdir()
    assert read_latest(spark, str(root)).count() == 2
