"""Layers change as a whole or not at all; runs resume; readers keep one version."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flagstar.functions.numeric import money_sum
from flagstar.operators import checks as V
from flagstar.operators.integrity import ForeignKey
from flagstar.operators.quality import FLAG_COL, Rule, TableSpec, refine, rule_columns
from flagstar.plans.medallion import Domain, run_layers
from flagstar.sources import files, versions
from flagstar.sources.landing import csv_files, land_csv, read_csv, read_latest, tables_ready, write_partition
from flagstar.sources.layers import read_table, table_rows
from helpers import plan_text, rows

BOOM = lambda kind: F.expr(f"CAST(raise_error('boom') AS {kind})")


def _domain(*rules):
    return Domain(
        specs={"a": TableSpec("a", ("id",)), "b": TableSpec("b", ("id",), rules)},
        build_gold=lambda s: {"dim": s["a"].select("id", "v"), "fact": s["b"].select("id", F.col("id").alias("a_id"))},
        foreign_keys=lambda g: ("fact", [ForeignKey("a", "a_id", g["dim"], "id")]),
    )


def _frames(spark, n, v):
    df = spark.range(n).select("id", F.lit(v).alias("v"))
    return {"a": df, "b": df}


def _seen(spark, root):
    return [tuple(read_table(spark, f"{root}/{t}").agg(F.count("*"), F.max("v") if t != "gold/fact" else F.lit(0)).first()) for t in ("silver/a", "silver/b", "gold/dim", "gold/fact")]


def test_failed_silver_keeps_both_tables_and_a_repetition_resumes(spark, tmp_path):
    root = str(tmp_path)
    assert all(s.ok for s in run_layers(spark, root, _domain(), frames=_frames(spark, 100, 1), load_date="2024-01-01"))
    first = _seen(spark, root)
    broken = _domain(Rule("x", lambda: BOOM("boolean")))
    statuses = run_layers(spark, root, broken, frames=_frames(spark, 60, 2), load_date="2024-01-02", run="day2")
    assert [(s.stage, s.ok) for s in statuses] == [("bronze", True), ("silver", False)]
    assert _seen(spark, root) == first == [(100, 1), (100, 1), (100, 1), (100, 0)]
    commits = files.names(spark, f"{root}/bronze/a/load_date=2024-01-02")
    statuses = run_layers(spark, root, _domain(), frames=_frames(spark, 60, 2), load_date="2024-01-02", run="day2")
    assert all(s.ok for s in statuses) and _seen(spark, root) == [(60, 2), (60, 2), (60, 2), (60, 0)]
    assert files.names(spark, f"{root}/bronze/a/load_date=2024-01-02") == commits  # not landed again
    statuses = run_layers(spark, root, broken, frames=_frames(spark, 60, 2), load_date="2024-01-02", run="day2")
    assert all(s.ok for s in statuses) and statuses[1].detail["resumed"] and statuses[2].detail["resumed"]


def test_gate_failure_keeps_gold(spark, tmp_path):
    root = str(tmp_path)
    run_layers(spark, root, _domain(), frames=_frames(spark, 10, 1), load_date="2024-01-01")
    orphans = {"a": spark.range(5).select("id", F.lit(3).alias("v")), "b": spark.range(50).select("id", F.lit(3).alias("v"))}
    statuses = run_layers(spark, root, _domain(), frames=orphans, load_date="2024-01-02", on_orphan="fail")
    assert [s.ok for s in statuses] == [True, True, False]
    assert _seen(spark, root) == [(5, 3), (50, 3), (10, 1), (10, 0)]


def test_a_reader_keeps_its_version_and_old_data_goes(spark, tmp_path):
    root = f"{tmp_path}/layer"
    put = lambda n, *names: versions.publish(spark, root, {t: versions.stage(spark.range(n), root, t) for t in names})
    put(1, "x", "y")
    held = versions.snapshot(spark, root)
    put(2, "x")
    assert (held.read(spark, "x").count(), held.read(spark, "y").count()) == (1, 1)
    now = versions.snapshot(spark, root)
    assert (now.number, now.read(spark, "x").count(), now.read(spark, "y").count()) == (2, 2, 1)
    put(3, "x")
    put(4, "x")
    assert len(files.names(spark, f"{root}/_data")) == 3  # y, and x of the last two versions
    assert read_table(spark, f"{root}/x").count() == 4 and read_table(spark, f"{root}/y").count() == 1


def test_a_crash_before_publishing_changes_nothing(spark, tmp_path):
    root = f"{tmp_path}/layer"
    versions.publish(spark, root, {"x": versions.stage(spark.range(1), root, "x"), "y": versions.stage(spark.range(1), root, "y")})
    versions.stage(spark.range(9), root, "x")  # the driver is lost before y
    assert read_table(spark, f"{root}/x").count() == 1
    with pytest.raises(FileExistsError):
        files.write_json(spark, f"{root}/_manifest/00000001.json", {})


def test_failed_landing_keeps_the_days_earlier_one(spark, tmp_path):
    root = str(tmp_path / "t")
    assert write_partition(spark.range(100).toDF("k"), root, "2024-01-01") == 100
    with pytest.raises(Exception, match="boom"):
        write_partition(spark.range(5).select(BOOM("long").alias("k")), root, "2024-01-01")
    assert read_latest(spark, root).count() == 100
    with pytest.raises(Exception, match="boom"):
        write_partition(spark.range(5).select(BOOM("long").alias("k")), root, "2024-01-02")
    assert read_latest(spark, root).count() == 100  # the newest committed date
    assert write_partition(spark.range(7).toDF("k"), root, "2024-01-01") == 7
    assert read_latest(spark, root).count() == 7 and spark.read.parquet(root).count() == 7


def test_torn_missing_and_empty_tables_are_not_ready(spark, tmp_path):
    root = f"{tmp_path}/layer"
    staged = {t: versions.stage(spark.range(n), root, t) for t, n in (("full", 10), ("torn", 10), ("short", 10), ("empty", 0))}
    snap = versions.publish(spark, root, staged)
    part = lambda t: sorted((tmp_path / "layer" / "_data" / snap.tables[t]["folder"]).glob("*.parquet"))
    part("torn")[0].write_bytes(part("torn")[0].read_bytes()[:-20])
    (tmp_path / "layer" / "_data" / snap.tables["torn"]["folder"] / f".{part('torn')[0].name}.crc").unlink()
    part("short")[-1].rename(tmp_path / "elsewhere")
    assert table_rows(spark, f"{root}/full") == 10 and table_rows(spark, f"{root}/empty") == 0
    assert [tables_ready(spark, root, [t], min_rows=1) for t in ("full", "torn", "short", "empty", "none")] == [True, False, False, False, False]


# ------------------------------------------------------------------------ CSV


def test_csv_files_meet_by_name_and_lose_no_cell(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "1.csv").write_text("a,b\n3,4,5\n1,2\n")
    (src / "2.csv").write_text("b,a,c\n20,10,x\n")
    (src / "3.csv").write_text('"a","a",\n7,8,9\n6\n')
    (src / "4.csv").write_text("")
    (src / "_hidden.csv").write_text("z\n1\n")
    land_csv(spark, "t", str(src), str(tmp_path / "bronze"), "2024-01-01")
    df = read_latest(spark, str(tmp_path / "bronze" / "t"))
    assert df.columns == ["a", "b", "c", "a_1", "_c2", "_corrupt_record"]
    assert rows(df) == sorted([
        ("3", "4", None, None, None, "3,4,5"), ("1", "2", None, None, None, None), ("10", "20", "x", None, None, None),
        ("7", None, None, "8", "9", None), ("6", None, None, None, None, "6"),
    ], key=repr)
    assert [h for h, _ in csv_files(spark, f"{src}/[12].csv")] == [("a", "b"), ("b", "a", "c")]


def test_csv_inference_and_declared_types_across_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("id,n\n1,5\n")
    (tmp_path / "2.csv").write_text("n,id\nx,2\n")
    df = read_csv(spark, str(tmp_path), infer_schema=True)
    assert dict(df.dtypes) == {"id": "int", "n": "string"} and rows(df) == [(1, "5"), (2, "x")]
    schema = spark.createDataFrame([], "n int, id int").schema
    assert rows(read_csv(spark, str(tmp_path), schema=schema, keep_corrupt=True)) == sorted([(5, 1, None), (None, 2, "x,2")], key=repr)
    (tmp_path / "3.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="3.csv"):
        read_csv(spark, str(tmp_path), schema=schema)


# ---------------------------------------------------------------------- flags


def test_flags_stand_for_their_own_column(spark):
    spec = TableSpec("t", ("id",), (Rule("mail", lambda: ~F.col("mail").contains("@")), Rule("late", lambda: F.col("d") > "2020-01-01"), Rule("no_date", lambda: F.col("e").isNull())), types={"id": "bigint", "d": "date", "e": "date"})
    df = spark.createDataFrame([("1", "bad", "not a date", "2019-01-01"), ("2", "a@b", "not a date", "x"), ("3", "bad", "2021-01-01", None)], "id string, mail string, d string, e string")
    got = {r["id"]: r[FLAG_COL] for r in refine(df, spec).collect()}
    lost = "valor_no_interpretable_d"
    assert got == {1: ["mail", lost], 2: ["no_date", lost], 3: ["mail", "late", "no_date"]}
    assert [rule_columns(df, r) for r in spec.rules] == [{"mail"}, {"d"}, {"e"}]
    assert rule_columns(df, Rule("x", "mail = d", columns=("e",))) == {"e"}


# ---------------------------------------------------------------------- money


def test_money_below_the_sixth_decimal_and_beside_huge_values(spark):
    total = lambda values, parts=3: spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts).agg(money_sum("x").alias("s")).first()["s"]
    assert total([4e-7] * 1000) == 0.0004
    assert total([1e300, 1e-6, -1e300, 2e-6]) == 3e-6
    assert total([1e17, 0.25, -1e17]) == 0.25
    rng = random.Random(9)
    values = [rng.choice([1e-9, 1e-3, 1, 1e5, 1e9]) * rng.random() for _ in range(500)]
    sums = set()
    for k in range(4):
        rng.shuffle(values)
        sums.add(total(values, 1 + k))
    assert len(sums) == 1
    assert spark.createDataFrame([], "x double").agg(money_sum("x").alias("s")).first()["s"] == 0.0
    assert total([float("nan"), 1.0]) != total([1.0])


# --------------------------------------------------------------------- checks


def test_silver_contract_agrees_with_the_single_checks_in_one_scan(spark, tmp_path):
    raw = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, d string")
    silver = spark.createDataFrame([(1, "a", ["x"]), (1, None, ["x"]), (2, None, ["missing"]), (None, None, None)], "k int, d string, data_quality_flag array<string>")
    raw.write.parquet(f"{tmp_path}/raw")
    silver.write.parquet(f"{tmp_path}/silver")
    raw, silver = spark.read.parquet(f"{tmp_path}/raw"), spark.read.parquet(f"{tmp_path}/silver")
    single = V.run_checks([V.pk_unique(silver, ["k"]), V.null_date_flagged(silver, "d", "missing"), V.no_row_loss(raw, silver, ["k"])])
    whole = V.silver_contract(raw, silver, ["k"], "d", "missing")
    assert rows(V.run_checks([whole])) == rows(single)
    assert plan_text(whole, "simple").count("FileScan parquet") == 2
