"""Deterministic deduplication and duplicate counts."""

from __future__ import annotations

import pytest

from helpers import plan_text
from flagstar.operators.dedup import dedup_by_key, duplicate_count


def test_same_survivor_whatever_the_partitioning(spark):
    data = [(1, "c", 3), (1, "a", 9), (1, "b", 1), (2, "z", 0)]
    df = spark.createDataFrame(data, "k int, v string, w int")
    seen = set()
    for parts in (1, 2, 3, 7):
        out = dedup_by_key(df.repartition(parts), ["k"], ["v"]).orderBy("k").collect()
        seen.add(tuple(tuple(r) for r in out))
    assert seen == {((1, "a", 9), (2, "z", 0))}


def test_default_order_uses_all_other_columns(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 1)], "k int, v string, w int")
    assert [tuple(r) for r in dedup_by_key(df.repartition(3), ["k"]).collect()] == [(1, "a", 1)]


def test_null_is_a_key_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert sorted((tuple(r) for r in dedup_by_key(df, ["k"], ["v"]).collect()), key=repr) == sorted([(None, 1), (1, 3)], key=repr)
    c = duplicate_count(df, ["k"]).first()
    assert (c["total_rows"], c["distinct_keys"], c["duplicates_removed"]) == (3, 2, 1)


def test_duplicate_count_of_empty_table(spark):
    c = duplicate_count(spark.createDataFrame([], "k int"), ["k"]).first()
    assert (c["total_rows"], c["distinct_keys"], c["duplicates_removed"]) == (0, 0, 0)


def test_needs_a_key(spark):
    with pytest.raises(ValueError):
        dedup_by_key(spark.createDataFrame([(1,)], "k int"), [])


def test_plan_combines_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    plan = plan_text(dedup_by_key(df, ["k"], ["v"]))
    tree = plan.split("\n\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("SortAggregate")  # a partial aggregate below the exchange
    assert "partial_min" in plan


def test_map_columns_ride_along(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2})], "k int, v int, m map<string,int>")
    out = dedup_by_key(df, ["k"], ["v"]).collect()
    assert [(r["k"], r["v"], r["m"]) for r in out] == [(1, 1, {"b": 2})]


def test_descending_orders_use_the_window_form(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 1), (1, 3), (1, 2)], "k int, v int")
    assert [tuple(r) for r in dedup_by_key(df, ["k"], [F.col("v").desc()]).collect()] == [(1, 3)]
