"""Hot keys: a key holding half of all rows must not land in one task."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from helpers import plan_text
from flagstar.operators.dedup import dedup_by_key
from flagstar.operators.integrity import orphan_count
from flagstar.operators.quality import Rule, apply_rules, flag_audit
from flagstar.session import tune_session

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark, n=200_000):
    """Half of the rows share key 0."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("line")
    )


def test_hot_join_key_is_split_before_the_dedup(spark):
    tune_session(spark)
    with conf(spark, SMALL_SKEW):
        dim = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("k2"), (F.col("id") * 3).alias("cust"))
        j = _hot(spark).join(dim, F.col("k") == F.col("k2")).select("k", "line", "cust")
        d = dedup_by_key(j, ["k", "line"], ["cust"])
        assert len(d.collect()) == 200_000
        plan = plan_text(d)
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_keys_are_combined_map_side(spark):
    df = _hot(spark)
    flagged = apply_rules(df, [Rule("hot", F.col("k") == 0)])
    plan = plan_text(flag_audit(flagged))
    assert "partial_count" in plan  # pre-aggregated before the shuffle
    dim = spark.range(1, 10).select(F.col("id").alias("k"))
    assert orphan_count(df, dim, "k").first()["orphan_rows"] == 200_000 - 5  # keys 1, 3, 5, 7, 9 exist
    plan = plan_text(orphan_count(df, dim, "k"))
    assert "BroadcastHashJoin LeftAnti" in plan and "partial_count" in plan  # map-side filter, then combine


def test_hot_group_of_copies_is_collapsed_before_its_shuffle(spark):
    """Half of all rows are copies of one dedup key, and the input arrives
    partitioned by a join on a prefix of that key: after AQE splits the skewed
    join partition, the exchange feeding the dedup carries about one row per
    distinct key, not the copies."""
    import re

    tune_session(spark)
    with conf(spark, SMALL_SKEW):
        hot = F.col("id") % 2 == 0
        fact = spark.range(0, 200_000, 1, 8).select(
            F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("k"),
            F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("line"),
            F.col("id").alias("payload"),
        )
        dim = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("k2"), (F.col("id") * 3).alias("cust"))
        j = fact.join(dim, F.col("k") == F.col("k2")).select("k", "line", "payload", "cust")
        d = dedup_by_key(j, ["k", "line"], ["payload"])
        assert len(d.collect()) == 100_001
        plan = plan_text(d)
    assert "SortMergeJoin(skew=true)" in plan
    first_stage = re.search(r"ShuffleQueryStage \(\d+\), Statistics\([^)]*rowCount=([0-9.E+]+)\)", plan)
    assert first_stage and float(first_stage.group(1)) < 150_000


def test_hot_day_is_split_across_files_and_quiet_days_stay_whole(spark, tmp_path):
    import os

    from flagstar.sources.landing import land_by_date

    day = F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).otherwise(
        F.concat(F.lit("2024-02-"), F.lpad(((F.col("id") % 20) + 1).cast("string"), 2, "0")))
    df = spark.range(0, 400_000, 1, 8).select(F.col("id"), F.to_timestamp(day).alias("ts"), F.rand(1).alias("x"))
    root = str(tmp_path / "bronze")
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
                      "spark.sql.adaptive.coalescePartitions.enabled": "true"}):
        land_by_date(df, root, "ts")
    files = {d: [f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")]
             for d in os.listdir(root) if d.startswith("load_date=")}
    assert len(files) == 11
    hot = len(files["load_date=2024-01-01"])
    assert hot >= 4  # the day holding half the rows is split into advisory-sized pieces
    tasks = df.rdd.getNumPartitions()
    assert sum(len(v) for v in files.values()) < tasks * len(files)  # not one file per task per day
    assert spark.read.parquet(root).count() == 400_000
