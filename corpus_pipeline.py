"""The corpus pipeline: clean, deduplicate, redact, mix and pack documents.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all that its
predecessor kept. ``run`` writes each result as Parquet to the shared checkpoint
folder and rereads it, so a lost executor costs at most one stage's tasks.
SQL can't express the stages (a fitted classifier, MinHash candidates, boosted
trees, a knapsack, bin packing). Tests hold the near-duplicate groups and base
spans against brute force, the others against properties of their results only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flagstar.llm import op02_neardup, op03_mixing, op04_packing, op06_toxicity, op07_pii
from flagstar.llm.common import Saved, table

STAGES = [
    ("toxicity", op06_toxicity.stage),
    ("near_duplicates", op02_neardup.stage),
    ("pii", op07_pii.stage),
    ("mixing", op03_mixing.stage),
    ("packing", op04_packing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``: one row per packed piece."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Saved(spark, stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
