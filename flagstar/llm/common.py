"""Helpers shared by the training-data operators: words, scratch tables, names.

A *word* is a maximal run of characters other than space and ``\\x09``-``\\x0D``
throughout this subpackage; *lower-cased* means A-Z only.
"""

from __future__ import annotations

import re
import string
import sys
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send this module's functions to executors by value, so that they need no
    copy of the package on their own path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_cache(name: str) -> dict:
    """A dictionary that a Python worker keeps from task to task. Functions sent
    by value bring their own globals with every task, so it hangs on a module."""
    import types

    held = sys.modules.setdefault("_flagstar_worker_cache", types.ModuleType("_flagstar_worker_cache"))
    return held.__dict__.setdefault(name, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_array(text: Column) -> Column:
    """The words of a text in order; empty array for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


class Saved:
    """An intermediate table in the shared checkpoint folder.

    Cuts the lineage: after an executor is lost, later jobs reread the files
    instead of recomputing the whole chain. ``drop`` removes it once nothing
    reads it any more.
    """

    def __init__(self, spark: SparkSession, df: DataFrame, name: str):
        self.spark, self.path = spark, scratch_dir(spark, re.sub(r"\W", "-", name))
        schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows in the jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bucketed(spark: SparkSession, df: DataFrame, name: str, column: str) -> DataFrame:
    """An intermediate table in the shared checkpoint folder, in buckets by
    ``column``: a join on it later moves the other side only. The catalog forgets
    its name at once, the files stay."""
    path, title = scratch_dir(spark, name), f"{re.sub(r'\W', '_', name)}_{uuid.uuid4().hex[:12]}"
    buckets = min(shuffle_partitions(spark), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, column).saveAsTable(title)
    out = spark.table(title)
    spark.sql(f"DROP TABLE {title}")  # external: only the entry goes
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
