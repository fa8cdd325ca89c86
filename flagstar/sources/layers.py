"""Silver / Gold table I/O (Parquet)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flagstar.sources import versions


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Overwrite ``path`` with ``df`` and return the rows written.

    The row count rides on the write as an ``Observation`` instead of a second
    job over the same lineage. Spark's commit protocol makes the write atomic
    per task, so a lost executor's task is simply rerun. An unpartitioned table
    is written beside ``path`` and moved there when complete: a failed job
    leaves the old table as it was.
    """
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    if partition_by:
        # few, advisory-sized files per partition value; AQE splits a hot value
        df = df.hint("rebalance", *partition_by)
    # Observed last, i.e. in the result stage: a retried map stage cannot
    # count its rows twice.
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        observed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        observed.write.parquet(staged := staging_path(path))
        publish(df.sparkSession, staged, path)
    return int(obs.get.get("rows", 0))


def staging_path(path: str) -> str:
    """A new folder beside ``path``, hidden from scans of the parent."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_staging-{name}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Move a complete table to ``path``; the table that was there goes last."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, final, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path, staging_path(path)))
    fs = final.getFileSystem(conf)
    had = fs.exists(final)
    if had and not fs.rename(final, old):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(new, final):
        if had:
            fs.rename(old, final)
        raise OSError(f"could not move {staged} to {path}")
    if had:
        fs.delete(old, True)


def materialize(
    df: DataFrame,
    path: str,
    metrics: dict | None = None,
) -> tuple[DataFrame, dict]:
    """Write ``df`` to ``path`` and return the re-read table plus metrics.

    Cuts the lineage (later plans start from files in shared storage, so
    nothing upstream is recomputed, not even after a lost executor) and
    computes ``metrics`` (name -> aggregate Column) as an ``Observation`` on
    the same pass; ``rows`` is always included. A failed job leaves the table
    that was at ``path``.
    """
    obs = Observation(f"mat_{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in (metrics or {}).items()]
    df.observe(obs, *exprs).write.parquet(staged := staging_path(path))
    publish(df.sparkSession, staged, path)
    return df.sparkSession.read.parquet(path), dict(obs.get)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Silver/Gold table: its newest published version where the folder
    above is a layer (:mod:`flagstar.sources.versions`) that has it."""
    root, _, table = path.rstrip("/").rpartition("/")
    layer = versions.snapshot(spark, root)
    return layer.read(spark, table) if layer and table in layer.tables else spark.read.parquet(path)


def table_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a readable table, from its files' footers; None if it is missing,
    a file is torn, or it has not the rows that were published."""
    root, _, table = path.rstrip("/").rpartition("/")
    layer = versions.snapshot(spark, root)
    try:
        rows = read_table(spark, path).count()  # answered by the footers of all files
    except (PySparkException, Py4JError):
        return None
    told = layer.tables[table]["rows"] if layer and table in layer.tables else rows
    return rows if rows == told else None


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
