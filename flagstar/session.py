"""Session helpers: a builder for local runs and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime SQL settings the plans rely on at scale. None changes a result.
#  * AQE re-plans from measured shuffle sizes (coalescing, broadcast switch).
#  * skew join splits a hot key's partition; ``forceOptimizeSkewedJoin`` lets
#    it do so even where the join's partitioning is reused downstream (the
#    appointment join feeds a dedup on the same key), at the price of one
#    extra exchange only when skew is actually detected.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "flagstar",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session tuned for these jobs.

    Only used by tests, the bench and the command line; library functions take
    the caller's session and never change its static configuration.
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[*]"))
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("FLAGSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session (runtime SQL settings only)."""
    for key, value in RUNTIME_CONF.items():
        try:
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)
        except Exception:  # noqa: BLE001 - a locked conf only costs the optimization
            pass
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    When it is unset (local tests), a folder under the system temp dir is
    created and registered; on a cluster master that would be machine-local,
    so there the setting is required.
    """
    try:
        configured = spark.conf.get(CHECKPOINT_CONF, None)
    except Exception:  # noqa: BLE001 - some session types refuse static confs
        configured = None
    if not configured:
        configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} must name a shared folder on a cluster (master={master})"
        )
    local = tempfile.mkdtemp(prefix="flagstar-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A new, unique folder for intermediate tables of one run.

    Lives under the session's checkpoint folder, so every executor can read
    what another one wrote, and a lost executor's output is recomputed from
    files rather than from a machine-local disk. Never reused, never cleared.
    """
    return f"{_checkpoint_root(spark)}/flagstar/{name}-{uuid.uuid4().hex[:12]}"
