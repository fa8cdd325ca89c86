"""The Silver stage as an incremental file stream.

Bronze grows one ``load_date`` partition per landing. Instead of re-reading
the newest partition in a batch job, :func:`refine_stream` follows the Bronze
folder with Structured Streaming and refines only the dates that received
new files: their Bronze rows are typed, deduplicated *within the load date*
and flagged by the same :func:`~flagstar.operators.quality.refine` the batch
stage uses, then written to Silver partitioned by ``load_date`` with dynamic
partition overwrite. Because each micro-batch refines the complete Bronze
partitions of the dates it touched, a date split across micro-batches is never written in
part, and a replayed micro-batch (after a driver or executor loss) rewrites
the same partitions: the sink is idempotent. The checkpoint records which
files were done.

No state store is involved: deduplication is per load date, exactly what the
batch stage does per partition.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flagstar.operators.quality import TableSpec, refine
from flagstar.sources.landing import LOAD_COL


def touched_dates(dates: DataFrame, load_col: str) -> Column:
    """Filter on the load dates of a batch, NULL among them."""
    found = [r[0] for r in dates.collect()]
    match = F.col(load_col).isin([d for d in found if d is not None])
    return match | F.col(load_col).isNull() if None in found else match


def _write_batch(spec: TableSpec, bronze_table: str, schema: StructType, silver_path: str, load_col: str):
    per_date = replace(spec, key=(*spec.key, load_col))

    def write(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001 - Spark's callback signature
        # Refine the *whole* Bronze partition of every date this batch touched
        # (as literals, one per load date, so the scan prunes to those folders;
        # undated rows are a partition too), so a date whose files straddle two micro-batches is still
        # written complete, and a replayed batch rewrites the same output.
        dates = batch.select(load_col).distinct()
        bronze = batch.sparkSession.read.schema(schema).parquet(bronze_table)
        touched = bronze.filter(touched_dates(dates, load_col))
        (
            refine(touched, per_date)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(load_col)
            .parquet(silver_path)
        )

    return write


def refine_stream(
    spark: SparkSession,
    bronze_table: str,
    bronze_schema: StructType,
    spec: TableSpec,
    silver_path: str,
    checkpoint: str,
    available_now: bool = True,
    load_col: str = LOAD_COL,
) -> StreamingQuery:
    """Start the incremental Silver stream for one Bronze table.

    ``bronze_schema`` is the table's data schema (the load-date partition
    column is added). With ``available_now`` the query processes every file
    not yet in the checkpoint and stops; otherwise it keeps following the
    folder. The caller awaits or stops the returned query.
    """
    schema = StructType([*bronze_schema.fields, StructField(load_col, StringType())])
    stream = spark.readStream.schema(schema).parquet(bronze_table)
    writer = (
        stream.writeStream.foreachBatch(_write_batch(spec, bronze_table, schema, silver_path, load_col))
        .option("checkpointLocation", checkpoint)
        .queryName(f"silver_{spec.name}_{uuid.uuid4().hex[:8]}")  # unique among active queries
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
