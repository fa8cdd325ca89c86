"""Bronze landing: raw files in, dated Parquet partitions out.

* :func:`land_csv` reads one CSV with a declared schema (ids stay text, so a
  leading zero survives) and overwrites only today's ``load_date`` partition:
  same-day reruns are idempotent, earlier loads stay.
* :func:`read_latest` lists the dated folders and reads the newest alone.
* :func:`load_report` turns landing results into a DataFrame.
"""

from __future__ import annotations

import csv
import datetime as _dt
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flagstar.sources import files
from flagstar.sources.layers import table_rows

LOAD_COL = "load_date"
CORRUPT_COL = "_corrupt_record"
COMMIT = "_commit-"  # hidden from scans


@dataclass(frozen=True)
class LandingResult:
    table: str
    rows: int
    seconds: float
    destination: str
    status: str  # OK | EMPTY | MISSING


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` names at least one readable file or folder."""
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).count()
        return True
    except AnalysisException:
        return False


def csv_files(spark: SparkSession, path: str) -> list[tuple[tuple[str, ...], list[str]]]:
    """The files that ``path`` (a file, folder or glob) stands for, grouped by
    their header, in order of their names. Empty files have none and are left out.

    Reads the first line of each file only; compressed files included.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    codecs, todo, found = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf), list(fs.globStatus(top) or []), []
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [x for x in fs.listStatus(status.getPath()) if x.getPath().getName()[0] not in "_."]
        elif status.getLen():
            found.append((status.getPath().toString(), status.getPath()))
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, file in sorted(found, key=lambda x: x[0]):
        stream, codec = fs.open(file), codecs.getCodec(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():  # Spark passes blank lines over, too
            line = reader.readLine()
        reader.close()
        if line is not None:
            groups.setdefault(_column_names(next(csv.reader([line.removeprefix("\ufeff")]))), []).append(name)
    return list(groups.items())


def _column_names(cells: list[str]) -> tuple[str, ...]:
    """A file's header as distinct names: nameless columns by place, repeated
    names (in any case) with their place behind."""
    out, seen = [], set()
    for k, cell in enumerate(cells):
        name = cell.strip() or f"_c{k}"
        out.append(f"{name}_{k}" if name.lower() in seen else name)
        seen.add(out[-1].lower())
    return tuple(out)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer_schema: bool = False,
    keep_corrupt: bool = False,
    keep_extra: bool = False,
) -> DataFrame:
    """CSV with headers: a file, a folder or a glob whose files may have
    different ones. Each file is read under its own header and columns meet by
    name, so files that reorder, add or lack columns land correctly.

    With ``schema`` its columns come first and with its types; no inference pass
    is made. A file whose header lacks one of them raises ``ValueError``; with
    ``keep_extra`` undeclared columns follow, as text. Without ``schema`` every
    column of any file comes, as text, or with ``infer_schema`` in the type that
    Spark infers (text where files differ).

    Cells that do not fit their type become NULL (PERMISSIVE). With
    ``keep_corrupt`` a line with more or fewer cells than its header, or such a
    cell, is also kept whole in ``_corrupt_record``: no cell is lost.
    """
    declared = {f.name: f for f in schema.fields} if schema else {}
    groups = csv_files(spark, path)
    if schema and not groups:
        raise ValueError(f"{path}: no header")
    types: dict[str, object] = {}
    inferred = []
    for header, files_of in groups:
        if missing := [n for n in declared if n not in header]:
            raise ValueError(f"{files_of[0]}: header lacks declared columns {missing}")
        own = {n: StringType() for n in header}
        if infer_schema and not schema:
            fields = spark.read.option("header", True).option("inferSchema", True).csv(files_of).schema.fields
            own = {n: f.dataType for n, f in zip(header, fields)}
        own.update({n: f.dataType for n, f in declared.items()})
        for n, kind in own.items():
            types[n] = kind if types.get(n, kind) == kind else StringType()
        inferred.append(own)
    order = [*declared, *([n for n in types if n not in declared] if keep_extra or not schema else [])]
    parts = []
    for (header, files_of), own in zip(groups, inferred):
        fields = StructType([StructField(n, own[n] if own[n] == types[n] else StringType()) for n in header])
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if keep_corrupt:
            fields = fields.add(CORRUPT_COL, "string")
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        df = reader.schema(fields).csv(files_of)
        cells = [F.col(f"`{n}`") if n in header else F.lit(None).cast(types[n]).alias(n) for n in order]
        parts.append(df.select(*cells, *([CORRUPT_COL] if keep_corrupt else [])))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(CORRUPT_COL, StringType())] if keep_corrupt else []))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_partition(df: DataFrame, table_root: str, load_date, load_col: str = LOAD_COL, run: str | None = None) -> int:
    """Land ``df`` as the ``load_date`` of ``table_root``; returns rows.

    Each landing is an *attempt*: a new folder under ``<load_col>=<date>`` that
    counts from the moment a small commit file names it. A failed or interrupted
    attempt changes nothing, the day's earlier landing stays the one that is read;
    a complete one takes its place, and the files of the former go. Earlier dates
    stay. An empty frame still leaves a schema-only file: an empty landing is a
    real, readable partition. The count is an ``Observation`` on the write: one pass.
    """
    spark, day = df.sparkSession, f"{table_root}/{load_col}={load_date}"
    attempt = f"attempt-{uuid.uuid4().hex[:12]}"
    obs = Observation(f"land_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(f"{day}/{attempt}")
    rows = int(obs.get.get("rows", 0))
    before = _commits(files.names(spark, day))
    number = int(before[-1][len(COMMIT) :]) + 1 if before else 1
    files.write_json(spark, f"{day}/{COMMIT}{number:08d}", {"folder": attempt, "rows": rows, "run": run})
    for name in files.names(spark, day):  # superseded files and attempts that never ended
        if name != attempt and not name.startswith(COMMIT):
            files.delete(spark, f"{day}/{name}")
    return rows


def _commits(found: list[str]) -> list[str]:
    return sorted(n for n in found if n.startswith(COMMIT))


def landed_run(spark: SparkSession, table_root: str, load_date, load_col: str = LOAD_COL) -> dict | None:
    """What the newest commit of a date says (folder, rows, run); None without one."""
    day = f"{table_root}/{load_col}={load_date}"
    commits = _commits(files.names(spark, day))
    return files.read_json(spark, f"{day}/{commits[-1]}") if commits else None


def land_csv(
    spark: SparkSession,
    table: str,
    source_path: str,
    bronze_root: str,
    load_date: _dt.date | str,
    schema: StructType | None = None,
    infer_schema: bool = False,
    run: str | None = None,
) -> LandingResult:
    """Land one CSV into ``bronze_root/<table>/load_date=<d>``.

    Nothing the files hold is lost, with ``schema`` or without: undeclared columns
    land as text behind the declared ones, and a line that does not fit its file's
    header (or a cell its type) is also kept whole in ``_corrupt_record``. A missing source is reported as
    ``MISSING`` (0 rows) instead of failing, so a runner can decide whether
    that stops the run.
    """
    dest = f"{bronze_root}/{table}"
    start = time.time()
    if not path_exists(spark, source_path):
        return LandingResult(table, 0, 0.0, dest, "MISSING")
    df = read_csv(spark, source_path, schema=schema, infer_schema=infer_schema, keep_corrupt=True, keep_extra=True)
    rows = write_partition(df, dest, load_date, run=run)
    return LandingResult(table, rows, time.time() - start, dest, "OK" if rows > 0 else "EMPTY")


def read_latest(spark: SparkSession, table_root: str, load_col: str = LOAD_COL) -> DataFrame:
    """The newest ``load_date`` partition of a Bronze table, without that column.

    One listing of the table's folders names the newest date, and only that
    folder is then listed and read, however many landings came before. Of a
    date's attempts the newest committed one counts. An empty newest landing is
    still the newest partition; a date without a committed attempt or data files
    (a landing that failed) is passed over, and so is the folder of undated rows. Raises ``FileNotFoundError`` when the table has no partition.
    """
    dated = [n for n in files.names(spark, table_root) if n.startswith(f"{load_col}=")]
    for name in sorted(set(dated) - {f"{load_col}=__HIVE_DEFAULT_PARTITION__"}, reverse=True):
        day = f"{table_root}/{name}"
        found = files.names(spark, day)
        if commits := _commits(found):
            return spark.read.parquet(f"{day}/{files.read_json(spark, f'{day}/{commits[-1]}')['folder']}")
        if any(n.endswith(".parquet") for n in found):  # landed by date, without attempts
            return spark.read.option("basePath", table_root).parquet(day).drop(load_col)
    raise FileNotFoundError(f"no {load_col} partitions under {table_root}")


def land_by_date(
    df: DataFrame, table_root: str, date_col: str, load_col: str = LOAD_COL, keep_date_col: bool = True
) -> None:
    """Land a frame that spans many days as one ``load_col`` partition per day.

    ``rebalance`` on the partition column lets AQE gather each day into a few
    advisory-sized files and split a day that holds a large share of the rows,
    instead of every task writing one small file per day it happens to hold.
    Only the days present are overwritten.
    """
    out = df.withColumn(load_col, F.to_date(F.col(date_col)).cast("string"))
    if not keep_date_col:
        out = out.drop(date_col)
    (
        out.hint("rebalance", load_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(load_col)
        .parquet(table_root)
    )


def tables_ready(spark: SparkSession, root: str, names: Sequence[str], min_rows: int = 0) -> bool:
    """True when every ``root/<name>`` is published whole: readable footers in all
    files, the rows that its manifest states, and at least ``min_rows`` of them."""
    found = (table_rows(spark, f"{root}/{name}") for name in names)
    return all(rows is not None and rows >= min_rows for rows in found)


def load_report(spark: SparkSession, results: Sequence[LandingResult]) -> DataFrame:
    """``table_name, rows, seconds, destination, status`` per landed table and a
    ``TOTAL`` row, which is OK when every table is (S12)."""
    schema = "table_name string, rows bigint, seconds double, destination string, status string"
    rows = [(r.table, r.rows, float(r.seconds), r.destination, r.status) for r in results]
    state = "OK" if all(r.status == "OK" for r in results) else "FAILED"
    rows.append(("TOTAL", sum(r.rows for r in results), float(sum(r.seconds for r in results)), "", state))
    return spark.createDataFrame(rows, schema)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table plus a ``TOTAL`` row, as one plan."""
    if not tables:
        raise ValueError("table_counts needs at least one table")
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("rows").cast("bigint").alias("rows")).select(F.lit("TOTAL").alias("table_name"), "rows")
    return (
        out.unionByName(total)
        .withColumn("status", F.when(F.col("rows") > 0, F.lit("OK")).otherwise(F.lit("FAILED")))
    )
