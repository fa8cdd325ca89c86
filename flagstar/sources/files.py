"""Small file operations through Hadoop's FileSystem, so any store Spark reads will do."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``; nothing where it does not exist."""
    fs, p = _fs(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """A new file that appears whole or not at all; refuses to replace one."""
    parent, _, name = path.rpartition("/")
    fs, final = _fs(spark, path)
    _, part = _fs(spark, f"{parent}/.{name}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(part, final):
        fs.delete(part, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
