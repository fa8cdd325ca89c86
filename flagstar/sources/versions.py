"""Layers of tables in versions: written aside, published together.

A layer is a folder. Each table that is written gets a new folder under
``_data``; a *manifest* ``_manifest/<n>.json`` names the folder of every table.
Publishing is the creation of one small file, so all tables of a run change at
once or not at all: after a failure, a lost driver or between two writes, readers
see the former version of every table. A reader that took a :func:`snapshot`
keeps seeing it, also while the next version is published.

A manifest carries the id of the run that made it and the row counts, so a
repeated run can tell what is done and a check what should be there. One writer
per layer at a time; a second one that publishes the same number fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flagstar.sources import files

KEEP = 2  # versions whose data stays: the newest, and the one that readers may still have open


@dataclass(frozen=True)
class Staged:
    """A complete table that no manifest names yet."""

    folder: str
    rows: int
    metrics: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """One version of a layer; its tables never change."""

    root: str
    number: int
    tables: Mapping[str, dict]
    run: str | None = None
    detail: Mapping = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/_data/{self.tables[table]['folder']}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = files.names(spark, f"{root}/_manifest")
    return sorted(int(n[:-5]) for n in found if n.endswith(".json") and not n.startswith("."))


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    told = files.read_json(spark, f"{root}/_manifest/{number:08d}.json")
    return Snapshot(root, number, told["tables"], told.get("run"), told.get("detail", {}))


def snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest version of the layer at ``root``; None where there is none."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


def stage(df: DataFrame, root: str, table: str, metrics: Mapping[str, Column] | None = None) -> Staged:
    """Write ``df`` where no reader sees it. Its rows and ``metrics`` (aggregates)
    are taken on the same pass."""
    folder = f"{table}-{uuid.uuid4().hex[:12]}"
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    aggregates = [c.alias(n) for n, c in (metrics or {}).items()]
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *aggregates).write.parquet(f"{root}/_data/{folder}")
    taken = dict(obs.get)
    return Staged(folder, int(taken.pop("rows", 0)), taken)


def read_staged(spark: SparkSession, root: str, staged: Staged) -> DataFrame:
    return spark.read.parquet(f"{root}/_data/{staged.folder}")


def publish(
    spark: SparkSession, root: str, tables: Mapping[str, Staged], run: str | None = None, detail: Mapping | None = None, keep: int = KEEP
) -> Snapshot:
    """Make ``tables`` the layer's newest version; its other tables stay as they
    are. Data that only versions before the last ``keep`` name is deleted."""
    before = snapshot(spark, root)
    named = dict(before.tables) if before else {}
    named.update({t: {"folder": s.folder, "rows": s.rows} for t, s in tables.items()})
    number = before.number + 1 if before else 1
    files.write_json(spark, f"{root}/_manifest/{number:08d}.json", {"tables": named, "run": run, "detail": dict(detail or {})})
    _clear(spark, root, keep)
    return _load(spark, root, number)


def discard(spark: SparkSession, root: str, staged: Mapping[str, Staged]) -> None:
    """Delete tables that were staged and will not be published."""
    for s in staged.values():
        files.delete(spark, f"{root}/_data/{s.folder}")


def _clear(spark: SparkSession, root: str, keep: int) -> None:
    numbers = _numbers(spark, root)
    folders = lambda some: {t["folder"] for n in some for t in _load(spark, root, n).tables.values()}
    old, kept = numbers[:-keep], numbers[-keep:]
    for folder in folders(old) - folders(kept):
        files.delete(spark, f"{root}/_data/{folder}")
    for n in old:  # last, so an interrupted clearing is taken up by the next
        files.delete(spark, f"{root}/_manifest/{n:08d}.json")
