"""Referential integrity: orphan foreign keys.

A fact row is an orphan when its foreign key has no row in the dimension; a
NULL key is always an orphan. Anti joins ignore duplicate dimension keys, so
the dimension is only projected to its key (no ``distinct`` shuffle). Counts
are taken over ``(fk, rows)`` pairs: with a broadcast dimension Catalyst
filters the fact map-side first and then combines per key before the
shuffle; with a shuffled dimension AQE splits a hot key's partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstar.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast


@dataclass(frozen=True)
class ForeignKey:
    """``fact.fk`` must exist in ``dim.pk``; ``name`` labels the report row."""

    name: str
    fact_key: str
    dim: DataFrame
    dim_key: str
    known_rows: int | None = None  # dimension size when known by construction


def orphans(
    fact: DataFrame,
    dim: DataFrame,
    fk: str,
    pk: str | None = None,
    broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Fact rows whose ``fk`` is NULL or missing from ``dim.pk`` (left anti join)."""
    pk = pk or fk
    keys = bounded_broadcast(dim.select(F.col(pk).alias("__pk")), broadcast_max_rows)
    return fact.join(keys, fact[fk] == keys["__pk"], "left_anti")


def orphan_count(
    fact: DataFrame,
    dim: DataFrame,
    fk: str,
    pk: str | None = None,
    broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """One row ``orphan_rows``: fact rows without a dimension row."""
    pk = pk or fk
    per_key = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    keys = bounded_broadcast(dim.select(F.col(pk).alias("__pk")), broadcast_max_rows, known_rows)
    missing = per_key.join(keys, per_key["__fk"] == keys["__pk"], "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("orphan_rows"))


def _constant(kind: str):
    """Some value of a key's type that is not NULL."""
    if kind == "date" or kind.startswith("timestamp"):
        return F.lit("1970-01-01").cast(kind)
    return F.lit(False) if kind == "boolean" else F.lit("0").cast(kind)


def orphan_report(
    fact: DataFrame,
    keys: Sequence[ForeignKey],
) -> DataFrame:
    """One row per foreign key: ``fk_name, fact_key, orphan_rows, passed``.

    The fact is read once whatever the number of keys: its rows per (key,
    value) are counted, combined before the one shuffle, and held against the
    dimensions' values. Keys keep their types; a dimension's key of another type
    is compared in the fact's.
    """
    if not keys:
        raise ValueError("orphan_report needs at least one foreign key")
    kinds = dict(fact.dtypes)
    used = list(dict.fromkeys(kinds[k.fact_key] for k in keys))

    def cell(i: int, kind: str, value):
        """Key number and value, each type in a column of its own: no key is cast.
        Columns of other types hold one constant on both sides, so only the own
        one decides; a NULL there meets nothing."""
        values = [(value if t == kind else _constant(t)).alias(f"__v{j}") for j, t in enumerate(used)]
        return F.struct(F.lit(i).alias("__k"), *values)

    own = lambda i, k: cell(i, kinds[k.fact_key], F.col(k.fact_key))
    values = F.explode(F.array(*[own(i, k) for i, k in enumerate(keys)]))
    exploded = fact.select(values.alias("__x")).select("__x.*")
    counted = exploded.groupBy(*exploded.columns).agg(F.count(F.lit(1)).alias("__n"))
    known = None
    for i, k in enumerate(keys):
        kind = kinds[k.fact_key]
        value = F.col(k.dim_key) if dict(k.dim.dtypes)[k.dim_key] == kind else F.col(k.dim_key).try_cast(kind)
        part = k.dim.select(cell(i, kind, value).alias("__x")).select("__x.*")
        known = part if known is None else known.unionByName(part)
    missing = counted.join(known, exploded.columns, "left_anti")
    sums = [F.coalesce(F.sum(F.when(F.col("__k") == i, F.col("__n"))), F.lit(0)).cast("bigint") for i in range(len(keys))]
    totals = missing.agg(*[s.alias(f"__n{i}") for i, s in enumerate(sums)])
    rows = [
        F.struct(F.lit(k.name).alias("fk_name"), F.lit(k.fact_key).alias("fact_key"), F.col(f"__n{i}").alias("orphan_rows"))
        for i, k in enumerate(keys)
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn("passed", F.col("orphan_rows") == 0)


class OrphanError(RuntimeError):
    """Raised by :func:`enforce` when a foreign key has orphans."""


def enforce(report: DataFrame, on_orphan: str = "warn") -> list[dict]:
    """Act on an orphan report: ``'warn'`` returns the failing rows, ``'fail'`` raises.

    The report has one row per foreign key, so collecting it is bounded.
    """
    if on_orphan not in ("warn", "fail"):
        raise ValueError("on_orphan must be 'warn' or 'fail'")
    bad = [r.asDict() for r in report.filter(~F.col("passed")).collect()]
    if bad and on_orphan == "fail":
        raise OrphanError(f"orphan foreign keys: {bad}")
    return bad
