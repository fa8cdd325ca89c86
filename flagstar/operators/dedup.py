"""Deterministic deduplication by key.

``dropDuplicates`` keeps an arbitrary row per key (it plans as a ``first()``
aggregate), so two runs may publish different survivors. Here the survivor is
the first row of a declared total order.

It is written as an aggregate, ``groupBy(keys).agg(min_by(row, order))``,
rather than a ``row_number() = 1`` window, for the sake of hot keys: an
aggregate always keeps its partial (map-side) step, so a key whose copies make
up a third of the table is collapsed to one row per task before any shuffle,
also when the input already arrives partitioned by a join on a prefix of the
key and AQE only adds the exchange later, after splitting that join's skewed
partition. A window's partial per-key limit is dropped in that situation. The
window form remains for orders given as arbitrary Column expressions
(e.g. descending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RN = "__flagstar_rn"
_ROW = "__flagstar_row"
_KEYHASH = "__flagstar_keyhash"


def _orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and _comparable(f.dataType)]


def _comparable(kind: DataType) -> bool:
    """Whether values of this type have an order, nested parts included."""
    if isinstance(kind, ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def _key_exprs(df: DataFrame, keys: list[str]) -> list[Column]:
    """Grouping expressions; long text keys get a 64-bit hash in front so
    sorts compare one long instead of whole texts (near copies share long
    prefixes). The keys still follow, so grouping stays exact."""
    exprs = [F.col(k) for k in keys]
    types = dict(df.dtypes)
    if any(types.get(k) in ("string", "binary") for k in keys):
        exprs.insert(0, F.xxhash64(*keys).alias(_KEYHASH))
    return exprs


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (ascending, NULLs
    first), ties broken by the remaining columns, so the survivor never
    depends on partitioning. ``order_by`` defaults to all other columns.
    Column order of ``df`` is preserved.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("dedup_by_key needs at least one key column")
    order = list(order_by) if order_by else _orderable(df, keys)
    if any(not isinstance(c, str) for c in order):
        return _dedup_window(df, keys, order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_RN)).select(*keys)
    orderable = _orderable(df, keys)
    ranked = [*order, *[c for c in orderable if c not in order]]
    if set(ranked) == set(rest):
        # every column compares: the smallest (order..., rest...) struct is the row
        survivor = F.min(F.struct(*[F.col(c) for c in ranked]))
    else:
        # map/variant columns cannot be compared: carry them along with min_by
        survivor = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in ranked]))
    grouped = df.groupBy(*_key_exprs(df, keys)).agg(survivor.alias(_ROW))
    return grouped.select(*[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns])


def _dedup_window(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    # ties go on by all columns that have an order, so the survivor is fixed
    named = [c for c in order if isinstance(c, str)]
    order = [*order, *[c for c in _orderable(df, keys) if c not in named]]
    order_cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*_key_exprs(df, keys)).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total_rows, distinct_keys, duplicates_removed``.

    Two partial-aggregated ``groupBy``s; NULL is a key value here, as it is
    for deduplication.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates_removed"),
    )
