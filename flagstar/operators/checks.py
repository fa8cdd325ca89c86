"""Data-contract checks as operators.

Every check returns a one-row DataFrame ``(check_name, violations)``;
:func:`run_checks` unions them and adds ``passed = violations = 0``. Data checks
are distributed aggregates; schema checks are decided from the schema alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.operators.integrity import ForeignKey, orphan_count, orphan_report
from flagstar.operators.quality import FLAG_COL
from flagstar.operators.star import UNKNOWN_DATE_ID
from flagstar.sources.landing import tables_ready


def _row(df: DataFrame, name: str, violations) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), violations.cast("bigint").alias("violations"))


def _const(spark: SparkSession, name: str, violations: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("check_name"), F.lit(violations).cast("bigint").alias("violations")
    )


def failed(spark: SparkSession, name: str) -> DataFrame:
    """A check that can't be made, as one violation."""
    return _const(spark, name, 1)


def table_exists(spark: SparkSession, root: str, table: str, name: str | None = None, min_rows: int = 0) -> DataFrame:
    """V1: ``root/<table>`` is there whole (every file's footer, the published row
    count), with at least ``min_rows`` rows."""
    return _const(spark, name or f"table_exists:{table}", 0 if tables_ready(spark, root, [table], min_rows) else 1)


def pk_unique(df: DataFrame, keys: Sequence[str], name: str = "pk_unique") -> DataFrame:
    """V2: rows minus distinct keys (0 when the key is unique)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    agg = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("v"))
    return _row(agg, name, F.col("v"))


def column_present(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """V3: the column exists in the schema."""
    return _const(df.sparkSession, name or f"column_present:{column}", 0 if column in df.columns else 1)


def null_date_flagged(
    df: DataFrame,
    date_col: str,
    flag: str,
    flag_col: str = FLAG_COL,
    name: str = "null_date_flagged",
) -> DataFrame:
    """V4: rows with a NULL date that do not carry ``flag``."""
    bad = F.col(date_col).isNull() & ~F.coalesce(F.array_contains(F.col(flag_col), flag), F.lit(False))
    return _row(df.agg(F.count_if(bad).alias("v")), name, F.col("v"))


def no_row_loss(
    before: DataFrame, after: DataFrame, keys: Sequence[str], name: str = "no_row_loss"
) -> DataFrame:
    """V5: |distinct keys before - rows after| (dedup may only remove repeats)."""
    distinct_before = before.groupBy(*keys).agg(F.lit(1).alias("n")).agg(F.count(F.lit(1)).alias("n"))
    rows_after = after.agg(F.count(F.lit(1)).alias("n"))
    both = distinct_before.select(F.col("n").alias("b"), F.lit(0).cast("bigint").alias("a")).unionByName(
        rows_after.select(F.lit(0).cast("bigint").alias("b"), F.col("n").alias("a"))
    )
    return _row(both.agg(F.sum("b").alias("b"), F.sum("a").alias("a")), name, F.abs(F.col("b") - F.col("a")))


def silver_contract(
    before: DataFrame, after: DataFrame, keys: Sequence[str], date_col: str, flag: str, flag_col: str = FLAG_COL
) -> DataFrame:
    """V2, V4 and V5 with one scan of each table and one shuffle.

    Rows of both tables are counted by key, tagged by where they come from; the
    row-level check rides along. Counts are combined before the shuffle, so a key
    with very many rows is one row per task.
    """
    count = lambda n: F.lit(n).cast("bigint")
    unflagged = F.col(date_col).isNull() & ~F.coalesce(F.array_contains(F.col(flag_col), flag), F.lit(False))
    mine = after.select(*keys, count(0).alias("__before"), count(1).alias("__after"), unflagged.cast("bigint").alias("__bad"))
    theirs = before.select(*keys, count(1).alias("__before"), count(0).alias("__after"), count(0).alias("__bad"))
    by_key = mine.unionByName(theirs).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("__before", "__after", "__bad")])
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    found = by_key.agg(
        sum_of(F.greatest(F.col("__after") - 1, F.lit(0))).alias("pk_unique"),
        sum_of("__bad").alias("null_date_flagged"),
        F.abs(F.count_if(F.col("__before") > 0) - sum_of("__after")).alias("no_row_loss"),
    )
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in found.columns]
    return found.select(F.inline(F.array(*rows)))


def not_null(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """V6: NULLs in a column that must never be NULL (e.g. a fact's key)."""
    return _row(
        df.agg(F.count_if(F.col(column).isNull()).alias("v")), name or f"not_null:{column}", F.col("v")
    )


def single_unknown_member(
    dim: DataFrame, key: str = "id_tiempo", unknown_id: int = UNKNOWN_DATE_ID, name: str = "single_unknown_member"
) -> DataFrame:
    """V7: |rows with the unknown key - 1|."""
    n = F.count_if(F.col(key) == F.lit(unknown_id))
    return _row(dim.agg(n.alias("v")), name, F.abs(F.col("v") - 1))


def columns_absent(df: DataFrame, forbidden: Sequence[str], name: str = "columns_absent") -> DataFrame:
    """V8: how many forbidden (e.g. personal) columns are exposed."""
    return _const(df.sparkSession, name, len(set(forbidden) & set(df.columns)))


def no_orphans(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str | None = None, name: str | None = None,
    known_rows: int | None = None,
) -> DataFrame:
    """V9: fact rows whose key has no dimension row."""
    counted = orphan_count(fact, dim, fk, pk, known_rows=known_rows)
    return _row(counted, name or f"no_orphans:{fk}", F.col("orphan_rows"))


def no_orphans_each(fact: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """V9 for several keys in one pass over the fact: one row per key."""
    name = F.concat(F.lit("no_orphans:"), F.col("fact_key"))
    return orphan_report(fact, keys).select(name.alias("check_name"), F.col("orphan_rows").alias("violations"))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Union of check rows plus ``passed``."""
    if not checks:
        raise ValueError("run_checks needs at least one check")
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("passed", F.col("violations") == 0)
