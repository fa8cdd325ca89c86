"""KPI and group-by marts over the star view.

All marts are single aggregations (partial + final hash aggregate), so only
mart-sized results ever leave the cluster. NULL-handling is pinned down: an
empty selection gives ``total = 0``, revenue 0, mean wait NULL and a flagged
percentage of 0; NULL group keys are dropped, as the dashboard's group-bys do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flagstar.functions.numeric import money_sum, percent_of, round_half_even
from flagstar.operators.star import UNKNOWN_DATE_ID


def select_rows(
    star: DataFrame,
    category_col: str | None = None,
    categories: Sequence[str] | None = None,
    clean_only: bool = False,
    has_flag_col: str = "tiene_flag_calidad",
) -> DataFrame:
    """The dashboard's filters: category membership (NULL never passes) and
    optionally only rows without quality flags."""
    out = star
    if category_col is not None:
        c = F.col(category_col)
        out = out.filter(c.isin(list(categories)) if categories is not None else c.isNotNull())
    if clean_only:
        out = out.filter(~F.col(has_flag_col))
    return out


def kpis(
    star: DataFrame,
    wait_col: str = "tiempo_espera_minutos",
    amount_col: str = "costo",
    has_flag_col: str = "tiene_flag_calidad",
) -> DataFrame:
    """One row: ``total_citas, tiempo_espera_prom, ingresos_totales, pct_con_flag``.

    Revenue counts every row (all statuses) and is summed exactly in decimal.
    """
    return star.agg(
        F.count(F.lit(1)).alias("total_citas"),
        F.avg(F.col(wait_col)).cast("double").alias("tiempo_espera_prom"),
        money_sum(amount_col).alias("ingresos_totales"),
        percent_of(F.count_if(F.col(has_flag_col)), F.count(F.lit(1))).alias("pct_con_flag"),
    )


def monthly(
    star: DataFrame,
    date_key_col: str = "id_tiempo",
    year_col: str = "anio",
    month_col: str = "mes",
    unknown_id: int = UNKNOWN_DATE_ID,
) -> DataFrame:
    """Rows per (year, month), unknown dates excluded, with ``periodo = 'YYYY-MM'``."""
    return (
        star.filter(F.col(date_key_col) != F.lit(unknown_id))
        .filter(F.col(year_col).isNotNull() & F.col(month_col).isNotNull())
        .groupBy(year_col, month_col)
        .agg(F.count(F.lit(1)).alias("total_citas"))
        .select(
            F.col(year_col).cast("int").alias(year_col),
            F.col(month_col).cast("int").alias(month_col),
            "total_citas",
            F.concat_ws("-", F.col(year_col).cast("string"), F.lpad(F.col(month_col).cast("string"), 2, "0")).alias(
                "periodo"
            ),
        )
        .orderBy(year_col, month_col)
    )


def count_by(star: DataFrame, col: str, alias: str = "total") -> DataFrame:
    """Rows per value of ``col`` (NULL dropped), most frequent first."""
    return (
        star.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(F.col(alias).desc(), F.col(col).asc())
    )


def mean_by(star: DataFrame, group_col: str, value_col: str, decimals: int = 1) -> DataFrame:
    """Mean of ``value_col`` per group, half-even rounded, ascending."""
    return (
        star.filter(F.col(group_col).isNotNull())
        .groupBy(group_col)
        .agg(round_half_even(F.avg(F.col(value_col)), decimals).alias(value_col))
        .orderBy(F.col(value_col).asc_nulls_last(), F.col(group_col).asc())
    )


def top_k(star: DataFrame, group_col: str | Sequence[str], k: int = 10, alias: str = "total_citas") -> DataFrame:
    """The ``k`` most frequent values of ``group_col``; ties broken by value ascending.

    Several columns (name and id, say) keep apart what one of them would merge;
    rows without the first are left out.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``k`` after the partial count, so only ``k`` rows per task move.
    """
    cols = [group_col] if isinstance(group_col, str) else list(group_col)
    return (
        star.filter(F.col(cols[0]).isNotNull())
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(alias))
        .orderBy(F.col(alias).desc(), *[F.col(c).asc() for c in cols])
        .limit(k)
    )


def domain(star: DataFrame, col: str) -> DataFrame:
    """Distinct non-NULL values of ``col``, sorted (a filter's choice list)."""
    return star.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)
