"""Star-schema builders (Gold layer).

Dimensions are projections of Silver tables, the calendar is generated from
the fact's date range plus one "unknown" member (Kimball's technique for facts
whose date is missing), and the fact carries a smart date key that points at
that member instead of NULL.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.functions.dates import age_years, date_key, is_weekend
from flagstar.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from flagstar.operators.quality import FLAG_COL

# Fixed values of the Gold date dimension contract.
UNKNOWN_DATE_ID = -1
UNKNOWN_DATE_LABEL = "Desconocido"
CALENDAR_COLUMNS = ("id_tiempo", "fecha", "dia_semana", "mes", "trimestre", "anio", "es_fin_de_semana")

# Days per calendar generation task; a century is ~36,500 days.
_DAYS_PER_PARTITION = 100_000


def project_dim(
    df: DataFrame,
    columns: Sequence[str | Column],
    forbidden: Sequence[str] = (),
) -> DataFrame:
    """Select the dimension's columns; refuse to expose ``forbidden`` ones."""
    out = df.select(*columns)
    leaked = set(forbidden) & set(out.columns)
    if leaked:
        raise ValueError(f"dimension would expose forbidden columns: {sorted(leaked)}")
    return out


def with_age(df: DataFrame, birth_col: str, as_of, alias: str = "edad", exact: bool = False) -> DataFrame:
    """Add an age-in-years column computed at ``as_of``."""
    return df.withColumn(alias, age_years(birth_col, as_of, exact=exact))


def date_bounds(df: DataFrame, ts_col: str) -> tuple[_dt.date | None, _dt.date | None]:
    """(min, max) calendar day of a date/timestamp column; NULLs ignored.

    One distributed aggregate over a single pruned column; only two scalars
    reach the driver.
    """
    d = F.to_date(F.col(ts_col))
    row = df.select(d.alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    return (row["lo"], row["hi"]) if row is not None else (None, None)


def calendar_days(spark: SparkSession, start: _dt.date, end: _dt.date, alias: str = "fecha") -> DataFrame:
    """One row per day in ``[start, end]``, generated in parallel by ``range``."""
    n_days = (end - start).days + 1
    if n_days <= 0:
        return spark.range(0).select(F.lit(None).cast("date").alias(alias))
    parts = max(1, -(-n_days // _DAYS_PER_PARTITION))
    return spark.range(0, n_days, 1, parts).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(alias)
    )


def date_attributes(d: Column, unknown_label: str = UNKNOWN_DATE_LABEL) -> list[Column]:
    """The date dimension's attributes as expressions of a day (NULL = unknown).

    One definition serves the generated calendar and :func:`with_date_attributes`,
    so both always agree.
    """
    return [
        d.alias("fecha"),
        F.coalesce(F.date_format(d, "EEEE"), F.lit(unknown_label)).alias("dia_semana"),
        F.month(d).alias("mes"),
        F.quarter(d).alias("trimestre"),
        F.year(d).alias("anio"),
        is_weekend(d).alias("es_fin_de_semana"),
    ]


def calendar_attributes(days: DataFrame, date_col: str = "fecha") -> DataFrame:
    """Attributes of the date dimension for a column of days."""
    d = F.col(date_col)
    return days.select(date_key(d).alias("id_tiempo"), *date_attributes(d))


def with_date_attributes(fact: DataFrame, ts_col: str, unknown_label: str = UNKNOWN_DATE_LABEL) -> DataFrame:
    """The fact plus the date dimension's attributes, computed from its own date.

    Equal, row for row, to joining the calendar built from the same fact: the
    calendar covers every fact date and its attributes are functions of the
    date. No calendar has to be sized, built or joined.
    """
    return fact.select("*", *date_attributes(F.to_date(F.col(ts_col)), unknown_label))


def unknown_member(
    spark: SparkSession, unknown_id: int = UNKNOWN_DATE_ID, label: str = UNKNOWN_DATE_LABEL
) -> DataFrame:
    """The single "unknown date" row, built JVM-side from literals."""
    return spark.range(1).select(
        F.lit(unknown_id).cast("int").alias("id_tiempo"),
        F.lit(None).cast("date").alias("fecha"),
        F.lit(label).cast("string").alias("dia_semana"),
        F.lit(None).cast("int").alias("mes"),
        F.lit(None).cast("int").alias("trimestre"),
        F.lit(None).cast("int").alias("anio"),
        F.lit(None).cast("boolean").alias("es_fin_de_semana"),
    )


def calendar_dim(
    df: DataFrame,
    ts_col: str,
    unknown_id: int = UNKNOWN_DATE_ID,
    unknown_label: str = UNKNOWN_DATE_LABEL,
) -> DataFrame:
    """Date dimension covering every day from the first to the last date of
    ``ts_col`` (gaps filled), plus the unknown member.

    With no dates at all only the unknown member is returned.
    """
    lo, hi = date_bounds(df, ts_col)
    return calendar_from_bounds(df.sparkSession, lo, hi, unknown_id, unknown_label)


def date_bound_metrics(ts_col: str) -> dict[str, Column]:
    """Aggregates for :func:`calendar_from_bounds`, to observe during a write."""
    d = F.to_date(F.col(ts_col))
    return {"date_lo": F.min(d), "date_hi": F.max(d)}


def calendar_size(lo: _dt.date | None, hi: _dt.date | None) -> int:
    """Rows of :func:`calendar_from_bounds`: the days in ``[lo, hi]`` plus the unknown member."""
    return 1 if lo is None or hi is None else max(0, (hi - lo).days + 1) + 1


def calendar_from_bounds(
    spark: SparkSession,
    lo: _dt.date | None,
    hi: _dt.date | None,
    unknown_id: int = UNKNOWN_DATE_ID,
    unknown_label: str = UNKNOWN_DATE_LABEL,
) -> DataFrame:
    """Date dimension for ``[lo, hi]`` plus the unknown member.

    Its size is exactly ``hi - lo + 2`` rows, known before any job runs.
    """
    member = unknown_member(spark, unknown_id, unknown_label)
    if lo is None or hi is None:
        return member
    return calendar_attributes(calendar_days(spark, lo, hi)).unionByName(member)


def fact_build(
    df: DataFrame,
    ts_col: str,
    columns: Sequence[str],
    date_key_col: str = "id_tiempo",
    has_flag_col: str = "tiene_flag_calidad",
    flag_col: str = FLAG_COL,
    unknown_id: int = UNKNOWN_DATE_ID,
) -> DataFrame:
    """Fact table at the grain of ``df`` (row count unchanged).

    ``columns`` lists the output columns in order; ``date_key_col`` becomes
    the ``yyyyMMdd`` key of ``ts_col`` (``unknown_id`` when NULL) and
    ``has_flag_col`` is ``size(flags) > 0``.
    """
    ts = F.col(ts_col)
    computed = {
        date_key_col: F.when(ts.isNotNull(), date_key(ts)).otherwise(F.lit(unknown_id)).cast("int"),
        has_flag_col: F.size(F.col(flag_col)) > 0,
    }
    return df.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in columns])


@dataclass(frozen=True)
class DimRef:
    """A dimension to join into the star: its frame, join key and renames."""

    df: DataFrame
    key: str
    rename: Mapping[str, str] = field(default_factory=dict)
    fact_key: str | None = None
    broadcast_max_rows: int = DEFAULT_BROADCAST_ROWS
    known_rows: int | None = None  # exact size when known by construction


def star_view(fact: DataFrame, dims: Sequence[DimRef]) -> DataFrame:
    """Inner-join the fact with its dimensions (orphan facts drop out).

    Colliding attribute names must be renamed through ``DimRef.rename``; the
    join keys appear once. Each dimension is broadcast only when its row
    count is under ``broadcast_max_rows``; otherwise the planner shuffles
    (and AQE splits skewed fact keys). Dimensions that may be shuffled are
    joined first, so that a shuffle moves the fact without the attributes of
    those that are broadcast for certain; the columns keep the order of ``dims``.
    """
    out, columns, joins = fact, list(fact.columns), []
    for ref in dims:
        dim = ref.df.withColumnsRenamed(dict(ref.rename)) if ref.rename else ref.df
        added = [c for c in dim.columns if c != ref.key]
        if clash := set(added) & set(columns):
            raise ValueError(f"columns {sorted(clash)} exist on both sides; rename them")
        fk = ref.fact_key or ref.key
        # as a join on a common column returns them: that column first
        columns = [fk, *[c for c in columns if c != fk], *added] if fk == ref.key else [*columns, *added]
        hinted = bounded_broadcast(dim, ref.broadcast_max_rows, ref.known_rows)
        joins.append((hinted is not dim, hinted, fk, ref.key))
    if all(fk in fact.columns for _, _, fk, _ in joins):  # none hangs on another's attribute
        joins.sort(key=lambda j: j[0])
    for _, dim, fk, key in joins:
        if fk == key:
            out = out.join(dim, on=key, how="inner")
        else:
            out = out.join(dim, out[fk] == dim[key], "inner").drop(dim[key])
    return out if out.columns == columns else out.select(*columns)
