"""Numeric helpers with pinned-down semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


HUGE = 1e24  # from here on a double's own steps are far beyond any money


def money_sum(col, scale: int = 6) -> Column:
    """Sum of a money column that does not depend on row order.

    Each value below 1e24 is cut in two: its multiple of ``10 ** -scale``, and
    what that leaves, to 32 decimals. Both are added as decimals, so neither
    small fractions nor cents beside large amounts are lost. Larger values are
    added as doubles, beside the others. The total is returned as double; where
    a decimal total overflows, all are added as doubles. An empty input gives 0.
    """
    value = _c(col).cast("double")
    small = F.abs(value) < HUGE
    main = F.when(small, value.cast(f"decimal(38,{scale})"))
    rest = F.when(small, (value - main.cast("double")).cast("decimal(38,32)"))
    cents, fractions = F.try_sum(main), F.try_sum(rest)
    huge = F.sum(F.when(small, F.lit(0.0)).otherwise(value))
    exact = cents.cast("double") + fractions.cast("double")
    together = F.coalesce(F.try_add(cents.cast(f"decimal(38,{2 * scale})"), fractions.cast(f"decimal(38,{2 * scale})")).cast("double"), exact)
    total = F.when(fractions == 0, cents.cast("double")).otherwise(together)
    return F.coalesce(total + huge, F.sum(value), F.lit(0.0))


def percent_of(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as double; 0 when ``whole`` is 0 or NULL."""
    return F.coalesce(
        F.lit(100.0).cast("double") * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)),
        F.lit(0.0),
    )


def round_half_even(col, decimals: int = 1) -> Column:
    """Banker's rounding (2.25 -> 2.2), the rule numpy/pandas ``round`` uses."""
    return F.bround(_c(col), decimals)
