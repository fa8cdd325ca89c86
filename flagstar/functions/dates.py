"""Date helpers for calendar keys and ages."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """A date literal from a ``date``/ISO string, or a Column passed through."""
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    if not isinstance(value, _dt.date):
        value = _dt.date.fromisoformat(str(value))
    return F.lit(value)


def date_key(col: Column | str) -> Column:
    """Smart date key ``yyyyMMdd`` as int, computed arithmetically.

    Equal to ``cast(date_format(d, 'yyyyMMdd') as int)`` but without string
    formatting in the hot path.
    """
    d = F.to_date(F.col(col) if isinstance(col, str) else col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def age_years(birth: Column | str, as_of, exact: bool = False) -> Column:
    """Age in whole years at ``as_of``.

    Default (``exact=False``) is ``floor(days / 365.25)``, the approximation the
    source model uses; it is off by one around some birthdays. ``exact=True``
    counts completed birthdays: year difference minus one when the
    (month, day) of ``as_of`` comes before that of the birth date.
    """
    b = F.to_date(F.col(birth) if isinstance(birth, str) else birth)
    ref = as_date(as_of)
    if not exact:
        return F.floor(F.datediff(ref, b) / F.lit(365.25)).cast("int")
    before_birthday = (F.month(ref) < F.month(b)) | (
        (F.month(ref) == F.month(b)) & (F.dayofmonth(ref) < F.dayofmonth(b))
    )
    return (F.year(ref) - F.year(b) - F.when(before_birthday, 1).otherwise(0)).cast("int")


def is_weekend(col: Column | str) -> Column:
    """Saturday or Sunday (``dayofweek``: 1 = Sunday ... 7 = Saturday)."""
    d = F.col(col) if isinstance(col, str) else col
    return F.dayofweek(d).isin(1, 7)
