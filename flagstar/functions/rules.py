"""Predicate builders for quality rules.

Each builder returns a boolean Column that is TRUE when a value breaks the
rule. Following SQL three-valued logic, a NULL input yields NULL ("not
flagged") unless ``null_is_bad=True``; that mirrors how the flags behave when a
``CASE WHEN bad THEN flag END`` meets a NULL.

All builders are plain Spark SQL expressions: they stay in whole-stage codegen
and can be pushed into Parquet scans when used as filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.lit(_dt.date.fromisoformat(str(value)))


def _null_guard(bad: Column, col: Column, null_is_bad: bool) -> Column:
    return (bad | col.isNull()) if null_is_bad else bad


def is_missing(col: ColumnLike) -> Column:
    """Value is NULL (also the result of an unparseable ``try_cast``)."""
    return _c(col).isNull()


def regex_mismatch(col: ColumnLike, pattern: str, null_is_bad: bool = False) -> Column:
    """Value does not match ``pattern`` (Java regex, ``find`` semantics)."""
    c = _c(col)
    return _null_guard(~c.rlike(pattern), c, null_is_bad)


def regex_match(col: ColumnLike, pattern: str) -> Column:
    """Value contains a match of ``pattern`` (e.g. personal data in free text)."""
    return _c(col).rlike(pattern)


# Fixed value: the "e-mail-like token somewhere in a text" language,
# ``[^@\s]+@[^@\s]+\.[^@\s]+`` with find semantics. Java's backtracking
# engine needs quadratic time on a long run without '@' (it retries from every
# position in the run), so whole texts are scanned with this equivalent form:
# a match may only start where a token starts (any match can be moved left to
# one), and the part before '@' never gives characters back (it cannot hold
# '@'). Linear per text; the same rows match.
EMAIL_TOKEN_PATTERN = r"(?<![^@\s])[^@\s]++@[^@\s]+\.[^@\s]+"


def contains_email(col: ColumnLike) -> Column:
    """Text contains an e-mail-like token (linear-time on whole texts)."""
    return _c(col).rlike(EMAIL_TOKEN_PATTERN)


def outside_range(col: ColumnLike, low=None, high=None, null_is_bad: bool = False) -> Column:
    """``col < low OR col > high``; the bounds themselves are valid."""
    c = _c(col)
    parts = []
    if low is not None:
        parts.append(c < F.lit(low))
    if high is not None:
        parts.append(c > F.lit(high))
    if not parts:
        raise ValueError("outside_range needs at least one bound")
    bad = parts[0]
    for p in parts[1:]:
        bad = bad | p
    return _null_guard(bad, c, null_is_bad)


def outside_dates(col: ColumnLike, min_date, as_of, null_is_bad: bool = False) -> Column:
    """Date must be on/after ``min_date`` and strictly before ``as_of``.

    ``as_of`` replaces ``current_date()`` so that reruns give the same flags;
    pass ``F.current_date()`` to get the run-day behaviour.
    """
    c = F.to_date(_c(col))
    bad = (c >= _date(as_of)) | (c < _date(min_date))
    return _null_guard(bad, c, null_is_bad)


def negative(col: ColumnLike, null_is_bad: bool = False) -> Column:
    """``col < 0``; zero is valid."""
    c = _c(col)
    return _null_guard(c < F.lit(0), c, null_is_bad)


def clamp_below(col: ColumnLike, floor_value=0) -> Column:
    """Repair: values below ``floor_value`` become ``floor_value``; NULL stays NULL.

    Written as CASE rather than ``greatest``, which would turn NULL into the
    floor value.
    """
    c = _c(col)
    return F.when(c < F.lit(floor_value), F.lit(floor_value).cast("int")).otherwise(c)
