"""Flag-don't-drop quality rules (Silver layer).

A :class:`Rule` names a flag and the predicate that raises it; a
:class:`Repair` replaces a column's value. :func:`apply_rules` evaluates every
predicate on the *input* values and applies the repairs in the same
``select`` - so a flag always describes the value as it arrived - and gathers
the raised flags, in rule order and without NULLs, into one
``array<string>`` column (empty when the row is clean).

The whole rule set compiles to one projection: no shuffle, no UDF, one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flagstar.operators.dedup import dedup_by_key

FLAG_COL = "data_quality_flag"

PredicateLike = Column | str | Callable[[], Column]


def _resolve(pred: PredicateLike) -> Column:
    if isinstance(pred, Column):
        return pred
    if isinstance(pred, str):
        return F.expr(pred)
    return pred()


@dataclass(frozen=True)
class Rule:
    """Raise ``flag`` on rows where ``predicate`` is TRUE (NULL = not raised).

    ``columns``: what the rule judges; by default, the columns its predicate reads.
    """

    flag: str
    predicate: PredicateLike
    columns: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Repair:
    """Replace ``column`` with ``value`` (evaluated on the input row)."""

    column: str
    value: PredicateLike


@dataclass(frozen=True)
class TableSpec:
    """Everything Silver needs to know about one table.

    ``key`` is the primary key used for deduplication; ``order_by`` the
    tie-break that decides which duplicate survives (default: all other
    columns ascending). ``types`` maps columns to the SQL type they must have
    in Silver; values that do not parse become NULL via ``try_cast`` instead of
    failing the job, so a rule can flag them.
    """

    name: str
    key: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    repairs: tuple[Repair, ...] = ()
    order_by: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)


def flag_array(rules: Iterable[Rule]) -> Column:
    """``array<string>`` of the flags raised by ``rules``, in rule order.

    Rules that share a flag name are OR-ed, so a flag appears at most once.
    """
    merged: dict[str, Column] = {}
    for rule in rules:
        pred = _resolve(rule.predicate)
        merged[rule.flag] = (merged[rule.flag] | pred) if rule.flag in merged else pred
    if not merged:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(p, F.lit(f)) for f, p in merged.items()]))


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    repairs: Sequence[Repair] = (),
    flag_col: str = FLAG_COL,
) -> DataFrame:
    """Add ``flag_col`` and apply ``repairs`` in a single projection.

    Flags are computed from the input columns, never from repaired values.
    """
    repaired = {r.column: _resolve(r.value) for r in repairs}
    unknown = set(repaired) - set(df.columns)
    if unknown:
        raise ValueError(f"repairs on unknown columns: {sorted(unknown)}")
    cols = [repaired[c].alias(c) if c in repaired else F.col(c) for c in df.columns if c != flag_col]
    return df.select(*cols, flag_array(rules).alias(flag_col))


INTEGER_TYPES = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def parsed(column: str, kind: str) -> Column:
    """``column`` as ``kind``; NULL where it does not parse. Integer types also
    take whole numbers written with zero decimals (``12.0``)."""
    value = F.col(column).try_cast(kind)
    if kind.lower() not in INTEGER_TYPES:
        return value
    whole = F.regexp_extract(F.col(column).cast("string"), r"^\s*([+-]?[0-9]+)\.0+\s*$", 1)
    return F.coalesce(value, whole.try_cast(kind))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns with :func:`parsed`: unparseable text becomes NULL, not an error."""
    if not types:
        return df
    texts = {name for name, kind in df.dtypes if kind == "string"}
    cast = lambda c: parsed(c, types[c]) if c in texts else F.col(c).try_cast(types[c])
    return df.select(*[cast(c).alias(c) if c in types else F.col(c) for c in df.columns])


def quality_summary(df: DataFrame, table: str, flag_col: str = FLAG_COL) -> DataFrame:
    """One row: ``table, total_rows, flagged_rows, pct_flagged`` in one pass."""
    flagged = F.count_if(F.size(F.col(flag_col)) > 0)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        flagged.alias("flagged_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        "total_rows",
        "flagged_rows",
        F.coalesce(
            F.lit(100.0) * F.col("flagged_rows") / F.nullif(F.col("total_rows"), F.lit(0)),
            F.lit(0.0),
        ).alias("pct_flagged"),
    )


def flag_audit(df: DataFrame, flag_col: str = FLAG_COL) -> DataFrame:
    """How many rows carry each flag: ``flag, rows``.

    ``explode`` then ``groupBy``: the partial aggregate collapses each flag on
    the map side, so a flag carried by most rows does not skew a reducer.
    """
    return (
        df.select(F.explode(F.col(flag_col)).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def clean_rows(df: DataFrame, flag_col: str = FLAG_COL) -> DataFrame:
    """Rows with no flag (``size(flags) = 0``)."""
    return df.filter(F.size(F.col(flag_col)) == 0)


def dirty_rows(df: DataFrame, flag_col: str = FLAG_COL) -> DataFrame:
    """Rows with at least one flag (``size(flags) > 0``)."""
    return df.filter(F.size(F.col(flag_col)) > 0)


def rule_columns(df: DataFrame, rule: Rule) -> set[str]:
    """The columns of ``df`` that a rule judges, from its resolved expression."""
    if rule.columns is not None:
        return set(rule.columns)
    plan = df.select(_resolve(rule.predicate).alias("rule"))._jdf.queryExecution().analyzed()
    found, each = set(), plan.expressions().iterator()
    while each.hasNext():
        references = each.next().references().iterator()
        while references.hasNext():
            found.add(references.next().name())
    return found


UNPARSED_PREFIX = "valor_no_interpretable_"
_RAW = "__flagstar_raw_"


def refine(df: DataFrame, spec: TableSpec, flag_col: str = FLAG_COL) -> DataFrame:
    """Bronze -> Silver for one table: types, deterministic dedup, rules, repairs.

    A text value that does not parse becomes NULL and its row carries a flag:
    that of a rule on this very column which objects to the row, or else
    ``valor_no_interpretable_<column>``; flags of other columns don't stand for it. A key that does not parse stays the
    key: such rows are told apart by their raw text, never merged as one NULL.
    """
    texts = {name for name, kind in df.dtypes if kind == "string"}
    watched = [c for c in spec.types if c in texts]
    kept = df.withColumns({f"{_RAW}{c}": F.col(c) for c in watched}) if watched else df
    out = typed(kept, spec.types)
    failed = {c: F.col(c).isNull() & (F.trim(F.col(f"{_RAW}{c}")) != "") for c in watched}
    if watched:
        out = out.withColumns({f"{_RAW}{c}": F.when(p, F.col(f"{_RAW}{c}")) for c, p in failed.items()})
    keys = [*spec.key, *[f"{_RAW}{c}" for c in spec.key if c in watched]]
    out = dedup_by_key(out, keys, list(spec.order_by) or None)
    judged = [(_resolve(r.predicate), rule_columns(out, r)) for r in spec.rules] if watched else []
    unparsed = []
    for c in watched:
        objections = [F.coalesce(p, F.lit(False)) for p, columns in judged if c in columns]
        lost = F.col(f"{_RAW}{c}").isNotNull()
        unparsed.append(Rule(f"{UNPARSED_PREFIX}{c}", reduce(lambda x, p: x & ~p, objections, lost)))
    return apply_rules(out, [*spec.rules, *unparsed], spec.repairs, flag_col).drop(*[f"{_RAW}{c}" for c in watched])
