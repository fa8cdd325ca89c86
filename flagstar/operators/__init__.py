"""DataFrame -> DataFrame operators: quality, dedup, star, integrity, marts, checks."""

from flagstar.operators.checks import (
    column_present,
    columns_absent,
    no_orphans,
    no_row_loss,
    not_null,
    null_date_flagged,
    pk_unique,
    run_checks,
    single_unknown_member,
)
from flagstar.operators.dedup import dedup_by_key, duplicate_count
from flagstar.operators.integrity import ForeignKey, enforce, orphan_count, orphan_report, orphans
from flagstar.operators.joins import bounded_broadcast
from flagstar.operators.marts import count_by, domain, kpis, mean_by, monthly, select_rows, top_k
from flagstar.operators.quality import (
    FLAG_COL,
    Repair,
    Rule,
    TableSpec,
    apply_rules,
    clean_rows,
    dirty_rows,
    flag_array,
    flag_audit,
    quality_summary,
    refine,
    typed,
)
from flagstar.operators.star import (
    DimRef,
    calendar_attributes,
    calendar_days,
    calendar_dim,
    calendar_from_bounds,
    calendar_size,
    date_bound_metrics,
    date_attributes,
    date_bounds,
    fact_build,
    project_dim,
    star_view,
    unknown_member,
    with_age,
    with_date_attributes,
)

__all__ = [name for name in dir() if not name.startswith("_")]
