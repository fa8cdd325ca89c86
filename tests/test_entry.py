"""Driver contract: entry, queries, oracle SQL, and plan properties."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from flagstar.plans.driver_tables import QUERIES
from helpers import SF_SMALL, plan_text

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["anio", "mes", "total_citas", "periodo"]
    assert len(rows) > 0


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def _norm(v):
    return v  # exact: doubles must agree to the last bit, as a value hash would require


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_at_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert {c: SAME_TYPE[spark_types[c]] for c in df.columns} == {c: duck_types[c] for c in df.columns}
    s_order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    s_rows = sorted((tuple(_norm(r[i]) for i in s_order) for r in df.collect()), key=repr)
    d_rows = sorted((tuple(_norm(r[i]) for i in d_order) for r in rel.fetchall()), key=repr)
    assert s_rows == d_rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    plan = plan_text(E.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{name}: {node} in plan"


def test_scans_read_only_needed_columns(spark):
    plan = plan_text(E.queries()["kpis"](spark, SF_SMALL))
    assert "l_discount" not in plan and "l_tax" not in plan and "c_acctbal" not in plan
    plan = plan_text(E.queries()["flag_date_bounds"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_latest_partition_prunes_partitions(spark):
    latest = E.queries()["latest_partition"](spark, SF_SMALL)
    folders = {f.rsplit("/", 1)[0] for f in latest.inputFiles()}
    assert len(folders) == 1 and "load_date=" in folders.pop()  # only the newest date's files are even listed


def test_calendar_join_never_drops_fact_rows(spark):
    """The calendar covers every fact date by construction, so marts that use
    no date attribute may leave it out: same rows either way."""
    from flagstar.operators.marts import kpis
    from flagstar.plans.driver_tables import star

    with_cal = star(spark, SF_SMALL)
    without = star(spark, SF_SMALL, with_calendar=False)
    cols = without.columns
    assert sorted(map(tuple, with_cal.select(*cols).collect())) == sorted(map(tuple, without.collect()))
    assert kpis(with_cal).first() == kpis(without).first()


def test_derived_date_attributes_equal_the_calendar_join(spark):
    """Date attributes computed from the fact's own date equal those joined
    from the generated calendar, for every row and column."""
    from flagstar.plans.driver_tables import star, star_with_dates

    joined = star(spark, SF_SMALL)
    derived = star_with_dates(spark, SF_SMALL)
    cols = sorted(joined.columns)
    assert cols == sorted(derived.columns)
    key = lambda r: repr(r)  # noqa: E731 - rows hold NULLs
    assert sorted(map(tuple, joined.select(*cols).collect()), key=key) == sorted(
        map(tuple, derived.select(*cols).collect()), key=key)
