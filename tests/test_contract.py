"""The registry: every query has a SQL twin and a plan without nested loops over big sides."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
import workload
from conftest import SF, plan
from tools.compare import TABLES, compare

QUERIES, SQL = workload.QUERIES, workload.SQL
SAMPLE = ["company_table", "kpi_parameter_42", "windows_all_anchors", "breakdown_channel", "reload_panel_a_milk",
          "load_panel_e_others", "load_panel_d_union", "product_or_join", "new_products_not_in", "derived_measures_tall",
          "dim_calendar_daily", "top6_trend", "monthly_yoy", "dq_referential", "format_es_columns", "wide_fact", "flat_extract",
          "trend_matrix_pivot", "dynamic_report_subtotals", "sales_in_calendar_quarter", "reload_after_emptied_period",
          "append_exactly_once", "stream_panel_d_union", "star_csv_round_trip", "staging_to_report"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) and len(QUERIES) > 150
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["manufacturer", "sales", "share", "bps", "growth", "pct_growth", "has_prior"]
    assert df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    found = cursor.fetchall()
    problem = compare([tuple(r) for r in df.collect()], df.columns, found, [d[0] for d in cursor.description])
    assert problem is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("dim_calendar_daily",)][::4])
def test_plans_have_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", ["kpi_card_l6m", "window_comparison", "bps_by_window", "monthly_yoy", "segment_table", "dynamic_report"])
def test_windows_reach_the_scan(spark, name):
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES[name](spark, SF))
