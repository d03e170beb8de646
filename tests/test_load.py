"""Panel loads into a warehouse, batch and stream."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from panelwright.plans import panels
from panelwright.schemas import MAPPINGS, STAGING, STAR_COLUMNS, star_schema
from panelwright.sources import star_csv
from panelwright.sources.layers import Warehouse
from panelwright.sources.rows import inline_rows
from panelwright.plans import star
from panelwright.streaming.reload import start_panel_stream

MILK = STAGING["STG_PT_PANEL_A_MILK"]


def milk(code, day, value, loaded, name="MILK"):
    amount = decimal.Decimal(value)
    return (name, code, "202401", f"{day:02d}/01/2024", f"{day:02d}/01/2024", amount, amount, amount, "file",
            dt.datetime(2024, 2, loaded))


def maps(spark):
    data = {
        "MAP_PT_CHANNEL": [("PANEL_A_MILK", "panel_a_milk ", 5)],
        "MAP_PT_SALES_TYPE": [("OTHER", "x", 1)],
        "MAP_ES_CHANNEL": [], "MAP_ES_SALES_TYPE": [], "MAP_ES_UNITS": [("PANEL_F", "vol", 1)],
    }
    return {m: inline_rows(spark, MAPPINGS[m], r) for m, r in data.items()}


def deliver(warehouse, table, schema, data):
    warehouse.append(inline_rows(warehouse.spark, schema, data), "BRONZE_STG", table)


def set_up(warehouse):
    for name, df in maps(warehouse.spark).items():
        warehouse.replace(df, "SILVER_DWH", name)


def fact(warehouse, table="FACT_PT_PANEL_A_MILK"):
    df = warehouse.read("SILVER_DWH", table)
    return [(p, c, float(v)) for p, c, v in rows(
        df.select("PER_DSC", "PDT_COD", "SO_VALUES"), F.col("PER_DSC").asc_nulls_last(), "PDT_COD", "SO_VALUES")]


def test_reload_replaces_delivered_periods(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    deliver(warehouse, panel.staging, MILK, [milk("p1", 1, 10, 1), milk("p1", 2, 20, 1), milk("p2", 3, 30, 1),
                                             milk("p1", 1, 5, 1, "TOTAL")])
    panels.run(panel, warehouse)
    assert fact(warehouse) == [(20240101, "p1", 10.0), (20240102, "p1", 20.0), (20240103, "p2", 30.0)]
    codes = warehouse.read("SILVER_DWH", panel.target).select("CHL_COD", "SAL_TYP_COD").distinct()
    assert rows(codes) == [(5, 99)]

    # a later delivery corrects one day and leaves another with its total only
    deliver(warehouse, panel.staging, MILK, [milk("p1", 2, 21, 2), milk("p1", 2, 22, 3), milk("p3", 3, 1, 3, "TOTAL")])
    panels.run(panel, warehouse)
    expected = [(20240101, "p1", 10.0), (20240102, "p1", 22.0)]
    assert fact(warehouse) == expected
    panels.run(panel, warehouse)  # nothing new: nothing changes
    assert fact(warehouse) == expected


def test_reload_keeps_rows_without_a_period(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    bad = list(milk("p9", 1, 1, 1))
    bad[3] = "soon"
    deliver(warehouse, panel.staging, MILK, [tuple(bad), milk("p1", 1, 10, 1)])
    panels.run(panel, warehouse)
    bad[1], bad[-1] = "p8", dt.datetime(2024, 2, 5)
    deliver(warehouse, panel.staging, MILK, [tuple(bad), milk("p1", 1, 11, 5)])
    panels.run(panel, warehouse)
    assert fact(warehouse) == [(20240101, "p1", 11.0), (None, "p8", 1.0), (None, "p9", 1.0)]


def test_reload_rewrites_only_its_partitions(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    deliver(warehouse, panel.staging, MILK, [milk("p1", 1, 10, 1), milk("p1", 2, 20, 1)])
    panels.run(panel, warehouse)
    files = lambda: {r[0] for r in warehouse.read("SILVER_DWH", panel.target).select(
        F.input_file_name()).distinct().collect()}
    before = files()
    deliver(warehouse, panel.staging, MILK, [milk("p1", 2, 21, 2)])
    panels.run(panel, warehouse)
    assert len(before & files()) == 1


def test_emptied_period_stays_empty(warehouse):
    """A delivery of totals only empties its period; an older delivery of it must not come back with the next load."""
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    for data in ([milk("p1", 1, 10, 1)], [milk("p2", 2, 20, 2)], [milk("p2", 2, 1, 3, "TOTAL")], [milk("p4", 4, 40, 4)]):
        deliver(warehouse, panel.staging, MILK, data)
        panels.run(panel, warehouse)
    assert fact(warehouse) == [(20240101, "p1", 10.0), (20240104, "p4", 40.0)]
    assert warehouse.staged_to("SILVER_DWH", panel.target) == dt.datetime(2024, 2, 4)


def test_repeated_batch_changes_nothing(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    bad = list(milk("p9", 1, 1, 1))
    bad[3] = "soon"
    batch = panels.load(panel, {panel.staging: inline_rows(warehouse.spark, MILK, [tuple(bad), milk("p1", 1, 10, 1)])}, maps(warehouse.spark))
    for _ in range(3):
        warehouse.reload(batch, "SILVER_DWH", panel.target)
        assert fact(warehouse) == [(20240101, "p1", 10.0), (None, "p9", 1.0)]


def test_lost_log_entry(warehouse):
    """A load that ended before its log entry is repeated: a reload gives the same, an append adds nothing."""
    set_up(warehouse)
    milk_, panel_f = panels.PANELS["PANEL_A_MILK"], panels.PANELS["PANEL_F"]
    deliver(warehouse, milk_.staging, MILK, [milk("p1", 1, 10, 1)])
    deliver(warehouse, panel_f.staging, STAGING[panel_f.staging], [("m", "g", "c", "VOL", "202401", None, "file", dt.datetime(2024, 1, 1))])
    for panel in (milk_, panel_f):
        panels.run(panel, warehouse)
    warehouse.replace(warehouse.spark.createDataFrame([], "TARGET string, STAGED_TO string"), "SILVER_DWH", "LOAD_LOG")
    for panel in (milk_, panel_f):
        panels.run(panel, warehouse)
        assert warehouse.read("SILVER_DWH", panel.target).count() == 1


def test_catalog_reload(spark):
    """The same loads on catalog tables."""
    layers = ["BRONZE_STG", "SILVER_DWH"]
    try:
        for layer in layers:
            spark.sql(f"CREATE DATABASE {layer}")
        warehouse = Warehouse(spark, database="spark_catalog")
        set_up(warehouse)
        panel = panels.PANELS["PANEL_A_MILK"]
        for data in ([milk("p1", 1, 10, 1), milk("p2", 2, 20, 1)], [milk("p2", 2, 1, 3, "TOTAL")], [milk("p1", 1, 11, 4), milk("p4", 4, 40, 4)]):
            deliver(warehouse, panel.staging, MILK, data)
            panels.run(panel, warehouse)
        assert fact(warehouse) == [(20240101, "p1", 11.0), (20240104, "p4", 40.0)]
    finally:
        for layer in layers:
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_append_panel(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_F"]
    row = ("m", "g", " cat ", "VOL ", "202401", None, "file", dt.datetime(2024, 1, 1))
    deliver(warehouse, panel.staging, STAGING[panel.staging], [row])
    panels.run(panel, warehouse)
    panels.run(panel, warehouse)
    got = warehouse.read("SILVER_DWH", panel.target).select("PDT_PCK", "KPI_FLG_COD", "CHL_COD", "KPI_VAL", "SRC_COD")
    assert rows(got) == [("CAT", 1, 99, decimal.Decimal("0.0000"), 2)]


@pytest.mark.parametrize("name", list(panels.PANELS))
def test_every_panel_loads_an_empty_delivery(spark, name):
    panel = panels.PANELS[name]
    tables = {t: inline_rows(spark, STAGING[t], []) for t in (list(panel.feed_sources.values()) or [panel.staging])}
    out = panels.load(panel, tables, maps(spark))
    assert out.columns == panel.output and out.count() == 0


def test_stream_loads_each_file_once(warehouse, tmp_path):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    maps_ = {m: warehouse.read("SILVER_DWH", m) for m in ["MAP_PT_CHANNEL", "MAP_PT_SALES_TYPE"]}
    for data in ([milk("p1", 1, 10, 1), milk("p1", 2, 20, 1)], [milk("p1", 2, 21, 2)], []):
        if data:
            deliver(warehouse, panel.staging, MILK, data)
        start_panel_stream(panel, warehouse, maps_, str(tmp_path / "cp")).awaitTermination()
    assert fact(warehouse) == [(20240101, "p1", 10.0), (20240102, "p1", 21.0)]
    with pytest.raises(ValueError):
        start_panel_stream(panels.PANELS["PANEL_F"], Warehouse(warehouse.spark, database="spark_catalog"), maps_)


def test_star_tables(warehouse):
    star.create_star_tables(warehouse)
    assert warehouse.read("GOLD_STAR", "DIM_PROD").count() == 0
    assert warehouse.read("GOLD_STAR", "DIM_UNITS").count() == 4
    assert star.units_catalogue(warehouse.spark).filter("KPI_FLG_COD = 99").count() == 1
    with pytest.raises(ValueError):
        warehouse.path("NOWHERE", "T")
    with pytest.raises(ValueError):
        Warehouse(warehouse.spark)


def test_csv_round_trip(spark, tmp_path):
    data = [(1, "Volume", "Kg", "Volumen Kg"), (2, "Value", "EUR", "Valor €")]
    df = inline_rows(spark, star_schema("DIM_UNITS"), data)
    star_csv.write_csv(star_csv.with_star_headers(df, "DIM_UNITS"), str(tmp_path / "DIM_UNITS.csv"), single_file=True)
    assert rows(star_csv.read_star_csv(spark, str(tmp_path), "DIM_UNITS"), "kpi_flag_id") == data


def test_calendar_csv_types(spark, tmp_path):
    header = ",".join(h for h, _, _ in STAR_COLUMNS["DIM_CALENDAR"])
    (tmp_path / "DIM_CALENDAR.csv").write_text(
        header + "\n2022-01-01,2022,1,1,Jan,January,202201,2022-01,2022-Q1,2021,2021-01-01,0,0\n")
    row = star_csv.read_star_csv(spark, str(tmp_path), "DIM_CALENDAR").first()
    assert row["period_name"] == "2022-01" and row["date"] == dt.date(2022, 1, 1) and row["period_id"] == 202201


def test_lines_are_joined_in_more_tasks_as_they_grow(spark, sf, monkeypatch):
    from workload import staging

    whole = staging.base(spark, sf)
    assert staging.tasks_for(spark, sf) is None and "REPARTITION_BY_NUM" not in plan(whole)
    monkeypatch.setattr(staging, "LINES_A_TASK", 10_000)
    tasks = staging.tasks_for(spark, sf)
    monkeypatch.setattr(staging, "LINES_A_TASK", 5_000)
    assert tasks > spark.sparkContext.defaultParallelism and 2 * tasks - 1 <= staging.tasks_for(spark, sf) <= 2 * tasks
    dealt = staging.base(spark, sf)
    assert dealt.rdd.getNumPartitions() == staging.tasks_for(spark, sf)  # not merged by the bytes they read
    assert dealt.count() == whole.count() and dealt.exceptAll(whole).isEmpty()
    assert "l_tax" not in plan(dealt) and "PushedFilters: [IsNotNull(l_orderkey)" in plan(dealt)
