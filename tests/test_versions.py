"""Tables that change by commits: readers, crashes, races, replays."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwright.plans import panels, quality
from panelwright.schemas import STAGING
from panelwright.sources.layers import Warehouse
from panelwright.sources.rows import inline_rows
from panelwright.sources.versions import Conflict, Receipt, VersionedTable
from panelwright.streaming import reload as streams
from test_load import MILK, deliver, fact, maps, milk, set_up

SCHEMA = "PER_DSC int, v int"
AT = ("SILVER_DWH", "FACT")


def content(warehouse):
    return rows(warehouse.read(*AT), F.col("PER_DSC").asc_nulls_last(), "v")


@pytest.fixture
def table(warehouse):
    warehouse.reload(inline_rows(warehouse.spark, SCHEMA, [(1, 10), (2, 20), (3, 30), (None, 0)]), *AT)
    return warehouse


def put(warehouse, data, gone=(), receipt=None):
    emptied = inline_rows(warehouse.spark, "PER_DSC int", [(p,) for p in gone])
    warehouse.reload(inline_rows(warehouse.spark, SCHEMA, data), *AT, emptied=emptied, receipt=receipt)


def test_a_reader_sees_old_or_new(table, monkeypatch):
    """Between a load's write and its commit, and with a plan made before the commit."""
    old = [(1, 10), (2, 20), (3, 30), (None, 0)]
    new = [(1, 11), (3, 30), (4, 40), (None, 0)]
    seen, publish, planned = [], VersionedTable._publish, table.read(*AT)

    def between(self, manifest):
        seen.append(content(table))
        return publish(self, manifest)

    monkeypatch.setattr(VersionedTable, "_publish", between)
    put(table, [(1, 11), (4, 40)], gone=[2])
    assert seen == [old] and content(table) == new
    assert rows(planned, F.col("PER_DSC").asc_nulls_last(), "v") == old


def test_a_crash_before_the_commit_changes_nothing(table, monkeypatch):
    old, version = content(table), table.manifest(*AT).version

    def crash(self, manifest):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_publish", crash)
        with pytest.raises(RuntimeError, match="lost"):
            put(table, [(1, 11)], gone=[2])
    assert content(table) == old and table.manifest(*AT).version == version
    put(table, [(1, 11)], gone=[2])
    assert content(table) == [(1, 11), (3, 30), (None, 0)]


def test_commits_at_the_same_time_both_count(table, monkeypatch):
    publish, others = VersionedTable._publish, iter([[(2, 22)]])

    def overtaken(self, manifest):
        for data in others:
            put(table, data)
        return publish(self, manifest)

    monkeypatch.setattr(VersionedTable, "_publish", overtaken)
    put(table, [(1, 11)])
    assert content(table) == [(1, 11), (2, 22), (3, 30), (None, 0)]


def test_the_same_rows_of_staging_are_not_taken_twice(table):
    first = Receipt(staged_to="2024-01-01")
    table.append(inline_rows(table.spark, SCHEMA, [(5, 50)]), *AT, "PER_DSC", first)
    next_ = Receipt(staged_from="2024-01-01", staged_to="2024-01-02")
    table.append(inline_rows(table.spark, SCHEMA, [(5, 51)]), *AT, "PER_DSC", next_)
    with pytest.raises(Conflict):
        table.append(inline_rows(table.spark, SCHEMA, [(5, 51)]), *AT, "PER_DSC", next_)
    assert content(table)[3:5] == [(5, 50), (5, 51)]
    assert table.staged_to(*AT) == dt.datetime(2024, 1, 2)


def test_a_replayed_micro_batch_adds_nothing(table):
    for batch in (0, 0, 1, 0, 1):
        table.append(inline_rows(table.spark, SCHEMA, [(9, batch)]), *AT, "PER_DSC", Receipt(query="q", batch=batch))
        put(table, [(8, batch), (None, batch + 5)], receipt=Receipt(query="r", batch=batch))
    assert [r for r in content(table) if r[0] in (8, 9)] == [(8, 1), (9, 0), (9, 1)]
    assert [v for p, v in content(table) if p is None] == [0, 5, 6]
    assert table.manifest(*AT).batches == {"q": 1, "r": 1}


def test_changes_between_versions(table):
    versions, start = table.versioned(*AT), table.manifest(*AT).version
    put(table, [(1, 11)], gone=[2, 77], receipt=Receipt(query="q", batch=0))
    table.append(inline_rows(table.spark, SCHEMA, [(4, 1)]), *AT, "PER_DSC")
    assert versions.changed_since(start) == {"PER_DSC=1", "PER_DSC=2", "PER_DSC=4"}
    assert versions.changed_since(start + 2) == set() and versions.changed_since(99) is None
    table.replace(inline_rows(table.spark, SCHEMA, [(4, 1)]), *AT, "PER_DSC")
    assert versions.changed_since(start) is None
    assert content(table) == [(4, 1)]


def test_vacuum_keeps_what_is_named(table):
    put(table, [(1, 11)], gone=[2], receipt=Receipt(query="q", batch=0))
    put(table, [(1, 12)], receipt=Receipt(query="q", batch=1))
    versions, now = table.versioned(*AT), content(table)
    assert versions.vacuum(versions=1) == []  # all folders are young
    gone = versions.vacuum(versions=1, older_than=dt.timedelta(0))
    assert sorted(g.split("/")[1] for g in gone) == ["PER_DSC=1", "PER_DSC=1", "PER_DSC=2"]
    assert content(table) == now and len(versions.versions()) == 1
    assert versions.changed_since(1) is None


def test_rows_of_a_plain_folder_stay(warehouse):
    df = inline_rows(warehouse.spark, SCHEMA, [(1, 10), (2, 20)])
    df.write.partitionBy("PER_DSC").parquet(warehouse.path(*AT))
    put(warehouse, [(2, 21)])
    assert content(warehouse) == [(1, 10), (2, 21)]


def test_empty_and_odd_tables(warehouse):
    warehouse.create_empty("`a b` int, `x.y` string", *AT)
    assert warehouse.read(*AT).columns == ["a b", "x.y"] and warehouse.read(*AT).count() == 0
    warehouse.append(inline_rows(warehouse.spark, "`a b` int, `x.y` string", [(1, "ä=/%")]), *AT)
    assert rows(warehouse.read(*AT)) == [(1, "ä=/%")]
    odd = ("GOLD_DMT", "ODD")
    data = [("a b/c=d%", 1), ("é", 2), (None, 3)]
    warehouse.reload(inline_rows(warehouse.spark, "PER_DSC string, v int", data), *odd)
    assert rows(warehouse.read(*odd), "v") == data


def test_a_load_reads_no_target(warehouse, monkeypatch):
    """An append-only panel knows from its commits how far it is."""
    set_up(warehouse)
    panel = panels.PANELS["PANEL_F"]
    read, asked = Warehouse.read, []
    monkeypatch.setattr(Warehouse, "read", lambda self, layer, table, schema=None: (asked.append(table), read(self, layer, table, schema))[1])
    for delivered in ([1], [2], []):
        for day in delivered:
            deliver(warehouse, panel.staging, STAGING[panel.staging], [("m", "g", f"c{day}", "VOL", "202401", None, "f", dt.datetime(2024, 1, day))])
        asked.clear()
        panels.run(panel, warehouse)
        assert panel.staging in asked and (panel.target not in asked or delivered == [1])
    assert read(warehouse, "SILVER_DWH", panel.target).count() == 2


def test_what_a_load_counts(warehouse):
    set_up(warehouse)
    panel = panels.PANELS["PANEL_A_MILK"]
    bad = list(milk("p9", 1, 1, 1))
    bad[3], bad[1] = "soon", None
    deliver(warehouse, panel.staging, MILK, [tuple(bad), milk("p1", 1, 10, 1), milk("p1", 2, 10, 2)])
    panels.run(panel, warehouse)
    counted = warehouse.manifest("SILVER_DWH", panel.target).metrics
    assert (counted["rows"], counted["without_period"], counted["PDT_COD_missing"], counted["SAL_TYP_COD_unmapped"]) == (3, 1, 1, 3)
    assert counted["first_stamp"].startswith("2024-02-01") and counted["last_stamp"].startswith("2024-02-02")
    deliver(warehouse, panel.staging, MILK, [milk("p1", 5, 10, 5)])
    panels.run(panel, warehouse)
    kept = {(r.version, r.metric): r.value for r in quality.load_metrics(warehouse, "SILVER_DWH", panel.target).collect()}
    assert kept[1, "rows"] == "3" and kept[2, "rows"] == "1"


@pytest.mark.parametrize("name", ["PANEL_F", "PANEL_G", "PANEL_H", "PANEL_I"])
def test_append_panels_as_streams(warehouse, tmp_path, monkeypatch, name):
    """A micro-batch whose commit is there but whose end the stream did not record is replayed, and adds nothing."""
    set_up(warehouse)
    panel = panels.PANELS[name]
    fields = inline_rows(warehouse.spark, STAGING[panel.staging], []).columns
    row = lambda day: tuple({"KPI_FLG": "VOL", "PER_DSC": "202401", "KPI_VAL": decimal.Decimal(day), "PDT_PCK": f"p{day}",
                             "CAT_DSC": f"c{day}", "PDT_DSC": f"d{day}", "LOA_DAT": dt.datetime(2024, 1, day)}.get(c) for c in fields)
    stream = lambda: streams.start_panel_stream(panel, warehouse, {m: warehouse.read("SILVER_DWH", m) for m in maps(warehouse.spark)},
                                                str(tmp_path / "cp")).awaitTermination()
    deliver(warehouse, panel.staging, STAGING[panel.staging], [row(1)])
    stream()
    deliver(warehouse, panel.staging, STAGING[panel.staging], [row(2)])
    append, crashed = Warehouse.append, []

    def crash_after(self, df, layer, table, *rest, **named):
        append(self, df, layer, table, *rest, **named)
        if table == panel.target and not crashed:
            crashed.append(True)
            raise RuntimeError("lost after the commit")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "append", crash_after)
        with pytest.raises(Exception, match="lost after the commit"):
            stream()
    assert crashed
    stream()
    stream()
    got = warehouse.read("SILVER_DWH", panel.target)
    assert sorted(float(r.KPI_VAL) for r in got.collect()) == [1.0, 2.0]


def test_catalog_overwrites_leave_the_session_alone(spark):
    """Also a table that was made with another mode."""
    try:
        spark.sql("CREATE DATABASE SILVER_DWH")
        warehouse = Warehouse(spark, database="spark_catalog")
        inline_rows(spark, SCHEMA, [(1, 10), (2, 20)]).write.partitionBy("PER_DSC").saveAsTable("SILVER_DWH.FACT")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "static")
        try:
            put(warehouse, [(2, 21)], gone=[7])
            assert spark.conf.get(mode) == "static"
        finally:
            spark.conf.set(mode, before)
        assert rows(warehouse.read(*AT).select("PER_DSC", "v"), "PER_DSC") == [(1, 10), (2, 21)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS SILVER_DWH CASCADE")
