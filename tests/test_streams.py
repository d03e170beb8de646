"""Streams of one feed and of unions of feeds against the batch loads."""

import datetime as dt
import decimal

import pytest

from panelwright.plans import panels
from panelwright.schemas import MAPPINGS, STAGING
from panelwright.sources.layers import Warehouse
from panelwright.sources.rows import inline_rows
from panelwright.sources.versions import VersionedTable
from panelwright.streaming import reload as streams

MAPS = {
    "MAP_PT_CHANNEL": [("PANEL_D_MASS", "1", 21), ("PANEL_D_META", "2", 32)],
    "MAP_PT_SALES_TYPE": [("PANEL_D_MASS", "2", 202), ("PANEL_D_PHARMA", "3", 203), ("PANEL_D_MASS", "1", 211)],
}
NAMES = ["PANEL_D_UNION", "PANEL_D_UNION_TRA"]


def row(code, period, value, day):
    amount = decimal.Decimal(value)
    return {"GEO_COD": "g", "PDT_COD": code, "CHL_COD": "1", "PER_DSC": period, "SO_VALUES": amount, "SO_UNITS": amount, "SAL_VAL": amount,
            "SAL_UNT": amount, "LOA_DAT": dt.datetime(2024, 2, day)}


def deliver(warehouse, panel, feed, data):
    name = panel.feed_sources[feed]
    columns = inline_rows(warehouse.spark, STAGING[name], []).columns
    values = [tuple(row(*d).get(c) for c in columns) for d in data]
    warehouse.append(inline_rows(warehouse.spark, STAGING[name], values), panel.staging_layer, name)


def mappings(spark):
    return {m: inline_rows(spark, MAPPINGS[m], r) for m, r in MAPS.items()}


def new_warehouse(spark, path, panel):
    warehouse = Warehouse(spark, root=str(path))
    for name, df in mappings(spark).items():
        warehouse.replace(df, "SILVER_DWH", name)
    for feed in panel.feed_sources:
        deliver(warehouse, panel, feed, [])
    return warehouse


def table(warehouse, panel):
    df = warehouse.read_or_none(panel.target_layer, panel.target)
    return [] if df is None else sorted((tuple(map(str, r)) for r in df.select(*panel.output).collect()))


def stream(panel, warehouse, path):
    streams.start_panel_stream(panel, warehouse, mappings(warehouse.spark), str(path / "cp")).awaitTermination()


@pytest.mark.parametrize("name", NAMES)
def test_a_late_feed(spark, tmp_path, name):
    """A period waits until its last feed is there; afterwards the table is what a batch load makes of all deliveries."""
    panel = panels.PANELS[name]
    flowing, at_once = new_warehouse(spark, tmp_path / "s", panel), new_warehouse(spark, tmp_path / "b", panel)
    deliveries = [
        {"PANEL_D_MASS": [("a", "202401", 1, 1), ("b", "20240215", 2, 1)], "PANEL_D_META": [("a", "202401", 3, 1), ("a", "202401", 3, 2)]},
        {"PANEL_D_PHARMA": [("c", "20240216", 4, 3)], "PANEL_D_META": [("d", "202402", 5, 3), ("x", None, 9, 3)]},
        {"PANEL_D_PHARMA": [("c", "202401", 6, 4), ("e", "202403", 7, 4)]},
    ]
    seen = []
    for arrivals in deliveries:
        for feed, data in arrivals.items():
            deliver(flowing, panel, feed, data)
            deliver(at_once, panel, feed, data)
        stream(panel, flowing, tmp_path)
        seen.append(sorted({r[panel.output.index("PER_DSC")] for r in table(flowing, panel)}))
    assert [len(x) for x in seen[:1]] == [0] and "202401" not in seen[1] and "202402" in seen[1]
    assert streams.waiting(panel, flowing) == {"202403": ["PANEL_D_PHARMA"]}
    panels.run(panel, at_once)
    period = panel.output.index("PER_DSC")
    assert table(flowing, panel) == [r for r in table(at_once, panel) if r[period] != "202403"]
    streams.release(panel, flowing, mappings(spark), ["202403", "209901"], 1)
    streams.release(panel, flowing, mappings(spark), ["202403"], 1)
    assert table(flowing, panel) == table(at_once, panel) and streams.waiting(panel, flowing) == {}


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_crash_at_each_step(spark, tmp_path, monkeypatch, step):
    """The commit of the inbox, of the target and of what has left the inbox: each may be the last one that came through."""
    panel = panels.PANELS["PANEL_D_UNION_TRA"]
    warehouse = new_warehouse(spark, tmp_path / "s", panel)
    for k, feed in enumerate(panel.feed_sources):
        deliver(warehouse, panel, feed, [("a", "202401", k + 1, 1)])
    publish, commits = VersionedTable._publish, []

    def crash_after(self, manifest):
        done = publish(self, manifest)
        commits.append(manifest.version)
        if len(commits) == step:
            raise RuntimeError("lost")
        return done

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_publish", crash_after)
        with pytest.raises(Exception, match="lost"):
            stream(panel, warehouse, tmp_path)
    stream(panel, warehouse, tmp_path)
    assert sorted(float(r[panel.output.index("SAL_VAL")]) for r in table(warehouse, panel)) == [1.0, 2.0, 3.0]
    assert streams.waiting(panel, warehouse) == {}
    assert warehouse.read(panel.target_layer, streams.inbox_of(panel)).count() == 0


def test_all_feeds_deliver_a_period_again(spark, tmp_path):
    panel = panels.PANELS["PANEL_D_UNION"]
    warehouse = new_warehouse(spark, tmp_path / "s", panel)
    for day, value in ((1, 10), (2, 20)):
        for feed in panel.feed_sources:
            deliver(warehouse, panel, feed, [("a", "202401", value, day)])
        stream(panel, warehouse, tmp_path)
    got = warehouse.read(panel.target_layer, panel.target)
    assert [float(r[0]) for r in got.select("SO_VALUES").collect()] == [20.0] * 3
    deliver(warehouse, panel, "PANEL_D_MASS", [("a", "202401", 30, 3)])
    stream(panel, warehouse, tmp_path)
    assert warehouse.read(panel.target_layer, panel.target).filter("SO_VALUES = 30").count() == 0
    assert streams.waiting(panel, warehouse) == {"202401": ["PANEL_D_MASS"]}


def test_feeds_need_commits(spark):
    with pytest.raises(ValueError):
        streams.start_panel_stream(panels.PANELS["PANEL_D_UNION"], Warehouse(spark, database="spark_catalog"), {})
