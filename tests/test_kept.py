"""Rollups, run-time pruning, subtotals and lines set aside."""

import datetime as dt
import decimal
import re

import pytest
from pyspark.sql import functions as F

import test_change
from conftest import plan, rows
from panelwright.operators import lookup
from panelwright.plans import lineage, periods, reports, rollups, star
from panelwright.schemas import STAGING
from panelwright.sources import quarantine
from panelwright.sources.rows import inline_rows
from panelwright.sources.versions import VersionedTable

D = decimal.Decimal


@pytest.fixture
def loaded(warehouse):
    test_change.set_up(warehouse)
    data = [{"PDT_COD": c, "PER_DSC": f"{m:02d}/01/{y}", "SO_VALUES": D(v)} for y, m, c, v in [
        (2023, 1, "c1", 5), (2023, 1, "c2", 6), (2023, 12, "c1", 7), (2024, 1, "c1", 8), (2024, 1, "c2", 9), (2024, 1, "x", 1), (2024, 2, "c2", 10)]]
    test_change.staged(warehouse, "STG_PT_PANEL_C", data, test_change.amounts(1, 1))
    lineage.run(warehouse)
    return warehouse


def test_the_smallest_rollup_that_has_the_columns():
    sizes = {"AGG_COMPANY": 10, "AGG_COMPANY_CATEGORY": 50, "AGG_COMPANY_SLICERS": 400}
    pick = lambda columns, among=sizes: getattr(rollups.choose(among, columns), "table", None)
    assert pick(["manufacturer", "pidx", "value"]) == "AGG_COMPANY"
    assert pick(["category", "metric", "value"]) == "AGG_COMPANY_CATEGORY"
    assert pick(["channel", "value"]) == "AGG_COMPANY_SLICERS"
    assert pick(["product", "value"]) is None and pick(["manufacturer"], {}) is None
    assert pick(["manufacturer"], {"AGG_COMPANY_SLICERS": 4}) == "AGG_COMPANY_SLICERS"
    assert pick(["manufacturer"], {"AGG_COMPANY": 9, "AGG_COMPANY_CATEGORY": 8}) == "AGG_COMPANY_CATEGORY"


def reads(df, table):
    return any(f"/{table}/" in f for f in df.inputFiles())


def report_rows(market, calendar):
    market = market.filter("metric = 'Valor €'")
    sel = periods.resolve([2024], [1], "MES")
    months = calendar.select("pidx", "period_id")
    out = [reports.company_table(market, sel, months), reports.trend(market, "manufacturer", calendar=months),
           reports.monthly_yoy(market, "BELL", 2024, months)]
    return [sorted(tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in o.collect()) for o in out]


def test_reports_read_the_rollup(loaded, monkeypatch):
    columns = ["manufacturer", "metric", "pidx", "value"]
    market, calendar = rollups.market(loaded, columns)
    assert reads(market, "AGG_COMPANY") and not reads(market, "FACT_TABLE")
    kept = report_rows(market, calendar)
    from_fact = report_rows(*lineage.market(loaded, columns))
    assert kept == from_fact and all(kept)
    wide, _ = rollups.market(loaded, ["product", "value"])
    assert reads(wide, "FACT_TABLE")


def test_a_rollup_follows_the_dirty_period(loaded):
    before = {r.table: loaded.manifest("GOLD_STAR", r.table).parts for r in rollups.ROLLUPS}
    test_change.staged(loaded, "STG_PT_PANEL_C", [{"PDT_COD": "c1", "PER_DSC": "02/01/2024", "SO_VALUES": D(3)}], test_change.amounts(1, 2))
    lineage.run(loaded)
    for table, parts in before.items():
        now = loaded.manifest("GOLD_STAR", table).parts
        assert [p for p in now if now[p] != parts.get(p)] == ["period_id=202402"], table
    columns = ["category", "channel", "metric", "pidx", "value"]
    wide = lambda m: sorted((r.category, r.channel, r.metric, r.pidx, float(r.v)) for r in m.groupBy(*columns[:-1]).agg(F.sum("value").alias("v")).collect())
    assert wide(rollups.market(loaded, columns)[0]) == wide(lineage.market(loaded, columns)[0])


def test_the_star_is_joined_once_for_all_rollups(loaded, monkeypatch):
    joins, wide_fact = [], star.wide_fact
    monkeypatch.setattr(star, "wide_fact", lambda *a: joins.append(a[2]) or wide_fact(*a))
    test_change.staged(loaded, "STG_PT_PANEL_C", [{"PDT_COD": "c1", "PER_DSC": "02/01/2024", "SO_VALUES": None, "SO_KILOS": D(4)},
                                                  {"PDT_COD": "y", "PER_DSC": "03/01/2024", "SO_VALUES": D(5), "SO_KILOS": None}], test_change.amounts(1, 2))
    lineage.run(loaded)
    assert joins == [star.FLAT_COLUMNS]
    read = {t: loaded.read("GOLD_STAR", t) for t in ("FACT_TABLE", *star.RELATIONS)}
    for rollup in rollups.ROLLUPS:
        kept, joined = loaded.read("GOLD_STAR", rollup.table), rollup.of(read["FACT_TABLE"], read)
        assert sorted(map(str, kept.select(*joined.columns).collect())) == sorted(map(str, joined.collect()))
        assert dict(kept.dtypes) == dict(joined.dtypes)
    mart = loaded.read("GOLD_DMT", "FACT_MARKETSHARE_ALL")
    late = rows(mart.where("PER_DSC >= 202402").select("PER_DSC", "PDT_COD", "PDT_PCK", "KPI", "SO_VALUE"), "PER_DSC")
    assert [r[2:] for r in late] == [("PACK 1", "VOL", D(4)), ("NOT_ASSIGNED", "VAL", D(5))] and late[1][1] == 99
    # derived rows and periods cost no interpreted filter and no scan
    assert "lambda" not in plan(star.tall_fact(star.base_fact(mart), read["DIM_PROD"]))
    months = lineage._periods(loaded, "GOLD_DMT", "FACT_MARKETSHARE_ALL", mart)
    assert months.inputFiles() == [] and months.schema["PER_DSC"].dataType == mart.schema["PER_DSC"].dataType
    assert rows(months, "PER_DSC") == rows(mart.select("PER_DSC").distinct(), "PER_DSC")


def test_many_products_are_not_broadcast(warehouse, monkeypatch):
    """A broadcast holds every product at the driver, however small the files are: here products differ in their codes alone."""
    test_change.set_up(warehouse)
    given = {"PNL_C_COD": "concat('P', id)", "CNY_DSC": "'Acme'", "CAT_DSC": "'Milk'", "FOR_WGH": "'500g'", "LOA_DAT": "TIMESTAMP '2024-03-02 00:00:00'"}
    fields = inline_rows(warehouse.spark, STAGING["STG_PT_PRODUCT"], []).schema
    products = warehouse.spark.range(120_000).selectExpr(*[f"CAST({given.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])
    warehouse.append(products, "BRONZE_STG", "STG_PT_PRODUCT")
    test_change.staged(warehouse, "STG_PT_PANEL_C", [{"PDT_COD": c, "PER_DSC": "02/01/2024"} for c in ("c1", "P7", "P119999", "x")], test_change.amounts(20, 2))
    plans, write = {}, VersionedTable.write
    monkeypatch.setattr(VersionedTable, "write", lambda self, df, *a, **k: plans.update({self.path.rpartition("/")[2]: plan(df)}) or write(self, df, *a, **k))
    lineage.run(warehouse)
    plans["market"] = plan(lineage.market(warehouse, ["product", "value"])[0])
    keys = next(s for s in lineage.STEPS if s.table == "KEY_PROD")
    plans["KEY_PROD"] = plan(keys.rows({t: warehouse.read(layer, t) for t, layer in {**keys.reads, "KEY_PROD": "GOLD_STAR"}.items()}))
    for table, key in {"DIM_PROD": "PDT_COD", "KEY_PROD": "PDT_COD", "FACT_MARKETSHARE_ALL": "number", "FACT_TABLE": "product_id", "FLAT_FACT": "product_id",
                       "market": "product_id"}.items():
        assert re.search(rf"SortMergeJoin \[{key}#", plans[table]) and not re.search(rf"BroadcastHashJoin \[{key}#", plans[table]), table
    few = warehouse.read("GOLD_STAR", "KEY_CATEGORY")
    assert lookup.without_large_broadcast(few) is few
    flat = warehouse.read("GOLD_STAR", "FLAT_FACT").select("manufacturer", "metric", "value")
    assert sorted(tuple(r) for r in flat.collect()) == sorted(
        (m, k, v) for m, units in (("ACME", 3.0), ("ACME", 6.0), ("ACME", 6.0), ("NOT_ASSIGNED", 6.0))
        for k, v in (("Valor €", 20.0), ("Volumen Kg", 3.0), ("Volumen L", 3.0), ("Unidades", units)))


def test_a_stale_rollup_is_not_read(loaded):
    fact = loaded.read("GOLD_STAR", "FACT_TABLE")
    loaded.append(fact.limit(1), "GOLD_STAR", "FACT_TABLE", "period_id")
    assert rollups.sizes(loaded) == {}
    assert reads(rollups.market(loaded, ["manufacturer", "value"])[0], "FACT_TABLE")


def files_read(df):
    """Files that the scans of the executed plan have opened."""
    df.collect()
    found, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif "QueryStage" in name:
            stack.append(node.plan())
        else:
            if node.metrics().contains("numFiles") and "DynamicFileList" not in node.nodeName() and "kpi_flag_id" in str(node.relation().schema()):
                found += node.metrics().apply("numFiles").value()
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
    return found


def test_months_of_the_calendar_prune_at_run_time(loaded):
    fact, calendar = loaded.read("GOLD_STAR", "FACT_TABLE"), loaded.read("GOLD_STAR", "DIM_CALENDAR")
    some = periods.in_calendar(fact, calendar, "year = 2024 AND quarter = 1")
    assert "dynamicpruning" in plan(some).lower()
    assert {r.period_id for r in some.select("period_id").distinct().collect()} == {202401, 202402}
    total = some.groupBy("product_id").agg(F.sum("value").alias("v"))
    assert 0 < files_read(total) < files_read(fact.groupBy("product_id").agg(F.sum("value").alias("v")))


def test_subtotals_in_one_exchange(spark):
    data = [("a", "x", 1, 24300, 2.0), ("a", "y", 1, 24300, 3.0), ("b", None, 2, 24300, 4.0), (None, "x", 2, 24300, 5.0), ("b", "y", 1, 1, 50.0)]
    market = inline_rows(spark, "m string, c string, k int, pidx int, value double", data)
    sel = periods.resolve([2024], [12], "MES")
    out = reports.dynamic_report_with_subtotals(market, ["m", "c", "k"], sel)
    text = plan(out)
    got = sorted(map(tuple, out.collect()), key=str)
    want = [("a", "x", 1, 2.0, 3), ("a", "y", 1, 3.0, 3), ("b", None, 2, 4.0, 3), (None, "x", 2, 5.0, 3),
            ("a", "x", None, 2.0, 2), ("a", "y", None, 3.0, 2), ("b", None, None, 4.0, 2), (None, "x", None, 5.0, 2),
            ("a", None, None, 5.0, 1), ("b", None, None, 4.0, 1), (None, None, None, 5.0, 1), (None, None, None, 14.0, 0)]
    assert got == sorted(want, key=str)
    assert text.count("Exchange hashpartitioning") == 1 and "Union" not in text
    assert reports.dynamic_report_with_subtotals(market.filter("false"), ["m"], sel).count() == 0


KIND = "id int, name string, day date, amount decimal(9,2)"
GOOD = ['1,"a, b",2024-01-01,1.50', "2,,,", '3,"say ""x""",2024-01-03,-2']
BAD = {"4,short,2024-01-01": "too few fields: 3 of 4", "5,long,2024-01-01,1.0,more": "too many fields: 5 of 4", "x6,a,2024-01-01,1": "id: not a int",
       "7,a,yesterday,1": "day: not a date", '8,"q,r",2024-01-01,much': "amount: not a decimal(9,2)"}


def test_lines_set_aside(warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.csv").write_text("id,name,day,amount\n" + "\n".join([*GOOD, *list(BAD)[:3]]) + "\n")
    (folder / "two.csv").write_text("id,name,day,amount\n\n" + "\n".join(list(BAD)[3:]) + "\n9,last,2024-01-09,9\n")
    (folder / "none.csv").write_text("id,name,day,amount\n")
    good, rejected = quarantine.read_csv(warehouse.spark, str(folder), KIND)
    assert rows(good, "id") == [(1, "a, b", dt.date(2024, 1, 1), D("1.50")), (2, None, None, None), (3, 'say "x"', dt.date(2024, 1, 3), D("-2.00")),
                                (9, "last", dt.date(2024, 1, 9), D("9.00"))]
    assert {r.line: r.reason for r in rejected.collect()} == BAD
    files = {r.line: r.file.rsplit("/", 1)[1] for r in rejected.collect()}
    assert [files[x] for x in BAD] == ["one.csv"] * 3 + ["two.csv"] * 2
    assert rows(good.select("id"), "id") == [(1,), (2,), (3,), (9,)]  # the same lines, whatever is asked for
    counts = quarantine.load_csv(warehouse, str(folder), KIND, "BRONZE_STG", "LANDED")
    assert counts == {"rows": 4, "rejected": 5}
    assert warehouse.read("BRONZE_STG", "LANDED").count() == 4
    assert sum(r.lines for r in quarantine.reasons(warehouse.read("BRONZE_STG", "LANDED_REJECTED")).collect()) == 5
