"""Derived tables kept up by change, and dimensions that the runner makes itself."""

import datetime as dt
import decimal
import random

import pytest

from conftest import rows
from panelwright.operators import dictionary
from panelwright.plans import lineage, periods, reports
from panelwright.schemas import MAPPINGS, STAGING
from panelwright.sources.layers import Warehouse
from panelwright.sources.rows import inline_rows

D = decimal.Decimal
FACTS = [("GOLD_DMT", "FACT_NACIONAL", "PER_DSC"), ("GOLD_DMT", "FACT_TOP2", "PER_DSC"), ("GOLD_DMT", "FACT_MARKETSHARE_ALL", "PER_DSC"),
         ("GOLD_STAR", "FACT_TABLE", "period_id"), ("GOLD_STAR", "FLAT_FACT", "period_id")]
KEYS = ["KEY_PROD", "KEY_CATEGORY", "KEY_SOURCE"]
PRODUCTS = [{"PNL_C_COD": "c1", "CNY_DSC": "Acme", "CAT_DSC": "Milk", "ORG_DSC": "PANEL_C", "FOR_WGH": "1kg", "PDT_DSC": "One", "PDT_PCK": "pack 1"},
            {"PNL_C_COD": "c2", "CNY_DSC": "Bell", "CAT_DSC": "Tea", "ORG_DSC": "PANEL_B", "FOR_WGH": "500g", "PDT_DSC": "Two", "PDT_PCK": "pack 2"}]


def staged(warehouse, name, data, fixed=None, layer="BRONZE_STG"):
    fields = inline_rows(warehouse.spark, STAGING[name], []).columns
    warehouse.append(inline_rows(warehouse.spark, STAGING[name], [tuple({**(fixed or {}), **r}.get(c) for c in fields) for r in data]), layer, name)


def amounts(value, day):
    return {"SO_VALUES": D(value), "SO_UNITS": D(2), "SO_KILOS": D(3), "LOA_DAT": dt.datetime(2024, 3, day), "SOURCE_CODE": "file"}


def set_up(warehouse):
    maps = {"MAP_PT_CHANNEL": [("PANEL_C", "panel_c", 7), ("PANEL_B", "panel_b", 8)], "MAP_PT_SALES_TYPE": [("PANEL_C", "PANEL_C", 71)]}
    for name, schema in MAPPINGS.items():
        warehouse.replace(inline_rows(warehouse.spark, schema, maps.get(name, [])), "SILVER_DWH", name)
    for feed in ("MASS", "META", "PHARMA"):
        staged(warehouse, f"TRA_PT_PANEL_D_{feed}", [], layer="SILVER_TRA")
    for name in ("STG_PT_PANEL_B", "STG_PT_PANEL_A_FOOD", "STG_PT_PANEL_A_MILK"):
        staged(warehouse, name, [])
    warehouse.replace(inline_rows(warehouse.spark, "PDT_COD string, PNL_C_COD string, PNL_D_COD string, PNL_B_COD string",
                                  [("p1", "c1", None, "b1"), ("p2", "c2", None, None)]), "SILVER_TRA", "M_PT_PRODUCT_NACIONAL")
    warehouse.replace(inline_rows(warehouse.spark, "PDT_COD string, EAN_COD string, PNL_C_COD string, PNL_A_COD string, PNL_D_COD string",
                                  [("p1", None, "c1", "a1", None)]), "SILVER_TRA", "M_PT_PRODUCT_TOP2")
    staged(warehouse, "STG_PT_PRODUCT", PRODUCTS, {"LOA_DAT": dt.datetime(2024, 3, 1)})
    warehouse.replace(inline_rows(warehouse.spark, "PER_DSC int, BIRTH_RATE double", [(202401, 1.5), (202402, 1.6)]), "GOLD_DMT", "FACT_BIRTH_RATE")


FIRST = [{"PDT_COD": "c1", "PER_DSC": "01/01/2024"}, {"PDT_COD": "c2", "PER_DSC": "02/01/2024", "SO_VALUES": D(30)},
         {"PDT_COD": "nobody", "PER_DSC": "02/01/2024"}]


def content(warehouse, layer, table, but=("LOA_DAT",)):
    df = warehouse.read(layer, table)
    return sorted(map(str, df.select(*[c for c in sorted(df.columns) if c not in but]).collect()))


def parts(warehouse):
    return {t: warehouse.manifest(layer, t).parts for layer, t, _ in FACTS}


def numbers(warehouse):
    return {k: dict(warehouse.read("GOLD_STAR", k).collect()) for k in KEYS}


def test_from_staging_to_reports_without_a_written_dimension(warehouse):
    set_up(warehouse)
    staged(warehouse, "STG_PT_PANEL_C", FIRST, amounts(10, 1))
    lineage.run(warehouse)
    market, calendar = lineage.market(warehouse, ["manufacturer", "category", "metric", "pidx", "value"])
    table = reports.company_table(market.filter("metric = 'Valor €'"), periods.resolve([2024], [2], "MES"), calendar)
    assert {r["manufacturer"]: (r["sales"], r["has_prior"]) for r in table.collect()} == {
        "BELL": (30.0, True), "ACME": (0.0, True), "NOT_ASSIGNED": (10.0, True)}
    assert sorted({r["category"] for r in market.select("category").collect()}) == ["MILK", "NOT_ASSIGNED", "TEA"]
    litres = {r["manufacturer"]: r["value"] for r in market.filter("metric = 'Unidades'").collect()}
    assert litres["BELL"] == 6.0 and litres["ACME"] == 3.0  # three kilograms in packs of 500 g and of 1 kg
    channel = lineage.market(warehouse, ["channel", "sales_type"])[0].distinct()
    assert rows(channel, "channel") == [("PANEL_C", "PANEL_C")]
    assert rows(warehouse.read("GOLD_STAR", "FACT_BIRTH_RATE").select("period_id", "value"), "period_id") == [(202401, 1.5), (202402, 1.6)]


def test_a_new_period_is_all_that_is_written(warehouse, tmp_path):
    set_up(warehouse)
    staged(warehouse, "STG_PT_PANEL_C", FIRST, amounts(10, 1))
    lineage.run(warehouse)
    before, given = parts(warehouse), numbers(warehouse)
    assert not [t for t in lineage.run(warehouse) if t.startswith("GOLD")]  # nothing new: nothing is written
    assert parts(warehouse) == before and numbers(warehouse) == given
    third = [{"PDT_COD": "c1", "PER_DSC": "03/01/2024", "SO_VALUES": D(7)}]
    staged(warehouse, "STG_PT_PANEL_C", third, amounts(10, 2))
    lineage.run(warehouse)
    after = parts(warehouse)
    for _, table, period in FACTS:
        month = "20240301" if table in ("FACT_NACIONAL", "FACT_TOP2") else "202403"
        assert set(after[table]) - set(before[table]) == {f"{period}={month}"}, table
        assert {p: after[table][p] for p in before[table]} == before[table], table
    # a period delivered again, with another product
    again = [{"PDT_COD": "c2", "PER_DSC": "02/01/2024", "SO_VALUES": D(31)}]
    staged(warehouse, "STG_PT_PANEL_C", again, amounts(10, 3))
    lineage.run(warehouse)
    assert [p for p, loads in parts(warehouse)["FACT_TABLE"].items() if loads != after["FACT_TABLE"][p]] == ["period_id=202402"]
    assert numbers(warehouse) == given
    # the same from nothing
    other = Warehouse(warehouse.spark, root=str(tmp_path / "other"))
    set_up(other)
    staged(other, "STG_PT_PANEL_C", FIRST[:1], amounts(10, 1))
    staged(other, "STG_PT_PANEL_C", third, amounts(10, 2))
    staged(other, "STG_PT_PANEL_C", again, amounts(10, 3))
    lineage.run(other)
    for layer, table, _ in FACTS:
        assert content(warehouse, layer, table) == content(other, layer, table), table
    flat = warehouse.read("GOLD_STAR", "FLAT_FACT")
    lineage.export_flat(warehouse, str(tmp_path / "flat"))
    assert warehouse.spark.read.option("header", True).csv(str(tmp_path / "flat")).count() == flat.count() > 0


def test_a_changed_master_makes_all_anew(warehouse):
    set_up(warehouse)
    staged(warehouse, "STG_PT_PANEL_C", FIRST, amounts(10, 1))
    lineage.run(warehouse)
    given = numbers(warehouse)
    staged(warehouse, "STG_PT_PRODUCT", [{**PRODUCTS[0], "CNY_DSC": "Acme Two"}, {"PNL_C_COD": "nobody", "CNY_DSC": "Some", "CAT_DSC": "Tea"}],
           {"LOA_DAT": dt.datetime(2024, 3, 9)})
    lineage.run(warehouse)
    now = numbers(warehouse)
    assert all(now[k][m] == n for k in KEYS for m, n in given[k].items())
    assert set(now["KEY_PROD"]) - set(given["KEY_PROD"]) == {"NOBODY"} or set(now["KEY_PROD"]) - set(given["KEY_PROD"]) == {"nobody"}
    market, _ = lineage.market(warehouse, ["manufacturer"])
    assert "ACME TWO" in {r[0] for r in market.distinct().collect()}


def test_a_supplied_table_is_left_alone(warehouse):
    set_up(warehouse)
    staged(warehouse, "STG_PT_PANEL_C", FIRST, amounts(10, 1))
    mart = inline_rows(warehouse.spark, "PDT_COD int, CHL_COD int, SAL_TYP_COD int, CTG_COD int, PDT_PCK string, KPI string, SO_VALUE decimal(18,4), PER_DSC int",
                       [(1, 1, 1, 1, "x", "VAL", D(5), 202312)])
    warehouse.replace(mart, "GOLD_DMT", "FACT_MARKETSHARE_ALL", "PER_DSC")
    lineage.run(warehouse)
    assert warehouse.read("GOLD_DMT", "FACT_MARKETSHARE_ALL").count() == 1
    assert rows(warehouse.read("GOLD_STAR", "FACT_TABLE").select("period_id")) == [(202312,)]


def member_rows(spark, names):
    return spark.createDataFrame([(n,) for n in names], "member string")


def test_numbers_stay(spark):
    """Members come in several deliveries, with repeats; numbers are dense, stable and never 99."""
    pick = random.Random(4)
    known, seen = None, {}
    for size in (0, 60, 1, 80, 80):
        names = [f"m{pick.randint(0, 200)}" for _ in range(size)] + [None]
        added = dictionary.extended(member_rows(spark, names).repartition(3), known, "member", "number")
        again = dictionary.extended(member_rows(spark, names[::-1]), known, "member", "number")
        assert sorted(map(tuple, added.collect())) == sorted(map(tuple, again.collect()))
        seen |= dict(map(tuple, added.collect()))
        known = spark.createDataFrame(list(seen.items()), "member string, number int")
    count = len(seen)
    assert count > 110 and sorted(seen.values()) == [n for n in range(1, count + 2) if n != 99]
    looked_up = dictionary.number_of(member_rows(spark, ["m999", None]), known, "member", "number")
    assert [r.number for r in looked_up.collect()] == [99, 99]


@pytest.mark.parametrize("after", [97, 98, 100])
def test_99_is_kept(spark, after):
    got = dictionary.numbered(member_rows(spark, ["a", "b", "c"]), "member", "number", after)
    assert sorted(r.number for r in got.collect()) == [n for n in range(after + 1, after + 6) if n != 99][:3]
