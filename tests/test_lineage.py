"""From staging rows to a report through the warehouse."""

import datetime as dt
import decimal

from conftest import rows
from panelwright.plans import lineage, periods, reports
from panelwright.schemas import MAPPINGS, STAGING, star_schema
from panelwright.sources.rows import inline_rows


def put(warehouse, layer, table, schema, data):
    warehouse.append(inline_rows(warehouse.spark, schema, data), layer, table)


def staged(warehouse, name, schema, fixed, data, layer="BRONZE_STG"):
    """Rows given by the columns that matter; the rest is NULL."""
    fields = inline_rows(warehouse.spark, schema, []).columns
    put(warehouse, layer, name, schema, [tuple({**fixed, **r}.get(c) for c in fields) for r in data])


def test_staging_to_company_table(warehouse):
    d, stamp = decimal.Decimal, dt.datetime(2024, 3, 1)
    for name, schema in MAPPINGS.items():
        put(warehouse, "SILVER_DWH", name, schema, [])
    amounts = {"SO_VALUES": d(10), "SO_UNITS": d(2), "SO_KILOS": d(3), "LOA_DAT": stamp, "SOURCE_CODE": "file"}
    staged(warehouse, "STG_PT_PANEL_C", STAGING["STG_PT_PANEL_C"], amounts, [
        {"PDT_COD": "c1", "PER_DSC": "01/01/2024"}, {"PDT_COD": "c2", "PER_DSC": "02/01/2024", "SO_VALUES": d(30)}])
    staged(warehouse, "STG_PT_PANEL_B", STAGING["STG_PT_PANEL_B"], amounts, [{"PDT_COD": "b1", "PDT_PCK": "pack", "PER_DSC": "jan24"}])
    for feed in ("MASS", "META", "PHARMA"):
        name, schema = f"TRA_PT_PANEL_D_{feed}", STAGING[f"TRA_PT_PANEL_D_{feed}"]
        data = [{"PDT_COD": "d1", "PER_DSC": "202401"}] if feed == "MASS" else []
        staged(warehouse, name, schema, amounts, data, "SILVER_TRA")
    put(warehouse, "SILVER_TRA", "M_PT_PRODUCT_NACIONAL", "PDT_COD string, PNL_C_COD string, PNL_D_COD string, PNL_B_COD string",
        [("p1", "c1", None, "b1"), ("p2", "c2", None, None)])
    staged(warehouse, "STG_PT_PRODUCT", STAGING["STG_PT_PRODUCT"], {"LOA_DAT": stamp}, [{"PNL_C_COD": "c1"}])

    loaded = lineage.run(warehouse)
    assert {"FACT_PT_PANEL_C", "FACT_PT_PANEL_B", "FACT_PT_PANEL_D_UNION", "GOLD_DMT.FACT_NACIONAL", "GOLD_DMT.DIM_PRODUCT",
            "GOLD_DMT.DIM_CALENDAR_NACIONAL"} <= set(loaded)
    national = warehouse.read("GOLD_DMT", "FACT_NACIONAL")
    assert [(c, float(v)) for c, v in rows(national.select("PDT_COD", "SAL_VAL"), "PDT_COD", "SAL_VAL")] == [("c1", 10.0), ("c1", 10.0), ("c2", 30.0), ("d1", 10.0)]

    # the consolidated mart takes product numbers; its volume and value rows come from the national fact
    ids = inline_rows(warehouse.spark, "code string, id int", [("c1", 1), ("c2", 2)])
    mart = national.join(ids, national["PDT_COD"] == ids["code"]).selectExpr(
        "CAST(substr(PER_DSC, 1, 6) AS INT) AS PER_DSC", "id AS PDT_COD", "1 AS CHL_COD", "1 AS SAL_TYP_COD", "1 AS CTG_COD", "'x' AS PDT_PCK",
        "stack(2, 'VOL', SAL_WGT, 'VAL', SAL_VAL) AS (KPI, SO_VALUE)")
    warehouse.replace(mart, "GOLD_DMT", "FACT_MARKETSHARE_ALL", "PER_DSC")
    products = [{"product_id": 1, "manufacturer": "A", "format": "1kg", "conversor_lkg": 1.0}, {"product_id": 2, "manufacturer": "B", "format": "1kg", "conversor_lkg": 1.0}]
    fields = inline_rows(warehouse.spark, star_schema("DIM_PROD"), []).columns
    warehouse.replace(inline_rows(warehouse.spark, star_schema("DIM_PROD"), [tuple(p.get(c) for c in fields) for p in products]), "GOLD_STAR", "DIM_PROD")
    assert "GOLD_STAR.FACT_TABLE" in lineage.run(warehouse)
    market, calendar = lineage.market(warehouse, ["manufacturer", "metric", "pidx", "value"])
    table = reports.company_table(market.filter("metric = 'Valor €'"), periods.resolve([2024], [2], "MES"), calendar)
    assert [(r["manufacturer"], r["sales"], r["has_prior"]) for r in table.collect()] == [("B", 30.0, True), ("A", 0.0, True)]
