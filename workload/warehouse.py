"""Loads that run through a warehouse: several deliveries into a table of commits, and what it holds afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.plans import lineage, panels, reports, rollups
from panelwright.schemas import STAGING as LANDED
from panelwright.session import shared_folder
from panelwright.sources import star_csv
from panelwright.sources.layers import Warehouse
from panelwright.sources.rows import empty_table
from panelwright.streaming.reload import start_panel_stream

from .bi import selection
from .ingest import CUT, KEYS, OUTPUT, PT_MAPS, _columns, _d_body, _doubles, _sql_doubles, _union_sql, sql_latest
from .registry import SQL, add, rounded, table
from .staging import MAPPINGS, STAGING, base, mapping, sql_base, staging
from .star_queries import SQL_FACT, fact_rows
from .star_view import sql_wide

SECOND_CUT = "TIMESTAMP '2001-02-28 00:00:00'"


def scratch(spark: SparkSession) -> Warehouse:
    """A new warehouse in the shared folder, with the mappings of the panels."""
    warehouse = Warehouse(spark, root=f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}")
    for name in MAPPINGS:
        warehouse.replace(mapping(spark, name), "SILVER_DWH", name)
    return warehouse


# ---- a panel in three deliveries; the second has nothing but totals for the first quarters ------------

MILK_IN_MONTHS = {
    **STAGING["STG_PT_PANEL_A_MILK"],
    "PDT_DSC": f"CASE WHEN ln = 7 OR (mon <= 3 AND loa > {CUT} AND loa <= {SECOND_CUT}) THEN 'TOTAL' ELSE concat('Item ', ln) END",
    "PER_INI": "CASE WHEN ln = 2 AND rf = 'R' THEN 'soon' ELSE concat('01/', mm, '/', yy) END",
}
MILK_COLUMNS = ", ".join(f"{e} AS {n}" for n, e in MILK_IN_MONTHS.items())
DELIVERIES = [f"LOA_DAT <= {CUT}", f"LOA_DAT > {CUT} AND LOA_DAT <= {SECOND_CUT}", f"LOA_DAT > {SECOND_CUT}"]


def reload_after_emptied_period(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries, each loaded when it is there, the last one twice."""
    warehouse, panel = scratch(spark), panels.PANELS["PANEL_A_MILK"]
    rows = base(spark, sf).selectExpr(*[f"{e} AS {n}" for n, e in MILK_IN_MONTHS.items()])
    for delivered in DELIVERIES:
        warehouse.append(rows.filter(delivered), panel.staging_layer, panel.staging)
        panels.run(panel, warehouse)
    panels.run(panel, warehouse)
    return _doubles(warehouse.read(panel.target_layer, panel.target))


MILK_PERIOD = "TRY_CAST(strftime(try_strptime(PER_INI, '%d/%m/%Y'), '%Y%m%d') AS INTEGER)"
MILK_KEYS = ["PDT_DSC", "PDT_COD", "PER_ALL", "PER_INI", "PER_FIN"]
MILK_OUTPUT = ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SO_VALUES", "SO_UNITS", "SO_KILOS", "SOURCE_CODE", "LOA_DAT"]


def _milk(number: int) -> str:
    latest = sql_latest("stg", MILK_KEYS, list(MILK_IN_MONTHS), f"PDT_DSC <> 'TOTAL' AND ({DELIVERIES[number - 1]})")
    return (f"b{number} AS (SELECT PDT_COD, 12 AS CHL_COD, 99 AS SAL_TYP_COD, 'PANEL_A_MILK' AS SRC_DSC, {MILK_PERIOD} AS PER_DSC, "
            f"SO_VALUES, SO_UNITS, SO_KILOS, SOURCE_CODE, LOA_DAT FROM ({latest}) AS l{number}), "
            f"g{number} AS (SELECT DISTINCT {MILK_PERIOD} AS PER_DSC FROM stg WHERE {DELIVERIES[number - 1]})")


def _reloaded(target: str, number: int) -> str:
    return (f"SELECT * FROM {target} WHERE NOT EXISTS (SELECT 1 FROM g{number} WHERE g{number}.PER_DSC = {target}.PER_DSC) "
            f"UNION ALL SELECT * FROM b{number}")


add("reload_after_emptied_period", reload_after_emptied_period, f"""
WITH {sql_base()}, stg AS (SELECT {MILK_COLUMNS} FROM base), {_milk(1)}, {_milk(2)}, {_milk(3)},
t2 AS ({_reloaded('b1', 2)}), t3 AS ({_reloaded('t2', 3)})
{_sql_doubles('SELECT * FROM t3', MILK_OUTPUT)}""")


# ---- an append-only panel, with each delivery replayed ------------------------------------------------

def append_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of an append-only panel as micro-batches, each sent again after the next one."""
    from panelwright.sources.versions import Receipt

    warehouse, panel = scratch(spark), panels.PANELS["PANEL_F"]
    rows = base(spark, sf).selectExpr(*[f"{e} AS {n}" for n, e in STAGING["STG_ES_PANEL_F"].items()])
    maps = {m: mapping(spark, m) for m in MAPPINGS}
    for batch in (0, 1, 0, 2, 1, 2):
        loaded = panels.load(panel, {panel.staging: rows.filter(DELIVERIES[batch])}, maps)
        warehouse.append(loaded, panel.target_layer, panel.target, "PER_DSC", Receipt(query="deliveries", batch=batch))
    return _doubles(warehouse.read(panel.target_layer, panel.target))


F_KEYS = ["MKT_DSC", "GEO_DSC", "CAT_DSC", "PER_DSC", "KPI_FLG"]
F_OUTPUT = ["PDT_COD", "PDT_PCK", "CHL_COD", "SAL_TYP_COD", "KPI_FLG_COD", "KPI_VAL", "PER_DSC", "SRC_COD", "SRC_DSC_ORG", "LOA_DAT"]


def _sent(number: int) -> str:
    latest = sql_latest("stg", F_KEYS, list(STAGING["STG_ES_PANEL_F"]), DELIVERIES[number])
    return (f"SELECT sha256(upper(trim(CAT_DSC))) AS PDT_COD, upper(trim(CAT_DSC)) AS PDT_PCK, 51 AS CHL_COD, 61 AS SAL_TYP_COD, "
            f"CASE upper(trim(KPI_FLG)) WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 99 END AS KPI_FLG_COD, coalesce(KPI_VAL, 0) AS KPI_VAL, "
            f"PER_DSC, 2 AS SRC_COD, SRC_DSC_ORG, LOA_DAT FROM ({latest}) AS s{number}")


add("append_exactly_once", append_exactly_once, f"""
WITH {sql_base()}, stg AS (SELECT {', '.join(f'{e} AS {n}' for n, e in STAGING['STG_ES_PANEL_F'].items())} FROM base)
{_sql_doubles(' UNION ALL '.join(_sent(k) for k in range(3)), F_OUTPUT)}""")


# ---- three feeds as a stream, the third one late -------------------------------------------------------

D_MONTH = "substr(PER_DSC, 1, 6)"


def stream_panel_d_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two feeds deliver everything, then the third in two parts. A month is loaded when the third has delivered it; what
    comes of it later waits for the other two."""
    warehouse, panel = scratch(spark), panels.PANELS["PANEL_D_UNION"]
    maps = {m: mapping(spark, m) for m in MAPPINGS}
    rows = {tag: staging(spark, sf, name) for tag, name in panel.feed_sources.items()}
    late = rows["PANEL_D_PHARMA"]
    arrivals = [{**rows, "PANEL_D_PHARMA": late.filter("false")}, {"PANEL_D_PHARMA": late.filter(f"LOA_DAT <= {CUT}")},
                {"PANEL_D_PHARMA": late.filter(f"LOA_DAT > {CUT}")}]
    for delivered in arrivals:
        for tag, feed in delivered.items():
            warehouse.append(feed, panel.staging_layer, panel.feed_sources[tag])
        start_panel_stream(panel, warehouse, maps, f"{warehouse.root}/_checkpoint").awaitTermination()
    return _doubles(warehouse.read(panel.target_layer, panel.target).select(*panel.output))


add("stream_panel_d_union", stream_panel_d_union, f"""
WITH {sql_base()}, stg AS ({_union_sql('TRA_PT_')}), {PT_MAPS},
have AS (SELECT {D_MONTH} AS m, bool_or(SRC_DSC = 'PANEL_D_MASS') AND bool_or(SRC_DSC = 'PANEL_D_META') AND bool_or(SRC_DSC = 'PANEL_D_PHARMA') AS whole,
  bool_or(SRC_DSC = 'PANEL_D_PHARMA' AND LOA_DAT <= {CUT}) AS early FROM stg GROUP BY 1),
arrived AS (SELECT stg.* FROM stg JOIN have ON {D_MONTH} = m WHERE whole AND NOT (early AND SRC_DSC = 'PANEL_D_PHARMA' AND LOA_DAT > {CUT})),
latest AS ({sql_latest('arrived', KEYS['PANEL_D_UNION'], [*_columns('TRA_PT_PANEL_D'), 'SRC_DSC'], 'true')})
{_sql_doubles(_d_body, OUTPUT['PANEL_D_UNION'])}""")


# ---- the star fact through CSV files -------------------------------------------------------------------

def star_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The star fact written as CSV under the header names of the extract, and read back."""
    folder = f"{shared_folder(spark)}/star-csv-{uuid.uuid4().hex}"
    star_csv.write_csv(star_csv.with_star_headers(fact_rows(spark, sf), "FACT_TABLE"), f"{folder}/FACT_TABLE.csv")
    return star_csv.read_star_csv(spark, folder, "FACT_TABLE")


add("star_csv_round_trip", star_csv_round_trip, f"WITH {SQL_FACT} SELECT * FROM fact")


# ---- from landed files to a report, by the runner ------------------------------------------------------

# The code 99 is the master's own, for what is not assigned: parts get codes of another form.
PANEL_C = {**STAGING["STG_PT_PANEL_C"], "PDT_COD": "concat('P', partk)",
           "PER_DSC": "concat(lpad(concat(CAST(floor((mon - 1) / 3) * 3 + 1 AS INT), ''), 2, '0'), '/01/', yy)"}  # by quarter
PANEL_C_COLUMNS = ", ".join(f"{e} AS {n}" for n, e in PANEL_C.items())
PRODUCT = {"PNL_C_COD": "concat('P', p_partkey)", "CNY_DSC": "p_brand", "CAT_DSC": "p_type", "PDT_DSC": "p_name", "FOR_WGH": "'1kg'",
           "ORG_DSC": "'PANEL_C'", "SRC_DSC_ORG": "'parts'", "LOA_DAT": "TIMESTAMP '2001-09-01 00:00:00'"}


def staging_to_report(spark: SparkSession, sf: str) -> DataFrame:
    """Panel C and the product master land in two deliveries; the runner loads panels, gold facts, dimensions with their
    numbers, star and rollups; the company report reads the smallest rollup."""
    warehouse = scratch(spark)
    for name in ("STG_PT_PANEL_B", *panels.PANELS["PANEL_D_UNION"].feed_sources.values()):
        layer = "BRONZE_STG" if name.startswith("STG") else "SILVER_TRA"
        warehouse.append(empty_table(spark, LANDED[name]), layer, name)
    warehouse.replace(empty_table(spark, "PDT_COD string, PNL_C_COD string, PNL_D_COD string, PNL_B_COD string"), "SILVER_TRA", "M_PT_PRODUCT_NACIONAL")
    columns = empty_table(spark, LANDED["STG_PT_PRODUCT"]).schema
    products = table(spark, sf, "part").selectExpr(*[f"CAST({PRODUCT.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in columns])
    warehouse.append(products, "BRONZE_STG", "STG_PT_PRODUCT")
    rows = base(spark, sf).selectExpr(*[f"{e} AS {n}" for n, e in PANEL_C.items()])
    # the second delivery has whole months of its own, so that it adds to the first and replaces nothing
    for months in ("substr(PER_DSC, 7, 4) < '2000'", "substr(PER_DSC, 7, 4) >= '2000'"):
        landed = rows.filter(months)
        if "<" in months:
            landed = landed.withColumn("LOA_DAT", F.expr(f"least(LOA_DAT, {CUT})"))
        else:
            landed = landed.withColumn("LOA_DAT", F.expr("greatest(LOA_DAT, TIMESTAMP '2001-01-01 00:00:00')"))
        warehouse.append(landed, "BRONZE_STG", "STG_PT_PANEL_C")
        lineage.run(warehouse)
    market, calendar = rollups.market(warehouse, ["manufacturer", "metric", "pidx", "value"])
    out = reports.company_table(reports.apply_filters(market, "Valor €"), selection(), calendar.select("pidx", "period_id"))
    return rounded(out, sales=4, share=8, bps=4, growth=4, pct_growth=8)


_latest_c = sql_latest("stg", KEYS["PANEL_C"], list(PANEL_C), "true")
_sold = (f"{sql_base()}, stg AS (SELECT {PANEL_C_COLUMNS} FROM base), latest AS ({_latest_c}), "
         "wf AS (SELECT upper(trim(p_brand)) AS manufacturer, CAST(substr(PER_DSC, 7, 4) AS INTEGER) * 12 + CAST(substr(PER_DSC, 1, 2) AS INTEGER) AS pidx, "
         "SO_VALUES AS value FROM latest JOIN part ON concat('P', p_partkey) = PDT_COD)")
add("staging_to_report", staging_to_report, SQL["company_table"].replace(sql_wide(), _sold))
